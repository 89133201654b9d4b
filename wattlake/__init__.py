"""wattlake: a Spark-native snapshot warehouse.

Monthly CSV snapshots of products, prices and contracts are reconciled
against an expected schema, staged with their lineage, historised as
type-2 versions, cut into price periods and turned into a per-contract
period revenue mart.  Every step is a function ``DataFrame(s) -> DataFrame``
planned by Catalyst; keys, tie-breaks and dates are explicit arguments so
that results never depend on row order or on the wall clock.
"""

__version__ = "0.1.0"
