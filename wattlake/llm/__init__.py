"""Training-data operators: one module per operator, plus their registered queries.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries only when it is present.
"""
