"""Table contracts: expected landing names, staged types and warehouse keys.

One ``StructType`` per entity replaces the loader's name set and the view's
cast list.  Landing files are read as strings; ``typed_projection`` casts
every contract column once (ANSI cast: bad input raises, as a strict
warehouse load should).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference: the open-interval sentinel, the
# outlier bound, the statuses that end validity and the in-delivery status.
OPEN_END = _dt.date(9999, 12, 31)
USAGE_OUTLIER_BOUND = 15000
INVALID_STATUSES = ("cancelled", "terminated")
IN_DELIVERY = "indelivery"
NO_DATA = "no_data"
BASE_COMPONENT = 1
WORKING_COMPONENT = 2

# Expected landing column names per entity.
EXPECTED_COLUMNS = {
    "products": ["id", "deleted", "releasedversion", "productcode", "productname",
                 "energy", "consumptiontype", "modificationdate"],
    "prices": ["id", "productid", "pricecomponentid", "pricecomponent", "price",
               "unit", "valid_from", "valid_until", "modificationdate"],
    "contracts": ["id", "type", "energy", "usage", "usagenet", "createdat", "startdate",
                  "enddate", "filingdatecancellation", "cancellationreason", "city",
                  "status", "productid", "modificationdate"],
}

PRICE_DECIMAL = T.DecimalType(38, 10)

# Staged column types per entity, in staging-view order.
STAGING_TYPES = {
    "products": [
        ("id", T.LongType()), ("deleted", T.ShortType()), ("releasedversion", T.StringType()),
        ("productcode", T.StringType()), ("productname", T.StringType()),
        ("energy", T.StringType()), ("consumptiontype", T.StringType()),
        ("modificationdate", T.DateType()),
    ],
    "prices": [
        ("id", T.LongType()), ("productid", T.IntegerType()), ("pricecomponentid", T.IntegerType()),
        ("pricecomponent", T.StringType()), ("price", PRICE_DECIMAL), ("unit", T.StringType()),
        ("valid_from", T.DateType()), ("valid_until", T.DateType()),
        ("modificationdate", T.DateType()),
    ],
    "contracts": [
        ("id", T.LongType()), ("type", T.StringType()), ("energy", T.StringType()),
        ("usage", T.IntegerType()), ("usagenet", T.IntegerType()), ("createdat", T.DateType()),
        ("startdate", T.DateType()), ("enddate", T.DateType()),
        ("filingdatecancellation", T.DateType()), ("cancellationreason", T.StringType()),
        ("city", T.StringType()), ("status", T.StringType()), ("productid", T.IntegerType()),
        ("modificationdate", T.DateType()),
    ],
}

# Unique keys of the warehouse tables (checked by operators.checks).
TABLE_KEYS = {
    "products": ["product_id", "valid_from"],
    "prices": ["price_id", "modificationdate"],
    "contracts": ["contract_id", "modificationdate"],
    "price_periods": ["snapshot_date", "product_id", "valid_from", "valid_until"],
    "contract_price_enriched": ["contract_id", "productid", "period_start"],
}

NOT_NULL = {
    "products": ["product_id", "valid_from", "modificationdate"],
    "prices": ["price_id", "product_id", "pricecomponentid", "valid_from", "valid_until",
               "modificationdate"],
    "contracts": ["contract_id", "product_id", "startdate", "status", "modificationdate",
                  "snapshot_date", "valid_from", "valid_until"],
    "price_periods": ["snapshot_date", "product_id", "valid_from", "valid_until"],
    "contract_price_enriched": ["contract_id", "productid", "period_start", "period_end",
                                "startdate", "createdat", "final_end"],
}


# Cell texts that the usual CSV readers take as missing.
MISSING_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _typed(src: Column, current: T.DataType, dtype: T.DataType, missing_as_null: bool, lenient: bool
           ) -> tuple[Column, Column | None]:
    """A column cast to its contract type, and the text it was cast from (None if it was no text).

    ``lenient`` gives null where the text does not fit instead of failing.
    """
    def to(c: Column, t: T.DataType | str) -> Column:
        return c.try_cast(t) if lenient else c.cast(t)

    if not isinstance(current, T.StringType):
        return to(src, dtype), None
    text = F.trim(src)  # blank landing cells are missing values
    text = F.when(~text.isin(*MISSING_WORDS), text)
    if missing_as_null and not isinstance(dtype, T.StringType):
        text = F.when(text == NO_DATA, F.lit(None).cast("string")).otherwise(text)
    if isinstance(dtype, T.StringType):
        return text, text
    if isinstance(dtype, T.DateType):
        return to(to(text, "timestamp_ntz"), "date"), text
    if isinstance(dtype, T.IntegralType):
        return to(F.round(to(text, "decimal(38,10)")), dtype), text
    return to(text, dtype), text


def typed_projection(df: DataFrame, entity: str, keep: tuple[str, ...] = ("source_table",),
                     missing_as_null: bool = False, rejects: str | None = None) -> DataFrame:
    """Cast every contract column; absent optional columns become typed nulls.

    Text dates are cast as a whole through a timestamp, so ``2020-08-27`` and
    ``2020-08-27 00:00:00`` are dates and trailing garbage fails the cast.
    Whole numbers may be written with a fraction (``3650.0``).  The usual words
    for a missing value (MISSING_WORDS) are missing, as blanks are.
    A ``no_data`` fill in a non-text column fails the cast, as coded;
    ``missing_as_null=True`` (Q28) reads it as null instead.

    ``rejects`` names a further column, an array of (column, text, reason) of
    the cells that do not fit; such cells are null then and nothing fails.
    """
    present = set(df.columns)
    cols: list[Column] = []
    bad: list[Column] = []
    for name, dtype in STAGING_TYPES[entity]:
        if name not in present:
            cols.append(F.lit(None).cast(dtype).alias(name))
            continue
        value, text = _typed(F.col(name), df.schema[name].dataType, dtype, missing_as_null, rejects is not None)
        cols.append(value.alias(name))
        if text is not None and not isinstance(dtype, T.StringType):
            bad.append(F.when(text.isNotNull() & value.isNull(), F.struct(
                F.lit(name).alias("column"), F.col(name).alias("text"),
                F.lit(f"not a {dtype.simpleString()}").alias("reason"))))
    for extra in keep:
        if extra in present:
            cols.append(F.col(extra))
    if rejects is not None:
        found = F.array_compact(F.array(*bad)) if bad else F.array()
        cols.append(found.cast("array<struct<column:string,text:string,reason:string>>").alias(rejects))
    return df.select(*cols)
