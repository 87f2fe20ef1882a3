"""User-defined functions: SQL, Python and vectorised forms of the same work.

Spark's own functions are always faster; these exist for code that must be
called by name from SQL or that has no built-in twin.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_letter(text: str) -> str | None:
    return text[0] if text else None


first_letter_udf = F.udf(first_letter, useArrow=False)


@F.udf(T.StringType())
def first_letter_typed(text: str) -> str | None:
    return text[0] if text else None


@F.pandas_udf(T.StringType())
def first_letter_batch(text: pd.Series) -> pd.Series:
    return text.str[0]


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL text in this session."""
    spark.udf.register("mr_first_letter", first_letter_udf)
    spark.udf.register("mr_first_letter_batch", first_letter_batch)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mr_price_tag(name STRING, price DOUBLE) RETURNS STRING "
        "COMMENT 'Name of an item and its price with tax' "
        "RETURN concat(upper(name), ': ', round(price * 1.19, 0), ' with tax')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mr_size_note(name STRING, size INT) RETURNS STRING "
        "RETURN CASE WHEN name LIKE '%ring' THEN 'jewellery' WHEN size > 40 THEN concat('bulky ', name) "
        "ELSE concat('small ', name) END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mr_mask(x STRING) RETURNS STRING "
        "RETURN concat(repeat('*', greatest(length(x) - 2, 0)), right(x, 2))"
    )
