"""Join of a large, skewed table with a table of unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    rows_per_key: str,
    spread_by: str,
    rows_per_salt: int = 5_000_000,
) -> DataFrame:
    """Inner join of ``facts`` with ``lookup`` (one row per key) where some keys are very frequent.

    ``lookup`` knows the frequency of each key in ``rows_per_key``. A key with more than
    ``rows_per_salt`` rows is hot: its facts are spread over ``rows / rows_per_salt`` salts by hashing
    ``spread_by``, and its lookup row is repeated once per salt. So no join task gets more than about
    ``rows_per_salt`` rows of one key, whatever the data size. No broadcast is forced: Spark sends the
    hot keys to all tasks while they are below its size limit, and joins them by a skew-split shuffle
    beyond it.
    """
    replicas = F.ceil(F.col(rows_per_key) / F.lit(float(rows_per_salt))).cast("int")
    sized = lookup.withColumn("_salts", F.greatest(replicas, F.lit(1)))
    hot = sized.filter(F.col("_salts") > 1).select(key, "_salts")
    salted_facts = facts.join(hot, key, "left").select(
        *facts.columns,
        F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_salts")), F.lit(0)).cast("int").alias("_salt"),
    )
    salted_lookup_rows = sized.select(
        *lookup.columns, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")
    )
    return salted_facts.join(salted_lookup_rows, [key, "_salt"]).drop("_salt")
