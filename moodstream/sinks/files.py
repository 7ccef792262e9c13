"""Write comments and results as CSV, JSON and parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.operators.rollups import negative_users


def _on_one_line(name: str) -> Column:
    doubled = F.replace(F.col(name), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")).alias(name)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", partition: str | None = None,
    rows_per_file: int = 1_000_000, bom: bool = False, escape_breaks: bool = False,
) -> None:
    """CSV with a header; quotes, line breaks and blanks at the ends survive.

    Null is written as nothing and an empty text as ``""``, so a reader can tell them apart.

    Files with quoted line breaks cannot be split by readers, so their length is limited;
    ``escape_breaks`` writes breaks as ``\\n`` and ``\\r`` and a backslash doubled, which keeps every row on
    one line. With ``bom`` every file starts with a byte order mark, which spreadsheet programs look for.
    """
    if escape_breaks:
        df = df.select(*[_on_one_line(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])
    if bom:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
    )
    if partition:
        writer = writer.partitionBy(partition)
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition: str | None = None) -> None:
    """JSON lines."""
    writer = df.write.mode(mode)
    if partition:
        writer = writer.partitionBy(partition)
    writer.json(path)


def write_scored(df: DataFrame, path: str, mode: str = "append") -> None:
    """Scored rows as parquet, one folder per class, so a class is read without the others."""
    df.write.mode(mode).partitionBy("class").parquet(path)


def write_archive(df: DataFrame, path: str, batch: str, mode: str = "append") -> None:
    """Scored rows as JSON text lines, one folder per batch number.

    Batches never share a folder, so none replaces another. Rows are brought together by batch
    first, with small batches put in one task and a big one split over many by its size, so there
    are neither tiny files nor one task that writes a third of the data.
    """
    rest = [c for c in df.columns if c != batch]
    lines = df.select(batch, F.to_json(F.struct(*rest)).alias("value"))
    lines.hint("rebalance", F.col(batch)).write.mode(mode).partitionBy(batch).text(path)


def write_arrays(df: DataFrame, path: str, batch: str, order: str, item: Column, mode: str = "append") -> None:
    """Batches as JSON lines, each the batch's number and the array of its items in order.

    A batch must be bounded, as it becomes one row; callers cut batches by a number of rows. Batches are dealt by number,
    and a file takes as many as its task has, so small batches make no files of their own.
    """
    rows = df.select(F.col(batch).cast("long").alias("batch"), F.struct(F.col(order).alias("at"), item.alias("item")).alias("e"))
    arrays = rows.groupBy("batch").agg(F.sort_array(F.collect_list("e")).alias("e"))
    arrays.select("batch", F.col("e.item").alias("items")).write.mode(mode).json(path)


def write_negative_users(
    df: DataFrame, path: str, user: str = "UserID", comment: str | None = None
) -> None:
    """Replace the table of users with negative comments, one row per comment.

    With ``comment`` the text goes along.
    """
    if comment:
        rows = df.filter(F.col("class") == "negative").select(user, comment)
    else:
        rows = negative_users(df, user)
    rows.write.mode("overwrite").parquet(path)


def preview(df: DataFrame, n: int = 5, truncate: int | bool = 30) -> None:
    """Print schema and first rows. This runs a job."""
    df.printSchema()
    df.show(n, truncate)
