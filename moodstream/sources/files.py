"""CSV tables, JSON archives, word lists and parquet tables."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream import schemas
from moodstream.functions.messages import scored_comment, unnest
from moodstream.operators.basics import union_by_name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a folder of tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Lines in which a header must end; one that does not is an error.
HEADER_LINES = 20

# A null marker no text equals: then only a missing value is null, and "" stays an empty text.
_NEVER = "\x00null\x00"


def _csv_reader(spark: SparkSession, multi_line: bool, encoding: str, empty_is_null: bool):
    return (
        spark.read.option("header", True)
        .option("nullValue", "" if empty_is_null else _NEVER)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = schemas.LABELLED,
    multi_line: bool = False,
    encoding: str = "UTF-8",
    empty_is_null: bool = True,
    escaped_breaks: bool = False,
) -> DataFrame:
    """CSV with a header and a fixed schema, bound by position.

    Rows that do not fit the schema, such as text with an unquoted comma, keep their source line in
    the ``_bad_row`` column instead of shifting text into the next column unseen. Large files are split;
    those with line breaks inside quotes cannot be, and need ``multi_line=True``. ``escaped_breaks``
    reads breaks that ``write_csv`` wrote as escapes. Quoted empty text is read as null unless
    ``empty_is_null`` is off.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    rows = (
        _csv_reader(spark, multi_line, encoding, empty_is_null)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .schema(with_bad)
        .csv(path)
    )
    return with_breaks(rows) if escaped_breaks else rows


def fitting_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


def bad_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(schemas.CORRUPT).isNotNull())


def scoring_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, escaped_breaks: bool = False
) -> DataFrame:
    """One-column CSV of texts to score, every row of it.

    A line with an unquoted comma is one text, comma included, and an empty text stays empty. ``escaped_breaks`` is
    as in ``csv_table``.
    """
    read = csv_table(spark, path, schemas.UNLABELLED, multi_line, empty_is_null=False)
    text = F.coalesce(schemas.CORRUPT, *[F.col(f.name) for f in schemas.UNLABELLED.fields])
    rows = read.select(text.alias(schemas.UNLABELLED.fields[0].name))
    return with_breaks(rows) if escaped_breaks else rows


def csv_headers(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(file, header)``: the header of every file of a folder, the first record of its first split.

    A header whose quotes are still open at the end of its line goes on in the next one. One that is not closed
    within ``HEADER_LINES`` lines is an error.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        .filter(F.col("start") == 0)
        .withColumn("at", F.monotonically_increasing_id())
    )
    first = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    few = lines.withColumn("n", first).filter(F.col("n") <= HEADER_LINES)
    whole = few.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("lines"))
    joined = F.aggregate(
        "lines",
        F.lit(None).cast("string"),
        lambda text, line: F.when(text.isNull(), line["value"])
        .when(F.length(F.regexp_replace(text, '[^"]', "")) % 2 == 1, F.concat_ws("\n", text, line["value"]))
        .otherwise(text),
    )
    is_open = F.length(F.regexp_replace("header", '[^"]', "")) % 2 == 1
    endless = F.raise_error(F.concat(F.lit(f"the header is not closed after {HEADER_LINES} lines in "), F.col("file")))
    found = whole.select("file", F.regexp_replace(joined, "^\\uFEFF", "").alias("header"))
    return found.select("file", F.when(is_open, endless).otherwise(F.col("header")).alias("header"))


def merged_csv(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    multi_line: bool = False,
    empty_is_null: bool = True,
    layouts: Mapping[str, Sequence[str]] | None = None,
    escaped_breaks: bool = False,
) -> DataFrame:
    """All CSV files of one folder as one table, matched by column name, all columns strings.

    ``layouts`` maps file name patterns to their columns, for one pass over the data; Spark checks the
    names against each file's header. Without it the headers are looked up first, which reads the first
    split of every file; the driver then holds file names, as it does for any read. A folder that cannot
    be read is an error.
    """
    if layouts is None:
        found: dict[str, list[str]] = {}
        for row in csv_headers(spark, folder, pattern).toLocalIterator():
            found.setdefault(row["header"], []).append(row["file"])
        if not found:
            raise FileNotFoundError(f"no {pattern} files in {folder}")
        reads = [(_header_names(h), None, sorted(names)) for h, names in sorted(found.items())]
    else:
        reads = [(list(names), glob, folder) for glob, names in sorted(layouts.items())]
    frames = []
    for names, glob, paths in reads:
        reader = _csv_reader(spark, multi_line, "UTF-8", empty_is_null).option("enforceSchema", glob is None)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frames.append(reader.schema(schema).csv(paths))
    merged = union_by_name(frames)
    return with_breaks(merged) if escaped_breaks else merged


def _header_names(header: str) -> list[str]:
    return next(csv.reader(io.StringIO(header, newline="")))


def with_breaks(df: DataFrame) -> DataFrame:
    """Undo ``sinks.files.write_csv(escape_breaks=True)`` in all text columns."""

    def undo(name: str) -> Column:
        # Between doubled backslashes a backslash can only open a break; joining puts single ones back.
        parts = F.split(name, r"\\\\", -1)
        whole = F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))), "\\")
        return F.when(F.col(name).contains("\\"), whole).otherwise(F.col(name)).alias(name)

    return df.select(*[undo(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])


def json_archive(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Files that are one JSON array each, as ``(file, pos, item)`` rows with items as text."""
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.from_json("value", T.ArrayType(T.StringType())).alias("items"),
        )
    )
    return unnest(files, "items")


def array_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived batches as ``sinks.files.write_arrays`` wrote them, decoded twice: ``(batch, pos, UserID, Sentence, prediction)``.

    A file holds many batches, one on a line, so it can be split, and the files are as many as the data is large.
    """
    lines = spark.read.schema("batch long, items array<string>").json(path)
    return unnest(lines, "items").select("batch", "pos", scored_comment(F.col("item")).alias("c")).select("batch", "pos", "c.*")


def scored_archive(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Archived scored batches, decoded twice, as ``(file, pos, UserID, Sentence, prediction)``."""
    return json_archive(spark, path, pattern).select(
        "file", "pos", scored_comment(F.col("item")).alias("c")
    ).select("file", "pos", "c.*")


def word_list(
    spark: SparkSession, path: str, only_line: int | None = None, limit: int = 100_000
) -> list[str]:
    """Trimmed entries of a word list, one per line, for use as stop words or phrases.

    ``only_line`` keeps a single line (counted from 1). The list ends up inside expressions, so one
    longer than ``limit`` is refused.
    """
    if only_line is not None:
        lines = spark.read.text(path, wholetext=True)
        one = lines.select(F.get(F.split("value", "\n"), F.lit(only_line - 1)).alias("w"))
        return [r["w"].strip() for r in one.filter("w IS NOT NULL").collect()]
    words = spark.read.text(path).select(F.trim("value").alias("w")).filter("w <> ''").distinct()
    found = [r["w"] for r in words.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{path} has more than {limit} entries")
    return sorted(found)


def single_words(entries: Sequence[str]) -> list[str]:
    return [e for e in entries if len(e.split()) == 1]


def phrases(entries: Sequence[str]) -> list[str]:
    return [e for e in entries if len(e.split()) > 1]
