"""Line dedup with range-partitioned line hashes and keep bitmaps. Built-in functions only.

Every line becomes a row of hash, document and position. The rows are range partitioned by hash and document, which
cuts a line that a third of all documents share into pieces, and sorted by hash, document and position. In this
order the first line of every (hash, document) is told by the row before it, and firsts are counted per piece and
hash before anything is summed over pieces. What goes back to the documents is a bitmap of lines, not text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.functions.binding import let
from moodstream.llm.common import materialise, table

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines in one word of a bitmap.
WORD = 64


def lines_of(text: Column) -> Column:
    """The lines of a text; a null text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _name(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """``h1``, ``h2`` (128 bits of the key), ``doc``, ``name`` and ``pos`` of every line whose key has ``min_chars`` code points."""
    lowered = F.translate(F.col(text_col), UPPER, LOWER)
    every = docs.select(F.col(id_col).alias("doc"), _name(F.col(text_col)).alias("name"), F.posexplode(lines_of(lowered)).alias("pos", "line"))
    keyed = every.select("doc", "name", "pos", F.trim(F.col("line"), F.lit(SPACE)).alias("key"))
    keyed = keyed.where(F.length("key") >= min_chars)
    # Hashing a number first starts the second hash from another seed.
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "name", "pos")


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The line rows with ``part``, the range they lie in, and ``first``: whether the hash is new in its document.

    Rows of one hash and document lie in one range. The table is written once, in its order.
    """
    ranged = lines.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos", "name")
    # The ranges and their order serve this window as they are: it neither shuffles nor sorts again.
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "doc").orderBy("pos"))
    return materialise(ranged.select("*", (nth == 1).alias("first"), F.spark_partition_id().alias("part")), "lines")


def common_lines(placed: DataFrame, min_docs: int) -> DataFrame:
    """``part``, ``h1``, ``h2`` and ``n_docs`` of the hashes found in ``min_docs`` documents, once for every range they lie in."""
    pieces = placed.groupBy("part", "h1", "h2").agg(F.count_if("first").alias("n"))
    total = pieces.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    return pieces.select("part", "h1", "h2").join(total, ["h1", "h2"])


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc``, ``name``, ``n_dropped`` and ``keep`` of every text that loses lines.

    ``keep`` holds the 64-line words of the bitmap that are not all ones, by number: bit i of word w tells whether
    line 64 w + i stays.
    """
    placed = first_occurrences(line_hashes(docs, id_col, text_col, min_chars))
    # The range is part of the key, so a line that very many documents share is joined piece by piece.
    gone = placed.select("part", "h1", "h2", "doc", "name", "pos").join(common_lines(placed, min_docs), ["part", "h1", "h2"], "left_semi")
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    words = gone.groupBy("doc", "name", F.expr(f"pos div {WORD}").alias("word")).agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("doc", "name").agg(
        F.sum(F.bit_count("gone").cast("long")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct(F.col("word").cast("int").alias("word"), F.bitwise_not("gone").alias("bits")))).alias("keep"),
    )


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines whose bit is set. The left-out words are filled in first, so that finding a bit takes one step."""

    def filled(words: Column) -> Column:
        return F.flatten(F.transform(words, lambda w, i: F.concat(
            F.array_repeat(F.lit(-1).cast("long"), (w["word"] - F.coalesce(F.get(words, i - 1)["word"], F.lit(-1)) - 1).cast("int")), F.array(w["bits"]),
        )))

    def stays(words: Column, i: Column) -> Column:
        word = F.coalesce(F.get(words, F.floor(i / WORD).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(word, i % WORD) == 1

    return let(let(keep, filled), lambda words: F.filter(lines, lambda line, i: stays(words, i)))


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, columns in ``keep``, ``n_lines``, ``n_dropped``, ``bitmap`` and ``kept`` (the text that stays) of every row.

    A line's key is the line without white space at both ends, A-Z in lower case. Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all their lines, in every document; ``bitmap`` is null where
    no line goes. Documents are told apart by their id: rows that share one, the null id too, count as one document
    when a key's documents are counted, while each row is cut by itself and gives a row. A null or empty text is one
    empty line, which stays, as does any line of white space. An empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    row = F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep])
    whole = docs.select(row.alias("row"), F.col(id_col).alias("doc"), _name(F.col(text_col)).alias("name"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    maps = keep_bitmaps(docs, min_docs, min_chars, id_col, text_col).withColumnsRenamed({"doc": "d", "name": "m"})
    # The bitmaps are the small side: they are looked up by hash, so the texts are dealt once and not sorted.
    met = whole.join(maps.hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("d")) & (F.col("name") == F.col("m")), "left")
    lines = lines_of(F.col("text"))
    return met.select(
        F.col("row").getField("_id").alias(id_col), *[F.col("row").getField(c).alias(c) for c in keep],
        F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.col("keep").alias("bitmap"),
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.array_join(kept_lines(lines, F.col("keep")), "\n")).alias("kept"),
    )


def op13(spark, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten documents share, as a checksum of what stays."""
    out = drop_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: The same in DuckDB.
ORACLE = f"""WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM cut),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
