"""Fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` covers a whole text and keeps the end of every repetition, so the number of units and
both cut places come from one list of ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import ship, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: White space with the word behind it, or the white space at the end.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_UNITS = regex.compile(f"({UNIT})*")
#: A batch is passed on once it holds so many code points, so that one of long texts stays small.
_BATCH_CHARS = 4_000_000


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on the seed and the id alone; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of units, and the code points before the middle and before the suffix."""
    ends = _UNITS.fullmatch(text).ends(1)
    n = len(ends)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[first - 1] if first else 0, ends[second - 1] if second else 0


def transform(text: str, doc_id: int | None, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """Units, form, prefix and middle lengths (None if plain), and the text in its form."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n, a, b = cut(text, h1, h2)
    if not text or h3 % 100 >= fim_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80,
    id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, columns in ``keep``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row.

    ``fim_percent`` of the ids are cut, ``spm_percent`` of these with the suffix first. Cuts lie between units and
    depend on the id, the seed and the number of units only, so a row gives the same output in any table. Rows are
    handled alone and nothing is shuffled. Null texts are empty; empty texts and texts that hold a mark stay
    plain, with null lengths. A null id counts as an empty one. Rows with equal ids and texts give equal outputs. An
    empty table gives no rows, and other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            ids, first, held, made = batch.column(1).to_pylist(), 0, 0, []
            for i, value in enumerate(batch.column(2)):
                made.append(transform(value.as_py() or "", ids[i], seed, fim_percent, spm_percent))
                held += len(made[-1][-1])
                if held >= _BATCH_CHARS or i == batch.num_rows - 1:
                    columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(made)), *columns], names=names)
                    first, held, made = i + 1, 0, []

    row = F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep])
    source = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(run, f"row {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    kept = [F.col("row").getField(c).alias(c) for c in keep]
    return out.select(F.col("row").getField("_id").alias(id_col), *kept, "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text that gave ``output``, from the output and its form alone.

    A text in parts holds each mark once, and no mark can arise where a mark meets text, so the marks tell the parts.
    """
    middle = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)

    def between(mark: str, end: str) -> Column:
        return F.substring_index(F.substring_index(head, mark, -1), end, 1)

    whole = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).otherwise(whole)


def op12(spark, sf_dir: str) -> DataFrame:
    """All documents cut, as checksums of the outputs and of the texts rebuilt from them."""
    ship(spark)
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The same in DuckDB.
ORACLE = r"""WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50
              THEN 'plain' WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM docs
),
parts AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""
