"""Target-distribution importance resampling over hashed word runs.

Runs of one to three words are counted in buckets, in the corpus and in the target. A bucket's gain is the scaled
logarithm of its ratio, a document's weight the sum of gains over an array of its buckets, and its score the weight
plus noise that depends on its id. The number of documents drawn is a share of those long enough. The score that
parts them is found by halving its range with exact counts over the stored scores, ties by halving ids; only what
is drawn is then sorted, by ranges, for its ranks.

Buckets are CRC-32 values, which are linear: the register after "a b" follows from that after "a " by a shift over
the length of "b" and the register of "b" alone. So one pass over the bytes gives the registers of single words,
and those of the longer runs come from them, all as arrays.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import as_int64, byte_slices, global_index, materialise, ship, table

BUCKETS = 10_000
RUN = 3
_FULL = np.uint32(0xFFFFFFFF)
_POLYNOMIAL = 0xEDB88320
#: Words up to this many bytes are shifted over by one table each, longer ones by powers of two.
_SHORT = 64
_SLICE_BYTES = 2_000_000


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), out >> np.uint32(1))
    return out


_BYTE = _byte_table()


def _step(register: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    """The register after one more byte, which meets its lowest one."""
    return _BYTE[register.astype(np.uint8) ^ np.uint8(byte)] ^ (register >> np.uint32(8))


def _through(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    """A linear map of registers, given as four tables of 256."""
    out = tables[0][register & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][(register >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """Tables that pass 0 to ``_SHORT`` zero bytes, and such that pass 2^k."""
    start = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    short = [start]
    for _ in range(_SHORT):
        short.append(_step(short[-1], 0))
    powers = [short[1]]
    for _ in range(31):
        powers.append(np.stack([_through(powers[-1], row) for row in powers[-1]]))
    return np.stack(short), np.stack(powers)


_SHORT_SHIFTS, _POWER_SHIFTS = _shift_tables()
_FLAT = np.ascontiguousarray(_SHORT_SHIFTS).reshape(-1)


def _shifted(register: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers after as many zero bytes as ``sizes`` tells."""
    at = np.minimum(sizes, _SHORT).astype(np.int64) << 10
    out = _FLAT[at + (register & np.uint32(255))]
    for k in range(1, 4):
        out ^= _FLAT[at + 256 * k + ((register >> np.uint32(8 * k)) & np.uint32(255))]
    for i in np.flatnonzero(sizes > _SHORT).tolist():
        one = register[i : i + 1]
        for k in range(32):
            if int(sizes[i]) >> k & 1:
                one = _through(_POWER_SHIFTS[k], one)
        out[i] = one[0]
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[:0x30] = _IN_WORD[0x3A:0x61] = _IN_WORD[0x7B:0x80] = False


def word_registers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes of the words in lower-cased bytes, and each word's register from zero."""
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    borders = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = borders[::2], borders[1::2]
    sizes = ends - starts
    capped = np.minimum(sizes, _SHORT + 1)
    # Longest first, as small numbers, which sort fast; so the words longer than k are the first ones.
    order = np.argsort((_SHORT + 1 - capped).astype(np.uint8), kind="stable")
    longer = len(starts) - np.cumsum(np.bincount(capped, minlength=_SHORT + 2))
    long = int(longer[_SHORT])
    sorted_sizes, sorted_starts = sizes[order], starts[order]
    registers = np.zeros(len(starts), np.uint32)
    for k in range(min(int(sizes.max(initial=0)), _SHORT)):
        n = int(longer[k])
        registers[long:n] = _step(registers[long:n], data[sorted_starts[long:n] + k])
    for i in range(long):
        a = int(sorted_starts[i])
        registers[i] = zlib.crc32(data[a : a + int(sorted_sizes[i])], 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(registers)
    out[order] = registers
    return starts, sizes, out


def run_buckets(data: np.ndarray, borders: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text number and the bucket of every word run, and the number of words of each text.

    ``data`` holds the bytes of all texts and ``borders`` where each starts and the last ends.
    """
    data = _LOWER[data]
    # A text's last word must not run on into the next text: a zero byte goes between texts.
    gaps = np.arange(len(borders) - 1)
    spread = np.zeros(len(data) + len(gaps), np.uint8)
    spread[np.arange(len(data)) + np.repeat(gaps, np.diff(borders))] = data
    starts, sizes, own = word_registers(spread)
    text = np.searchsorted(borders[:-1] + gaps, starts, "right") - 1
    texts, found = [text], []
    register = _shifted(np.full(len(own), _FULL), sizes) ^ own
    found.append((register ^ _FULL) % np.uint32(buckets))
    for n in range(2, RUN + 1):
        # Runs of n words are runs of n - 1 with a space and the word behind, where that is in the same text.
        register = _shifted(_step(register[:-1], 32), sizes[n - 1 :]) ^ own[n - 1 :]
        same = np.flatnonzero(text[n - 1 :] == text[: len(text) - n + 1])
        texts.append(text[same])
        found.append(((register ^ _FULL) % np.uint32(buckets))[same])
    return np.concatenate(texts), np.concatenate(found), np.bincount(text, minlength=len(borders) - 1)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """``bucket`` and ``n`` (how many word runs fall into it) over all texts; buckets without any are left out.

    Every task counts its own texts in one array and passes on at most ``buckets`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, borders in byte_slices(batch.column(0), _SLICE_BYTES):
                total += np.bincount(run_buckets(data, borders, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: list[int], corpus: list[int]) -> np.ndarray:
    """Each bucket's scaled logarithm of how much more often it is in the target, one added to every count."""
    n, t_all, s_all = len(corpus), sum(target), sum(corpus)
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n)))) for t, s in zip(target, corpus)
    ], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Scaled Gumbel noise of an id; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _dense(counts: DataFrame, buckets: int) -> list[int]:
    # One number per bucket reaches the driver, however large the corpus is.
    out = [0] * buckets
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def scored(docs: DataFrame, weights: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (the id and columns in ``keep``), ``n_words``, ``n_features``, ``weight`` and ``score`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for first, end, data, borders in byte_slices(batch.column(2), _SLICE_BYTES):
                text, bucket, words = run_buckets(data, borders, len(weights))
                # Sums of whole numbers below 2^53 are exact in doubles.
                weight = np.bincount(text, weights[bucket], minlength=end - first).astype(np.int64)
                total = weight + np.array([noise(i, seed) for i in ids[first:end]], np.int64)
                features = np.bincount(text, minlength=end - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *[pa.array(x.astype(np.int64)) for x in (words, features, weight, total)]],
                    names=["row", "n_words", "n_features", "weight", "score"],
                )

    row = F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep])
    source = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, n_words long, n_features long, weight long, score long")


def least_reaching(rows: DataFrame, value: str, wanted: int, ways: int = 16) -> int:
    """The smallest number that at least ``wanted`` rows do not exceed; ``wanted`` is at most the number of rows.

    Each round is one exact count job that compares the rows with ``ways - 1`` inner numbers of the range still
    open, and leaves one of ``ways`` parts of it.
    """
    ends = rows.agg(F.min(value).alias("a"), F.max(value).alias("b")).first()
    low, high = ends["a"], ends["b"]
    while low < high:
        cuts = sorted({low + (high - low) * i // ways for i in range(ways)} - {high})
        counts = rows.agg(*[F.count_if(F.col(value) <= F.lit(c)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
        reached = [c for i, c in enumerate(cuts) if counts[i] >= wanted]
        short = [c for i, c in enumerate(cuts) if counts[i] < wanted]
        low, high = max([low, *[c + 1 for c in short]]), min([high, *reached])
    return low


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
    id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, columns in ``keep``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``percent`` percent (rounded down) with the highest scores are
    drawn, like ``target`` in their word runs; ``rank`` counts them from 1 and is null for all others. Equal scores go
    by the smaller id, a null id before all others, then by fewer features; rows equal in all of these are interchangeable
    and get ranks of their own. Null and empty texts have no words, weigh nothing and are never drawn. Without a target
    every gain tells only how rare a bucket is. Repeated rows count and score each. An empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    weights = gains(_dense(bucket_counts(target, buckets), buckets), _dense(bucket_counts(docs, buckets, text_col), buckets))
    # Scores are counted over many times, so they are written once.
    rows = materialise(scored(docs, weights, seed, id_col, text_col, keep), "scores")
    rows = rows.withColumns({"_down": -F.col("score"), "_order": as_int64(F.col("row._id"))})
    fit = F.col("n_words") >= min_words
    wanted = percent * rows.where(fit).count() // 100
    own = [F.col("row._id").alias(id_col), *[F.col("row").getField(c).alias(c) for c in keep], "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*own, F.lit(None).cast("long").alias("rank"))
    limit = least_reaching(rows.where(fit), "_down", wanted)
    above = rows.where(fit & (F.col("_down") < limit)).count()
    last = least_reaching(rows.where(fit & (F.col("_down") == limit)), "_order", wanted - above)
    drawn = fit & ((F.col("_down") < limit) | ((F.col("_down") == limit) & (F.col("_order") <= last)))
    numbered = global_index(rows.where(drawn), ["_down", "_order", "n_features"], "_place")
    # Rows that share the last id and score may be more than are wanted.
    ranked = numbered.select(*own, F.when(F.col("_place") < wanted, F.col("_place") + 1).alias("rank"))
    return ranked.unionByName(rows.where(~drawn).select(*own, F.lit(None).cast("long").alias("rank")))


def op11(spark, sf_dir: str) -> DataFrame:
    """All documents scored by their likeness to the benchmark texts, five percent of the longer ones drawn."""
    ship(spark)
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The same in DuckDB, which has no CRC-32: it is computed byte by byte for every different run of words.
ORACLE = f"""WITH codes AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
),
words AS (
  SELECT 'd' AS part, doc_id AS id, {_WORDS} AS w FROM documents
  UNION ALL SELECT 'b', item_id, {_WORDS} FROM benchmark
),
runs AS (
  SELECT part, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS run FROM words
),
each AS (SELECT part, id, run, count(*) AS n FROM runs GROUP BY ALL),
distinct_runs AS (SELECT DISTINCT run, hex(encode(run)) AS h, octet_length(encode(run)) AS size FROM each),
hashed AS (
  SELECT run, xor(list_reduce(list_concat([4294967295], list_transform(range(size), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM distinct_runs CROSS JOIN codes
),
placed AS (SELECT part, id, bucket, n FROM each JOIN hashed USING (run)),
counts AS (
  SELECT r.bucket, coalesce(sum(n) FILTER (WHERE part = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE part = 'b'), 0) AS t
  FROM (SELECT unnest(range(10000)) AS bucket) r LEFT JOIN placed USING (bucket) GROUP BY r.bucket
),
sums AS (SELECT CAST(sum(s) AS DOUBLE) + 10000 AS s_all, CAST(sum(t) AS DOUBLE) + 10000 AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * s_all / ((CAST(s AS DOUBLE) + 1) * t_all))) AS BIGINT) AS gain FROM counts CROSS JOIN sums
),
weights AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE part = 'd' GROUP BY id),
scores AS (
  SELECT d.id AS doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || d.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM words d LEFT JOIN weights w ON w.id = d.id WHERE d.part = 'd'
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scores WHERE n_words >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r.rank <= 5 * r.n // 100 THEN r.rank END AS rank
FROM scores s LEFT JOIN ranked r ON r.doc_id = s.doc_id"""
