"""Quality classifier: a factorisation machine over hashed words, text statistics and stored metadata.

The score is the logistic of w0 + <w, x> + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), linear in the
number of features. Features are computed on whole texts where the texts are; only the feature vectors of a
bounded sample of labelled rows come to the driver for training, and only the weights go back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import ship

WORD_BUCKETS = 1 << 15
FACTORS = 8
SAMPLE = 12_000
EPOCHS = 12
CACHED_WORDS = 250_000
#: Borders of the bins of each statistic; a value's bin is one feature.
_BINS = np.array([0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.18, 0.25, 0.35, 0.5, 0.65, 0.8, 0.95])
_STATISTICS = (
    "words", "word length", "upper case", "symbols", "digits", "lines", "different words", "commonest word",
    "word equals the one before", "words without a letter", "doubled marks", "bars", "upper words", "stored length",
)
_SLOTS = len(_BINS) + 1
WIDTH = WORD_BUCKETS + len(_STATISTICS) * _SLOTS
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?")
_DOUBLED = re.compile(rb"([!-/:-@\[-`{-~])\1")
_bucket: dict[str, int] = {}


def _share(text: bytes, letters: bytes) -> float:
    return 1.0 - len(text.translate(None, letters)) / len(text) if text else 0.0


def features(text: str | None, stored_length: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n = len(words)
    if len(_bucket) > CACHED_WORDS:
        _bucket.clear()
    for w in set(words).difference(_bucket):
        _bucket[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "replace")) % WORD_BUCKETS
    at = np.fromiter(map(_bucket.__getitem__, words), np.int32, n)
    slot, count = np.unique(at, return_counts=True)
    size = max(n, 1)
    statistics = (
        np.log1p(n) / 12, len(raw) / size / 40, _share(raw, _UPPER), _share(raw, _SYMBOLS), _share(raw, _DIGITS),
        raw.count(b"\n") / size, len(slot) / size, (count.max() if n else 0) / size,
        float((at[1:] == at[:-1]).sum()) / size, sum(map(str.isalpha, words)) / size,
        len(_DOUBLED.findall(raw)) / size, words.count("|") / size, sum(map(str.isupper, words)) / size,
        np.log1p(max(stored_length if stored_length is not None else len(text), 0)) / 16,
    )
    bins = np.searchsorted(_BINS, statistics, "right")
    stats = WORD_BUCKETS + np.arange(len(_STATISTICS)) * _SLOTS + bins
    value = np.log1p(count)
    norm = np.sqrt((value**2).sum()) if n else 1.0
    return (
        np.concatenate([slot, stats]).astype(np.int32),
        np.concatenate([value / norm, np.full(len(stats), 1 / np.sqrt(len(_STATISTICS)))]).astype(np.float32),
    )


@dataclass
class FactorisationMachine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def margins(self, index: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Margins of rows given as joined feature lists with row starts; linear in their length."""
        v = self.factors[index] * value[:, None]
        total = np.add.reduceat(v, first, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1), first)
        return self.bias + np.add.reduceat(self.weight[index] * value, first) + 0.5 * ((total**2).sum(axis=1) - squares)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, factors: int = FACTORS, seed: int = 1) -> FactorisationMachine:
    """Adaptive gradient descent on the logistic loss in mini-batches; no row gives the neutral model."""
    rng = np.random.default_rng(seed)
    model = FactorisationMachine(0.0, np.zeros(WIDTH, np.float32), rng.normal(0, 0.02, (WIDTH, factors)).astype(np.float32))
    if not rows:
        model.factors[:] = 0
        return model
    y = np.array([r[2] for r in rows], np.float32)
    share = float(np.clip(y.mean(), 0.01, 0.99))
    model.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v = np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, factors), 1e-6, np.float32)
    rate, decay, batch = 0.1, 1e-5, 128
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            v = model.factors[index] * value[:, None]
            total = np.add.reduceat(v, first, axis=0)
            margin = model.bias + np.add.reduceat(model.weight[index] * value, first)
            margin += 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), first))
            error = (1 / (1 + np.exp(-margin)) - y[part]) / len(part)
            each = np.repeat(error, sizes) * value
            slots, at = np.unique(index, return_inverse=True)
            grad_w = np.bincount(at, each, len(slots)).astype(np.float32) + decay * model.weight[slots]
            rest = each[:, None] * (np.repeat(total, sizes, axis=0) - v)
            grad_v = np.stack([np.bincount(at, rest[:, f], len(slots)) for f in range(factors)], axis=1).astype(np.float32)
            grad_v += decay * model.factors[slots]
            seen_w[slots] += grad_w**2
            seen_v[slots] += grad_v**2
            model.weight[slots] -= rate * grad_w / np.sqrt(seen_w[slots])
            model.factors[slots] -= 0.2 * rate * grad_v / np.sqrt(seen_v[slots])
            model.bias -= 0.1 * float(error.sum())
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index, value = [], []
        for text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            i, v = features(text, size)
            index.append(i.tobytes())
            value.append(v.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["y", "i", "v"])


def _scored(model: FactorisationMachine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = [features(t, n) for t, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                first = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])[:-1]]).astype(np.int64)
                margin = model.margins(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), first)
                score = 1 / (1 + np.exp(-margin.astype(np.float64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=["row", "score"])

    return run


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> FactorisationMachine:
    """Fit on at most ``sample`` labelled rows, those with the least hashes of their ids, none held out.

    ``docs`` has ``doc_id``, ``text``, ``n_chars``; ``labels`` has ``doc_id``, ``quality``. Null ids or
    labels teach nothing. The sample's ids are broadcast: ``sample`` bounds their number. Of documents stored again under
    one id the text with the least hash is learnt, so what is learnt does not depend on the order of the input.
    """
    order = F.xxhash64("doc_id")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("y")).orderBy(order, "doc_id").limit(sample)
    )
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")
    text = F.struct("text", F.col("n_chars").cast("long").alias("n"))
    one = rows.groupBy("doc_id", "y").agg(F.min_by(text, F.xxhash64("text", "n_chars")).alias("r"))
    made = one.select("r.text", "r.n", "y").mapInArrow(_featured, "y int, i binary, v binary").collect()
    made.sort(key=lambda r: (bytes(r["i"]), bytes(r["v"]), r["y"]))
    return fit([(np.frombuffer(r["i"], np.int32), np.frombuffer(r["v"], np.float32), int(r["y"])) for r in made], epochs)


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every row: the id, columns in ``keep``, ``score`` (higher: better), ``predicted`` (1 from 0.5 on).

    Null and empty texts are scored from their statistics. A missing stored length is replaced by the text's
    own. Repeated rows get equal scores; other columns are ignored.
    """
    length = F.col(length_col).cast("long") if length_col else F.lit(None).cast("long")
    source = docs.select(F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep]).alias("row"), F.col(text_col).alias("text"), length.alias("n"))
    out = source.mapInArrow(_scored(model), f"row {source.schema['row'].dataType.simpleString()}, score double")
    return out.select(
        F.col("row").getField("_id").alias(id_col), *[F.col("row").getField(c).alias(c) for c in keep], "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
