"""Naive Bayes from counts: cross-validation by subtraction, and models that grow batch by batch.

A multinomial Naive Bayes model is a function of how often each class has each term. Counts add up, so a model of
several batches comes from the sum of their counts, and the model that leaves a fold out from all counts minus the
fold's. Neither reads a text again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.text import remove_words, term_counts, tokens
from moodstream.operators import terms
from moodstream.operators.joins import salted_lookup
from moodstream.plans import metrics
from moodstream.plans.model import BAG_OF_WORDS, Features, split_bucket, with_text
from moodstream.session import materialise

#: A table of term weights is sent to all tasks up to this size and joined by salted terms beyond it.
BROADCAST_BYTES = 64_000_000
#: More classes than this are refused: every class has a column in the sums.
MAX_CLASSES = 100


def words(features: Features) -> Column:
    """The terms of a text, as the tokenizer and the stop-word remover of ``features`` give them."""
    return remove_words(tokens(F.col(features.text), features.pattern), features.stop_words)


def counts(labelled: DataFrame, features: Features = BAG_OF_WORDS, part: Column | None = None) -> DataFrame:
    """``(part, class, term, n, docs)``: how often the rows of a part and class have a term, and in how many rows.

    The row with a null term counts the rows themselves, so one aggregation gives all a model needs. Rows without a text
    or a label are left out. Sums are made per task first; a frequent term or class sends partial counts only.
    """
    rows = with_text(labelled, features).filter(F.col(features.label).isNotNull())
    itself = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).cast("long").alias("tf")))
    part = F.lit(0) if part is None else part
    pairs = rows.select(part.alias("part"), F.col(features.label).alias("class"), F.inline(F.concat(itself, term_counts(words(features)))))
    return pairs.groupBy("part", "class", "term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("docs"))


def vocabulary(counted: DataFrame, features: Features = BAG_OF_WORDS) -> DataFrame:
    """``(term, term_count, doc_freq)`` of the terms a model uses: frequent enough, and at most ``vocab_size``."""
    stats = counted.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("term_count"), F.sum("docs").alias("doc_freq"))
    least = features.min_df
    if least < 1:
        least *= counted.filter(F.col("term").isNull()).agg(F.sum("n")).first()[0] or 0
    return terms.vocabulary(stats, least, features.vocab_size)


@dataclass(frozen=True)
class CountModel:
    """Weights of terms by part and setting, as a table, with the weights of the classes themselves.

    ``weights`` has ``(term, term_count, weights)``; the inner list of a part holds the weight of every class for the
    first setting, then for the next. ``priors`` is nested in the same way. A part's weights come from all rows but
    the part's own, or from all rows where ``parts`` is empty.
    """

    classes: tuple[str, ...]
    parts: tuple
    smoothings: tuple[float, ...]
    priors: tuple[tuple[float, ...], ...]
    weights: DataFrame
    vocab_size: int

    @property
    def cells(self) -> int:
        return len(self.classes) * len(self.smoothings)

    def bytes(self) -> int:
        """Most the weights can take in memory, with 64 bytes for a term."""
        return self.vocab_size * (64 + 8 * self.cells * max(1, len(self.parts)))


def fit(counted: DataFrame, features: Features = BAG_OF_WORDS, smoothings: Sequence[float] = (1.0,), leave_out: bool = False) -> CountModel:
    """Models from counts: one of all rows, or one for each part that leaves the part out.

    All of them share the vocabulary of all rows. The driver gets one number for each part and class. Classes go by
    falling number of rows, then by name, and win ties in this order. A class without rows outside a part keeps its
    smoothed weight there.
    """
    counted = materialise(counted, "counts")
    size = {(r["part"], r["class"]): r["n"] for r in counted.filter(F.col("term").isNull()).limit(1_000_000).collect()}
    total: dict[str, int] = {}
    for (_, name), n in size.items():
        total[name] = total.get(name, 0) + n
    classes = tuple(sorted(total, key=lambda c: (-total[c], c)))
    if not classes:
        raise ValueError("no row has a text and a label")
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} different values in {features.label}")
    parts = tuple(sorted({p for p, _ in size})) if leave_out else ()
    kept = materialise(vocabulary(counted, features), "vocabulary")
    vocab_size = kept.count()
    if not vocab_size:
        raise ValueError(f"no term is in {features.min_df} texts")

    def sum_of(part, name: str) -> Column:
        there = F.col("class") == name
        return F.coalesce(F.sum(F.when(there if part is None else there & (F.col("part") == F.lit(part)), F.col("n"))), F.lit(0))

    all_of = [sum_of(None, c).alias(f"all_{i}") for i, c in enumerate(classes)]
    of_part = [sum_of(p, c).alias(f"part_{k}_{i}") for k, p in enumerate(parts) for i, c in enumerate(classes)]
    wide = counted.join(kept.select("term"), "term").groupBy("term").agg(*all_of, *of_part).join(kept, "term")
    wide = materialise(wide, "class-terms")
    # Counts outside a part: all counts minus the part's own.
    outside = [
        [F.col(f"all_{i}") - F.col(f"part_{k}_{i}") if parts else F.col(f"all_{i}") for i in range(len(classes))] for k in range(max(1, len(parts)))
    ]
    tokens_in = wide.agg(*[F.sum(c).alias(f"s{k}_{i}") for k, row in enumerate(outside) for i, c in enumerate(row)]).first()
    weights, priors = [], []
    for k, row in enumerate(outside):
        rows = [total[c] - (size.get((parts[k], c), 0) if parts else 0) for c in classes]
        weights.append(F.array(*[
            F.log(c + F.lit(float(s))) - F.lit(log(tokens_in[f"s{k}_{i}"] + vocab_size * s)) for s in smoothings for i, c in enumerate(row)
        ]))
        priors.append(tuple(log(n + s) - log(sum(rows) + len(classes) * s) for s in smoothings for n in rows))
    table = wide.select("term", "term_count", F.array(*weights).alias("weights"))
    return CountModel(classes, parts, tuple(float(s) for s in smoothings), tuple(priors), table, vocab_size)


def evidence(rows: DataFrame, model: CountModel, keep: Sequence[str], part: str | None = None, words_col: str = "terms") -> DataFrame:
    """``keep`` and ``scores`` (log weights of classes by setting) of every row, from its ``(term, tf)`` list.

    ``keep`` must identify a row. ``part`` names the column that says which part's weights a row gets. Terms meet
    their weights by a broadcast where the vocabulary's size allows it, else by salted terms. Each task adds up its
    rows' terms before anything is dealt by row.
    """
    at = F.lit(0) if not model.parts else F.array_position(F.array(*[F.lit(p) for p in model.parts]), F.col(part)).cast("int") - 1
    held = rows.select(*keep, at.alias("_at"), words_col)
    pairs = held.select(*keep, "_at", F.inline(words_col))
    if model.bytes() <= BROADCAST_BYTES:
        met = pairs.join(F.broadcast(model.weights.select("term", "weights")), "term")
    else:
        met = salted_lookup(pairs, model.weights, "term", "term_count", keep[0])
    own = F.get("weights", F.col("_at"))
    adds = met.select(*keep, "_at", *[(F.col("tf") * F.get(own, F.lit(k))).alias(f"_{k}") for k in range(model.cells)])
    # Rows without a known term are still rows.
    none = held.select(*keep, "_at", *[F.lit(0.0).alias(f"_{k}") for k in range(model.cells)])
    sums = adds.unionByName(none).groupBy(*keep, "_at").agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in range(model.cells)])
    prior = F.array(*[F.array(*[F.lit(x) for x in p]) for p in model.priors])
    score = [F.col(f"_{k}") + F.get(F.get(prior, F.col("_at")), F.lit(k)) for k in range(model.cells)]
    n = len(model.classes)
    return sums.select(*keep, F.array(*[F.array(*score[i : i + n]) for i in range(0, model.cells, n)]).alias("scores"))


def best_class(scores: Column, model: CountModel) -> Column:
    """Name of the class with the highest score; the first on ties."""
    return F.element_at(F.array(*[F.lit(c) for c in model.classes]), F.array_position(scores, F.array_max(scores)).cast("int"))


def confidence(scores: Column) -> Column:
    """Probability of the best class."""
    top = F.array_max(scores)
    return F.lit(1.0) / F.aggregate(F.transform(scores, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)


def predict(docs: DataFrame, model: CountModel, features: Features = BAG_OF_WORDS) -> DataFrame:
    """All columns of every row, with ``class`` and ``confidence``. A null text is scored like an empty one."""
    given = F.struct(*[F.col(c) for c in docs.columns]).alias("_given")
    text = F.coalesce(F.col(features.text), F.lit("")).alias(features.text)
    # Equal rows are rows of their own; the texts are read once, so the ids are the same all through.
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), given, text)
    rows = materialise(rows.select("_row", "_given", term_counts(words(features)).alias("terms")), "rows-to-score")
    scored = evidence(rows, model, ["_row"]).select("_row", F.get("scores", F.lit(0)).alias("s"))
    named = scored.select("_row", best_class(F.col("s"), model).alias("class"), confidence(F.col("s")).alias("confidence"))
    return rows.join(named, "_row").select("_given.*", "class", "confidence")


def cross_validate(
    labelled: DataFrame, key: str, features: Features = BAG_OF_WORDS, smoothings: Sequence[float] = (0.5, 1.0, 2.0), folds: int = 5,
) -> DataFrame:
    """``(smoothing, f1)``: weighted f1 of each smoothing, as the mean over folds of the model of the other folds.

    The texts are read once, into lists of counted terms. One aggregation counts (fold, class, term); every fold's
    models are all counts minus the fold's, and one pass scores each row by its own fold's models at all settings. A
    row's fold is a hash of ``key``, so repeated keys share a fold. Rows without a text or a label take no part.
    """
    rows = with_text(labelled, features).filter(F.col(features.label).isNotNull())
    fold = split_bucket(F.col(key), folds).cast("int")
    listed = rows.select(
        F.monotonically_increasing_id().alias("_row"), fold.alias("fold"), F.col(features.label).alias("actual"), term_counts(words(features)).alias("terms"),
    )
    listed = materialise(listed, "counted-rows")
    itself = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).cast("long").alias("tf")))
    pairs = listed.select(F.col("fold").alias("part"), F.col("actual").alias("class"), F.inline(F.concat(itself, "terms")))
    counted = pairs.groupBy("part", "class", "term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("docs"))
    model = fit(counted, features, smoothings, leave_out=True)
    scored = evidence(listed, model, ["_row", "fold", "actual"], "fold")
    tried = F.arrays_zip(F.array(*[F.lit(s) for s in model.smoothings]).alias("smoothing"), F.col("scores").alias("s"))
    judged = scored.select("fold", "actual", F.inline(tried)).select("smoothing", "fold", "actual", best_class(F.col("s"), model).alias("predicted"))
    table = judged.groupBy("smoothing", "fold", "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return metrics.weighted_f1_by(table, "smoothing", "fold").groupBy("smoothing").agg(F.avg("f1").alias("f1"))


# --- models that grow ------------------------------------------------------------------------


def add_batch(path: str, batch: str, labelled: DataFrame, features: Features = BAG_OF_WORDS) -> None:
    """Count a batch of labelled rows and store its counts under its name.

    Only the batch is read. A batch that comes again replaces its own counts, so a repeated or restarted run changes
    nothing. The name becomes a folder's, so it is restricted to letters, digits, ``_`` and ``-``.
    """
    if not batch or not all(c.isalnum() or c in "_-" for c in batch):
        raise ValueError("a batch's name has letters, digits, _ and - only")
    counted = counts(labelled, features).drop("part")
    counted.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def stored_counts(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> DataFrame:
    """``(class, term, n, docs)`` summed over the stored batches, or over those named: any earlier version of the model."""
    rows = spark.read.schema("class string, term string, n long, docs long, batch string").parquet(path)
    if batches is not None:
        rows = rows.filter(F.col("batch").isin(list(batches)))
    return rows.groupBy("class", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def stored_model(
    spark: SparkSession, path: str, features: Features = BAG_OF_WORDS, smoothing: float = 1.0, batches: Sequence[str] | None = None
) -> CountModel:
    """The model of all stored batches, from their counts alone: no text is read."""
    return fit(stored_counts(spark, path, batches).withColumn("part", F.lit(0)), features, (smoothing,))
