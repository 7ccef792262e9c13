"""Train, save, load and apply sentiment classifiers as Spark ML models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    HashingTF,
    IDF,
    CountVectorizerModel,
    IndexToString,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexerModel,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.functions.text import NON_WORD, STOP_WORDS, WHITESPACE, term_counts
from moodstream.operators import terms
from moodstream.operators.basics import bag_union
from moodstream.operators.rollups import class_distribution


@dataclass(frozen=True)
class Features:
    """How text becomes a vector. The defaults are hashed TF-IDF over whitespace tokens."""

    # The parameters of the original models.

    text: str = "Sentence"
    label: str = "Emotion"
    pattern: str = WHITESPACE
    stop_words: Sequence[str] = ()
    kind: str = "tfidf"  # or "counts"
    num_features: int = 8000
    min_doc_freq: int = 2
    vocab_size: int = 30_000
    min_df: float = 5.0


TFIDF = Features()
BAG_OF_WORDS = Features(pattern=NON_WORD, stop_words=STOP_WORDS, kind="counts")

#: Words per task in the passes of a fit: with fewer, starting the task costs more than its rows; more take too much memory.
FEWEST_WORDS, MOST_WORDS = 2_000_000, 16_000_000


def logistic_regression(max_iter: int = 300, reg: float = 0.3, elastic_net: float = 0.0) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net)


def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(smoothing=smoothing)


def word_stages(features: Features) -> list:
    """Tokenizer and stop-word remover."""
    tokenizer = RegexTokenizer(inputCol=features.text, outputCol="words", pattern=features.pattern)
    remover = StopWordsRemover(inputCol="words", outputCol="filtered").setStopWords(
        list(features.stop_words)
    )
    return [tokenizer, remover]


def hashing(features: Features) -> HashingTF:
    return HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=features.num_features)


def fit_features(rows: DataFrame, features: Features) -> PipelineModel:
    """Fitted stages from text to ``features``, on rows that have a text.

    Term counts use the vocabulary of ``terms.vocabulary``, which settles equal counts at its size limit
    by term; the driver gets at most ``vocab_size`` terms. Hashed terms are counted once for the weights.
    """
    words = Pipeline(stages=word_stages(features)).fit(rows)
    if features.kind == "counts":
        pairs = words.transform(rows).select(F.inline(term_counts(F.col("filtered"))))
        least = features.min_df if features.min_df >= 1 else features.min_df * rows.count()
        kept = terms.vocabulary(terms.term_stats(pairs), least, features.vocab_size)
        found = [r["term"] for r in kept.select("term").collect()]
        if not found:
            raise ValueError(f"no term is in {least} texts")
        counts = CountVectorizerModel.from_vocabulary(found, inputCol="filtered", outputCol="features")
        return PipelineModel(stages=[*words.stages, counts])
    hashed = hashing(features)
    idf = IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=features.min_doc_freq)
    weighed = idf.fit(hashed.transform(words.transform(rows)).select("rawFeatures"))
    return PipelineModel(stages=[*words.stages, hashed, weighed])


def fit_labels(
    labelled: DataFrame, features: Features, invalid: str = "skip", max_classes: int = 1000
) -> StringIndexerModel:
    """Class names to indexes by falling frequency, ties by name.

    Only the label column is read. The names are collected, so a column with more than
    ``max_classes`` of them, such as one with text shifted into it, is refused. ``invalid`` says
    what happens to rows without a known label: ``skip``, ``error`` or ``keep``.
    """
    names = class_distribution(labelled.select(features.label).na.drop(), features.label)
    found = [r[0] for r in names.limit(max_classes + 1).collect()]
    if len(found) > max_classes:
        raise ValueError(f"more than {max_classes} different values in {features.label}")
    return StringIndexerModel.from_labels(
        found, inputCol=features.label, outputCol="label", handleInvalid=invalid
    )


def with_text(df: DataFrame, features: Features = TFIDF) -> DataFrame:
    """Rows the tokenizer can take: it fails on null text."""
    return df.filter(F.col(features.text).isNotNull())


def train(
    labelled: DataFrame,
    features: Features = TFIDF,
    classifier: Estimator | None = None,
    fit_features_on: DataFrame | None = None,
) -> PipelineModel:
    """Fit features and classifier, and return one model that maps text to a class name.

    Features are fitted on the training rows; pass ``fit_features_on`` to fit them on other rows,
    such as all rows before the split. The returned model has no label stage, so scoring needs no
    placeholder label; it carries the class names, so ``class`` does not depend on index order.
    """
    classifier = classifier or logistic_regression()
    rows = with_text(labelled, features)
    basis = labelled if fit_features_on is None else fit_features_on
    vectors = fit_features(with_text(basis, features), features)
    labels = fit_labels(basis, features)
    prepared = labels.transform(vectors.transform(rows)).select("features", "label")
    fitted = classifier.fit(prepared)
    names = IndexToString(inputCol="prediction", outputCol="class", labels=labels.labels)
    return PipelineModel(stages=[*vectors.stages, fitted, names])


def score(df: DataFrame, model: PipelineModel, features: Features = TFIDF) -> DataFrame:
    """Batch or streaming scoring: input columns plus ``probability, prediction, class``.

    Scoring is row by row on the executors. The inputs stay in the row, so nothing is joined back. Every
    row is kept: a null text is scored like an empty one and stays null.
    """
    scored = model.transform(_filled(df, features))
    return scored.select(*_as_given(df, features), "probability", "prediction", "class")


def _filled(df: DataFrame, features: Features) -> DataFrame:
    """The tokenizer fails on null text, so it gets an empty one; the given text goes along."""
    given = F.col(features.text)
    return df.withColumn("_given", given).withColumn(features.text, F.coalesce(given, F.lit("")))


def _as_given(df: DataFrame, features: Features) -> list[Column]:
    return [F.col("_given").alias(c) if c == features.text else F.col(c) for c in df.columns]


def prepare(df: DataFrame, model: PipelineModel, features: Features = TFIDF) -> DataFrame:
    """First half of ``score``: input columns plus ``features``."""
    vectors = PipelineModel(stages=model.stages[:-2])
    return vectors.transform(_filled(df, features)).select(*_as_given(df, features), "features")


def predict(prepared: DataFrame, model: PipelineModel) -> DataFrame:
    """Second half of ``score``: prepared rows plus ``probability, prediction, class``."""
    keep = [c for c in prepared.columns if c != "features"]
    scored = PipelineModel(stages=model.stages[-2:]).transform(prepared)
    return scored.select(*keep, "probability", "prediction", "class")


def label_position(df: DataFrame, model: PipelineModel, label: str, name: str = "label") -> DataFrame:
    """Add the index the model uses for each class name; unknown names give null."""
    labels = model.stages[-1].getLabels()
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label))
    return df.withColumn(name, F.when(position > 0, (position - 1).cast("double")))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def split_bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the md5 of a key: the same in every run and at every scale."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def hash_split(df: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key. A filter, so neither part depends on partitioning."""
    bucket = split_bucket(F.col(key))
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 100) -> list[DataFrame]:
    """Seeded random parts; their rows depend on how the input is partitioned."""
    return df.randomSplit(list(weights), seed=seed)


def retrain(
    stored: DataFrame,
    arrived: DataFrame,
    features: Features = TFIDF,
    classifier: Estimator | None = None,
) -> PipelineModel:
    """Fit again on the stored rows plus newly arrived ones."""
    columns = [features.text, features.label]
    return train(bag_union(stored.select(*columns), arrived.select(*columns)), features, classifier)


def pass_tasks(words: int, cores: int) -> int:
    """Tasks for rows that fits pass over again and again: one per core, unless they had too few or too many words."""
    return max(1, min(cores, -(-words // FEWEST_WORDS)), -(-words // MOST_WORDS))


def dealt_for_passes(prepared: DataFrame, words: str) -> DataFrame:
    """The rows without their column ``words``, dealt evenly over few tasks and kept on the executors.

    Every task of a pass starts with the whole coefficients and ends with a whole gradient, whatever the number of
    its rows, so the splits of the texts would cost more in tasks than in rows.
    """
    read = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = read.agg(F.sum(words)).first()[0] or 0
        tasks = pass_tasks(total, prepared.sparkSession.sparkContext.defaultParallelism)
        dealt = read.drop(words).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        dealt.count()  # all of it is kept before the first copy goes
    finally:
        read.unpersist()
    return dealt


def cross_validate(
    labelled: DataFrame,
    key: str,
    features: Features = BAG_OF_WORDS,
    classifier: Estimator | None = None,
    grid: dict[str, Sequence[float]] | None = None,
    folds: int = 5,
    parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Grid search with cross-validation: the refitted best model and the mean f1 of each setting.

    ``grid`` maps parameters of the classifier to their values. A row's fold is a hash of ``key``, so
    the scores do not depend on partitions, cores or the order of rows. Features are fitted on all
    rows once, and all fits share these vectors, which are dealt over few tasks and stay on the executors
    while they run.
    """
    classifier = classifier or logistic_regression(max_iter=20)
    grid = grid or {"regParam": (0.1, 0.3, 0.5), "elasticNetParam": (0.0, 0.1, 0.2)}
    rows = with_text(labelled, features)
    vectors = fit_features(rows, features)
    labels = fit_labels(labelled, features)
    fold = split_bucket(F.col(key), folds).cast("int").alias("fold")
    n_words = F.size("filtered").alias("n_words")
    prepared = labels.transform(vectors.transform(rows)).select("features", "label", fold, n_words)
    prepared = dealt_for_passes(prepared, "n_words")
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(classifier.getParam(name), list(values))
    settings = builder.build()
    search = CrossValidator(
        estimator=classifier,
        estimatorParamMaps=settings,
        evaluator=MulticlassClassificationEvaluator(predictionCol="prediction"),
        numFolds=folds,
        parallelism=parallelism,
        foldCol="fold",
    )
    try:
        found = search.fit(prepared)
    finally:
        prepared.unpersist()
    scores = labelled.sparkSession.createDataFrame(
        [
            (*[float(p[classifier.getParam(n)]) for n in grid], float(m))
            for p, m in zip(settings, found.avgMetrics)
        ],
        ", ".join(f"{n} double" for n in [*grid, "f1"]),
    )
    names = IndexToString(inputCol="prediction", outputCol="class", labels=labels.labels)
    return PipelineModel(stages=[*vectors.stages, found.bestModel, names]), scores


def with_label_names(features: Features, text: str, label: str) -> Features:
    """The same features for other column names."""
    return replace(features, text=text, label=label)
