"""Streaming jobs: score comments, count classes, count per window, keep snapshots."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from moodstream.functions import messages
from moodstream.functions.text import clean_comment, decode_bytes
from moodstream.operators.ranking import latest_per_class
from moodstream.operators.rollups import class_counters
from moodstream.plans.model import TFIDF, Features, score
from moodstream.streaming.results import epoch_writer


def _trigger(every: str | None) -> dict:
    """Take what is there and stop, or run on at an interval such as ``"30 seconds"``."""
    return {"processingTime": every} if every else {"availableNow": True}


def _start(writer: DataStreamWriter, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start with a number of state partitions that suits the number of keys.

    A query copies the session's settings when it starts and keeps this one in its checkpoint, so
    the session's own value is put back right after.
    """
    if state_partitions is None:
        return writer.start()
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)


def comments_from_payload(
    payload: DataFrame, keep: tuple[str, ...] = (), clean: bool = True
) -> DataFrame:
    """Message bytes to ``(*keep, pos, UserID, Sentence)`` rows, cleaned. Works on streams."""
    text = payload.withColumn("value", decode_bytes(F.col("value")))
    rows = messages.comments_from_messages(text, keep)
    return rows.withColumn("Sentence", clean_comment(F.col("Sentence"))) if clean else rows


def start_scoring(
    comments: DataFrame,
    model: PipelineModel,
    out: str,
    checkpoint: str,
    features: Features = TFIDF,
    every: str | None = None,
    columns: tuple[str, ...] = ("UserID", "Sentence", "prediction", "class"),
) -> StreamingQuery:
    """Score a stream and append it to a parquet table, one folder per class, exactly once."""
    scored = score(comments, model, features).select(*columns)
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("class")
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )


def start_quarantine(
    payload: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep messages that cannot be read, as they came, instead of losing them or stopping."""
    decoded = payload.withColumn("_raw", F.col("value")).withColumn("value", decode_bytes(F.col("value")))
    _, bad = messages.split_messages(decoded)
    return (
        bad.withColumn("value", F.col("_raw"))
        .drop("_raw")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )


def start_publishing(
    scored: DataFrame,
    checkpoint: str,
    sink_format: str = "kafka",
    every: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Send scored rows (see ``sinks.stream.to_payload``) to a topic or a file stand-in."""
    return (
        scored.writeStream.format(sink_format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(every))
        .start()
    )


def start_class_counts(
    scored: DataFrame, out: str, checkpoint: str, every: str | None = None, state_partitions: int = 1
) -> StreamingQuery:
    """Running rows per class since the first start.

    The state holds one row per class, and every task sends one partial count per class, so one
    state partition is enough at any volume.
    """
    counts = scored.filter(F.col("class").isNotNull()).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    writer = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(epoch_writer(out))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
    )
    return _start(writer, scored.sparkSession, state_partitions)


def start_window_counts(
    scored: DataFrame,
    out: str,
    checkpoint: str,
    ts: str = "ts",
    window: str = "1 hour",
    watermark: str = "1 hour",
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Rows per class and event-time window. Windows older than the watermark leave the state.

    ``ts`` must be a timestamp with zone. Changed windows are emitted in every micro-batch, so
    open windows are visible too. The state holds one row per open window and class;
    ``state_partitions`` replaces the session's number of shuffle partitions for it.
    """
    counts = (
        scored.filter(F.col("class").isNotNull())
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, window).alias("w"), "class")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "class", "n")
    )
    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(epoch_writer(out))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
    )
    return _start(writer, scored.sparkSession, state_partitions)


def start_sessions(
    scored: DataFrame, out: str, checkpoint: str, ts: str = "ts", user: str = "UserID", gap: str = "30 minutes",
    watermark: str = "1 hour", every: str | None = None, state_partitions: int | None = None,
) -> StreamingQuery:
    """Final sessions of each user: first and last moment, comments, and how many of them were negative.

    A session ends when the user is silent for ``gap``. It is written once, when the watermark has passed its end, and
    leaves the state then, so the state holds the users of the last hours only. Rows without a user or a time are left
    out. The last moment includes the gap.
    """
    sessions = (
        scored.filter(F.col(user).isNotNull())
        .withWatermark(ts, watermark)
        .groupBy(F.session_window(ts, gap).alias("s"), user)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("class") == "negative").alias("negative"))
        .select(user, F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "n", "negative")
    )
    writer = (
        sessions.writeStream.outputMode("append")
        .foreachBatch(epoch_writer(out))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
    )
    return _start(writer, scored.sparkSession, state_partitions)


def start_final_windows(
    scored: DataFrame, out: str, checkpoint: str, ts: str = "ts", window: str = "1 hour", delay: str = "1 hour", every: str | None = None
) -> StreamingQuery:
    """Rows per class and event-time window, each window written once, with rows that came too late kept apart.

    A micro-batch's watermark is the latest time of all earlier ones minus ``delay``. Rows whose window ends at or before
    it are late: they go to ``out/late`` as they are. Other rows join the windows that are open. Windows that end at or
    before the watermark after the micro-batch go to ``out/final``, the others to ``out/open``, from where the next
    micro-batch goes on. So every row with a class and a time is in a final window, an open one or the late table, and
    what is carried over is one row per open window and class. A micro-batch that runs again replaces its own tables.
    Spark's own watermark, as in ``start_window_counts``, drops late rows instead.
    """
    spark = scored.sparkSession
    counted = "window_start timestamp, window_end timestamp, class string, n long, epoch long"

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(F.col("class").isNotNull() & F.col(ts).isNotNull()).withColumn("_w", F.window(ts, window)).persist()
        try:
            before, held = None, None
            if batch_id:
                marks = spark.read.schema("mark timestamp, epoch long").parquet(f"{out}/watermark")
                before = marks.filter(F.col("epoch") == batch_id - 1).first()["mark"]
                held = spark.read.schema(counted).parquet(f"{out}/open").filter(F.col("epoch") == batch_id - 1).drop("epoch")
            is_late = F.coalesce(F.col("_w.end") <= F.lit(before).cast("timestamp"), F.lit(False))
            known.filter(is_late).drop("_w").write.mode("overwrite").parquet(f"{out}/late/epoch={batch_id}")
            fresh = known.filter(~is_late).select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "class")
            counts = fresh.groupBy("window_start", "window_end", "class").agg(F.count(F.lit(1)).alias("n"))
            if held is not None:
                counts = counts.unionByName(held).groupBy("window_start", "window_end", "class").agg(F.sum("n").alias("n"))
            reached = F.max(F.col(ts)) - F.expr(f"interval {delay}")
            mark = known.agg(F.greatest(reached, F.lit(before).cast("timestamp")).alias("mark"))
            mark.write.mode("overwrite").parquet(f"{out}/watermark/epoch={batch_id}")
            after = mark.first()["mark"]
            is_final = F.coalesce(F.col("window_end") <= F.lit(after).cast("timestamp"), F.lit(False))
            counts.filter(is_final).write.mode("overwrite").parquet(f"{out}/final/epoch={batch_id}")
            counts.filter(~is_final).write.mode("overwrite").parquet(f"{out}/open/epoch={batch_id}")
        finally:
            known.unpersist()

    return (
        scored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_snapshots(
    scored: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """One row of cumulative class counters per micro-batch, with its number and time."""
    counts = scored.agg(*class_counters())

    def stamp(batch: DataFrame, batch_id: int) -> DataFrame:
        return batch.select(
            F.lit(batch_id).cast("long").alias("batch_id"), F.current_timestamp().alias("taken_at"), "*"
        )

    writer = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(epoch_writer(out, stamp))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
    )
    return _start(writer, scored.sparkSession, 1)


def start_archive(
    scored: DataFrame,
    out: str,
    checkpoint: str,
    columns: tuple[str, ...] = ("UserID", "Sentence", "prediction"),
    every: str | None = None,
) -> StreamingQuery:
    """Keep every micro-batch as JSON text lines in a folder of its own, with class codes and names."""
    fields = messages.published_columns(columns, scored.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(messages.row_json(*fields).alias("value"))
        lines.write.mode("overwrite").text(f"{out}/batch={batch_id}")

    return (
        scored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_latest(
    scored: DataFrame, out: str, checkpoint: str, order: tuple[str, ...], k: int = 13, every: str | None = None
) -> StreamingQuery:
    """The newest ``k`` comments of each class so far, after every micro-batch.

    What is held from one micro-batch to the next is the last result: ``k`` rows per class, whatever the stream has
    brought. Each task passes on its own ``k`` newest rows per class only. A micro-batch that runs again after a failure
    starts from the result before it and replaces its own, so a restart neither loses nor repeats rows. ``order`` must
    identify a row, and later means greater; rows without a class are left out.
    """
    spark = scored.sparkSession
    held = T.StructType([*scored.schema.fields, T.StructField("epoch", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if batch_id:
            # The result before this one. A repeated batch finds its own, unfinished or not, and does not read it.
            before = spark.read.schema(held).parquet(out).filter(F.col("epoch") == batch_id - 1)
            rows = batch.unionByName(before.select(*batch.columns))
        newest = latest_per_class(rows, order, k).drop("rank")
        newest.write.mode("overwrite").parquet(f"{out}/epoch={batch_id}")

    return (
        scored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_negative_users(
    scored: DataFrame,
    out: str,
    checkpoint: str,
    user: str = "UserID",
    comment: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Table of users with negative comments, one row per comment, growing by micro-batch.

    The whole table is the cumulative list; nothing is rewritten when a batch arrives.
    """
    columns = [user, comment] if comment else [user]
    rows = scored.filter(F.col("class") == "negative").select(*columns)
    return (
        rows.writeStream.foreachBatch(epoch_writer(out))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def snapshots(spark: SparkSession, out: str, k: int = 10) -> DataFrame:
    """The ``k`` newest snapshots. Each epoch has one, so only the newest epochs are read."""
    rows = spark.read.parquet(out)
    last = rows.agg(F.max("epoch").alias("epoch")).first()["epoch"]
    newest = rows.filter(F.col("epoch") > (last if last is not None else 0) - k)
    return newest.drop("epoch").orderBy(F.desc("batch_id")).limit(k)
