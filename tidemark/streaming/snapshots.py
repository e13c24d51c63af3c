"""Incremental runs: a stream of observations against keyed state, and windowed counts with a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import compare_snapshots
from ..sources.archive import current_of
from ..sources.sinks import upsert_day


def latest_per_day(rows: DataFrame) -> DataFrame:
    """A forced second observation of a day replaces the first."""
    rest = [c for c in rows.columns if c not in ("slug", "obs_date")]
    return rows.groupBy("slug", "obs_date").agg(F.max_by(F.struct(*rest), "observed_at").alias("_o")).select("slug", "obs_date", "_o.*")


def process_day(snapshots: DataFrame | None, batch: DataFrame, date: str) -> DataFrame:
    """Changes of one day's batch against the state before it, the earlier observations of that day included."""
    day = latest_per_day(batch.where(F.col("obs_date") == F.lit(date).cast("date")))
    before = current_of(snapshots.where(F.col("obs_date") <= F.lit(date).cast("date")), order=("obs_date", "observed_at")) if snapshots is not None else day.limit(0)
    seen = day.select("slug", F.col("observed_at").alias("observed_at"))
    return compare_snapshots(before, day).join(seen, "slug").withColumn("date", F.lit(date).cast("date"))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def run_stream(observations: DataFrame, snapshot_path: str, change_path: str, checkpoint: str, available_now: bool = True):
    """Each micro-batch is compared day by day with the state before it; observations and changes are then appended.

    Both tables are logs by day and batch: a later batch of a day adds to it (state_of gives the newest
    observation, the change log keeps every change), and a batch that runs again replaces only what it wrote.
    """

    def batch(rows: DataFrame, n: int) -> None:
        spark = rows.sparkSession
        rows = rows.persist()
        try:
            for (day,) in sorted(rows.select(F.date_format("obs_date", "yyyy-MM-dd")).distinct().collect()):  # days of a batch
                at = F.lit(day).cast("date")
                snaps = read_or_none(spark, snapshot_path)
                if snaps is not None:  # this batch's own earlier days count, what an interrupted run left of this day does not
                    snaps = snaps.where((F.col("batch") < n) | ((F.col("batch") == n) & (F.col("obs_date") < at))).drop("batch")
                upsert_day(process_day(snaps, rows, day).withColumn("batch", F.lit(n)), change_path, "date", "batch")
                upsert_day(latest_per_day(rows.where(F.col("obs_date") == at)).withColumn("batch", F.lit(n)), snapshot_path, "obs_date", "batch")
        finally:
            rows.unpersist()

    writer = observations.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def state_of(snapshots: DataFrame) -> DataFrame:
    """The newest observation of each slug and day of a table that run_stream wrote."""
    return latest_per_day(snapshots.drop("batch"))


def last_value_moves(observations: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Arbitrary keyed state without expiry: each new value of a key beside the key's previous one.

    Works on a stream; state is one (time, value) per key. Late rows older than the state are left out.
    """
    schema = f"{key} string, {time} timestamp, previous double, {value} double"

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last_t, last_v = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values([time, value])
        out = []
        for t, v in zip(rows[time], rows[value]):
            us = int(pd.Timestamp(t).value // 1000)
            if last_t is not None and us < last_t:
                continue
            if last_v is None or v != last_v:
                out.append((keys[0], t, last_v, v))
            last_t, last_v = us, float(v)
        state.update((last_t, last_v))
        yield pd.DataFrame(out, columns=[key, time, "previous", value])

    from pyspark.sql.streaming.state import GroupStateTimeout

    rows = observations.select(F.col(key).cast("string").alias(key), F.col(time).cast("timestamp").alias(time), F.col(value).cast("double").alias(value))
    return rows.groupBy(key).applyInPandasWithState(step, schema, "t long, v double", "append", GroupStateTimeout.NoTimeout)


def tumbling_counts(events: DataFrame, time: str, by: list[str], width: str, lateness: str) -> DataFrame:
    """Counts in tumbling windows; rows later than the watermark are left out. Works on streams and tables."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return rows.groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")
