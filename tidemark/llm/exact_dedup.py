"""Exact dedup by stateful streaming: disk-backed keyed state without expiry, full bytes checked on hits.

Each row becomes (digest of the normalised text, stable identifier, code points, content locator). A
Structured Streaming query keyed by digest keeps one RocksDB entry for each digest for ever: how many
rows had it, and the identifier and locator of the row that stays. Digests with more than one row are
hits; the full normalised bytes of their rows are then read again and compared, the least with the
greatest of each digest, so that a hot digest's rows combine before they move. A digest whose rows differ
in bytes (a collision) is settled by the bytes themselves. The locator (file and row) of the row that
stays is part of the result.

Defined cases: a null text counts as empty; all texts that normalise to nothing are equal. A null
identifier sorts after all others on ties; keep_id is null where such a row stays. Of rows repeated in
full, one stays. An empty table gives an empty result. Columns other than the two named ones are not
read by the decision, whatever their names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, free_names, materialize, no_rows, remove_path, scratch_path, small_side

#: Stands for a null identifier in the state: after all others.
_LAST = (1 << 63) - 1
_KEYED = "digest string, sha string, n_chars long, id long, uid long, locator string"
_STATE = "digest string, n long, best struct<n_chars: long, neg: long, neg_uid: long, locator: string>"
_ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no space set aside for each one's logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def content_locator(docs: DataFrame) -> Column:
    """Where a row's content lies: its file and its place there; of rows that come from no such file, the file or nothing."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return F.input_file_name()
    return F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 256) -> DataFrame:
    """All that the state sees of a row; uid tells rows with one identifier apart. digest_bits: fewer only in tests."""
    sha = F.sha2(normalised(F.col(text_col)), 256)
    return docs.select(
        F.substring(sha, 1, digest_bits // 4).alias("digest"),
        sha.alias("sha"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        F.col(id_col).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("uid"),
        content_locator(docs).alias("locator"),
    )


def stream_state(spark: SparkSession, source: str, sink: str, at: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream the keyed rows at source through the state; its last entry for each digest.

    No watermark and no timeout: an entry never expires. State lives in RocksDB on the executors' disks,
    its checkpoint in the folder `at` (shared by all), so the part of a lost executor is loaded anew and a
    later call with the same folders goes on from there; changed entries are written to `sink`.
    """
    before = {k: spark.conf.get(k, None) for k in _ROCKS}
    for k, v in _ROCKS.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(_KEYED)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        best = F.max(F.struct("n_chars", (-F.coalesce("id", F.lit(_LAST))).alias("neg"), (-F.col("uid")).alias("neg_uid"), "locator"))
        state = reader.parquet(source).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
        no_rows(spark, _STATE).write.mode("overwrite").parquet(f"{sink}/batch=-1")

        def changed(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

        state.writeStream.outputMode("update").option("checkpointLocation", at).trigger(availableNow=True).foreachBatch(changed).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changes = spark.read.schema(_STATE + ", batch int").parquet(sink)
    # a digest's count only grows, so its largest count is its latest entry
    last = changes.groupBy("digest").agg(F.max(F.struct("n", "best")).alias("s"))
    return last.select("digest", "s.n", F.expr(f"nullif(-s.best.neg, {_LAST})").alias("keep_id"), (-F.col("s.best.neg_uid")).alias("keep_uid"), F.col("s.best.locator").alias("keep_locator"))


def _collided(docs: DataFrame, state: DataFrame, text_col: str, digest_bits: int) -> DataFrame:
    """Digests of hits whose rows differ in normalised bytes: least and greatest text of each are compared."""
    norm = normalised(F.col(text_col))
    rows = docs.select(F.substring(F.sha2(norm, 256), 1, digest_bits // 4).alias("digest"), norm.alias("norm"))
    # hits grow with the corpus: rows meet them by digest, in one way at every size, and combine where they met
    hits = state.where("n > 1").select("digest").hint("shuffle_hash")
    ends = rows.join(hits, "digest", "left_semi").groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    return ends.where("lo <> hi").select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 256, files_per_batch: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text), keep_locator."""
    spark = docs.sparkSession
    source = scratch_path(spark, "dedup-keys")
    keyed_rows(docs, id_col, text_col, digest_bits).write.parquet(source)
    keyed = spark.read.schema(_KEYED).parquet(source)
    sink, at = scratch_path(spark, "dedup-changes"), scratch_path(spark, "dedup-state")
    state = materialize(stream_state(spark, source, sink, at, files_per_batch), "dedup-final")
    # the state's own folder stays: executors still hold its stores, and let go of them in their own time
    remove_path(spark, sink)
    bad = materialize(_collided(docs, state, text_col, digest_bits), "dedup-collided")
    named = ["id", "keep_id", "group_size", "kept", "text_sha256", "keep_locator"]
    out = keyed.join(state, "digest").select("digest", "id", "keep_id", F.col("n").alias("group_size"), (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("sha").alias("text_sha256"), "keep_locator")
    if bad.isEmpty():
        return out.select(named)
    # collided digests: the bytes decide; their full SHA-256 and text together name a group
    norm = normalised(F.col(text_col))
    rows = docs.select(F.substring(F.sha2(norm, 256), 1, digest_bits // 4).alias("digest"), norm.alias("norm"), F.col(id_col).cast("long").alias("id"), F.char_length(F.coalesce(text_col, F.lit(""))).alias("n_chars"), F.monotonically_increasing_id().alias("uid"), content_locator(docs).alias("locator"))
    rows = materialize(rows.join(bad, "digest", "left_semi"), "dedup-bytes")
    groups = rows.groupBy("norm").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("n_chars", (-F.coalesce("id", F.lit(_LAST))).alias("neg"), (-F.col("uid")).alias("neg_uid"), "locator")).alias("b"))
    redone = rows.join(groups, "norm").select("id", F.expr(f"nullif(-b.neg, {_LAST})").alias("keep_id"), "group_size", (F.col("uid") == -F.col("b.neg_uid")).alias("kept"), F.sha2("norm", 256).alias("text_sha256"), F.col("b.locator").alias("keep_locator"))
    return out.join(bad, "digest", "left_anti").select(named).union(redone)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, all columns. Identifiers that are null or repeated are told apart by their text."""
    found = materialize(exact_dedup(docs, id_col, text_col), "dedup-found")
    ambiguous = found.groupBy("id").count().where("count > 1 OR id IS NULL")
    if ambiguous.isEmpty():
        gone = small_side(found.where("NOT kept").select(F.col("id").alias(id_col)))
        return docs.join(gone, id_col, "left_anti")
    # by text then: of the rows that hold the winner's identifier and content the longest, and one of these
    own, chars, by_sha, by_id, top = free_names(docs, "row_sha", "row_chars", "kept_sha", "kept_id", "most_chars")
    keep = found.where("kept").select(F.col("text_sha256").alias(by_sha), F.col("id").alias(by_id))
    rows = docs.withColumn(own, F.sha2(normalised(F.col(text_col)), 256)).withColumn(chars, F.char_length(F.coalesce(text_col, F.lit(""))))
    rows = rows.join(keep, (F.col(own) == F.col(by_sha)) & F.col(id_col).eqNullSafe(F.col(by_id)), "left_semi")
    best = rows.groupBy(F.col(own).alias(by_sha)).agg(F.max(chars).alias(top))
    rows = rows.join(best, (F.col(own) == F.col(by_sha)) & (F.col(chars) == F.col(top)), "left_semi").dropDuplicates([own])
    return rows.select(docs.columns)
