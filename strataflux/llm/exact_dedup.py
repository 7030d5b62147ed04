"""Exact deduplication by a streaming query with keyed state.

The texts are normalised once and staged with their digest. A stream reads the staged
digests and keeps one entry of state per digest in RocksDB: the number of rows, and of the row
that stays its length, its id and its locator. State has no watermark and never expires,
so a copy is found however late it arrives. Every hit is then checked: the full bytes of
the row are compared with those the locator points to. Digests under which different bytes
were found are grouped again by their bytes.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.llm.common import SPACE_CLASS, Workspace, settings, staged, whole, workspace

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Native memory that an executor holds beside its heap, also for a while after the query.
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # Many small stores: no space is set aside in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
}

# A larger value stays; negated ids let the smallest one win, a missing id comes last.
KEEPER = "struct<n_points:int,known:boolean,id:bigint,locator:bigint>"


def normalised(text: Column) -> Column:
    return F.regexp_replace(whole(text), f"[{SPACE_CLASS}]+", "")


def full_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def keeper() -> Column:
    return F.struct(
        F.col("n_points"),
        F.col("doc_id").isNotNull().alias("known"),
        (-F.col("doc_id")).alias("id"),
        (-F.col("locator")).alias("locator"),
    )


def keep_state(spark: SparkSession, arrivals: DataFrame, path: str, batches: int) -> DataFrame:
    """The state after all arrivals: one row per digest with its size and its keeper."""
    files = max(1, ceil(len(arrivals.inputFiles()) / batches))
    source = f"{path}/rows"
    stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", files).parquet(source)
    state = stream.groupBy("digest").agg(
        F.count("*").alias("group_size"), F.max(keeper()).cast(KEEPER).alias("keeper")
    )

    def note(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/state/epoch={epoch}")

    with settings(spark, STATE_SETTINGS):
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(note)
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    noted = spark.read.schema(state.schema).parquet(f"{path}/state/epoch=*")
    # A group only grows, so its largest note is its last.
    return noted.groupBy("digest").agg(F.max(F.struct("group_size", "keeper")).alias("last")).select(
        "digest", "last.group_size", "last.keeper"
    )


def exact_groups(docs: DataFrame, digest=full_digest, batches: int = 2) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without their space characters; a null text is empty. Of
    equal texts the one with the most code points stays, then the smallest doc_id, rows
    without an id last, and of rows repeated whole exactly one. ``digest`` may be any
    function of the normalised text: hits are settled by full bytes. An empty table gives no
    rows; other columns of ``docs`` are ignored.
    """
    with workspace(docs.sparkSession, "exact-dedup") as work:
        return staged(_grouped(docs, digest, batches, work), "exact-dedup-result")


def _grouped(docs: DataFrame, digest, batches: int, work: Workspace) -> DataFrame:
    spark, path = docs.sparkSession, work.folder()
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(whole(F.col("text"))).alias("n_points"),
        normalised(F.col("text")).alias("content"),
        F.monotonically_increasing_id().alias("locator"),
    )
    rows.withColumn("digest", digest(F.col("content"))).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    arrivals = rows.select("digest", "doc_id", "n_points", "locator")
    groups = work.staged(keep_state(spark, arrivals, path, batches))

    # Where only one row has a digest there is nothing to compare.
    many = groups.where("group_size > 1").select("digest", (-F.col("keeper.locator")).alias("keep_locator"))
    hits = arrivals.join(many, "digest").select("locator", "keep_locator")
    # The one shuffle of texts; what follows handles those of hits alone.
    texts = work.staged(rows.select("locator", "digest", "content").join(hits, "locator"))
    keepers = texts.where("locator = keep_locator").select(
        "keep_locator", F.col("content").alias("keep_content")
    )
    differing = (
        texts.where("locator != keep_locator")
        .join(keepers, "keep_locator")
        .where("content != keep_content")
        .select("digest")
        .distinct()
    )
    differing = work.staged(differing)
    if not differing.isEmpty():
        return _by_bytes(rows, groups, differing)
    return _answer(arrivals.join(groups, "digest"), F.col("digest"), digest is full_digest, rows)


def _answer(joined: DataFrame, key: Column, is_sha: bool, rows: DataFrame) -> DataFrame:
    if not is_sha:
        texts = rows.select("locator", full_digest(F.col("content")).alias("text_sha256"))
        joined, key = joined.join(texts, "locator"), F.col("text_sha256")
    return joined.select(
        "doc_id",
        (-F.col("keeper.id")).alias("keep_id"),
        "group_size",
        (F.col("locator") == -F.col("keeper.locator")).alias("kept"),
        key.alias("text_sha256"),
    )


def _by_bytes(rows: DataFrame, groups: DataFrame, differing: DataFrame) -> DataFrame:
    """The answer where some digests cover several texts: those are grouped by their bytes."""
    clean = _answer(
        rows.drop("content").join(groups.join(differing, "digest", "left_anti"), "digest"), F.col("digest"), False, rows
    )
    mixed = rows.join(differing, "digest", "left_semi")
    own = mixed.groupBy("digest", "content").agg(
        F.count("*").alias("group_size"), F.max(keeper()).cast(KEEPER).alias("keeper")
    )
    settled = mixed.join(own, ["digest", "content"])
    return clean.unionByName(_answer(settled.drop("content"), F.col("digest"), False, rows))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, in all their columns.

    Of rows with the same id and equal texts one stays, any of them if they differ elsewhere.
    """
    groups = exact_groups(docs)
    kept = groups.where("kept").select(F.col("doc_id").alias("kept_doc_id"), F.col("text_sha256").alias("kept_digest"))
    same_id = docs["doc_id"].eqNullSafe(F.col("kept_doc_id"))
    if groups.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.join(kept, same_id, "left_semi")
    own = "own_digest"
    while own in docs.columns:
        own += "_"
    told = docs.withColumn(own, full_digest(normalised(F.col("text"))))
    same = told["doc_id"].eqNullSafe(F.col("kept_doc_id")) & (told[own] == F.col("kept_digest"))
    return told.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
