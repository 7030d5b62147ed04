"""A mix of sources at given weights, in which documents are left out or repeated.

Words are summed per source. Sources share as many words as there are by their weights; no target passes
``most`` times its source's words, and what is left over is shared again by weight until none does. A
source's target over its words is its rate: each document is emitted floor(rate) times, and once more with
the fraction as probability, drawn from a hash of the document. Rows of sources, not of documents, carry
the arithmetic; the sums that settle the targets are whole numbers, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.common import SPACE_CLASS, Workspace, staged, whole, workspace

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
# A draw is so many hexadecimal digits of a digest.
DIGITS = 13


def n_words(text: Column) -> Column:
    """Words between white space: a word begins where a character follows no other."""
    return F.regexp_count(whole(text), F.lit(f"[^{SPACE_CLASS}]+")).cast("bigint")


def draw(key: Column, text: Column) -> Column:
    """A number from 0 up to 1, from the digest of seed, id and text."""
    shown = F.concat_ws(":", F.lit(SEED), F.coalesce(key.cast("string"), F.lit("")), F.md5(whole(text).cast("binary")))
    digits = F.conv(F.substring(F.md5(shown.cast("binary")), 1, DIGITS), 16, 10).cast("bigint")
    return digits.cast("double") / F.lit(float(1 << (4 * DIGITS)))


def ranked(sources: DataFrame, work: Workspace) -> DataFrame:
    """Sources with their rank from 0 in code-point order, the missing one last.

    Sorted by ranges; ranks within a range and the sizes of the ranges before add up, so no task sees
    all sources. The driver handles a number for each range.
    """
    ordered = sources.orderBy(F.asc_nulls_last("source"))
    ordered = work.staged(ordered.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, starts = 0, []
    for row in sizes:
        starts += [F.lit(row["part"]), F.lit(before)]
        before += row["count"]
    if not starts:
        return ordered.withColumn("rank", F.lit(0).cast("bigint")).drop("place")
    offset = F.element_at(F.create_map(*starts), part)
    return ordered.withColumn("rank", offset + F.col("place").bitwiseAND((1 << 33) - 1)).drop("place")


def shared_out(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with target: the sum of sizes shared by weight.

    A source at ``most`` times its size leaves the sharing; this lowers nobody's share, so rounds go on until none
    joins them. A round is one aggregate; the driver handles its two sums.
    """
    cap = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    capped, left = F.lit(False), None
    while True:
        sums = sources.agg(
            F.sum(F.when(capped, cap).otherwise(0)).alias("taken"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(capped.cast("int")).alias("n"),
        ).first()
        if not sums["weights"]:
            return sources.withColumn("target", cap.cast("double"))
        if left is not None and sums["n"] == left[2]:
            share = F.lit(float(total - sums["taken"])) * F.col("weight") / F.lit(float(sums["weights"]))
            return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share))
        left = (total - sums["taken"], sums["weights"], sums["n"])
        # Compared as whole numbers: share >= cap.
        wide = F.lit(left[0]).cast("decimal(38,0)") * F.col("weight").cast("decimal(18,0)")
        reached = wide >= cap.cast("decimal(20,0)") * F.lit(left[1]).cast("decimal(18,0)")
        capped = reached


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` with size, source_size, target and copies: how often the mix takes each row.

    Sources in code-point order, the missing one last, weigh ``weights``, repeating. A null text
    has size 0; a source of size 0 has target 0 and none of its rows is taken. Rows repeated
    whole share one draw. An empty table gives no rows; other columns stay, those of the four new
    names give way to them.
    """
    new = ["size", "source_size", "target", "copies"]
    docs = docs.drop(*[name for name in docs.columns if name in new])
    with workspace(docs.sparkSession, "mix") as work:
        sized = docs.select("source", n_words(F.col("text")).alias("size"))
        sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        sources = ranked(sources, work)
        weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
        sources = work.staged(sources.withColumn("weight", weight.cast("bigint")).drop("rank"))
        targets = staged(shared_out(sources, most), "mix-targets")
    named = targets.select(F.col("source").alias("__source"), "source_size", "target")
    found = docs.join(named, docs["source"].eqNullSafe(F.col("__source"))).drop("__source")
    found = found.withColumn("size", n_words(F.col("text")))
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    extra = (draw(F.col("doc_id"), F.col("text")) < rate - F.floor(rate)).cast("bigint")
    return found.withColumn("copies", F.floor(rate) + extra)


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of a mixture as often as it takes them."""
    once = F.array_repeat(F.lit(True), F.col("copies").cast("int"))
    return mixed.withColumn("__copy", F.explode(once)).drop("__copy")


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of ``docs`` (doc_id, text, source)."""
    found = mixture(docs.select("doc_id", "text", "source"))
    taken = F.col("size") * F.col("copies")
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))
