"""Benchmark decontamination by SimHash over item-sized windows.

A benchmark item of n words is compared with windows of n words of the documents. Items and
windows have a bag of five-word shingles; a shingle's weight is how often it occurs. Steps:

1. A window as similar as asked shares a least number of shingles with its item, so windows are taken
   at every start where that many places hold a shingle of an item of its size, and nowhere else.
2. Each window gets a 64-bit SimHash of its bag, as each item has.
3. Multi-index: fingerprints are cut into blocks of 8 bits. Within a distance of ``RADIUS`` bits
   some block differs in RADIUS // 8 bits at most, so the index holds every item under all
   such values of every block, and an equality join finds all pairs within the radius.
4. The weighted Jaccard similarity of the whole bags decides.

At a similarity of 0.8 a bit differs with a chance of 0.152, so the distance is 9.7 bits on
average with a deviation of 2.9, and the radius of 23 lies 4.8 deviations above.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.common import Workspace, staged, whole, workspace

WIDTH = 5
SIMILARITY = 0.8
BITS, BLOCK_BITS, RADIUS = 64, 8, 23
# Item shingles and windows are broadcast up to this number of rows, else joined by shuffling.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(whole(text)), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, in order; none where there are fewer words."""
    hashes = F.transform(words, lambda word: F.xxhash64(word))

    def rolled(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - width)
        found = F.transform(starts, lambda k: F.xxhash64(*[hashes[k + j] for j in range(width)]))
        return F.when(F.size(hashes) >= width, found).otherwise(F.array().cast("array<bigint>"))

    return _let(hashes, rolled)


def _let(value: Column, use) -> Column:
    """Name a value inside an expression, so that it is computed once."""
    return F.transform(F.array(value), use)[0]


def fingerprint(bag: Column) -> Column:
    """SimHash: bit b is set where more of the bag's hashes have it set than not."""

    def bit(place: Column) -> Column:
        votes = F.aggregate(
            bag, F.lit(0), lambda total, each: total + F.getbit(each, place).cast("int") * 2 - 1
        )
        set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        return F.when(votes > 0, set_bit).otherwise(F.lit(0).cast("bigint"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda total, each: total.bitwiseOR(each))


def weighted_similarity(left: Column, right: Column) -> Column:
    """Sum of the smaller weights over the sum of the larger ones."""

    def weight(bag: Column, each: Column) -> Column:
        return F.size(F.filter(bag, lambda other: other == each))

    distinct = F.array_intersect(left, right)
    both = F.aggregate(
        distinct, F.lit(0), lambda total, each: total + F.least(weight(left, each), weight(right, each))
    )
    return _let(both, lambda shared: shared / (F.size(left) + F.size(right) - shared).cast("double"))


def blocks_of(print_: Column) -> Column:
    """(number, value) of the blocks of a fingerprint."""
    count = BITS // BLOCK_BITS
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("number"),
                F.shiftrightunsigned(print_, k * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1).alias("value"),
            )
            for k in range(count)
        ]
    )


def near_masks(errors: int) -> list[int]:
    """All changes of a block in up to ``errors`` bits."""
    return [
        sum(1 << bit for bit in bits) for n in range(errors + 1) for bits in combinations(range(BLOCK_BITS), n)
    ]


def described_items(items: DataFrame) -> DataFrame:
    """item_id, n (words), width and bag of every item that has a word."""
    rows = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    rows = rows.withColumn("n", F.size("words"))
    bags = [F.when(F.least("n", F.lit(WIDTH)) == k, shingles_of(F.col("words"), k)) for k in range(1, WIDTH + 1)]
    return rows.select("item_id", "n", F.least("n", F.lit(WIDTH)).alias("width"), F.coalesce(*bags).alias("bag"))


def bounded(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if counted to be few, else left to a shuffled join."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def starts_of(places: Column, size: Column, least: Column) -> Column:
    """All starts of windows of ``size`` places with ``least`` or more of the ascending ``places``."""

    def run(k: Column) -> Column:
        # Starts whose first place of ``places`` is number k; those before belong to earlier numbers.
        first = F.greatest(F.lit(0), places[k + least - 1] - size + 1)
        first = F.when(k > 0, F.greatest(first, places[F.greatest(k - 1, F.lit(0))] + 1)).otherwise(first)
        last = places[k]
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    runs = F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - least), run))
    return F.when(F.size(places) >= least, runs).otherwise(F.array().cast("array<int>"))


def windows(docs: DataFrame, items: DataFrame, width: int, work: Workspace, similarity: float) -> DataFrame:
    """row, n, start and bag of the windows that can be as similar to an item of n words.

    Windows of a row with the same bag are equally similar to every item, so the first stands for
    all of them: a text that repeats a passage has as many as the passage has places.
    """
    own = items.where(F.col("width") == width)
    wanted = work.staged(own.select("n", F.explode("bag").alias("shingle")).distinct())
    rows = docs.select("row", shingles_of(words_of(F.col("text")), width).alias("shingles"))
    seen = rows.select("row", F.size("shingles").alias("count"), F.posexplode("shingles").alias("place", "shingle"))
    matched = seen.join(bounded(wanted), "shingle").groupBy("row", "n", "count")
    matched = matched.agg(F.array_sort(F.collect_set("place")).alias("places"))
    size = F.col("n") - width + 1
    # A window that would stick out is moved inside; a text shorter than the item is one window.
    latest = F.greatest(F.lit(0), F.col("count") - size)
    # Rounded down by more than the error of the division, never up.
    shared = similarity / (1 + similarity) * (size + F.least(size, F.col("count"))) - 1e-6
    least = F.greatest(F.lit(1), F.ceil(shared).cast("int"))
    found = matched.select("row", "n", "places", size.alias("size"), latest.alias("latest"), least.alias("least"))
    found = found.where(F.size("places") >= F.col("least"))
    every = starts_of(F.col("places"), F.col("size"), F.col("least"))
    inside = F.filter(every, lambda start: start <= F.col("latest"))
    starts = work.staged(found.select("row", "n", F.explode(inside).alias("start")))
    where = starts.groupBy("row").agg(F.collect_list(F.struct("n", "start")).alias("starts"))
    where = F.broadcast(where) if starts.count() <= BROADCAST_ROWS else where
    cut = rows.join(where, "row").select("row", "shingles", F.explode("starts").alias("at"))
    bag = F.slice("shingles", F.col("at.start") + 1, F.col("at.n") - width + 1)
    cut = cut.select("row", "at.n", "at.start", bag.alias("bag"))
    return cut.groupBy("row", "n", "bag").agg(F.min("start").alias("start"))


def contaminations(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, similarity and first_word of every document that holds an item.

    One row per document and item, for its most similar window of all, of equals the first. ``docs`` has
    doc_id and text, ``items`` item_id and text; other columns are ignored. Items of fewer than
    five words have one shingle, the whole of them; items and texts without words, null ones
    included, match nothing. Every row is examined by itself; rows that share a doc_id, or have none,
    give one answer, that of the most similar. Empty tables give no rows.
    """
    with workspace(docs.sparkSession, "decontaminate") as work:
        found = _held(docs, items, similarity, work)
        best = found.groupBy(F.col("row.doc_id").alias("doc_id"), "item_id").agg(
            F.max("similarity").alias("similarity"),
            F.max_by(F.col("start"), F.struct("similarity", -F.col("start"))).cast("bigint").alias("first_word"),
        )
        return staged(best, "decontaminate-result")


def row_key(docs: DataFrame) -> Column:
    """What tells rows apart: doc_id, null as it may be, and a digest of the text."""
    return F.struct(
        docs["doc_id"].cast("bigint").alias("doc_id"), F.unhex(F.sha2(whole(docs["text"]), 256)).alias("digest")
    )


def _held(docs: DataFrame, items: DataFrame, similarity: float, work: Workspace) -> DataFrame:
    """row, item_id, similarity and start of the distinct windows as similar as asked."""
    texts = docs.select(row_key(docs).alias("row"), docs["text"].alias("text"))
    described = work.staged(described_items(items.select("item_id", "text")).distinct())
    widths = sorted(row["width"] for row in described.select("width").distinct().collect())
    prints = work.staged(described.withColumn("print", fingerprint(F.col("bag"))))
    masks = F.array(*[F.lit(mask).cast("bigint") for mask in near_masks(RADIUS // (BITS // BLOCK_BITS))])
    index = prints.select("item_id", "n", "print", F.explode(blocks_of(F.col("print"))).alias("block"))
    index = index.select(
        F.col("item_id"),
        F.col("n"),
        F.col("print").alias("item_print"),
        F.col("block.number").alias("number"),
        F.explode(F.transform(masks, lambda mask: F.col("block.value").bitwiseXOR(mask))).alias("value"),
    )
    found = None
    for width in widths:
        cut = windows(texts, described, width, work, similarity)
        cut = work.staged(cut.withColumn("print", fingerprint(F.col("bag"))))
        keys = cut.select("row", "n", "start", "print", F.explode(blocks_of(F.col("print"))).alias("block"))
        keys = keys.select("row", "n", "start", "print", "block.number", "block.value")
        near = keys.join(index, ["n", "number", "value"])
        near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        near = near.select("row", "n", "start", "item_id").distinct()
        bags = prints.where(F.col("width") == width).select("item_id", "n", F.col("bag").alias("item_bag"))
        both = near.join(cut.select("row", "n", "start", "bag"), ["row", "n", "start"]).join(
            bags, ["item_id", "n"]
        )
        both = both.withColumn("similarity", weighted_similarity(F.col("bag"), F.col("item_bag")))
        both = both.where(F.col("similarity") >= similarity)
        both = both.select("row", "item_id", "similarity", "start")
        found = both if found is None else found.unionAll(both)
    return docs.sparkSession.createDataFrame([], HELD) if found is None else found


HELD = "row struct<doc_id: bigint, digest: binary>, item_id bigint, similarity double, start int"


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, in all their columns."""
    with workspace(docs.sparkSession, "decontaminate") as work:
        held = staged(_held(docs, items, SIMILARITY, work).select("row").distinct(), "decontaminate-held")
    return docs.join(held, row_key(docs) == held["row"], "left_anti")
