"""Links between documents whose shingle sets have a high Jaccard similarity, and their components.

Equal sets are put together first, so what follows handles one row per different set. With a least
similarity t, two sets of which the smaller has n elements differ in n (1 - t) / t elements at
most. Two exact ways to find similar sets rest on that, and a cost model over the sizes of
all sets draws the boundary between them:

* light: a small set emits all subsets that lack so many elements or fewer; similar sets share
  the subset that is their intersection;
* heavy: a large set of n elements enters the inverted lists of its first n - tn + 1 elements in
  one global order, rare elements first; similar sets share one of them at least. For the first
  element two sets share, neither can share more than stands from its place on (positional filter),
  and of two similar sets the smaller one has it among its first n - 2tn / (1 + t) + 1 elements.

For the order, every task counts the elements of all its documents and reports those it has met
several times; what adds up to ``FREQUENT`` goes last, by way of a bitmap of fixed size. Any
order gives the same result: one that keeps shared passages out of the lists gives it sooner.

Lists are not expanded into pairs. The head of a list is the set with the fewest rarer elements,
which in a group of near copies is what they are copies of. Each set is first compared with
one head, that of most of its lists, and what proves similar is united. A list whose sets are
all united needs no further work; in the others, only pairs of different components that pass
the positional filter are compared: first by parity sketches, whose distance never
exceeds the number of differing elements, then as whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.bpe import text_batches
from strataflux.llm.common import Workspace, give_back, settings, staged, whole, workspace
from strataflux.llm.components import connected

BATCH_CHARS = 500_000
# Sets of long texts are large, so few rows travel to Python at a time.
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
# No set above this size is light, whatever the cost model says.
LIGHT_LIMIT = 40
# What an entry of an inverted list costs beside a subset: it may have to be compared.
LIST_COST = 4
# What tells rows apart: doc_id where it does.
KEY = "__row_key"
# A task reports elements it has met so often among so many; those of this total are frequent.
REPORTED, COUNTED = 2, 4_000_000
FREQUENT = 8
BITMAP_BITS = 1 << 25
SKETCH_BITS = 2048
# Ids of sets to compare are broadcast up to this number of rows, else joined by shuffling.
BROADCAST_ROWS = 1_000_000

ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: well spread values from any."""
    x = values + np.uint64((seed * int(ODD)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def one(value: int, seed: int) -> np.uint64:
    return mixed(np.array([value % (1 << 64)], np.uint64), seed)[0]


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes."""
    split = [text.encode().lower().split() for text in texts]
    words = [word for own in split for word in own]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    rolled = hashes
    for k in range(1, width):
        rolled = mixed(rolled[:-1] * ODD + hashes[k:], k) if len(rolled) > 1 else rolled[:0]
    start = 0
    for own in split:
        count = len(own)
        if count >= width:
            found = np.sort(rolled[start : start + count - width + 1])
            yield found[np.r_[True, found[1:] != found[:-1]]]
        elif count:
            # The whole sequence, told apart from any full shingle by its length.
            whole_of = xxhash.xxh64_intdigest(b" ".join(own), seed=count)
            yield np.array([whole_of], np.uint64)
        else:
            yield np.zeros(0, np.uint64)
        start += count


def differing(size: int, percent: int) -> int:
    """In how many elements a set may differ from one at least as large."""
    return size * (100 - percent) // percent


def first_elements(elements: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    """The elements by which a large set is listed: rare ones first, else by value."""
    count = len(elements) - -(-percent * len(elements) // 100) + 1
    place = elements % np.uint64(BITMAP_BITS)
    bits = frequent[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)
    often = (bits & 1).astype(bool)
    return np.concatenate([elements[~often], elements[often]])[:count]


def light_signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """Digests of all subsets that lack no more elements than may differ."""
    values = mixed(elements, 5)
    total, found = values.sum(), []
    for lacking in range(differing(len(elements), percent) + 1):
        picked = np.array(list(combinations(range(len(elements)), lacking)), np.int64)
        sums = total - (values[picked].sum(axis=1, dtype=np.uint64) if lacking else np.zeros(1, np.uint64))
        found.append(mixed(sums + one(len(elements) - lacking, 23), 29))
    return np.concatenate(found)


def light_cost(size: int, percent: int) -> int:
    return sum(comb(size, lacking) for lacking in range(differing(size, percent) + 1))


def heavy_cost(size: int, percent: int) -> int:
    return LIST_COST * (size - -(-percent * size // 100) + 1)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size, such that all signatures together cost least.

    Sets just below the boundary emit both kinds, as their partner may lie above it.
    """

    def total(limit: int) -> int:
        light = sum(n * light_cost(size, percent) for size, n in sizes.items() if size <= limit)
        return light + sum(
            n * heavy_cost(size, percent) for size, n in sizes.items() if 100 * size > percent * limit
        )

    return min(range(LIGHT_LIMIT + 1), key=total)


def sketch(elements: np.ndarray) -> bytes:
    """The parity of the number of elements in each of SKETCH_BITS groups."""
    groups = (elements >> np.uint64(40)).astype(np.int64) % SKETCH_BITS
    return np.packbits((np.bincount(groups, minlength=SKETCH_BITS) & 1).astype(bool)).tobytes()


DESCRIBED = "id bigint, size bigint, digest binary, sketch binary, element bigint, met bigint"
NAMES = ["id", "size", "digest", "sketch", "element", "met"]


class Counted:
    """Elements a task has met; room for so many, and for what one more text brings."""

    def __init__(self) -> None:
        self.held, self.total = np.empty(COUNTED, np.uint64), 0

    def reports(self, elements: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take elements in; a report each time the room is used up."""
        for start in range(0, len(elements), COUNTED):
            part = elements[start : start + COUNTED]
            if self.total + len(part) > COUNTED:
                yield self.report()
            self.held[self.total : self.total + len(part)] = part
            self.total += len(part)

    def report(self) -> pa.RecordBatch:
        """Elements met ``REPORTED`` times or more, and how often. Sorted in place, which takes no more room."""
        met = self.held[: self.total]
        met.sort()
        self.total = 0
        # An element met n times equals the one REPORTED - 1 places on n - REPORTED + 1 times.
        apart = REPORTED - 1
        again = met[apart:][met[apart:] == met[: max(0, len(met) - apart)]]
        first = np.flatnonzero(np.r_[True, again[1:] != again[:-1]]) if len(again) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[first, len(again)]) + apart
        empty = [pa.nulls(len(first), kind) for kind in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        columns = [*empty, pa.array(again[first].view(np.int64)), pa.array(counts.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=NAMES)


def described_sets(texts: DataFrame, width: int) -> DataFrame:
    """Per row of ``texts`` (id, text) its id, and size, digest and sketch of its set.

    On rows without a size, elements a task met often and how often.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        counted = Counted()
        for keys, own_texts in text_batches(batches, BATCH_CHARS):
            sizes, digests, sketches = [], [], []
            for own in shingle_sets(own_texts, width):
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                sketches.append(sketch(own))
                yield from counted.reports(own)
            columns = [
                pa.array(keys, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(sketches, pa.binary()),
                pa.nulls(len(keys), pa.int64()),
                pa.nulls(len(keys), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)
        if counted.total:
            yield counted.report()

    return texts.mapInArrow(work, DESCRIBED)


def frequent_bitmap(rows: DataFrame) -> bytes:
    """A bit for each hash of an element that is met often; BITMAP_BITS bits, whatever the input."""
    often = rows.where("element IS NOT NULL").groupBy("element").agg(F.sum("met").alias("met"))
    place = F.pmod(F.col("element"), F.lit(BITMAP_BITS)) + 1
    often = often.where(F.col("met") >= FREQUENT).select(place.alias("place"))
    pages = often.groupBy(F.bitmap_bucket_number("place").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    size = 4096
    found = bytearray(BITMAP_BITS // 8)
    for row in pages.collect():
        found[(row["page"] - 1) * size : row["page"] * size] = row["bits"]
    return bytes(found)


def list_entries(docs: DataFrame, width: int, percent: int, limit: int, bitmap: Broadcast) -> DataFrame:
    """(signature, id, size, position): the entries of all subset lists and inverted lists.

    The position is the element's in the global order of its set; subsets have position 0, which
    the positional filter lets pass.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        frequent = np.frombuffer(bitmap.value, np.uint8)
        for keys, texts in text_batches(batches, BATCH_CHARS):
            ids, found, places = [], [], []
            for key, own in zip(keys, shingle_sets(texts, width), strict=True):
                if 0 < len(own) <= limit:
                    signatures = light_signatures(own, percent)
                    found.append(signatures)
                    places.append(np.full(len(signatures), len(own) << 32))
                    ids.append(np.full(len(signatures), key))
                if 100 * len(own) > percent * limit:
                    signatures = mixed(first_elements(own, percent, frequent), 31)
                    found.append(signatures)
                    places.append((len(own) << 32) + np.arange(len(signatures)))
                    ids.append(np.full(len(signatures), key))
            if found:
                columns = [np.concatenate(found).view(np.int64), np.concatenate(ids), np.concatenate(places)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in columns], names=["signature", "id", "place"]
                )

    # Size and position travel as one number.
    return docs.mapInArrow(work, "signature bigint, id bigint, place bigint")


def unpacked(entries: DataFrame) -> DataFrame:
    size, position = F.shiftright("place", 32), F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    return entries.withColumns({"size": size, "position": position}).drop("place")


def needed(left: Column, right: Column, percent: int) -> Column:
    """How many elements similar sets of these sizes share at least."""
    return F.ceil(percent * (left + right) / F.lit(100 + percent))


def may_be_smaller(percent: int) -> Column:
    """Whether an entry's set can be the smaller one of a pair that meets first in this list."""
    return F.col("position") <= F.col("size") - needed(F.col("size"), F.col("size"), percent)


def few_or_shuffled(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if counted to be few, else left to a shuffled join."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def beside(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) with the columns ``known`` (id, ...) has for either."""
    for side in ("a", "b"):
        names = {name: f"{side}_{name}" for name in known.columns if name != "id"}
        pairs = pairs.join(known.withColumnsRenamed(names | {"id": side}), side)
    return pairs


def similar_pairs(
    docs: DataFrame, pairs: DataFrame, sketches: DataFrame, width: int, percent: int, work: Workspace
) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough.

    What the sketches and sizes leave is settled by the whole sets, which are made again from
    the texts of just these documents.
    """

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
            left, right = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)
                for name in ("a_sketch", "b_sketch")
            )
            apart = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
            keep = apart * (100 + percent) <= (100 - percent) * sizes
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_batches(batches, BATCH_CHARS):
            found = [own.tobytes() for own in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(found, pa.binary())], names=["id", "elements"]
            )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                a, b = (
                    np.frombuffer(batch.column(name)[k].as_buffer(), np.uint64)
                    for name in ("a_elements", "b_elements")
                )
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep[k] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    near = beside(pairs, sketches).where(near_in_size(F.col("a_size"), F.col("b_size"), percent))
    left = work.staged(near.mapInArrow(likely, "a bigint, b bigint"))
    wanted = work.staged(left.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    known = docs.join(few_or_shuffled(wanted), "id", "left_semi").mapInArrow(sets, "id bigint, elements binary")
    return work.staged(beside(left, work.staged(known)).mapInArrow(compared, "a bigint, b bigint"))


def near_in_size(left: Column, right: Column, percent: int) -> Column:
    return 100 * F.least(left, right) >= percent * F.greatest(left, right)


def keyed(docs: DataFrame, work: Workspace) -> tuple[DataFrame, bool]:
    """``docs`` with ``KEY``, and whether that is doc_id.

    Where ids repeat or are missing, rows are written with a number of their own.
    """
    doc_id = F.col("doc_id").cast("bigint")
    if docs.groupBy(doc_id.alias("id")).count().where("count > 1 OR id IS NULL").isEmpty():
        return docs.withColumn(KEY, doc_id), True
    return work.staged(docs.withColumn(KEY, F.monotonically_increasing_id())), False


def similar_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text).

    Words are what white space separates, with A-Z lower-cased. A text of fewer words than
    ``width`` is one shingle; a text without words, or null, has none and is linked with
    nothing. Sets are linked from a similarity of ``percent`` on, which must be over 50.
    component_id is the smallest doc_id reachable by links, the own one included. Every row stands for
    itself, whether others share its doc_id or it has none; component_id is null where no row
    reachable has an id. An empty table gives no rows; other columns are ignored.
    """
    with workspace(docs.sparkSession, "jaccard") as work, settings(docs.sparkSession, BATCH_ROWS):
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        rows, plain = keyed(rows, work)
        found = _components(rows, width, percent, work)
        if plain:
            named = found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
        else:
            found = work.staged(found.join(rows.select(F.col(KEY).alias("id"), "doc_id"), "id"))
            least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
            named = found.join(least, "component").select("doc_id", "n_shingles", "component_id")
        return staged(named, "jaccard-result")


def _components(rows: DataFrame, width: int, percent: int, work: Workspace) -> DataFrame:
    """id, n_shingles and component (the smallest id reachable) by the rows' ``KEY``."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50, up to 100")
    texts = rows.select(F.col(KEY).alias("id"), whole(F.col("text")).alias("text"))
    described = work.staged(described_sets(texts, width))
    rows = described.where("size IS NOT NULL").select("id", "size", "digest", "sketch")
    known = rows.where("size > 0")
    classes = work.staged(known.groupBy("digest").agg(F.min("id").alias("class")))
    reps = few_or_shuffled(classes.select(F.col("class").alias("id")))
    apart = texts.join(reps, "id", "left_semi")
    sketches = work.staged(known.join(reps, "id", "left_semi").select("id", "size", "sketch"))
    sizes = rows.where(F.col("size").between(1, LIGHT_LIMIT)).groupBy("size").count()
    limit = boundary({row["size"]: row["count"] for row in sizes.collect()}, percent)

    bitmap = texts.sparkSession.sparkContext.broadcast(frequent_bitmap(described))
    entries = work.staged(list_entries(apart, width, percent, limit, bitmap))
    lists = unpacked(entries).groupBy("signature").agg(
        F.min("id").alias("low"),
        F.max("id").alias("high"),
        F.min_by("id", "position").alias("head"),
        F.min(F.when(may_be_smaller(percent), F.col("size"))).alias("smallest"),
    )
    lists = work.staged(lists.where("low != high").select("signature", "head", "smallest"))
    members = work.staged(unpacked(entries.join(lists, "signature")))

    # Each set beside the head of most of its lists.
    headed = members.where("id != head").groupBy(F.col("id").alias("a"), F.col("head").alias("b")).count()
    chosen = headed.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b"))
    links = similar_pairs(apart, work.staged(chosen), sketches, width, percent, work)
    united = connected(links, work)

    # As the larger one of a pair, a set needs a smaller one that leaves it enough to share.
    remaining = F.col("size") - F.col("position")
    useful = may_be_smaller(percent) | (remaining >= needed(F.col("size"), F.col("smallest"), percent))
    named = members.where(useful).join(united, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = work.staged(named.select("signature", "id", "size", "position", "component"))
    ends = named.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_lists = ends.where("low != high").select("signature")
    left_over = work.staged(named.join(open_lists, "signature", "left_semi"))
    crossing = work.staged(crossing_pairs(left_over, percent))
    more = similar_pairs(apart, crossing, sketches, width, percent, work)
    grouped = connected(links.unionAll(more), work)
    bitmap.unpersist()

    grouped = grouped.withColumnRenamed("id", "class")
    out = rows.join(classes, "digest", "left").join(grouped, "class", "left")
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.coalesce("component", "class"))
    return out.select("id", F.col("size").alias("n_shingles"), component.alias("component"))


def crossing_pairs(named: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that may be similar.

    First the pairs of components that meet in lists are found, with how many pairs of sets their
    lists hold. A pair of components whose sets meet in list after list is compared set by set,
    which is less than that; of the others only sets that meet in a list and pass the
    positional filter there are. Either way no similar pair is left out.
    """
    small = may_be_smaller(percent).cast("int")
    groups = named.groupBy("signature", "component").agg(
        F.count("*").alias("n"),
        F.sum(small).alias("small"),
        F.max(F.col("size") - F.col("position")).alias("left"),
        F.min("size").alias("least"),
    )
    others = groups.withColumnsRenamed({"component": "other", **{c: f"other_{c}" for c in ("n", "small", "left", "least")}})
    enough = needed(F.col("least"), F.col("other_least"), percent)
    meeting = groups.join(others, "signature").where(
        (F.col("component") < F.col("other"))
        & (F.col("small") + F.col("other_small") > 0)
        & (F.least("left", "other_left") >= enough)
    )
    listed = meeting.groupBy("component", "other").agg(F.sum(F.col("n") * F.col("other_n")).alias("listed"))
    members = named.select("component", "id", "size").distinct()
    sizes = members.groupBy("component").agg(F.count("*").alias("sets"))
    other_sizes = sizes.withColumnsRenamed({"component": "other", "sets": "other_sets"})
    judged = listed.join(sizes, "component").join(other_sizes, "other")
    by_sets = F.col("sets") * F.col("other_sets") <= F.col("listed")

    left = members.withColumnsRenamed({"id": "a", "size": "a_size"})
    right = members.withColumnsRenamed({"component": "other", "id": "b", "size": "b_size"})
    near = near_in_size(F.col("a_size"), F.col("b_size"), percent)
    whole = judged.where(by_sets).select("component", "other").join(left, "component").join(right, "other").where(near)

    entries = named.select("signature", "component", "id", "size", "position")
    left = entries.withColumnsRenamed({"id": "a", "size": "a_size", "position": "a_position"})
    right = entries.withColumnsRenamed({"component": "other", "id": "b", "size": "b_size", "position": "b_position"})
    shared = F.least(F.col("a_size") - F.col("a_position"), F.col("b_size") - F.col("b_position"))
    passes = near & (shared >= needed(F.col("a_size"), F.col("b_size"), percent))
    places = meeting.select("signature", "component", "other")
    places = places.join(judged.where(~by_sets).select("component", "other"), ["component", "other"])
    single = places.join(left, ["signature", "component"]).join(right, ["signature", "other"]).where(passes)
    return whole.select("a", "b").unionAll(single.select("a", "b")).distinct()


def one_of_each(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Of each group of similar rows of ``docs`` the one with the smallest doc_id, in all its columns.

    Every row stands for itself: rows that share a doc_id, or have none, go together only if their texts
    are similar. A row without an id stays where none of its group has one; of equal ids any
    one row stays. Rows without words are similar to none and all stay.
    """
    with workspace(docs.sparkSession, "jaccard") as work, settings(docs.sparkSession, BATCH_ROWS):
        rows, plain = keyed(docs, work)
        found = _components(rows.select(KEY, "text"), width, percent, work)
        if plain:
            goes = found.where("id != component").select(F.col("id").alias(KEY))
        else:
            own = found.join(rows.select(F.col(KEY).alias("id"), F.col("doc_id").cast("bigint").alias("doc_id")), "id")
            own = work.staged(own)
            first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "id")).alias("first")
            stays = own.groupBy("component").agg(first).select(F.col("first.id").alias("id"))
            goes = own.join(stays, "id", "left_anti").select(F.col("id").alias(KEY))
        # Fewer than the rows that stay, so whole texts are shuffled only where these are many, too.
        goes = staged(goes, "jaccard-goes")
        # Rows that were written for their numbers outlive the workspace.
        rows = rows if plain else staged(rows, "jaccard-rows")
    return rows.join(few_or_shuffled(goes), KEY, "left_anti").drop(KEY)
