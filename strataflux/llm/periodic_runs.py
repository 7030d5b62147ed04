"""Periodic runs of words, by suffix trees of a text and of its reversal.

A run is a stretch that repeats with some smallest period and cannot be made longer. Each run has a
Lyndon root: for one of two opposite orders of words, the longest Lyndon word that starts at
some place of the run is as long as the period. So the candidates are two per place, and a
candidate is extended by longest common extensions: to the right in the suffix tree of the text, to the
left in that of its reversal. The trees are built by Ukkonen's algorithm; an extension is
the depth of a lowest common ancestor, found in constant time in the Euler tour.

Only words that can lie in a run enter the trees. In a run of period q and at least 4q words
every three words recur at most q words away, so stretches in which they do not are left out.
What is left of the texts of a batch shares one pair of trees, each stretch between separators of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.bpe import text_batches
from strataflux.llm.common import SPACE_CLASS, whole

LEAST_WORDS, LEAST_EXPONENT = 6, 4
# Words that recur together in a run; a run of LEAST_WORDS holds several such groups.
GROUP = 3
BATCH_CHARS = 1_000_000
BLOCK = 16
ROUNDS = 6
PLANTED_DIVISOR = 10

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixTree:
    """The suffix tree of a text whose last symbol occurs nowhere else."""

    def __init__(self, text: list[int], width: int) -> None:
        self.size = len(text)
        self.starts, self.ends, self.suffix, edges = grown(text, width)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.parents, self.symbols = keys // width, keys % width
        self.children = np.fromiter(edges.values(), np.int64, len(edges))

    def ordered(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """Children by parent and then by ``symbols``; where those of each node begin."""
        order = np.lexsort((symbols, self.parents))
        counts = np.bincount(self.parents, minlength=len(self.starts))
        return self.children[order].tolist(), np.concatenate([[0], np.cumsum(counts)]).tolist()

    def ranks(self, symbols: np.ndarray) -> list[int]:
        """The rank of each suffix where symbols compare as ``symbols`` do."""
        children, begins = self.ordered(symbols)
        suffix, rank, found, open_nodes = self.suffix, [0] * self.size, 0, [0]
        while open_nodes:
            node = open_nodes.pop()
            if suffix[node] >= 0:
                rank[suffix[node]] = found
                found += 1
            else:
                open_nodes.extend(reversed(children[begins[node] : begins[node + 1]]))
        return rank

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths along the Euler tour, and where in it each suffix has its leaf."""
        children, begins = self.ordered(self.symbols)
        starts, ends, suffix = self.starts, self.ends, self.suffix
        depth, pointer = [0] * len(starts), begins[:-1]
        depths, places, path = [0], [0] * self.size, [0]
        while path:
            node = path[-1]
            at = pointer[node]
            if at == begins[node + 1]:
                path.pop()
                if path:
                    depths.append(depth[path[-1]])
                continue
            pointer[node] = at + 1
            child = children[at]
            depth[child] = depth[node] + ends[child] - starts[child]
            if suffix[child] >= 0:
                places[suffix[child]] = len(depths)
                depths += (depth[child], depth[node])
            else:
                depths.append(depth[child])
                path.append(child)
        return np.array(depths, np.int64), np.array(places, np.int64)

    def extensions(self) -> Extensions:
        return Extensions(*self.tour())


def grown(text: list[int], width: int) -> tuple[list[int], list[int], list[int], dict[int, int]]:
    """Ukkonen's construction: where the label of each node's edge begins and ends, the suffix
    of a leaf (-1 for other nodes), and the child by node * width + symbol."""
    size = len(text)
    starts, ends, suffix, links = [0], [0], [-1], [0]
    edges: dict[int, int] = {}
    node = edge = length = pending = 0
    for at, symbol in enumerate(text):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = at
            key = node * width + text[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(starts)
                parent = node
            else:
                span = ends[child] - starts[child]
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                middle = starts[child] + length
                if text[middle] == symbol:
                    length += 1
                    if unlinked:
                        links[unlinked] = node
                    break
                parent = edges[key] = len(starts)
                starts.append(starts[child])
                ends.append(middle)
                suffix.append(-1)
                links.append(0)
                starts[child] = middle
                edges[parent * width + text[middle]] = child
                edges[parent * width + symbol] = len(starts)
            starts.append(at)
            ends.append(size)
            suffix.append(at - pending + 1)
            links.append(0)
            if unlinked:
                links[unlinked] = parent
            unlinked = parent
            pending -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                edge = at - pending + 1
    return starts, ends, suffix, edges


class Extensions:
    """How far two suffixes agree: the least depth between their leaves in the Euler tour.

    Least depths are kept towards both ends of each block of the tour, and of stretches of
    whole blocks as long as each power of two.
    """

    def __init__(self, depths: np.ndarray, places: np.ndarray) -> None:
        blocks = -(-len(depths) // BLOCK)
        padded = np.zeros(blocks * BLOCK, np.int32)
        padded[: len(depths)] = depths
        by_block = padded.reshape(blocks, BLOCK)
        self.depths, self.places = padded, places
        self.heads = np.minimum.accumulate(by_block, axis=1).ravel()
        self.tails = np.minimum.accumulate(by_block[:, ::-1], axis=1)[:, ::-1].ravel()
        self.powers = [by_block.min(axis=1)]
        while (step := 1 << len(self.powers)) <= blocks:
            last = self.powers[-1]
            self.powers.append(np.minimum(last[: blocks - step + 1], last[step // 2 : blocks - step // 2 + 1]))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For suffixes that differ pair by pair."""
        one, two = self.places[left], self.places[right]
        low, high = np.minimum(one, two), np.maximum(one, two)
        first, last = low // BLOCK, high // BLOCK
        found = np.minimum(self.tails[low], self.heads[high])
        inside = last - first - 1
        spans = np.flatnonzero(inside > 0)
        level = np.frexp(inside[spans].astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            chosen = spans[level == k]
            table = self.powers[k]
            far = np.minimum(table[first[chosen] + 1], table[last[chosen] - (1 << k)])
            found[chosen] = np.minimum(found[chosen], far)
        near = np.flatnonzero(first == last)
        reach = np.minimum(low[near][:, None] + np.arange(BLOCK), high[near][:, None])
        found[near] = self.depths[reach].min(axis=1)
        return found.astype(np.int64)


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each suffix the next one that is smaller, which is where its longest Lyndon word ends."""
    size = len(rank)
    found = [size] * size
    for at in range(size - 2, -1, -1):
        other, own = at + 1, rank[at]
        while other < size and rank[other] > own:
            other = found[other]
        found[at] = other
    return np.array(found, np.int64)


def runs_between(text: np.ndarray, separators: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs between separators, in order.

    Symbols below ``separators`` are separators, each of which occurs once; one stands at either end.
    """
    size, width = len(text), int(text.max()) + 1
    forward, backward = SuffixTree(text.tolist(), width), SuffixTree(text[::-1].tolist(), width)
    symbols = forward.symbols
    # Separators stay the smallest symbols in either order, so a stretch's end ends every word.
    turned = np.where(symbols < separators, symbols, width + separators - 1 - symbols)
    begin = np.tile(np.flatnonzero(text >= separators), 2)
    half = len(begin) // 2
    orders = (symbols, turned)
    end = np.concatenate([next_smaller(forward.ranks(order))[begin[:half]] for order in orders])
    right = end + forward.extensions().of(begin, end)
    left = begin - backward.extensions().of(size - begin, size - end)
    period = end - begin
    wanted = right - left >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * period)
    found = np.unique(np.stack([left[wanted], period[wanted], (right - left)[wanted]]), axis=1)
    return found[0], found[2], found[1]


def stretches(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that can hold runs; none reaches over two texts.

    ``words`` are the words of texts of so many words each, as numbers. Groups are told apart by
    a hash, which can only add stretches.
    """
    empty = np.zeros(0, np.int64)
    if len(words) < LEAST_WORDS:
        return empty, empty
    numbers = words.astype(np.uint64)
    texts = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = texts[: len(words) - GROUP + 1] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(GROUP):
        key = (key ^ numbers[k : len(words) - GROUP + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    gap = np.full(len(key) + 1, len(words), np.int64)
    here, there = order[again], order[again + 1]
    gap[here] = there - here
    gap[there] = np.minimum(gap[there], there - here)
    ends = np.cumsum(counts)[counts > 0]
    for k in range(1, GROUP):
        gap[np.maximum(0, ends[ends - k < len(gap)] - k)] = len(words)
    able = gap < len(words)
    for _ in range(ROUNDS):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], able, [False]]).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        lengths = stops - starts + GROUP - 1
        # A period is at most a quarter of its run, and so of the stretch.
        most = np.zeros(len(able), np.int64)
        most[able] = np.repeat(np.where(lengths >= LEAST_WORDS, lengths // LEAST_EXPONENT, 0), stops - starts)
        kept = able & (gap <= most)
        if kept.sum() == able.sum():
            break
        able = kept
    edges = np.flatnonzero(np.diff(np.concatenate([[False], able, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] + GROUP - 1


def runs_of(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of texts of so many words each, in order."""
    starts, ends = stretches(words, counts)
    if not len(starts):
        return starts, starts, starts
    cut = len(starts) + 1
    sizes = ends - starts
    # A separator before each stretch and one at the end.
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.empty(offsets[-1] + 1, np.int64)
    text[offsets] = np.arange(cut)
    places = np.ones(len(text), bool)
    places[offsets] = False
    origin = np.repeat(starts - offsets[:-1] - 1, sizes + 1)
    inside = np.flatnonzero(places)
    text[inside] = np.unique(words[inside + origin[inside]], return_inverse=True)[1] + cut
    found, lengths, periods = runs_between(text, cut)
    return found + origin[found], lengths, periods


def word_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs and collapsed for every row of ``docs`` (doc_id, text).

    Words are what white space separates. ``runs`` holds start, length and period in words of every
    run of at least ``LEAST_WORDS`` words and ``LEAST_EXPONENT`` periods, by start and period;
    ``collapsed`` the words that no run contains after its first period, joined by one space. A text
    that is null, empty or without words has no runs and collapses to an empty text. Repeated
    rows are answered each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_batches(batches, BATCH_CHARS):
            split = [text.encode().split() for text in texts]
            counts = np.array([len(own) for own in split], np.int64)
            known: dict[bytes, int] = {}
            numbers = (known.setdefault(word, len(known)) for own in split for word in own)
            words = np.fromiter(numbers, np.int64, int(counts.sum()))
            starts, lengths, periods = runs_of(words, counts)
            borders = np.concatenate([[0], np.cumsum(counts)])
            kept = np.zeros(len(words) + 1, np.int64)
            np.add.at(kept, starts + periods, 1)
            np.add.at(kept, starts + lengths, -1)
            kept = np.cumsum(kept) == 0
            cuts = np.searchsorted(starts, borders).tolist()
            collapsed = []
            for k, own in enumerate(split):
                if cuts[k] < cuts[k + 1]:
                    mask = kept[borders[k] : borders[k + 1]].tolist()
                    own = [word for word, stays in zip(own, mask, strict=True) if stays]
                collapsed.append(b" ".join(own))
            within = starts - np.repeat(borders[:-1], np.diff(cuts))
            entries = pa.StructArray.from_arrays(
                [pa.array(column, pa.int64()) for column in (within, lengths, periods)], names=["start", "length", "period"]
            )
            columns = [
                pa.array(keys, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), entries).cast(kind),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(work, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where texts chosen by a checksum of their id repeat what stands after some word.

    Texts without an id, without words or not chosen stay as they are.
    """
    text = whole(F.col("text"))
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
        (check % PLANTED_DIVISOR == 0).alias("chosen"),
        F.floor(check / PLANTED_DIVISOR).alias("g"),
    )
    words = F.filter(F.split(F.col("text"), f"[{SPACE_CLASS}]+"), lambda word: word != "")
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    first = F.col("g") % F.col("n")
    rows = rows.withColumn("first", F.when(F.col("n") > 0, first))
    rows = rows.withColumn("every", 1 + F.floor((F.col("n") - F.col("first")) / (3 + F.col("g") % 8)))

    def place(at: Column) -> Column:
        return F.when(at < F.col("first"), at).otherwise(F.col("first") + F.pmod(at - F.col("first"), F.col("every")))

    repeated = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1), lambda at: F.element_at("words", (place(at) + 1).cast("int"))
    )
    planted = F.when(F.col("chosen") & (F.col("n") > 0), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", planted.alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its longest run and digests of all runs and of the collapsed text.

    Of runs of equal length the one with the smallest start comes first, then the smallest period.
    """
    found = word_runs(with_planted_runs(docs))
    ranked = F.transform("runs", lambda run: F.struct(run.length, (-run.start).alias("first"), (-run.period).alias("q")))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run.start, run.length, run.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", F.array_max(ranked))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.first")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("best.length * 1000 div -best.q").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
