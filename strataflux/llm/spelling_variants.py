"""Words of a corpus grouped by spelling: one letter inserted, deleted or replaced.

A word's letters are a multiset, which is a binary vector with a dimension for every letter and
occurrence. One edit changes at most ``DISTANCE`` = 2 dimensions. PartEnum finds all vectors that near: the
dimensions are cut into ``FIRST_PARTS`` parts, in one of which two such vectors differ in at most
k = DISTANCE // FIRST_PARTS dimensions; that part is cut into ``SECOND_PARTS``, and all but k of
those agree. So a signature is made of each choice of all but k second parts of each first part, and near
words share one at least. Words are joined on their signatures, which hold the length they are compared
at besides, and a pair counts if the words themselves are one edit apart.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.llm.bpe import text_batches
from strataflux.llm.common import Workspace, staged, whole, workspace

LEAST_LENGTH, LEAST_COUNT = 6, 5
# How much more often a word's form occurs than the word.
FORM_RATIO = 5
DISTANCE = 2
FIRST_PARTS, SECOND_PARTS = 1, 7
MISSPELT_DIVISOR = 199
BATCH_CHARS = 1_000_000
# Words a task holds counts of before it passes them on.
HELD_WORDS = 200_000
RUN = re.compile("[a-zÀ-ÿ]+")


def runs_of_letters(text: str) -> list[str]:
    """Maximal runs of letters, A-Z lower-cased."""
    # Bytes know no upper case beyond A-Z.
    return RUN.findall(text.encode().lower().decode())


def misspelt(doc_id: int | None, run: str, start: int) -> str:
    """The run, without one code point where a checksum of it says so; ``start`` is that of its text's id."""
    check = zlib.crc32(run.encode(), start)
    if check % MISSPELT_DIVISOR:
        return run
    gone = check % len(run)
    return run[:gone] + run[gone + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n, its occurrences in all texts, for words of at least ``LEAST_LENGTH`` code points.

    Tasks pass on partial counts; Spark adds them up.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))

    def partial(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for keys, texts in text_batches(batches, BATCH_CHARS):
            for key, text in zip(keys, texts, strict=True):
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in Counter(runs_of_letters(text)).items():
                    if len(run) >= LEAST_LENGTH:
                        word = misspelt(key, run, start)
                        if len(word) >= LEAST_LENGTH:
                            held[word] += n
            if len(held) >= HELD_WORDS:
                yield partial(held)
                held = Counter()
        if held:
            yield partial(held)

    found = rows.mapInArrow(work, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=4096)
def part_of(dimension: tuple[str, int]) -> tuple[int, int]:
    """The first and second part of a letter's occurrence."""
    mixed = xxhash.xxh64_intdigest(f"{dimension[0]}{dimension[1]}".encode(), seed=11)
    return mixed % FIRST_PARTS, mixed // FIRST_PARTS % SECOND_PARTS


def signatures(word: str) -> list[int]:
    """All signatures of the multiset of a word's letters, as 64-bit numbers."""
    parts: list[list[list[str]]] = [[[] for _ in range(SECOND_PARTS)] for _ in range(FIRST_PARTS)]
    for letter, count in Counter(word).items():
        for k in range(count):
            first, second = part_of((letter, k))
            parts[first][second].append(f"{letter}{k}")
    differing = DISTANCE // FIRST_PARTS
    found = []
    for first, own in enumerate(parts):
        texts = [" ".join(sorted(part)) for part in own]
        for chosen in combinations(range(SECOND_PARTS), SECOND_PARTS - differing):
            content = "|".join([str(first), *(f"{k}:{texts[k]}" for k in chosen)])
            # Words one edit apart differ in length by one at most, so they share one of two lengths.
            for length in (len(word) - 1, len(word)):
                found.append(xxhash.xxh64_intdigest(content.encode(), seed=length) - (1 << 63))
    return found


def near_pairs(words: DataFrame, work: Workspace) -> DataFrame:
    """Distinct pairs (a, b), a before b, of words one inserted, deleted or replaced code point apart."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            found = [signatures(word) for word in own]
            columns = [
                pa.array([word for word, part in zip(own, found, strict=True) for _ in part], pa.string()),
                pa.array([signature for part in found for signature in part], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "signature"])

    entries = work.staged(words.select("word").mapInArrow(signed, "word string, signature bigint"))
    left, right = entries.withColumnRenamed("word", "a"), entries.withColumnRenamed("word", "b")
    met = left.join(right, "signature").where("a < b AND abs(length(a) - length(b)) <= 1")
    return work.staged(met.where("levenshtein(a, b, 1) = 1").select("a", "b").distinct())


def grouped(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root for every row of ``words`` (word, n), words being distinct.

    A word's form is its near word of largest n, of several the smallest in code-point order, if it occurs
    ``FORM_RATIO`` times as often; root is where following forms ends. An empty table gives no rows.
    """
    with workspace(words.sparkSession, "spelling") as work:
        return staged(_grouped(work.staged(words.select("word", "n")), work), "spelling-result")


def _grouped(words: DataFrame, work: Workspace) -> DataFrame:
    pairs = near_pairs(words, work)
    known = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = work.staged(both.join(known, "b"))
    met = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.max("b_n").alias("most"))
    # Of the near words of largest n the smallest in code-point order.
    first = both.join(met.select(F.col("word").alias("a"), "most"), "a").where("b_n = most")
    first = first.groupBy(F.col("a").alias("word")).agg(F.min("b").alias("near"))
    told = words.join(met, "word", "left").join(first, "word", "left")
    formed = F.col("most") >= FORM_RATIO * F.col("n")
    told = work.staged(
        told.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("near")).alias("form"),
            F.when(formed, F.col("most")).alias("form_n"),
        )
    )
    # Each round looks twice as far; n grows FORM_RATIO times with each form, so rounds are few.
    ahead = work.staged(told.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = work.staged(ahead.join(further, "root").select("word", "root", "further"))
        settled = moved.where("root != further").isEmpty()
        ahead = moved.select("word", F.col("further").alias("root"))
        if settled:
            return told.join(ahead, "word")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for the words of ``docs`` (doc_id, text).

    Words are maximal runs of the letters A-Z, a-z and those from U+00C0 to U+00FF, A-Z lower-cased, of
    at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences. Where a checksum of doc_id and
    run says so, a run loses one code point first; a row without an id counts as one with an
    empty id. A null text has no words; every one of repeated rows counts; an empty table gives no
    rows; other columns are ignored.
    """
    often = word_counts(docs).where(F.col("n") >= LEAST_COUNT)
    return grouped(often).select("word", "form", "root", "n", "n_near", "form_n")
