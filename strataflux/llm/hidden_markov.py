"""Scoring texts with a hidden Markov language model.

A state emits the class of a word, the class emits the word. Frequent words are classes of their
own, the others share a class with those of the same ending; within a class a word has its
smoothed share of the corpus count. The number of classes is a parameter, so the model is
small enough to hand to every task, while word counts, the vocabulary and the Baum-Welch
expectations come from all training documents.

Words are numbered within blocks of documents. Only a block's distinct words are shuffled, once to
gather the corpus counts and once to bring them back, and never the tokens. The classes
of each document are then staged in order of length, so that documents of like length are worked
off side by side in numpy. Each round of Baum-Welch sums the expected counts of all partitions
and re-estimates on the driver from states x classes numbers. The scaled forward recursion
gives the exact likelihood of a whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.bpe import SLICE_ROWS
from strataflux.llm.common import Workspace, staged, whole, workspace

STATES = 6
FREQUENT = 1023
ENDINGS = 1024
CLASSES = 1 + FREQUENT + ENDINGS
ENDING_BYTES = 3
ROUNDS = 4
STAY = 0.95
SPREAD = 0.5
# Memory bounds in a worker: characters of a block, tokens worked off side by side.
BLOCK_CHARS = 32_000_000
SIDE_BY_SIDE = 400_000
DICTIONARY_ROWS = 10_000
# The end of a text is a token and a class of its own.
END = 0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


BLOCKS = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_words", pa.int64()),
        ("numbers", pa.binary()),
        ("first", pa.int64()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("endings", pa.list_(pa.int32())),
    ]
)
BLOCKS_SQL = (
    "block bigint, doc_id bigint, held_out boolean, n_words bigint, numbers binary, first bigint, "
    "words array<string>, counts array<bigint>, endings array<int>"
)


def numbered_blocks(docs: DataFrame) -> DataFrame:
    """Documents as numbers of words within their block, and the words of each block.

    A document's row has its numbers, compressed; a row of the dictionary has some words from number
    ``first`` on, how often each occurs in the block's training documents, and its ending.
    """

    def rows_of(block: int, docs: list, known: dict[str, int]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(known), np.int64)
        for _, held, _, numbers in docs:
            if not held:
                counts += np.bincount(numbers, minlength=len(known))
        empty = {"first": None, "words": None, "counts": None, "endings": None}
        for start in range(0, len(docs), 1000):
            part = [
                {"block": block, "doc_id": key, "held_out": held, "n_words": n, "numbers": packed(numbers), **empty}
                for key, held, n, numbers in docs[start : start + 1000]
            ]
            yield pa.RecordBatch.from_pylist(part, schema=BLOCKS)
        words = list(known)
        for start in range(0, len(words), DICTIONARY_ROWS):
            part = words[start : start + DICTIONARY_ROWS]
            row = {
                "block": block,
                "first": start,
                "words": part,
                "counts": counts[start : start + DICTIONARY_ROWS],
                "endings": [zlib.crc32(word.encode()[-ENDING_BYTES:]) % ENDINGS for word in part],
            }
            yield pa.RecordBatch.from_pylist([row], schema=BLOCKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        found, known, held_chars = [], {}, 0
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                runs = word_numbers(part.column(2), known)
                found += [
                    (key, held, len(run), run)
                    for key, held, run in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), runs, strict=True)
                ]
                held_chars += part.column(2).nbytes
                if held_chars >= BLOCK_CHARS:
                    yield from rows_of(task << 24 | number, found, known)
                    found, known, held_chars, number = [], {}, 0, number + 1
        if found:
            yield from rows_of(task << 24 | number, found, known)

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        whole(F.col("text")).alias("text"),
    )
    return rows.mapInArrow(work, BLOCKS_SQL)


def word_numbers(texts: pa.Array, known: dict[str, int]) -> list[np.ndarray]:
    """The words of each text as numbers; words not yet known get the next ones."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    # White space at either end leaves an empty word.
    places = np.array([known.setdefault(word, len(known)) if word else -1 for word in words], np.int32)
    numbers = places[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int32)
    owners = np.repeat(np.arange(len(counts)), counts)[numbers >= 0]
    cuts = np.searchsorted(owners, np.arange(len(counts) + 1))
    numbers = numbers[numbers >= 0]
    return [numbers[start:end] for start, end in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def packed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), kind)


@dataclass(frozen=True)
class Corpus:
    """Sums over the training documents, and the word classes' sums in two arrays."""

    tokens: int
    distinct: int
    texts: int
    class_counts: np.ndarray
    class_words: np.ndarray


def word_classes(entries: DataFrame, work: Workspace) -> DataFrame:
    """word, c and class of every training word; the most frequent words have their own class."""
    counts = entries.where("n > 0").groupBy("word").agg(F.sum("n").alias("c"), F.min("ending").alias("ending"))
    counts = work.staged(counts)
    order = [F.col("c").desc(), F.col("word")]
    top = [row["word"] for row in counts.orderBy(*order).select("word").limit(FREQUENT).collect()]
    rows = [(word, k) for k, word in enumerate(top, 1)]
    # FREQUENT rows at most, so a broadcast has a fixed bound.
    frequent = counts.sparkSession.createDataFrame(rows, "word string, own int")
    named = counts.join(F.broadcast(frequent), "word", "left")
    return work.staged(named.select("word", "c", F.coalesce("own", ending_class()).alias("class")))


def ending_class() -> Column:
    return F.col("ending") + F.lit(1 + FREQUENT)


def sums(classes: DataFrame, texts: int) -> Corpus:
    found = classes.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    counts, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in found:
        counts[row["class"]], words[row["class"]] = row["c"], row["n"]
    if texts:
        counts[END], words[END] = texts, 1
    return Corpus(int(counts.sum()), int(words.sum()), texts, counts, words)


PREPARED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("within", pa.float64()),
        ("classes", pa.binary()),
    ]
)
PREPARED_SQL = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, within double, "
    "classes binary"
)


def classified(docs: DataFrame, entries: DataFrame, corpus: Corpus) -> DataFrame:
    """Each document as classes, with what does not depend on the states already summed."""
    log_all = np.log10(corpus.tokens + corpus.distinct + 1)
    # A frequent word is all of its class; in the others one further word stands for all unseen.
    log_class = np.log10(corpus.class_counts + corpus.class_words + 1.0)
    log_class[: 1 + FREQUENT] = 0.0
    end_base = np.log10(corpus.texts + 1.0) - log_all

    def work(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
        numbers = dictionary["number"].to_numpy()
        counts, classes = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        counts[numbers], classes[numbers] = dictionary["c"].to_numpy(), dictionary["class"].to_numpy()
        log_count = np.log10(counts + 1.0)
        base = log_count - log_all
        within = np.where(classes > FREQUENT, log_count - log_class[classes], 0.0)
        rows = []
        for row in documents.to_pylist():
            own = unpacked(row["numbers"], row["n_words"], np.int32)
            rows.append(
                {
                    "doc_id": row["doc_id"],
                    "held_out": row["held_out"],
                    "n_tokens": len(own) + 1,
                    "n_known": int((counts[own] > 0).sum()) + (corpus.texts > 0),
                    "base_score": float(base[own].sum() + end_base),
                    "within": float(within[own].sum()),
                    "classes": packed(np.append(classes[own], END).astype(np.uint16)),
                }
            )
        return pa.Table.from_pylist(rows, schema=PREPARED)

    return docs.groupBy("block").cogroup(entries.groupBy("dictionary")).applyInArrow(work, PREPARED_SQL)


@dataclass(frozen=True)
class Model:
    """Start chances, transitions (from, to) and emissions (class, state)."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def first_model(corpus: Corpus, states: int, seed: int = 11) -> Model:
    """The corpus shares of the classes, shaken so that the states can part."""
    share = (corpus.class_counts + 1.0) / (corpus.class_counts + 1.0).sum()
    shaken = share[:, None] * np.exp(np.random.default_rng(seed).normal(0, SPREAD, (CLASSES, states)))
    moves = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(moves, STAY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), moves, shaken / shaken.sum(axis=0))


def side_by_side(rows: list[np.ndarray]) -> Iterator[list[int]]:
    """Places of the documents, longest first, in groups of a bounded number of tokens."""
    group, tokens = [], 0
    for k in sorted(range(len(rows)), key=lambda k: -len(rows[k])):
        if group and tokens + len(rows[k]) > SIDE_BY_SIDE:
            yield group
            group, tokens = [], 0
        group.append(k)
        tokens += len(rows[k])
    if group:
        yield group


def columns(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The classes of documents of falling length by position: all of position 0, then 1, ..."""
    lengths = np.array([len(row) for row in rows], np.int64)
    places = np.concatenate([np.arange(n) for n in lengths.tolist()])
    order = np.argsort(places, kind="stable")
    return np.concatenate(rows)[order].astype(np.int64), np.bincount(places)


def forward(model: Model, symbols: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward chances of every token and the scales, in the order of ``columns``."""
    alphas = model.emits[symbols]
    scales = np.empty(len(symbols))
    start = 0
    for t, width in enumerate(widths.tolist()):
        now = alphas[start : start + width]
        now *= model.start if t == 0 else before[:width] @ model.moves
        scale = now.sum(axis=1)
        now /= scale[:, None]
        scales[start : start + width] = scale
        before, start = now, start + width
    return alphas, scales


def log_likelihoods(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    """The log10 probability of each row of classes."""
    symbols, widths = columns(rows)
    _, scales = forward(model, symbols, widths)
    logs = np.log10(scales)
    starts = np.cumsum(widths) - widths
    # Document k stands at place k of every position it reaches.
    which = np.arange(len(symbols)) - np.repeat(starts, widths)
    return np.bincount(which, weights=logs, minlength=len(rows))


def expected_counts(model: Model, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of documents of falling length."""
    symbols, widths = columns(rows)
    alphas, scales = forward(model, symbols, widths)
    ends = np.cumsum(widths)
    moves = np.zeros_like(model.moves)
    beta = np.ones((int(widths[-1]), len(model.start)))
    for t in range(len(widths) - 1, -1, -1):
        end, width = int(ends[t]), int(widths[t])
        start = end - width
        if t:
            weighted = model.emits[symbols[start:end]] * beta / scales[start:end, None]
            earlier = alphas[start - int(widths[t - 1]) : start]
            moves += earlier[:width].T @ weighted
            further = np.ones((len(earlier), len(model.start)))
            further[:width] = weighted @ model.moves.T
        alphas[start:end] *= beta
        beta = further if t else beta
    emits = np.empty_like(model.emits)
    for state in range(len(model.start)):
        emits[:, state] = np.bincount(symbols, weights=alphas[:, state], minlength=CLASSES)
    return alphas[: int(widths[0])].sum(axis=0), moves * model.moves, emits


def class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        data, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield batch, [unpacked(d, n, np.uint16) for d, n in zip(data, counts, strict=True)]


def baum_welch_round(training: DataFrame, model: Model, corpus: Corpus) -> Model:
    """One re-estimation from the expected counts of all partitions."""
    states = len(model.start)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(states + states * states + CLASSES * states)
        for _, rows in class_rows(batches):
            for group in side_by_side(rows):
                found = expected_counts(model, [rows[k] for k in group])
                total += np.concatenate([part.ravel() for part in found])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["place", "value"])

    rows = training.select("classes", "n_tokens").mapInArrow(work, "place bigint, value double")
    total = np.zeros(states + states * states + CLASSES * states)
    for row in rows.groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[row["place"]] = row["value"]
    start, moves = total[:states], total[states : states + states * states].reshape(states, states)
    emits = total[states + states * states :].reshape(CLASSES, states)
    share = (corpus.class_counts + 1.0) / (corpus.class_counts + 1.0).sum()
    emits, start, moves = emits + share[:, None], start + 0.1, moves + 0.1
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Base and model score of every row of ``docs`` (doc_id, text).

    Tokens are what white space separates, with A-Z lower-cased, and one end. Rows whose
    crc32(doc_id as text) mod 7 is 2 are held out of all learning; rows without an id are learned
    from. A null or empty text is its end alone; repeated rows count as often as they stand;
    an empty table gives no rows; other columns are ignored. score is the log10 probability of
    the text under the model, exact for the whole sequence.
    """
    with workspace(docs.sparkSession, "hmm") as work:
        return staged(_scores(docs, states, rounds, work), "hmm-result")


def _scores(docs: DataFrame, states: int, rounds: int, work: Workspace) -> DataFrame:
    blocks = work.staged(numbered_blocks(docs))
    words = F.explode(F.arrays_zip("words", "counts", "endings", F.sequence(F.lit(0), F.size("words") - 1)))
    entries = blocks.where("words IS NOT NULL").select("block", "first", words.alias("e"))
    entries = entries.select(
        "block",
        (F.col("first") + F.col("e.3")).alias("number"),
        F.col("e.words").alias("word"),
        F.col("e.counts").alias("n"),
        F.col("e.endings").alias("ending"),
    )
    classes = word_classes(entries, work)
    documents = blocks.where("words IS NULL").select("block", "doc_id", "held_out", "n_words", "numbers")
    corpus = sums(classes, documents.where("NOT held_out").count())
    known = entries.join(classes, "word", "left").select(
        F.col("block").alias("dictionary"),
        "number",
        F.coalesce("c", F.lit(0)).cast("bigint").alias("c"),
        F.coalesce("class", ending_class()).cast("bigint").alias("class"),
    )
    # Documents of like length in one file, so that they can be worked off side by side; the id keeps
    # many copies of one text from coming into one file.
    prepared = classified(documents, known, corpus)
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prepared = work.staged(prepared.repartitionByRange(parts, "n_tokens", F.xxhash64("classes", "doc_id")))

    model = first_model(corpus, states)
    training = prepared.where("NOT held_out")
    for _ in range(rounds):
        model = baum_welch_round(training, model, corpus)
    last = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in class_rows(batches):
            out = np.empty(len(rows))
            for group in side_by_side(rows):
                out[group] = log_likelihoods(last, [rows[k] for k in group])
            within = batch.column("within").to_numpy()
            kept = batch.select(["doc_id", "held_out", "n_tokens", "n_known", "base_score"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(out + within)], names=[*kept.schema.names, "score"]
            )

    scored = prepared.select("classes", "n_tokens", "doc_id", "held_out", "n_known", "base_score", "within")
    found = scored.mapInArrow(
        score,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(corpus.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
