"""Language identification by a convolutional network over bytes.

Texts are cut into windows of ``WINDOW`` bytes. In each window filters of several widths run over
byte embeddings, every filter keeps its maximum, and a softmax over these maxima gives the
languages. A document's languages are scored by the mean log-probability of its windows, each
weighted by its bytes, so the whole text counts. The network is trained in numpy on a bounded,
stratified sample of labelled windows; prediction runs in batches of windows inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.bpe import SLICE_ROWS, text_batches
from strataflux.llm.common import give_back, whole

WINDOW = 128
WIDTHS = (2, 3, 4)
EMBEDDING = 8
FILTERS = 12
EPOCHS = 6
MINIBATCH = 64
RATE = 0.01
# Bounds of the training sample, for each language.
SAMPLED_ROWS = 500
WINDOWS_PER_ROW = 3
UNKNOWN = "und"
BATCH_CHARS = 1_000_000
CHUNK = 1024


@dataclass(frozen=True)
class Network:
    """The weights, as bytes so that a worker can tell whether it has prepared them before."""

    languages: tuple[str, ...]
    embedding: bytes
    filters: tuple[bytes, ...]
    bias: bytes
    dense: bytes
    offset: bytes


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows, zero after a text's end, and how many each text has (one at least)."""
    counts = np.array([max(1, -(-len(text) // WINDOW)) for text in texts], np.int64)
    buffer = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    at = 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        buffer[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += count * WINDOW
    return buffer.reshape(-1, WINDOW), counts


def train(windows: np.ndarray, wanted: np.ndarray, languages: tuple[str, ...], seed: int = 7) -> Network:
    """Fit the network with Adam on windows and the index of each one's language."""
    random = np.random.default_rng(seed)
    weights = {"embedding": random.normal(0, 0.5, (256, EMBEDDING))}
    for width in WIDTHS:
        scale = (width * EMBEDDING) ** -0.5
        weights[f"filter{width}"] = random.normal(0, scale, (width * EMBEDDING, FILTERS))
    weights["bias"] = np.zeros(len(WIDTHS) * FILTERS)
    weights["dense"] = random.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
    weights["offset"] = np.zeros(len(languages))
    first = {name: np.zeros_like(value) for name, value in weights.items()}
    second = {name: np.zeros_like(value) for name, value in weights.items()}
    step = 0
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        order = random.permutation(len(windows))
        for start in range(0, len(order), MINIBATCH):
            picked = order[start : start + MINIBATCH]
            step += 1
            for name, slope in slopes(weights, windows[picked], wanted[picked]).items():
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                rate = RATE * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                weights[name] -= rate * first[name] / (second[name] ** 0.5 + 1e-8)
    packed = {name: value.astype(np.float32).tobytes() for name, value in weights.items()}
    filters = tuple(packed[f"filter{width}"] for width in WIDTHS)
    return Network(languages, packed["embedding"], filters, packed["bias"], packed["dense"], packed["offset"])


def slopes(weights: dict, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy of a minibatch."""
    rows = np.arange(len(windows))
    embedded = weights["embedding"][windows]
    pooled, places = [], []
    for width in WIDTHS:
        span = WINDOW - width + 1
        stacked = np.concatenate([embedded[:, k : k + span] for k in range(width)], axis=2)
        answers = stacked @ weights[f"filter{width}"]
        places.append(answers.argmax(axis=1))
        pooled.append(np.take_along_axis(answers, places[-1][:, None], axis=1)[:, 0])
    raw = np.concatenate(pooled, axis=1) + weights["bias"]
    hidden = np.maximum(raw, 0)
    chances = softmax(hidden @ weights["dense"] + weights["offset"])
    chances[rows, wanted] -= 1
    error = chances / len(windows)
    found = {"dense": hidden.T @ error, "offset": error.sum(axis=0)}
    back = (error @ weights["dense"].T) * (raw > 0)
    found["bias"] = back.sum(axis=0)
    found["embedding"] = np.zeros_like(weights["embedding"])
    for n, width in enumerate(WIDTHS):
        own = back[:, n * FILTERS : (n + 1) * FILTERS]
        at = places[n][:, :, None] + np.arange(width)
        letters = windows[rows[:, None, None], at]
        seen = weights["embedding"][letters].reshape(len(windows), FILTERS, -1)
        found[f"filter{width}"] = np.einsum("bf,bfk->kf", own, seen)
        spread = own[:, :, None] * weights[f"filter{width}"].T
        np.add.at(found["embedding"], letters, spread.reshape(*letters.shape, EMBEDDING))
    return found


def softmax(values: np.ndarray) -> np.ndarray:
    grown = np.exp(values - values.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


class Predictor:
    """The network with its filters unrolled into tables over pairs of bytes."""

    def __init__(self, network: Network) -> None:
        def read(packed: bytes, *shape: int) -> np.ndarray:
            return np.frombuffer(packed, np.float32).reshape(shape)

        classes = len(network.languages)
        embedding = read(network.embedding, 256, EMBEDDING)
        self.bias, self.offset = read(network.bias, -1), read(network.offset, classes)
        self.dense = read(network.dense, -1, classes)
        self.tables = []
        for width, packed in zip(WIDTHS, network.filters, strict=True):
            single = [embedding @ part for part in read(packed, width, EMBEDDING, FILTERS)]
            pairs = [
                (single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS) for k in range(0, width - 1, 2)
            ]
            self.tables.append((width, pairs, single[-1] if width % 2 else None))

    def log_chances(self, windows: np.ndarray) -> np.ndarray:
        """Log-probabilities of each window's languages."""
        out = []
        for start in range(0, len(windows), CHUNK):
            part = windows[start : start + CHUNK]
            pairs = part[:, :-1].astype(np.uint16) << 8 | part[:, 1:]
            pooled = []
            for width, pair_tables, last in self.tables:
                span = WINDOW - width + 1
                answers = pair_tables[0].take(pairs[:, :span], axis=0)
                for k, pair_table in enumerate(pair_tables[1:], 1):
                    answers += pair_table.take(pairs[:, 2 * k : 2 * k + span], axis=0)
                if last is not None:
                    answers += last.take(part[:, width - 1 : width - 1 + span], axis=0)
                pooled.append(answers.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            out.append(np.log(softmax(hidden @ self.dense + self.offset) + 1e-12))
        return np.concatenate(out)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The index of each text's language and its probability."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0)
        packed = [text.encode() for text in texts]
        windows, counts = windows_of(packed)
        chances = self.log_chances(windows).astype(np.float64)
        starts = np.cumsum(counts) - counts
        sizes = np.full(len(windows), float(WINDOW))
        lengths = np.array([max(1, len(text)) for text in packed])
        sizes[starts + counts - 1] = lengths - (counts - 1) * WINDOW
        mean = np.add.reduceat(chances * sizes[:, None], starts) / lengths[:, None]
        shares = softmax(mean)
        return shares.argmax(axis=1), shares.max(axis=1)


@lru_cache(maxsize=2)
def prepared(network: Network) -> Predictor:
    return Predictor(network)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> Network | None:
    """Train on a sample of the labelled texts with letters that are not held out.

    About ``SAMPLED_ROWS`` rows of each language are chosen by a hash of id and text, equal texts count
    once, and of each text ``WINDOWS_PER_ROW`` windows spread over its length. None where nothing is labelled.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & has_letter(F.col("text")))
    usable = usable.where(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    counts = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    scale = 1 << 20
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale))
    shares = [F.when(F.col("lang") == lang, -(-SAMPLED_ROWS * scale // n)) for lang, n in counts.items()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, _ = windows_of([text.encode()])
                for k in sorted(set(np.linspace(0, len(own) - 1, WINDOWS_PER_ROW).astype(int).tolist())):
                    langs.append(lang)
                    found.append(own[k].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "window"]
            )

    sample = usable.where(draw < F.coalesce(*shares)).select("lang", "text").distinct()
    rows = sorted((row[0], bytes(row[1])) for row in sample.mapInArrow(cut, "lang string, window binary").collect())
    languages = tuple(sorted(counts))
    wanted = np.array([languages.index(lang) for lang, _ in rows])
    windows = np.frombuffer(b"".join(window for _, window in rows), np.uint8).reshape(-1, WINDOW)
    return train(windows, wanted, languages)


def has_letter(text: Column) -> Column:
    return F.coalesce(whole(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs`` (doc_id, text).

    A text that is null or has no letter is ``und`` with score 0, as is every text where there
    was nothing to learn from. Repeated rows are answered each; an empty table gives no rows; other
    columns are ignored, ``lang`` and ``source`` among them.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = F.when(has_letter(F.col("text")), F.col("text")).otherwise("")
    rows = rows.select("doc_id", known.alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for keys, texts in text_batches(batches, BATCH_CHARS):
            found, scores = answers(network, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    found = rows.mapInArrow(work, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def answers(network: Network | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text, ``und`` for the empty ones."""
    filled = [k for k, text in enumerate(texts) if text]
    found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if network is not None and filled:
        which, sure = prepared(network).predict([texts[k] for k in filled])
        for k, language, score in zip(filled, which.tolist(), sure.tolist(), strict=True):
            found[k], scores[k] = network.languages[language], min(1.0, score)
    return found, scores


def least_score(network: Network | None, margin: float) -> float:
    """The score that lies so far, from 0 to 1, between equal chances for all languages and certainty."""
    even = 1 / len(network.languages) if network else 0.0
    return even + margin * (1 - even)


def identified(docs: DataFrame, network: Network | None, margin: float) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least_score`` or more, unchanged.

    Texts that are null or have no letter go. Only texts travel to Python, and only answers back.
    """
    least = least_score(network, margin)

    @F.arrow_udf("boolean")
    def recognised(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        for texts in batches:
            keep = []
            for start in range(0, len(texts), SLICE_ROWS):
                found, scores = answers(network, texts.slice(start, SLICE_ROWS).to_pylist())
                keep += [lang != UNKNOWN and score >= least for lang, score in zip(found, scores, strict=True)]
            yield pa.array(keep, pa.bool_())

    return docs.where(recognised(F.when(has_letter(F.col("text")), whole(F.col("text"))).otherwise("")))
