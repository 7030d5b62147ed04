"""Personal data by fixed patterns and a skip-chain conditional random field.

The nodes of a document's graph are its words with a digit or an at sign. Neighbouring words are
joined by chain edges; words with the same digits or letters are joined by skip edges to the first of
them, however far on, and numbers that end alike to the first with that end. A repeated number makes a
star and not a clique, and any repeat is two edges away from any other. Every
node has a score for each label from its features, every edge a score for each pair of labels, the same
for all edges of a kind. Loopy message passing, gone on with until messages settle, gives the marginals, by which a word that looks
doubtful alone takes the label of its clear repetition elsewhere in the document.

The weights are fitted in numpy by pseudo-likelihood on a bounded sample of texts labelled by the
patterns. Spans of the patterns always stay; the field adds words it is sure of.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.llm.common import whole

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# The same matches in linear time. Digits end where no digit follows, so a match begins where digits do.
SOUGHT = PATTERNS | {"ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")}
# What stands on either side of an at sign, the first read backwards.
BEFORE_AT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AFTER_AT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LABELS = ("none", *KINDS)
WORD = re.compile(r"\S+")
RUNS = re.compile(r"[0-9]+|[^\W\d_]+")
TRIMMED = ".,;:!?\"'<>[]{}"

# Bounds of the training sample: texts, and nodes of one text.
SAMPLED_TEXTS = 6000
NODES_PER_TEXT = 60
FEATURES = 1 << 12
EPOCHS = 150
RATE = 0.1
SHRINK = 1e-3
SURE = 0.9
# Messages are passed until none changes by more. Ones that still do after so many rounds go round in
# circles; they are brought to rest by moving half as far in every further hundred rounds.
SETTLED = 1e-4
CIRCLING_ROUNDS = 2_000
# Numbers are similar when this many of their last digits are the same.
TAIL = 7

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found.split("."))
    digits = digits_of(found)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern. Every part of the text is looked at for one at sign only."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in BEFORE_AT:
            start -= 1
        host = AFTER_AT.match(text, at + 1) if start < at else None
        free = host.end() if host else at + 1
        if host:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and then by kind."""
    found = [(start, end, "email") for start, end in emails(text)]
    for kind in KINDS[1:]:
        matches = SOUGHT[kind].finditer(text)
        found += [(*match.span(), kind) for match in matches if valid(kind, match.group())]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


@dataclass
class Graph:
    """Nodes with their places, features and edges; ``chain`` and ``skip`` are pairs of nodes."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    chain: np.ndarray
    skip: np.ndarray


def shape(word: str, with_lengths: bool) -> str:
    def name(match: re.Match) -> str:
        kind = "d" if match[0][0].isdigit() else "a"
        return f"{kind}{min(len(match[0]), 20)}" if with_lengths and kind == "d" else kind

    return RUNS.sub(name, word)[:40]


def graph_of(text: str) -> Graph | None:
    """The graph of a text, None where no word has a digit or an at sign."""
    words = [(match.start(), match.end()) for match in WORD.finditer(text)]
    nodes, spans, features, chain, skip = {}, [], [], [], []
    firsts: dict[str, int] = {}
    tails: dict[str, int] = {}
    for place, (start, end) in enumerate(words):
        word = text[start:end]
        if not re.search(r"[0-9@]", word):
            continue
        core = word.strip(TRIMMED)
        lead = len(word) - len(word.lstrip(TRIMMED))
        node = nodes[place] = len(spans)
        spans.append((start + lead, start + lead + len(core)))
        before = text[slice(*words[place - 1])] if place else ""
        after = text[slice(*words[place + 1])] if place + 1 < len(words) else ""
        digits = digits_of(core)
        named = [
            "bias",
            f"exact {shape(core, True)}",
            f"shape {shape(core, False)}",
            f"digits {min(len(digits), 20)}",
            f"sum {12 <= len(digits) <= 19 and luhn(digits)}",
            f"before {shape(before, False)}",
            f"after {shape(after, False)}",
            f"word before {before.lower().strip(TRIMMED)[:20]}",
        ]
        features.append([zlib.crc32(name.encode()) % FEATURES for name in named])
        if place - 1 in nodes:
            chain.append((node - 1, node))
        # Words are alike when they have the same digits, or the same letters if they have none.
        key = digits if len(digits) >= 4 else core.lower()
        if key in firsts:
            skip.append((firsts[key], node))
        else:
            firsts[key] = node
            if len(digits) >= TAIL:
                alike = tails.setdefault(digits[-TAIL:], node)
                if alike != node:
                    skip.append((alike, node))
    if not spans:
        return None
    return Graph(spans, features, np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2))


def labels_of(graph: Graph, spans: list[Span]) -> np.ndarray:
    """The label the patterns give each node."""
    found = np.zeros(len(graph.spans), int)
    at = 0
    for k, (start, end) in enumerate(graph.spans):
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if at < len(spans) and spans[at][0] < end:
            found[k] = LABELS.index(spans[at][2])
    return found


@dataclass(frozen=True)
class Field:
    """Weights: feature x label, and label x label for chain and skip edges."""

    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(nodes: list[dict]) -> Field:
    """Maximise the chance of each node's label given those of its neighbours.

    A node has its features, its label, the label before and after (-1 without one) and how many
    skip neighbours have each label.
    """
    n = len(LABELS)
    weights = [np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros((n, n))]
    if not nodes:
        weights[0][:, 0] = 1.0
        return Field(*weights)
    features = np.array([node["features"] for node in nodes])
    wanted = np.array([node["label"] for node in nodes])
    before = one_hot(np.array([node["before"] for node in nodes]))
    after = one_hot(np.array([node["after"] for node in nodes]))
    alike = np.array([node["alike"] for node in nodes], float)
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for step in range(1, EPOCHS + 1):
        scores = weights[0][features].sum(axis=1) + before @ weights[1] + after @ weights[1].T + alike @ weights[2]
        error = np.exp(scores - scores.max(axis=1, keepdims=True))
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(len(nodes)), wanted] -= 1
        error /= len(nodes)
        slopes = [np.zeros_like(w) for w in weights]
        np.add.at(slopes[0], features, error[:, None, :])
        slopes[1] = before.T @ error + (after.T @ error).T
        slopes[2] = alike.T @ error
        # One potential for both ends of a skip edge.
        slopes[2] = slopes[2] + slopes[2].T
        for weight, slope, (first, second) in zip(weights, slopes, moments, strict=True):
            slope += SHRINK * weight / len(nodes) ** 0.5
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            rate = RATE * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            weight -= rate * first / (second**0.5 + 1e-8)
    return Field(*weights)


def one_hot(labels: np.ndarray) -> np.ndarray:
    found = np.zeros((len(labels), len(LABELS)))
    there = labels >= 0
    found[np.flatnonzero(there), labels[there]] = 1
    return found


def marginals(graph: Graph, field: Field) -> np.ndarray:
    """Label chances of every node by loopy sum-product message passing."""
    alone = field.features[np.array(graph.features)].sum(axis=1)
    edges = np.concatenate([graph.chain, graph.skip])
    scores = np.concatenate(
        [np.repeat(field.chain[None], len(graph.chain), 0), np.repeat(field.skip[None], len(graph.skip), 0)]
    )
    # Each edge passes messages both ways; row k and row k + len(edges) are opposite.
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    scores = np.concatenate([scores, scores.transpose(0, 2, 1)])
    messages = np.zeros((len(source), len(LABELS)))
    opposite = np.roll(np.arange(len(source)), len(edges))
    beliefs = alone.copy()
    step, rounds, change = 0.5, 0, SETTLED if len(source) else 0.0
    while change >= SETTLED:
        cavity = beliefs[source] - messages[opposite]
        mixed = cavity[:, :, None] + scores
        top = mixed.max(axis=1, keepdims=True)
        sent = np.log(np.exp(mixed - top).sum(axis=1)) + top[:, 0]
        sent -= sent.max(axis=1, keepdims=True)
        sent = step * sent + (1 - step) * messages
        change = np.abs(sent - messages).max()
        messages = sent
        beliefs = alone.copy()
        np.add.at(beliefs, target, messages)
        rounds += 1
        if rounds >= CIRCLING_ROUNDS and rounds % 100 == 0:
            step /= 2
    chances = np.exp(beliefs - beliefs.max(axis=1, keepdims=True))
    return chances / chances.sum(axis=1, keepdims=True)


def plausible(kind: str, found: str) -> bool:
    """Whether a word can be of a kind at all, less strictly than by the patterns."""
    digits = digits_of(found)
    if kind == "email":
        name, at, host = found.partition("@")
        return bool(name and at and "." in host.strip("."))
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}([.:-][0-9]{1,3}){3}", found) is not None
    if kind == "card":
        return 12 <= len(digits) <= 19
    return 7 <= len(digits) <= 15


def added_spans(text: str, graph: Graph, base: list[Span], field: Field) -> list[Span]:
    """Spans of words the field is sure of and no pattern has found."""
    chances = marginals(graph, field)
    labels = chances.argmax(axis=1)
    linked = {int(second) for _, second in graph.chain}
    taken = labels_of(graph, base) > 0
    found: list[Span] = []
    previous = -1
    for k, (start, end) in enumerate(graph.spans):
        if labels[k] == 0 or chances[k, labels[k]] < SURE or taken[k] or start >= end:
            continue
        kind = LABELS[labels[k]]
        if k in linked and previous == k - 1 and found and found[-1][2] == kind and kind in ("card", "phone"):
            found[-1] = (found[-1][0], end, kind)
        else:
            found.append((start, end, kind))
        previous = k
    return [span for span in found if plausible(span[2], text[span[0] : span[1]])]


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def training_nodes(text: str) -> list[dict]:
    """Labelled nodes of a text with what ``fit`` wants to know of them, the first ones of many."""
    graph = graph_of(text)
    if graph is None:
        return []
    labels = labels_of(graph, base_spans(text)).tolist()
    before, after = {int(b): labels[a] for a, b in graph.chain}, {int(a): labels[b] for a, b in graph.chain}
    alike = np.zeros((len(labels), len(LABELS)), int)
    for a, b in graph.skip.tolist():
        alike[a, labels[b]] += 1
        alike[b, labels[a]] += 1
    return [
        {
            "features": graph.features[k],
            "label": labels[k],
            "before": before.get(k, -1),
            "after": after.get(k, -1),
            "alike": alike[k].tolist(),
        }
        for k in range(min(len(labels), NODES_PER_TEXT))
    ]


TRAINING = pa.schema(
    [
        ("features", pa.list_(pa.int32())),
        ("label", pa.int32()),
        ("before", pa.int32()),
        ("after", pa.int32()),
        ("alike", pa.list_(pa.int32())),
    ]
)
TRAINING_SQL = "features array<int>, label int, before int, after int, alike array<int>"


def trained_field(docs: DataFrame) -> Field:
    """Fit on about ``SAMPLED_TEXTS`` texts, chosen by a hash of id and text; equal ones count once."""
    scale = 1 << 20
    share = min(scale, -(-SAMPLED_TEXTS * scale // max(1, docs.count())))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale)) < share)
    texts = sample.select(whole(F.col("text")).alias("text")).where(F.col("text").rlike("[0-9@]")).distinct()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [node for text in batch.column(0).to_pylist() for node in training_nodes(text)]
            yield pa.RecordBatch.from_pylist(nodes, schema=TRAINING)

    rows = [row.asDict() for row in texts.mapInArrow(work, TRAINING_SQL).collect()]
    return fit(sorted(rows, key=lambda row: [*row["features"], row["label"], row["before"], row["after"]]))


FOUND = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{kind}", pa.int64()) for kind in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)
FOUND_SQL = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
)


def find_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """Counts and spans of personal data for every row of ``docs`` (doc_id, text).

    n_ counts and base_sha256 are of the patterns' spans, ``spans`` has those and the ones the field
    adds, as kind:start:end in code points, by start and then by kind. Null and empty texts have
    none; repeated rows are answered each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    # Without a digit or an at sign there is nothing to find, so such texts stay behind.
    texts = F.when(F.col("text").rlike("[0-9@]"), F.col("text")).otherwise("")

    def answer(key: int | None, text: str) -> dict:
        base = base_spans(text) if text else []
        graph = graph_of(text) if text else None
        more = added_spans(text, graph, base, field) if graph else []
        kinds = [span[2] for span in base]
        return {
            "doc_id": key,
            **{f"n_{kind}": kinds.count(kind) for kind in KINDS},
            "base_sha256": hashlib.sha256(shown(base).encode()).hexdigest(),
            "spans": shown(in_order([*base, *more])),
        }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            yield pa.RecordBatch.from_pylist([answer(key, text) for key, text in pairs], schema=FOUND)

    return rows.select("doc_id", texts.alias("text")).mapInArrow(work, FOUND_SQL)
