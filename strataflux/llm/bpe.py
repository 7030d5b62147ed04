"""Byte-level BPE by a pair occurrence index.

All distinct pieces of a batch are laid end to end as one array of symbols with links to
the left and right neighbour. An index maps the rank of each adjacent pair to all
positions where it occurs. Ranks are applied in ascending order: all positions of the
lowest active rank merge at once, and the pairs this creates on either side are entered
into the index under their own ranks. A merge only creates pairs of higher rank, since
the token it makes must exist before a later merge can use it, so one ascending sweep
gives what merging the lowest pair of each piece over and over gives.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.llm.common import KEPT, whole

# Fixed value: how the byte-level vocabularies cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Bounds of memory in a worker: texts are worked off in batches of so many characters, and so
# many distinct words are remembered between batches. Neither changes a result.
BATCH_CHARS = 8_000_000
REMEMBERED_WORDS = 800_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    letters = {chr(byte): byte for byte in shown}
    return letters | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class PairIndexBpe:
    """Encoder and decoder for one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        vocab, letters = described["model"]["vocab"], byte_letters()
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        added = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in added.items()}
        self.added = added
        self.of_byte = np.empty(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocab[letter]
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in described["model"]["merges"]]
        self.left, self.right, self.made = (np.array(side, np.int64) for side in zip(*pairs, strict=True))
        self.shift = np.int64(1) << 32
        keys = self.left * self.shift + self.right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        self.pieces = regex.compile(PIECES)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where the vocabulary has no such merge."""
        wanted = left * self.shift + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.by_key[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces end to end, and how many each piece has."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ends = np.cumsum(lengths)
        if not len(symbols):
            return symbols, lengths
        after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        filled = lengths > 0
        after[ends[filled] - 1] = -1
        before[(ends - lengths)[filled]] = -1
        alive = np.ones(len(symbols), bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Put the pairs that start at these positions under their ranks."""
            ranks = self.ranks(symbols[at], symbols[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            starts = [0, *cuts.tolist(), len(at)]
            for start, end in zip(starts, starts[1:], strict=False):
                rank = int(ranks[start])
                if rank in index:
                    index[rank].append(at[start:end])
                else:
                    index[rank] = [at[start:end]]
                    heapq.heappush(active, rank)

        enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[rank], self.right[rank]
            at = at[alive[at] & (symbols[at] == a) & (after[at] >= 0)]
            at = at[symbols[after[at]] == b]
            if a == b and len(at) > 1:
                # In a run of one symbol every second position merges, from the left.
                follows = np.r_[False, after[at[:-1]] == at[1:]]
                place = np.arange(len(at))
                place -= np.maximum.accumulate(np.where(follows, 0, place))
                at = at[place % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbols[at] = self.made[rank]
            alive[gone] = False
            after[at] = beyond
            linked = beyond >= 0
            before[beyond[linked]] = at[linked]
            ahead = before[at]
            enter(np.unique(np.concatenate([ahead[ahead >= 0], at[linked]])))

        total = np.r_[0, np.cumsum(alive)]
        return symbols[alive], total[ends] - total[ends - lengths]

    def words(self, text: str) -> list[str]:
        """Cut before each white-space run, where no piece can cross; joined they are the text."""
        return regex.findall(r"\s*\S+|\s+$", text)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_pieces`` for whole words: cuts them into pieces, which it encodes once each."""
        known: dict[str, int] = {}
        pieces: list[int] = []
        counts = np.zeros(len(words), np.int64)
        marked = self.marks
        for k, word in enumerate(words):
            # Control strings are tokens of their own and stand in the list as -1 - id.
            parts = marked.split(word) if marked and "<" in word else [word]
            for part in parts:
                if part in self.added:
                    pieces.append(-1 - self.added[part])
                    counts[k] += 1
                    continue
                found = self.pieces.findall(part)
                counts[k] += len(found)
                pieces.extend([known.setdefault(piece, len(known)) for piece in found])
        ids, lengths = self.encode_pieces([piece.encode() for piece in known])
        added = sorted(self.added.values())
        ids, lengths = np.r_[ids, added].astype(np.int64), np.r_[lengths, np.ones(len(added), np.int64)]
        where = np.array(pieces, np.int64)
        special = where < 0
        where[special] = len(known) + np.searchsorted(added, -1 - where[special])
        flat, sizes = gather(ids, lengths, where)
        total, ends = np.r_[0, np.cumsum(sizes)], np.cumsum(counts)
        return flat, total[ends] - total[ends - counts]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def gather(flat: np.ndarray, lengths: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``where`` of a ragged array, end to end, and their lengths."""
    starts = np.cumsum(lengths) - lengths
    sizes = lengths[where]
    shift = starts[where] - (np.cumsum(sizes) - sizes)
    return flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


class Memo:
    """Words of earlier batches with their ids, so each is encoded once in a worker."""

    def __init__(self, encode) -> None:
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def lookup(self, words: list[str]) -> np.ndarray:
        """The place of each word in ``ids`` and ``lengths``."""
        if len(self.known) > REMEMBERED_WORDS:
            self.clear()
        known = self.known
        places = np.fromiter((known.get(word, -1) for word in words), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = list(dict.fromkeys([words[k] for k in missing]))
            ids, lengths = self.encode(new)
            self.ids = np.r_[self.ids, ids.astype(np.int32)]
            self.lengths = np.r_[self.lengths, lengths]
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            places[missing] = [known[words[k]] for k in missing]
        return places


def numbered_words(
    texts: list[str], cuts: dict[str, str], mark: str
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """How many words each text has, all words as numbers, and the distinct words.

    Each key of ``cuts`` is replaced by its value, then the texts are cut at every ``mark``.
    """
    found = pa.array(texts, pa.string())
    for old, new in cuts.items():
        found = pc.replace_substring(found, old, new)
    lists = pc.split_pattern(found, mark)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return counts, coded.indices.to_numpy(), coded.dictionary.to_pylist()


# Words keep the space or line end before them; no piece crosses these places.
CUTS = {"\n": "\0\n", " ": "\0 "}


def encode_texts(texts: list[str], encoder: PairIndexBpe, memo: Memo) -> list[np.ndarray]:
    """The ids of each text.

    Words are encoded apart. Where a cut may fall inside a white-space run, which shows by a word
    that ends in white space, or where the text has NULs itself, the text is cut the plain way.
    """
    counts, numbers, words = numbered_words(texts, CUTS, "\0")
    ends = np.cumsum(counts)
    odd = np.array([word[-1:].isspace() for word in words], bool)
    plain = {k for k, text in enumerate(texts) if "\0" in text}
    if odd.any():
        plain |= set(np.searchsorted(ends, np.flatnonzero(odd[numbers]), side="right").tolist())
    apart = [(k, encoder.words(texts[k])) for k in sorted(plain)]
    # Looked up together, so that what is remembered is not cleared in between.
    places = memo.lookup([*words, *[word for _, own in apart for word in own]])
    found = pieces_of(memo, places[numbers], counts)
    again = pieces_of(memo, places[len(words) :], np.array([len(own) for _, own in apart], np.int64))
    for (k, _), ids in zip(apart, again, strict=True):
        found[k] = ids
    return found


def pieces_of(memo: Memo, places: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The ids of runs of so many words each."""
    flat, sizes = gather(memo.ids, memo.lengths, places)
    cuts = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)].astype(np.int64)]
    return [flat[start:end] for start, end in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


@lru_cache(maxsize=2)
def loaded(path: str) -> tuple[PairIndexBpe, Memo]:
    """The encoder of this worker; the file is read once."""
    encoder = PairIndexBpe(path)
    return encoder, Memo(encoder.encode_words)


KEPT.append(loaded)


# Rows made into Python strings at a time.
SLICE_ROWS = 500


def text_batches(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a partition in groups of about so many characters."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                keys.append(key)
                texts.append(text)
                held += len(text)
                if held >= chars:
                    yield keys, texts
                    keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encode_documents(docs: DataFrame, path: str, decode: bool = True) -> DataFrame:
    """doc_id, the token ids of each whole text, and the text decoded from them.

    A null text is empty and has no ids; repeated rows are encoded each. Control strings of
    the vocabulary inside a text become their one id. ``path`` is a byte-level vocabulary
    file all executors can open; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, memo = loaded(path)
        for keys, texts in text_batches(batches, BATCH_CHARS // 8):
            ids = encode_texts(texts, encoder, memo)
            back = [encoder.decode(own) if decode else None for own in ids]
            offsets = np.r_[0, np.cumsum([len(own) for own in ids])].astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), lists, pa.array(back, pa.string())], schema=ENCODED
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), whole(F.col("text")).alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, ids array<int>, decoded string")


DIGESTED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_documents``, with digests in place of ids and decoded text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, memo = loaded(path)
        for keys, texts in text_batches(batches, BATCH_CHARS):
            ids = encode_texts(texts, encoder, memo)
            counts = [len(own) for own in ids]
            shas = [hashlib.sha256(own.astype("<u4").tobytes()).hexdigest() for own in ids]
            back = [hashlib.sha256(encoder.decode(own).encode()).hexdigest() for own in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), whole(F.col("text")).alias("text"))
    return rows.mapInArrow(work, DIGESTED)
