"""Token ids as Arrow files of equal-length sequences.

Documents are sorted by id, encoded and written shard by shard. A shard is an Arrow file
whose record batches hold two fixed-size lists per row: ``tokens`` and ``mask``, false where
the last row is padded. Row r of a shard holds its tokens from r * length on, so any sequence
is found without a search, and a memory-mapped file gives it without a copy. A second file
per shard says where each document begins. A manifest, committed by Spark, names the files of
the attempts that succeeded; files of lost attempts are never read.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataflux.llm.bpe import Memo, gather, numbered_words, text_batches
from strataflux.llm.common import staged, whole
from strataflux.session import scratch

# A task uses the one core Spark gives it.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LENGTH = 2048
ROWS_PER_BATCH = 128
ENCODE_CHARS = 8_000_000

INDEX = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard int, tokens_path string, index_path string, n_docs bigint, n_tokens bigint, n_rows bigint"


# What a word may end in and still be cut in two pieces for certain.
ENDINGS = frozenset(".,;:!?")
RUN_WORDS = 2000
WORD_END = "</w>"


def pieces_in(word: str) -> int:
    """Into how many pieces the vocabulary cuts a word: 1 or 2 where that is plain, else 0."""
    core = word[:-1] if word[-1:] in ENDINGS else word
    if not core.isalpha():
        return 0
    if not core.isascii() and not (unicodedata.is_normalized("NFC", core) and core.lower().isalpha()):
        return 0
    return 1 + (len(core) < len(word))


def encode_each(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts end to end, and how many each has."""
    found = [each.ids for each in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths


class WordEncoder:
    """Ids of words by the tokenizers library.

    Words whose number of pieces is plain are encoded as one run of text, which is cheaper; the
    tokens that end a piece show where each word ends.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.ending = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ending[i] = token.endswith(WORD_END)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = np.fromiter(map(pieces_in, words), np.int64, len(words))
        plain, rest = np.flatnonzero(pieces), np.flatnonzero(pieces == 0)
        runs = [plain[start : start + RUN_WORDS] for start in range(0, len(plain), RUN_WORDS)]
        ids, lengths = encode_each(self.tokenizer, [" ".join([words[k] for k in run]) for run in runs])
        ends = np.flatnonzero(self.ending[ids])
        if len(ends) != pieces.sum():
            return encode_each(self.tokenizer, words)
        stops = ends[np.cumsum(pieces[plain]) - 1] + 1
        more, more_lengths = encode_each(self.tokenizer, [words[k] for k in rest])
        order = np.empty(len(words), np.int64)
        order[np.r_[plain, rest]] = np.arange(len(words))
        return gather(np.r_[ids, more], np.r_[np.diff(stops, prepend=0), more_lengths], order)


@lru_cache(maxsize=2)
def loaded(path: str) -> tuple[WordEncoder, Memo]:
    encoder = WordEncoder(path)
    return encoder, Memo(encoder.encode)


# Words this vocabulary encodes apart, as none of its tokens holds white space.
CUTS, MARK = {"\n": " "}, " "


@contextmanager
def opened(path: str) -> Iterator[pa.NativeFile]:
    """An Arrow file to read at any place, memory-mapped where it is local."""
    system, inner = file_system(path)
    if isinstance(system, fs.LocalFileSystem):
        with pa.memory_map(inner) as file:
            yield file
    else:
        with system.open_input_file(inner) as file:
            yield file


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class ShardWriter:
    """Cuts a run of tokens into rows of equal length and writes them in batches."""

    def __init__(self, sink: pa.NativeFile, kind: pa.DataType, length: int) -> None:
        self.kind, self.length, self.rows, self.held, self.waiting = kind, length, 0, 0, []
        self.schema = pa.schema([("tokens", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)

    def add(self, tokens: np.ndarray) -> None:
        self.waiting.append(tokens)
        self.held += len(tokens)
        batch = self.length * ROWS_PER_BATCH
        if self.held < batch:
            return
        run = np.concatenate(self.waiting)
        full = len(run) // batch * batch
        for start in range(0, full, batch):
            self.write(run[start : start + batch])
        self.waiting, self.held = [run[full:]], len(run) - full

    def write(self, tokens: np.ndarray) -> None:
        rows = -(-len(tokens) // self.length)
        full = np.zeros(rows * self.length, self.kind.to_pandas_dtype())
        full[: len(tokens)] = tokens
        mask = np.arange(len(full)) < len(tokens)
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (full, mask)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.rows += rows

    def close(self) -> None:
        if self.held:
            self.write(np.concatenate(self.waiting))
        self.writer.close()


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, length: int = LENGTH
) -> DataFrame:
    """Encode each whole text, append ``end_id`` and write all ids in ascending doc_id order.

    Returns the manifest, one row per shard. Null texts are empty and have the end id only;
    documents without an id come first; rows that share an id are ordered by their text; other
    columns are ignored. An empty table gives no shards. ``folder`` must be one that every
    executor can write to.
    """
    text = whole(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"))
    # The digest lets the range partitioning cut between rows that share an id.
    ordered = rows.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        encoder, memo = loaded(tokenizer_path)
        kind = pa.uint16() if max(encoder.size, end_id + 1) <= 1 << 16 else pa.uint32()
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        system, inner = file_system(name)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        offset = n_docs = 0
        with (
            system.open_output_stream(f"{inner}.arrow") as tokens_sink,
            system.open_output_stream(f"{inner}.index.arrow") as index_sink,
            pa.ipc.new_file(index_sink, INDEX) as index,
        ):
            shard_file = ShardWriter(tokens_sink, kind, length)

            def all_batches() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            for keys, texts in text_batches(all_batches(), ENCODE_CHARS):
                counts, numbers, words = numbered_words(texts, CUTS, MARK)
                places = memo.lookup(words)[numbers]
                flat, sizes = gather(memo.ids, memo.lengths, places)
                total, ends = np.r_[0, np.cumsum(sizes)], np.cumsum(counts)
                own = total[ends] - total[ends - counts]
                run = np.insert(flat, np.cumsum(own), end_id)
                shard_file.add(run.astype(kind.to_pandas_dtype()))
                starts = offset + np.cumsum(own + 1) - (own + 1)
                columns = [pa.array(keys, pa.int64()), pa.array(starts), pa.array(own + 1)]
                index.write_batch(pa.RecordBatch.from_arrays(columns, schema=INDEX))
                offset, n_docs = offset + len(run), n_docs + len(keys)
            shard_file.close()
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "shard": shard,
                    "tokens_path": f"{name}.arrow",
                    "index_path": f"{name}.index.arrow",
                    "n_docs": n_docs,
                    "n_tokens": offset,
                    "n_rows": shard_file.rows,
                }
            ],
            schema=pa.schema(
                [("shard", pa.int32()), ("tokens_path", pa.string()), ("index_path", pa.string())]
                + [(key, pa.int64()) for key in ("n_docs", "n_tokens", "n_rows")]
            ),
        )

    return staged(ordered.mapInArrow(work, MANIFEST), "token-manifest")


class ShardReader:
    """Random access to the rows and token ranges of one shard."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.reader = pa.ipc.open_file(file)
        self.length = self.reader.schema.field("tokens").type.list_size
        self.per_batch = ROWS_PER_BATCH * self.length
        self.at, self.values = -1, None

    def batch(self, number: int) -> np.ndarray:
        if number != self.at:
            self.at = number
            # A view of the file's own bytes: nothing is copied.
            self.values = self.reader.get_batch(number).column(0).values.to_numpy(zero_copy_only=True)
        return self.values

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Views of the tokens from ``start`` on, one for each batch they lie in."""
        while count:
            number, inside = divmod(start, self.per_batch)
            part = self.batch(number)[inside : inside + count]
            yield part
            start, count = start + len(part), count - len(part)

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and mask of one row."""
        number, inside = divmod(row, ROWS_PER_BATCH)
        found = self.reader.get_batch(number)
        return found.column(0)[inside].values.to_numpy(), found.column(1)[inside].values.to_numpy(False)


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document from the files: where its ids begin among all, how many, and their crc32."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("shard_start", F.coalesce(before, F.lit(0)))
    rows = placed.select("tokens_path", "index_path", "shard_start")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["tokens_path"]) as tokens_file, opened(row["index_path"]) as index_file:
                    shard, index = ShardReader(tokens_file), pa.ipc.open_file(index_file)
                    for number in range(index.num_record_batches):
                        entry = index.get_batch(number)
                        offsets, counts = entry.column(1).to_numpy(), entry.column(2).to_numpy()
                        crcs = []
                        for start, count in zip(offsets.tolist(), counts.tolist(), strict=True):
                            crc = 0
                            for part in shard.tokens(start, count):
                                crc = zlib.crc32(part.astype("<u4"), crc)
                            crcs.append(crc)
                        columns = [
                            pa.array(entry.column(0).to_pylist(), pa.int64()),
                            pa.array(offsets + row["shard_start"], pa.int64()),
                            pa.array(counts, pa.int64()),
                            pa.array(crcs, pa.int64()),
                        ]
                        yield pa.RecordBatch.from_arrays(
                            columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]
                        )

    return rows.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(work, READ)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the files below the shared folder and read them back."""
    folder = scratch(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer_path, folder, end_id))
