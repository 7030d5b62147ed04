"""BPE and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strataflux.llm import bpe, token_files
from strataflux.session import scratch

from .conftest import EDGES, by_id

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "é", "1", "'s", "<|endoftext|>", "\0", "\x1c", "\x85", "aaaa", "漢", "😀"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_encodes_like_the_library(library):
    random.seed(3)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 40))) for _ in range(3000)]
    encoder = bpe.PairIndexBpe(BYTES)
    found = bpe.encode_texts(texts, encoder, bpe.Memo(encoder.encode_words))
    for text, ids in zip(texts, found, strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted
        assert encoder.decode(ids) == library.decode(wanted, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_text_comes_back(texts):
    encoder, memo = bpe.loaded(BYTES)
    assert [encoder.decode(ids) for ids in bpe.encode_texts(texts, encoder, memo)] == texts


def test_runs_of_one_symbol_merge_from_the_left(library):
    encoder = bpe.PairIndexBpe(BYTES)
    for n in range(1, 40):
        ids, counts = encoder.encode_pieces([b"a" * n, b"!" * n])
        wanted = [library.encode(c * n, add_special_tokens=False).ids for c in "a!"]
        assert ids.tolist() == wanted[0] + wanted[1]
        assert counts.tolist() == [len(each) for each in wanted]


def test_documents(spark, docs_of, library):
    docs = docs_of(EDGES)
    rows = bpe.encode_documents(docs, BYTES).collect()
    assert len(rows) == len(EDGES)
    texts = {key: text or "" for key, text in EDGES}
    for row in rows:
        assert row["ids"] == library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["decoded"] == texts[row["doc_id"]]
    for row in bpe.encode_digests(docs, BYTES).collect():
        ids = np.array(library.encode(texts[row["doc_id"]], add_special_tokens=False).ids, "<u4")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    assert bpe.encode_documents(docs_of([]), BYTES).collect() == []
    assert bpe.encode_digests(docs_of([]), BYTES).collect() == []


def test_token_files(spark, docs_of):
    library = Tokenizer.from_file(WORDS)
    rows = sorted(EDGES, key=lambda row: (row[0] is not None, row[0] or 0))
    start, wanted = 0, []
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        wanted.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_files.token_files(docs_of(EDGES), WORDS).orderBy("start").collect()
    assert [tuple(row) for row in found] == wanted
    assert token_files.token_files(docs_of([]), WORDS).collect() == []


def test_sequences_are_found_at_random(spark, docs_of):
    docs = docs_of([(k, f"word{k} " * (k % 50)) for k in range(400)])
    manifest = token_files.write_token_files(docs, WORDS, scratch(spark, "tokens"), length=16)
    library = Tokenizer.from_file(WORDS)
    for shard in manifest.collect():
        with token_files.opened(shard["tokens_path"]) as file, token_files.opened(shard["index_path"]) as index:
            reader = token_files.ShardReader(file)
            whole = np.concatenate(list(reader.tokens(0, shard["n_tokens"])))
            for row in range(shard["n_rows"]):
                tokens, mask = reader.sequence(row)
                assert len(tokens) == len(mask) == 16
                assert tokens[mask].tolist() == whole[row * 16 : (row + 1) * 16].tolist()
            assert sum(reader.sequence(row)[1].sum() for row in range(shard["n_rows"])) == shard["n_tokens"]
            for entry in token_files.pa.ipc.open_file(index).read_all().to_pylist():
                ids = whole[entry["offset"] : entry["offset"] + entry["n_tokens"]].tolist()
                text = f"word{entry['doc_id']} " * (entry["doc_id"] % 50)
                assert ids == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_plain_words_in_runs_like_each_alone():
    encoder = token_files.WordEncoder(WORDS)
    letters = [chr(c) + tail for c in range(33, 0x2000) for tail in ("", "A", ".")]
    words = [*letters, "İa", "ﬁn", "áb", "Σας", "don't", "..", "", "x\0y", "<|endoftext|>", "a<|endoftext|>b"]
    together, apart = encoder.encode(words), token_files.encode_each(encoder.tokenizer, words)
    assert together[0].tolist() == apart[0].tolist()
    assert together[1].tolist() == apart[1].tolist()


def test_ids_by_document(docs_of):
    found = by_id(bpe.encode_documents(docs_of([(1, "a b"), (2, None)]), BYTES, decode=False))
    assert found[2]["ids"] == [] and found[1]["decoded"] is None
