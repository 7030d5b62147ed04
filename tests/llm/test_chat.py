"""The prefix tree of conversations."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

from strataflux.llm import bpe, chat_tree
from strataflux.llm.common import workers_find_package

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, owner string, depth string, block int, size int"
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\n", "<", "[", "/", "s>", "a", "INST]", "n"]


@given(st.lists(st.sampled_from(BITS), max_size=12), st.lists(st.sampled_from(BITS), max_size=12))
def test_marks_come_back(role, text):
    role, text = "".join(role), "".join(text)
    formatted = "".join(chat_tree.turn_parts(role, text))
    assert chat_tree.parsed(formatted) == (role, text)
    inner = formatted[len(chat_tree.OPEN) : -len(chat_tree.CLOSE)]
    assert not any(mark in inner for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def tree_of(spark, rows):
    workers_find_package(spark)
    full = [(*row, "o", "d", 1, 2) for row in rows]
    return chat_tree.prefix_tree(spark.createDataFrame(full, SCHEMA).repartition(3), VOCABULARY)


def conversations():
    """A hot first turn, copies, prefixes of others, chains of branches, gaps, ties and nulls."""
    chance, rows = random.Random(5), []
    for conv in range(150):
        roles = ["user", "assistant"] * 4
        if conv < 90:
            texts = ["hot", *[chance.choice("xyz") * 3 for _ in range(chance.randrange(7))]]
        else:
            texts = [chance.choice("pq"), *[chance.choice("uv") for _ in range(chance.randrange(6))]]
        rows += [(conv, k * 2, role, text) for k, (role, text) in enumerate(zip(roles, texts, strict=False))]
    rows += [(500, None, None, None), (500, 1, "assistant", None), (500, 1, "assistant", "b"), (500, 1, "assistant", "b")]
    rows += [(None, 0, "user", "none"), (501, 0, "assistant", "</s>[INST] ok [/INST]"), (502, 0, "odd\nrole", "")]
    return [*rows, *[(503, k, "user" if k % 2 else "assistant", f"t{k // 9}") for k in range(2600)]]


def in_order(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(role, text) for _, _, role, text in sorted(turns)] for conv, turns in found.items()}


def test_tree(spark):
    rows = conversations()
    wanted = in_order(rows)
    tree = tree_of(spark, rows)
    nodes = {(row["owner"], row["depth"]): row for row in tree.nodes.collect()}

    # Shared runs of turns are emitted once, without gaps, parents first.
    runs = {tuple(turns[: k + 1]) for turns in wanted.values() for k in range(len(turns))}
    assert len(nodes) == len(runs)
    emitted = sorted(nodes.values(), key=lambda row: row["start"])
    place = 0
    for row in emitted:
        assert row["start"] == place and row["n_tokens"] == len(row["ids"])
        place += row["n_tokens"]
    stream = [token for row in emitted for token in row["ids"]]

    encoder, memo = bpe.loaded(VOCABULARY)
    paths = defaultdict(dict)
    for row in tree.segments.collect():
        for depth in range(row["first"], row["last"] + 1):
            paths[row["conv_id"]][depth] = nodes[row["owner"], depth]
    assert paths.keys() == wanted.keys()
    for conv, turns in wanted.items():
        path = [paths[conv][depth] for depth in sorted(paths[conv])]
        texts = ["".join(chat_tree.turn_parts(*turn)) for turn in turns]
        assert ["".join(encoder.decode(chat_tree.np.array(node["ids"]))) for node in path] == texts
        seen, position = [], 0
        for node, (role, text) in zip(path, turns, strict=True):
            # What the intervals show is exactly the earlier turns, and positions go on from them.
            visible = [token for start, end in node["ancestors"] for token in stream[start:end]]
            assert visible == seen and node["position"] == position
            assert [tuple(part) for part in node["ancestors"]] == sorted(tuple(part) for part in node["ancestors"])
            learned = encoder.decode(chat_tree.np.array(node["ids"][node["loss_start"] : node["loss_end"]], int))
            assert chat_tree.unescaped(learned) == (text if role == "assistant" else "")
            seen, position = seen + node["ids"], position + node["n_tokens"]

    # Depth first: a node's subtree is one interval of the run.
    for conv, path in paths.items():
        del conv
        for node in path.values():
            assert all(start < node["start"] for start, _ in node["ancestors"])


def test_read_back(spark):
    rows = conversations()
    wanted = in_order(rows)
    found = {row["conv_id"]: row for row in chat_tree.read_back(tree_of(spark, rows), VOCABULARY).collect()}
    assert found.keys() == wanted.keys()
    for conv, turns in wanted.items():
        learned = "".join(text for role, text in turns if role == "assistant")
        row = found[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert row["formatted_chars"] == sum(len("".join(chat_tree.turn_parts(*turn))) for turn in turns)


def test_no_conversations(spark):
    tree = tree_of(spark, [])
    assert tree.nodes.collect() == [] and chat_tree.read_back(tree, VOCABULARY).collect() == []
