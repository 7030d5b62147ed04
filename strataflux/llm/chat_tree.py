"""Chat formatting as a prefix tree.

Conversations that share their first turns share the nodes of one tree. A node is a turn after a
certain run of turns, known by its depth and a sum of hashes of all turns up to it. It
is owned by the smallest conversation that passes through it, so what a conversation owns is one
run of nodes, a chain, that hangs on a node of a chain owned by a smaller conversation. Listed
by the places where its ancestors' chains branch off, deeper ones first, chains come out
in depth-first order, and each shared token is emitted once.

Every node carries its place in the emitted run of tokens, the position id of its first token, and
the intervals of that run its tokens may attend to besides the earlier tokens of its own chain. No
tree, conversation or hot first turn is ever gathered in one task: order comes from a sort
by range, running sums from two levels of blocks, and joins are left to be split where skewed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflux.llm.bpe import encode_texts, loaded
from strataflux.llm.common import Workspace, staged, whole, workspace

# The marks of a turn and the other strings models take for control.
OPEN, CLOSE = "<s>", "</s>"
CONTROL = re.compile(r"<(?=/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\])")
LEARNED_ROLE = "assistant"
# Turns of one conversation that one task orders at most; longer ones are cut into blocks.
BLOCK = 1024


def escaped(text: str) -> str:
    """Text in which no control string stands; backslashes are doubled so it can be undone."""
    return CONTROL.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What a turn is formatted as: its head, its body and its end."""
    return f"{OPEN}{escaped(role).replace('\n', '\\n')}\n", escaped(text), CLOSE


def parsed(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    head, _, rest = formatted[len(OPEN) :].partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], head, flags=re.DOTALL)
    return role, unescaped(rest[: -len(CLOSE)])


def running_sums(
    rows: DataFrame, key: str, block: str, order: Sequence[Column], sums: dict[str, Column]
) -> DataFrame:
    """Add running sums along ``order`` within ``key``, each including its own row.

    Summed within blocks first and then over block totals, so a key of any length is spread over
    tasks. Blocks must ascend with the order.
    """
    inside = Window.partitionBy(key, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(key, block).agg(*[F.sum(value).alias(f"{name}_total") for name, value in sums.items()])
    before = totals.select(
        key, block, *[F.sum(f"{name}_total").over(earlier).alias(f"{name}_before") for name in sums]
    )
    summed = rows.withColumns({name: F.sum(value).over(inside) for name, value in sums.items()})
    joined = summed.join(before, [key, block])
    return joined.withColumns(
        {name: F.col(name) + F.coalesce(F.col(f"{name}_before"), F.lit(0)) for name in sums}
    ).drop(*[f"{name}_before" for name in sums])


@dataclass(frozen=True)
class PrefixTree:
    """The emitted run of tokens and who reads which part of it.

    ``nodes``: tree_id, owner, depth, start, n_tokens, position, ancestors (start, end), loss_start and
    loss_end within the node, ids. Tokens of a node attend to its ancestors' intervals, which
    end with the earlier part of its own chain, and to those before them in the node.
    ``segments``: conv_id, owner, first, last: the depths a conversation takes from each chain.
    """

    nodes: DataFrame
    segments: DataFrame


NODE_SQL = "owner bigint, depth bigint, n_tokens bigint, loss_start int, loss_end int, ids array<int>"


def encoded_turns(rows: DataFrame, vocabulary: str) -> DataFrame:
    """The tokens of each turn and which of them are learned."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, memo = loaded(vocabulary)
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            parts = [part for role, text in zip(roles, texts, strict=True) for part in turn_parts(role, text)]
            ids = encode_texts(parts, encoder, memo)
            sizes = np.array([len(each) for each in ids], np.int64).reshape(-1, 3)
            counts = sizes.sum(axis=1)
            learned = np.array([role == LEARNED_ROLE for role in roles])
            starts = sizes[:, 0].astype(np.int32)
            ends = np.where(learned, starts + sizes[:, 1], starts).astype(np.int32)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts),
                    pa.array(starts),
                    pa.array(ends),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["owner", "depth", "n_tokens", "loss_start", "loss_end", "ids"],
            )

    return rows.select("owner", "depth", "role", "text").mapInArrow(work, NODE_SQL)


def ordered_turns(conversations: DataFrame, work: Workspace) -> DataFrame:
    """conv_id, depth (from 1), role, text and the two sums that name the run of turns up to here."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        whole(F.col("role")).alias("role"),
        whole(F.col("text")).alias("text"),
    )
    # Turns without a number come first.
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = work.staged(running_sums(rows, "conv_id", "block", order, {"depth": F.lit(1)}))
    rows = rows.withColumn("block", F.floor(F.col("depth") / BLOCK))
    own = {
        name: F.xxhash64(F.lit(seed), "depth", "role", "text").cast("decimal(20,0)")
        for name, seed in (("run_a", 1), ("run_b", 2))
    }
    return work.staged(running_sums(rows, "conv_id", "block", [F.col("depth")], own))


def prefix_tree(conversations: DataFrame, vocabulary: str) -> PrefixTree:
    """Format conversations (conv_id, turn, role, text) and merge shared first turns.

    Turns are ordered by number, those without one first, ties by role and text; null texts
    and roles are empty; repeated rows are turns of their own; rows without a conv_id belong to
    no conversation and are left out; other columns are ignored; an empty table gives an empty
    tree. ``vocabulary`` is a byte-level BPE file all executors can open.
    """
    with workspace(conversations.sparkSession, "chat") as work:
        return _tree(conversations, vocabulary, work)


def _tree(conversations: DataFrame, vocabulary: str, work: Workspace) -> PrefixTree:
    rows = ordered_turns(conversations, work)
    run = ["depth", "run_a", "run_b"]
    owners = work.staged(rows.groupBy(*run).agg(F.min("conv_id").alias("owner")))
    owned = work.staged(rows.join(owners, run).select("conv_id", "owner", "depth", "role", "text"))
    spans = owned.groupBy("conv_id", "owner").agg(F.min("depth").alias("first"), F.max("depth").alias("last"))
    segments = staged(spans, "chat-segments")

    nodes = work.staged(encoded_turns(owned.where("conv_id = owner"), vocabulary))
    nodes = nodes.withColumn("block", F.floor(F.col("depth") / BLOCK))
    light = running_sums(
        nodes.select("owner", "depth", "block", "n_tokens"), "owner", "block", [F.col("depth")], {"end": F.col("n_tokens")}
    )
    light = work.staged(light.drop("block"))

    # Depth-first order of the chains, and where each begins in the emitted run.
    owning = segments.where("conv_id = owner").select("conv_id")
    paths = segments.join(owning, "conv_id", "left_semi").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("first", "owner"))).alias("path")
    )
    sizes = light.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("n_tokens").alias("size"))
    key = F.transform("path", lambda step: F.struct((-step["first"]).alias("up"), step["owner"].alias("owner")))
    chains = paths.join(sizes, "conv_id").select(
        F.col("conv_id").alias("owner"), F.col("path")[0]["owner"].alias("tree_id"), key.alias("key"), "size"
    )
    root_first = chains.orderBy("tree_id", "key").drop("key")
    placed = root_first.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    placed = work.staged(placed.withColumn("place", F.col("place").bitwiseAND(F.lit((1 << 33) - 1))))
    placed = placed.withColumn("block", F.floor(F.col("place") / BLOCK))
    inside = running_sums(placed, "part", "block", [F.col("place")], {"end": F.col("size")})
    parts = placed.groupBy("part").agg(F.sum("size").alias("whole"))
    # One row for each partition of the sort.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("before"))
    starts = inside.join(parts, "part").select(
        "owner", "tree_id", (F.col("before") + F.col("end") - F.col("size")).alias("chain_start")
    )
    starts = work.staged(starts)

    located = light.join(starts, "owner").select(
        "owner",
        "depth",
        "tree_id",
        "chain_start",
        (F.col("chain_start") + F.col("end") - F.col("n_tokens")).alias("start"),
        (F.col("chain_start") + F.col("end")).alias("stop"),
    )
    located = work.staged(located)
    above = segments.where("conv_id != owner").join(owning, "conv_id", "left_semi")
    ends = located.select("owner", F.col("depth").alias("last"), F.col("chain_start").alias("start"), "stop")
    intervals = above.join(ends, ["owner", "last"]).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("start", F.col("stop").alias("end")))).alias("above"),
        F.sum(F.col("stop") - F.col("start")).alias("depth_tokens"),
    )
    intervals = intervals.withColumnRenamed("conv_id", "owner")
    full = nodes.drop("block").join(located, ["owner", "depth"]).join(intervals, "owner", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    own = F.array(F.struct(F.col("chain_start").alias("start"), F.col("start").alias("end")))
    ancestors = F.concat(F.coalesce("above", none), F.when(F.col("start") > F.col("chain_start"), own).otherwise(none))
    out = full.select(
        "tree_id",
        "owner",
        "depth",
        "start",
        "n_tokens",
        (F.coalesce("depth_tokens", F.lit(0)) + F.col("start") - F.col("chain_start")).alias("position"),
        ancestors.alias("ancestors"),
        "loss_start",
        "loss_end",
        "ids",
    )
    return PrefixTree(staged(out, "chat-tree"), segments)


READ_SQL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def read_back(tree: PrefixTree, vocabulary: str) -> DataFrame:
    """Per conversation, from its nodes: turns, learned text and length of the formatted text."""
    steps = tree.segments.select("conv_id", "owner", F.explode(F.sequence("first", "last")).alias("depth"))
    nodes = tree.nodes.select("owner", "depth", "loss_start", "loss_end", "ids")
    turns = steps.join(nodes, ["owner", "depth"]).select("conv_id", "depth", "loss_start", "loss_end", "ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = loaded(vocabulary)
        now, state, done = None, None, []

        def finished() -> dict:
            turns_sha, loss_sha, counts = state
            return {
                "conv_id": now,
                "n_turns": counts[0],
                "turns_sha256": turns_sha.hexdigest(),
                "loss_chars": counts[1],
                "loss_sha256": loss_sha.hexdigest(),
                "formatted_chars": counts[2],
            }

        for batch in batches:
            convs, froms, untils = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for k, conv in enumerate(convs):
                if conv != now:
                    if state is not None:
                        done.append(finished())
                    now, state = conv, (hashlib.sha256(), hashlib.sha256(), [0, 0, 0])
                ids = batch.column(4)[k].values.to_numpy()
                formatted = encoder.decode(ids)
                role, text = parsed(formatted)
                learned = unescaped(encoder.decode(ids[froms[k] : untils[k]]))
                state[0].update(f"{role}\n{text}\n".encode())
                state[1].update(learned.encode())
                state[2][:] = state[2][0] + 1, state[2][1] + len(learned), state[2][2] + len(formatted)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=READ)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([finished()], schema=READ)

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "depth").mapInArrow(work, READ_SQL)


READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
