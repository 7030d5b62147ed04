"""Exact and near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strataflux.llm.common import workspace
from strataflux.llm.components import connected
from strataflux.llm.exact_dedup import exact_groups, without_copies
from strataflux.llm.jaccard_join import boundary, one_of_each, similar_components

from .conftest import EDGES, by_id


def grouped_by_text(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((key, text or ""))
    return groups


COPIES = [
    (1, "a b c"),
    (2, "abc"),
    (3, "a  b  c"),
    (4, "a\tb\nc  "),
    (5, None),
    (6, ""),
    (7, " \n"),
    (8, "x"),
    (9, "ÿ "),
    (10, "ÿ"),
    *[(k, "hot " * 50) for k in range(100, 300)],
    (300, "long " * 100_000),
    (301, "long" * 100_000),
]


@pytest.mark.parametrize("weak", [False, True])
def test_copies(docs_of, weak):
    """With a digest of one letter nearly all hits collide, and full bytes must settle them."""
    digest = {"digest": lambda content: F.substring(F.sha2(content, 256), 1, 1)} if weak else {}
    found = by_id(exact_groups(docs_of(COPIES), **digest))
    assert len(found) == len(COPIES)
    for content, rows in grouped_by_text(COPIES).items():
        stays = min(rows, key=lambda row: (-len(row[1]), row[0]))[0]
        for key, _ in rows:
            row = found[key]
            assert (row["keep_id"], row["group_size"], row["kept"]) == (stays, len(rows), key == stays)
            assert row["text_sha256"] == hashlib.sha256(content.encode()).hexdigest()


def test_repeated_rows_and_missing_ids(docs_of):
    rows = [(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y")]
    found = exact_groups(docs_of(rows)).collect()
    assert len(found) == 5
    assert sum(row["kept"] for row in found) == 2
    assert {row["keep_id"] for row in found if row["group_size"] == 3} == {1}
    assert exact_groups(docs_of([])).collect() == []
    assert without_copies(docs_of([(1, "x"), (2, "x"), (3, "y")])).count() == 2
    kept = without_copies(docs_of([*rows, (1, "z")]))
    assert kept.columns == docs_of([]).columns
    assert sorted((row["doc_id"] or 0, row["text"]) for row in kept.collect()) == [(0, "y"), (1, "x"), (1, "z")]


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def components_by_hand(rows, width, percent):
    sets = [(key, shingles(text, width)) for key, text in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    smallest = {}
    for k, (key, _) in enumerate(sets):
        smallest[root(k)] = min(key, smallest.get(root(k), key))
    return {key: (len(own), smallest[root(k)]) for k, (key, own) in enumerate(sets)}


def near_copies(seed):
    """Families of texts of all sizes with some words changed, a shared passage, chains of copies."""
    chance = random.Random(seed)
    common = [f"w{k}" for k in range(30)]
    passage = [chance.choice(common) for _ in range(40)]
    rows, key = [], 0
    for size in [1, 2, 3, 5, 9, 11, 12, 20, 21, 25, 30, 40, 41, 45, 60, 90, 150, 400, 900]:
        for _ in range(2):
            words = [f"u{chance.randrange(3000)}" if chance.random() < 0.7 else chance.choice(common) for _ in range(size)]
            if size > 100:
                words[20:20] = passage
            for copy in range(8):
                rows.append((key * 7 % 1009, " ".join(words).upper() if copy % 3 == 0 else " ".join(words)))
                key += 1
                words = list(words)
                for _ in range(max(1, size // 80)):
                    kind, at = chance.randrange(3), chance.randrange(len(words))
                    if kind == 0:
                        words[at] = f"n{chance.randrange(10**6)}"
                    elif kind == 1:
                        words.insert(at, chance.choice(common))
                    elif len(words) > 1:
                        del words[at]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_similar_sets(docs_of, width, percent):
    rows = near_copies(width)
    found = by_id(similar_components(docs_of(rows), width, percent))
    wanted = components_by_hand(rows, width, percent)
    assert {key: (row["n_shingles"], row["component_id"]) for key, row in found.items()} == wanted
    assert len({component for _, component in wanted.values()}) < len(rows)


def test_edges_of_similar_sets(docs_of):
    found = similar_components(docs_of(EDGES)).collect()
    assert len(found) == len(EDGES)
    named = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in found}
    assert named[1] == (0, 1) and named[2] == (0, 2) and named[3] == (0, 3)
    assert named[5] == (1, 5) and named[6] == (1, 5)
    assert named[7] == (3, 7) and named[None] == (1, None) and named[9] == (1, 9)
    assert similar_components(docs_of([])).collect() == []
    assert one_of_each(docs_of(EDGES)).count() == len(EDGES) - 2


def shared_ids():
    chance = random.Random(12)
    texts = [" ".join(chance.choices([f"w{k}" for k in range(500)], k=60)) for _ in range(12)]
    rows = [(1, texts[0]), (1, texts[1]), (2, f"{texts[1]} x"), (3, f"{texts[0]} x"), (1, texts[0])]
    rows += [(None, texts[2]), (None, f"{texts[2]} y"), (None, texts[3]), (None, None), (None, None), (None, "")]
    rows += [(7, texts[4]), (8, f"{texts[4]} z"), (7, f"{texts[5]} z"), (None, texts[5]), (9, texts[6]), (9, texts[7])]
    return rows + [(5, " ".join([text, chance.choice("ab")])) for text in texts[8:] for _ in range(6)]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_rows_that_share_ids_or_have_none(docs_of, width, percent):
    rows = shared_ids()
    sets = [shingles(text, width) for _, text in rows]
    groups = [{k} for k in range(len(rows))]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b) and groups[i] is not groups[j]:
                groups[i] |= groups[j]
                for k in groups[i]:
                    groups[k] = groups[i]
    least = [min((rows[k][0] for k in group if rows[k][0] is not None), default=None) for group in groups]
    wanted = Counter((key, len(own), component) for (key, _), own, component in zip(rows, sets, least, strict=True))
    found = similar_components(docs_of(rows), width, percent).collect()
    assert Counter((row["doc_id"], row["n_shingles"], row["component_id"]) for row in found) == wanted

    kept = one_of_each(docs_of(rows), width, percent)
    assert kept.columns == docs_of(rows).columns
    stay = [(row["doc_id"], row["text"]) for row in kept.collect()]
    for group in {id(group): group for group in groups}.values():
        own = [rows[k] for k in group]
        there = [row for row in stay if row in own]
        ids = [key for key, _ in own if key is not None]
        assert ids == [] or {key for key, _ in there} == {min(ids)}
    assert len(stay) == len({id(group) for group in groups})


def test_boundary_goes_by_cost():
    assert boundary({}, 90) == 0
    assert boundary({5: 1000}, 90) >= 5
    assert boundary({30: 1000}, 90) < 30


def test_long_chains_and_hot_ids(spark):
    chain = [(k, k + 1) for k in range(1000, 1200)]
    star = [(5, k) for k in range(2000, 2500)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (None, 8)], "a bigint, b bigint")
    with workspace(spark, "test") as work:
        found = {row["id"]: row["component"] for row in connected(links, work).collect()}
    assert found == {k: 1000 for k in range(1000, 1201)} | {5: 5} | {k: 5 for k in range(2000, 2500)}
