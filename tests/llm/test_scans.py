"""License scan and benchmark decontamination against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from strataflux.llm import decontamination, licenses

from .conftest import EDGES, by_id

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text):
    lowered = re.sub("[A-Z]", lambda match: match[0].lower(), text or "")
    return [word for word in re.split(SEPARATORS, lowered) if word]


def scanned_by_hand(text, threshold=0.8):
    words = license_words(text)
    starts, base, labels, shares, blocks = [], set(), set(), [0.0], set()
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(own)] == own]
        starts += found
        base |= {label} if found else set()
    for template, label in licenses.TEMPLATES:
        own, span = set(template.split()), len(template.split())
        for start in range(0, max(1, len(words)), span):
            share = len(own & set(words[start : start + 2 * span])) / len(own)
            if share >= threshold:
                labels.add(label)
                shares.append(share)
                blocks.add(f"{label}:{start}:{min(len(words), start + 2 * span)}")
    score = 1.0 if starts else max(shares)
    first, last = (min(starts), max(starts)) if starts else (None, None)
    joined = [",".join(sorted(each)) for each in (base, base | labels)]
    return (len(words), len(starts), first, last, *joined, score, ",".join(sorted(blocks)))


def license_texts(seed):
    chance = random.Random(seed)
    fill = ["the", "cc", "by", "license", "public", "general", "rights", "all", "ñ", "K", "İ", "of", "mit"]
    texts = [" ".join(chance.choice(fill) for _ in range(chance.randrange(80))) for _ in range(60)]
    for text, _ in [*licenses.TEMPLATES, *licenses.PHRASES]:
        words = text.upper().split()
        for dropped in range(0, len(words), 3):
            lead = " ".join(chance.choice(fill) for _ in range(chance.randrange(30)))
            texts.append(f"{lead} {', '.join(words[:dropped] + words[dropped + 1 :])}. {lead}")
        texts.append(f"x\n{text}\n{text}")
    return [*texts, "CC-BY cc/by ccby cc  by", "KK all rights reserved", "all\0rights\x7freserved", "all rights é reserved"]


def test_licenses(docs_of):
    rows = [*EDGES, *enumerate(license_texts(2), 100)]
    found = licenses.scan(docs_of(rows)).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for row in found:
        key, *answer = row
        assert tuple(answer) == scanned_by_hand(texts[key]), texts[key]
    assert licenses.scan(docs_of([])).collect() == []


def item_words(text):
    return [word for word in re.split(r"[\W_]+", (text or "").lower()) if word]


def bag(words, width):
    return Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def similarity(left, right):
    both = sum((left & right).values())
    return both / (sum(left.values()) + sum(right.values()) - both)


def held_by_hand(docs, items, least=0.8):
    """Every window of an item's size anywhere, aligned or not."""
    found = {}
    for key, text in docs:
        words = item_words(text)
        for item, item_text in items:
            own = item_words(item_text)
            if not own or not words:
                continue
            width, n = min(5, len(own)), len(own)
            if len(words) < width:
                continue
            starts = range(max(1, len(words) - n + 1))
            best = max(similarity(bag(words[s : s + n], width), bag(own, width)) for s in starts)
            if best >= least:
                found[key, item] = best
    return found


def test_decontamination(spark, docs_of):
    chance = random.Random(8)
    common = [f"w{k}" for k in range(400)]
    line = lambda n: [chance.choice(common) for _ in range(n)]
    items = [(k, " ".join(line(n))) for k, n in enumerate([15, 30, 31, 45, 60, 60, 5, 3, 1, 2, 80])]
    items += [(50, None), (51, " ,. "), (52, "again again again again again again again again"), (4, items[4][1])]
    docs = []
    for key in range(160):
        item = chance.choice(items[:11])[1].split()
        for _ in range(key % 4):
            kind, at = chance.randrange(3), chance.randrange(len(item))
            if kind == 0:
                item[at] = "new"
            elif kind == 1:
                item.insert(at, "more")
            elif len(item) > 1:
                del item[at]
        text = [*line(chance.randrange(60)), *item, *line(chance.randrange(60))]
        docs.append((key, ", ".join(text).upper() if key % 2 else " ".join(text)))
    docs += [(1000 + k, " ".join(line(200))) for k in range(40)]
    docs += [(2000, items[4][1]), (2001, " ".join(items[4][1].split()[:-2])), (2002, "again " * 40)]
    docs += [(5000 + key, text) if key else (None, items[0][1]) for key, text in EDGES]
    schema = "item_id bigint, text string, n int, bag string"
    table = spark.createDataFrame([(*item, 1, "x") for item in items], schema)
    found = decontamination.contaminations(docs_of(docs), table).collect()
    answers = {(row["doc_id"], row["item_id"]): row["similarity"] for row in found}
    wanted = held_by_hand(docs, items)
    assert len(answers) == len(found)
    assert answers == pytest.approx(wanted)
    texts = dict(docs)
    for row in found:
        own = item_words(dict(items)[row["item_id"]])
        window = item_words(texts[row["doc_id"]])[row["first_word"] :][: len(own)]
        width = min(5, len(own))
        assert similarity(bag(window, width), bag(own, width)) == row["similarity"]
        words = item_words(texts[row["doc_id"]])
        before = [bag(words[start : start + len(own)], width) for start in range(row["first_word"])]
        assert all(similarity(earlier, bag(own, width)) < row["similarity"] for earlier in before)
    kept = decontamination.without_contaminated(docs_of(docs), table)
    assert {row["doc_id"] for row in kept.collect()} == {key for key, _ in docs} - {key for key, _ in wanted}
    assert decontamination.contaminations(docs_of([]), table).collect() == []
    assert decontamination.contaminations(docs_of(docs), table.limit(0)).collect() == []


def test_long_items_edited_at_both_ends(spark, docs_of):
    """The best window stands between the places where the item's parts would let it begin."""
    line = lambda name, n: [f"{name}{k}" for k in range(n)]
    sizes = [(76, 2), (130, 5), (200, 8), (304, 11)]
    items = [(n, " ".join(line(f"i{n}x", n))) for n, _ in sizes]
    docs = []
    for key, (n, k) in enumerate(sizes):
        own = line(f"i{n}x", n)
        own[:k], own[-k:] = line("a", k), line("b", k)
        half = n // 2
        docs.append((key, " ".join([*line("c", 40), *own[:half], *line("d", 2 * k), *own[half:], *line("e", 40)])))
    wanted = held_by_hand(docs, items)
    assert set(wanted) == {(key, n) for key, (n, _) in enumerate(sizes)}
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contaminations(docs_of(docs), table).collect()
    assert {(row["doc_id"], row["item_id"]): row["similarity"] for row in found} == pytest.approx(wanted)


def test_a_long_text_that_repeats_an_item(spark, docs_of):
    """Windows of one bag are compared once, so the repeats cost no more than reading them."""
    own = [f"w{k}" for k in range(200)]
    items = spark.createDataFrame([(1, " ".join(own))], "item_id bigint, text string")
    docs = docs_of([(1, " ".join(own * 80)), (2, " ".join([*own[50:], *own * 40]))])
    found = sorted(tuple(row) for row in decontamination.contaminations(docs, items).collect())
    assert found == [(1, 1, 1.0, 0), (2, 1, 1.0, 150)]


def test_fingerprints_within_the_radius_share_a_block():
    chance = random.Random(2)
    masks = set(decontamination.near_masks(decontamination.RADIUS // (decontamination.BITS // decontamination.BLOCK_BITS)))
    for _ in range(2000):
        change = sum(1 << bit for bit in chance.sample(range(64), decontamination.RADIUS))
        assert any((change >> shift) & 0xFF in masks for shift in range(0, 64, 8))


def test_rows_repeated_whole(docs_of, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id bigint, text string")
    docs = docs_of([(3, "one two three four five six seven")] * 3)
    assert [tuple(row) for row in decontamination.contaminations(docs, items).collect()] == [(3, 1, 1.0, 0)]
    assert by_id(licenses.scan(docs))[3]["n_words"] == 7


def test_rows_without_an_id_or_with_a_shared_one_stand_for_themselves(docs_of, spark):
    item, near = "one two three four five six seven", "six seven " * 3
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(None, item), (None, "clean"), (None, near), (None, None), (None, f"x {item}"), (7, item), (7, "also clean")]
    kept = decontamination.without_contaminated(docs_of(rows), items).collect()
    left = [(None, "clean"), (None, near), (None, None), (7, "also clean")]
    assert sorted([(row["doc_id"], row["text"]) for row in kept], key=repr) == sorted(left, key=repr)
    found = decontamination.contaminations(docs_of(rows), items).collect()
    assert sorted([tuple(row) for row in found], key=repr) == [(7, 1, 1.0, 0), (None, 1, 1.0, 0)]
