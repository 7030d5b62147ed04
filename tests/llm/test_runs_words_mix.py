"""Periodic runs, spelling variants and source mixes against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strataflux.llm import periodic_runs, source_mix, spelling_variants
from strataflux.llm.common import table

from .conftest import EDGES, by_id

SMALL = "/root/testdata/sf0.001"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words):
    """Every maximal stretch that repeats at a distance, where no smaller distance does."""
    found = []
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end + period - start
            stretch = words[start : start + length]
            if end > start and length >= max(6, 4 * period) and not any(stretch[:-q] == stretch[q:] for q in range(1, period)):
                found.append((start, length, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted_by_hand(key, text):
    words = SPACES.findall(text or "")
    check, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and check % 10 == 0 and n:
        g = check // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digests_by_hand(key, text):
    words = planted_by_hand(key, text)
    runs = runs_by_hand(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(runs), *longest, *(hashlib.sha256(part.encode()).hexdigest() for part in (listed, kept)))


def random_words(seed):
    r = random.Random(seed)
    words = [r.randrange(r.randint(1, 4)) for _ in range(r.randint(0, 60))]
    if words and r.random() < 0.6:
        start = r.randrange(len(words))
        period = r.randint(1, max(1, (len(words) - start) // 3))
        words[start:] = [words[start + k % period] for k in range(len(words) - start)]
    return words


def test_runs_of_random_words():
    for seed in range(600):
        texts = [random_words(5 * seed + k) for k in range(4)]
        counts = np.array([len(words) for words in texts])
        flat = np.array([word for words in texts for word in words], np.int64)
        found = zip(*(part.tolist() for part in periodic_runs.runs_of(flat, counts)), strict=True)
        wanted, offset = [], 0
        for words in texts:
            wanted += [(start + offset, length, period) for start, length, period in runs_by_hand(words)]
            offset += len(words)
        assert list(found) == wanted


@pytest.mark.parametrize("kind", ["one", "cycle", "fibonacci"])
def test_runs_of_long_texts(kind):
    size = 30_000
    words = np.zeros(size, np.int64) if kind == "one" else np.arange(size) % 700
    if kind == "fibonacci":
        last, text = "1", "10"
        while len(text) < size:
            last, text = text, text + last
        words = np.array(list(map(int, text[:size])))
    found = list(zip(*(part.tolist() for part in periodic_runs.runs_of(words, np.array([size]))), strict=True))
    assert found == ([] if kind == "fibonacci" else [(0, size, 1 if kind == "one" else 700)])


def test_common_extensions():
    random_text = random.Random(4)
    text = [random_text.randrange(3) + 1 for _ in range(700)] + [0]
    tree = periodic_runs.SuffixTree(text, 4)
    assert np.argsort(tree.ranks(tree.symbols)).tolist() == sorted(range(701), key=lambda k: text[k:])
    left, right = np.triu_indices(701, 1)
    wanted = [next(k for k in range(702) if j + k > 700 or text[i + k] != text[j + k]) for i, j in zip(left, right)]
    assert tree.extensions().of(left, right).tolist() == wanted


RUN_TEXTS = [
    *[(key, text and text[:600]) for key, text in EDGES[:-2]],
    *[(k, " ".join(f"w{word}" for word in random_words(k))) for k in range(100, 260)],
    *[(k, " ".join(f"w{word}" for word in range(k % 37))) for k in range(260, 400)],
    (400, "a b " * 9 + "a b"),
]


def test_run_digests(spark, docs_of):
    rows = [*RUN_TEXTS, (401, "x y " * 8), (401, "x y " * 8)]
    found = periodic_runs.run_digests(docs_of(rows)).collect()
    wanted = Counter(digests_by_hand(key, text) for key, text in rows)
    assert Counter(map(tuple, found)) == wanted
    assert any(row[1] for row in wanted) and any(row[1] > 1 for row in wanted)
    assert periodic_runs.run_digests(docs_of([])).count() == 0


def test_word_runs_keep_texts(spark, docs_of):
    found = by_id(periodic_runs.word_runs(docs_of([(1, "go " * 6 + "on"), (2, "a b " * 3), (3, None)])))
    assert [tuple(run) for run in found[1].runs] == [(0, 6, 1)] and found[1].collapsed == "go on"
    assert found[2].runs == [] and found[2].collapsed == "a b a b a b"
    long = periodic_runs.word_runs(docs_of(EDGES)).where("doc_id = 7").first()
    assert [tuple(run) for run in long.runs] == [(0, 90_000, 3)] and long.collapsed == "lorem ipsum dolor"
    assert (found[3].n_words, found[3].runs, found[3].collapsed) == (0, [], "")


def test_query_on_given_documents(spark):
    docs = table(spark, SMALL, "documents")
    wanted = Counter(digests_by_hand(row["doc_id"], row["text"]) for row in docs.collect())
    assert Counter(map(tuple, periodic_runs.run_digests(docs).collect())) == wanted


def words_by_hand(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if check % 199 == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def variants_by_hand(rows):
    counts = words_by_hand(rows)
    near = defaultdict(set)
    by_rest = defaultdict(set)
    for word in counts:
        for k in range(len(word)):
            by_rest[word[:k] + word[k + 1 :]].add(word)
        by_rest[word].add(word)
    for words in by_rest.values():
        for a in words:
            near[a] |= {b for b in words if one_edit(a, b)}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * n else None
    found = set()
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        found.add((word, form[word], root, n, len(near[word]), counts[form[word]] if form[word] else None))
    return found


def spelt(seed=3):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdéß×") for _ in range(r.randint(6, 9))) for _ in range(40)]
    rows = []
    for key in range(300):
        words = []
        for _ in range(60):
            word = r.choice(base[: 1 + r.randrange(40)])
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                k = r.randrange(len(word))
                word = r.choice([word[:k] + word[k + 1 :], word[:k] + r.choice("abc") + word[k:], word[:k] + "D" + word[k + 1 :]])
            words.append(word)
        rows.append((key, r.choice([" ", "-", "7", "Ā", "㲀"]).join(words)))
    return rows


def test_spelling_variants(spark, docs_of):
    rows = [*spelt(), (None, "naïveté " * 9), (None, None), (500, ""), (500, ""), (501, "Ähnlich ÄHNLICH " * 20_000)]
    found = spelling_variants.spelling_variants(docs_of(rows))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = variants_by_hand(rows)
    assert {tuple(row) for row in found.collect()} == wanted and found.count() == len(wanted)
    assert any(form and root != form for _, form, root, *_ in wanted)
    assert spelling_variants.spelling_variants(docs_of([])).count() == 0


def test_spelling_of_given_documents(spark):
    docs = table(spark, SMALL, "documents")
    wanted = variants_by_hand([(row["doc_id"], row["text"]) for row in docs.collect()])
    assert {tuple(row) for row in spelling_variants.spelling_variants(docs).collect()} == wanted


def test_near_words_share_a_signature():
    r = random.Random(9)
    for _ in range(2_000):
        word = "".join(r.choice("abcdefghij") for _ in range(r.randint(6, 12)))
        k = r.randrange(len(word))
        edited = r.choice([word[:k] + word[k + 1 :], word[:k] + "x" + word[k:], word[:k] + "y" + word[k + 1 :]])
        assert set(spelling_variants.signatures(word)) & set(spelling_variants.signatures(edited))


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, what is above a limit shared again, until nothing is."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[k % len(weights)] for k, name in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[name] for name in full)
        rest = sum(weight[name] for name in names if name not in full)
        share = {name: left * weight[name] / rest for name in names if name not in full}
        above = {name for name in share if share[name] >= most * sizes[name]}
        if not above:
            return share | {name: float(most * sizes[name]) for name in full}
        full |= above
        if len(full) == len(names):
            return {name: float(most * sizes[name]) for name in names}


def sourced(spark, rows):
    clashing = "size string, copies string, rank int, place int, weight int, part int, rate int"
    full = [(*row, "s", "c", 1, 2, 3, 4, 5) for row in rows]
    return spark.createDataFrame(full, f"doc_id bigint, text string, source string, {clashing}").repartition(3)


MIXES = {
    "even": [(k, "w " * (20 + k % 7), f"s{k % 6}") for k in range(900)],
    "limits": [(k, "w " * (1 + k % 3), ["tiny", "big", "￿", "\U0001f600", None, ""][0 if k < 5 else 1 + k % 5]) for k in range(3000)],
    "hot": [(k, "w x " * 5, "a" if k % 3 else f"b{k % 40:02}") for k in range(2000)],
    "null": [(None, None, None), (1, "", "e"), (2, "one two", None), (2, "one two", None), (None, "x", "e")],
    "empty texts": [(1, "", "a"), (2, None, "b")],
    "long": [(1, "word " * 200_000, "a"), (2, "b", "b")],
}


@pytest.mark.parametrize("name", MIXES)
def test_source_mix(spark, name):
    rows = MIXES[name]
    docs = sourced(spark, rows)
    mixed = source_mix.mixture(docs)
    found = mixed.collect()
    size = {row: len(SPACES.findall(row[1] or "")) for row in rows}
    sizes = Counter()
    for row in rows:
        sizes[row[2]] += size[row]
    targets = targets_by_hand(sizes)
    taken, squares = Counter(), Counter()
    assert Counter((row.doc_id, row.text, row.source) for row in found) == Counter(rows)
    for row in found:
        assert row.size == size[(row.doc_id, row.text, row.source)] and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[row.source], rel=1e-12)
        rate = row.target / row.source_size if row.source_size else 0
        assert int(rate) <= row.copies <= min(3, int(rate) + 1)
        taken[row.source] += row.size * row.copies
        squares[row.source] += row.size**2
    for source, target in targets.items():
        # Five deviations of independent draws.
        assert abs(taken[source] - target) <= 5 * 0.5 * squares[source] ** 0.5
    again = source_mix.mixture(docs.repartition(7)).collect()
    assert Counter((row.doc_id, row.text, row.copies) for row in again) == Counter(
        (row.doc_id, row.text, row.copies) for row in found
    )
    emitted = source_mix.repeated(mixed)
    assert emitted.columns == mixed.columns and emitted.count() == sum(row.copies for row in found)


def test_source_mix_of_nothing(spark):
    assert source_mix.mixture(sourced(spark, [])).count() == 0
    assert source_mix.taken_words(sourced(spark, [])).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_source_mix_is_native(spark):
    plan = source_mix.taken_words(table(spark, SMALL, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
