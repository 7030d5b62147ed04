from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataflux.operators import incremental, joins, merge

KEYS = ["a", "b"]
ROWS = st.lists(
    st.tuples(
        st.sampled_from([1, 2, 3, None]), st.sampled_from(["x", "y", None]), st.integers(0, 3), st.integers(0, 3)
    ),
    max_size=8,
)
SCHEMA = "a int, b string, t int, v int"
FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def key(row):
    return row[:2]


def matches(row, others):
    return None not in key(row) and key(row) in {key(o) for o in others}


@FEW
@given(source=ROWS, target=ROWS)
def test_anti_and_semi_add_up(spark, source, target):
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    pairs = joins.same_keys(KEYS)
    absent, present = rows(joins.unseen(s, t, pairs)), rows(joins.seen(s, t, pairs))
    assert absent + present == Counter(source)
    assert present == Counter(r for r in source if matches(r, target))


@FEW
@given(source=ROWS, target=ROWS)
def test_joins_match_brute_force(spark, source, target):
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    pairs = joins.same_keys(KEYS)
    inner = Counter(l + r for l in source for r in target if matches(l, [r]))
    left = inner + Counter(l + (None,) * 4 for l in source if not matches(l, target))
    right_alone = Counter((None,) * 4 + r for r in target if not matches(r, source))
    assert rows(joins.key_join(s, t, pairs, "inner")) == inner
    assert rows(joins.key_join(s, t, pairs, "left_outer")) == left
    assert rows(joins.key_join(s, t, pairs, "right")) == inner + right_alone
    assert rows(joins.key_join(s, t, pairs, "full")) == left + right_alone


def test_join_columns_and_kinds(spark):
    s = spark.createDataFrame([(1, 2)], "k int, v int")
    joined = joins.key_join(s, s, [("k", "v")], "left")
    assert joined.columns == ["k", "v", "target_k", "target_v"]
    with pytest.raises(ValueError):
        joins.key_join(s, s, [("k", "v")], "sideways")


@FEW
@given(source=ROWS, target=ROWS)
def test_insert_only_merge(spark, source, target):
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    merged = merge.merge_insert_only(s, t, KEYS)
    assert rows(merged) == Counter(target) + Counter(r for r in source if not matches(r, target))


def complete(data):
    return [r for r in data if None not in key(r)]


def one_per_key(data):
    best = {}
    for r in data:
        kept = best.get(key(r))
        if kept is None or r[2:] > kept[2:]:
            best[key(r)] = r
    return list(best.values())


@FEW
@given(source=ROWS, target=ROWS)
def test_upsert(spark, source, target):
    source, target = complete(source), one_per_key(complete(target))
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    incoming = one_per_key(source)
    wanted = Counter(incoming) + Counter(r for r in target if not matches(r, source))
    once = merge.merge_update_insert(s, t, KEYS, newest_by=["t"])
    assert rows(once) == wanted
    assert rows(merge.upsert(s, once, KEYS, ["t"])) == wanted
    assert max(Counter(key(r) for r in once.collect()).values(), default=1) == 1


@FEW
@given(source=ROWS, target=ROWS)
def test_update_of_chosen_columns(spark, source, target):
    source, target = complete(source), one_per_key(complete(target))
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    incoming = {key(r): r for r in one_per_key(source)}
    fresh = Counter(r for r in incoming.values() if not matches(r, target))
    set_v = Counter(r[:3] + (incoming[key(r)][3],) if key(r) in incoming else r for r in target)
    assert rows(merge.merge_update_insert(s, t, KEYS, ["v"], ["t"])) == set_v + fresh
    assert rows(merge.merge_update_insert(s, t, KEYS, KEYS, ["t"])) == Counter(target) + fresh


def test_update_may_set_null(spark):
    s = spark.createDataFrame([(1, "x", 0, None)], SCHEMA)
    t = spark.createDataFrame([(1, "x", 0, 7)], SCHEMA)
    assert rows(merge.merge_update_insert(s, t, KEYS, ["v"])) == Counter([(1, "x", 0, None)])


@FEW
@given(data=ROWS)
def test_latest_per_key(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(merge.latest_per_key(df, KEYS, ["t"])) == Counter(one_per_key(data))


def test_latest_prefers_values_over_gaps_and_keeps_column_order(spark):
    df = spark.createDataFrame([(None, 1, 5), (3, 1, 5), (9, 1, 4)], "v int, k int, t int")
    best = merge.latest_per_key(df, ["k"], ["t"])
    assert best.columns == ["v", "k", "t"]
    assert [tuple(r) for r in best.collect()] == [(3, 1, 5)]


def test_newer_than_uses_the_default_for_an_empty_target(spark):
    source = spark.sql("SELECT TIMESTAMP '2024-01-01' AS t UNION ALL SELECT TIMESTAMP '1899-01-01'")
    assert incremental.newer_than(source, source.where("false"), "t").count() == 1
    assert incremental.newer_than(source, source, "t").count() == 0
