"""The pipeline's stages, each against brute force on its own input, and the registered queries."""

from __future__ import annotations

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from strataflux.llm import oracles, queries
from strataflux.llm.common import table

from .conftest import EDGES
from .test_dedup import components_by_hand, grouped_by_text
from .test_scans import held_by_hand

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "conversations"]


def pairs(df):
    return [(row["doc_id"], row["text"]) for row in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs, stages = table(spark, SMALL, "documents"), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_copies", "decontamination", "bpe"]
    items = [(row["item_id"], row["text"]) for row in table(spark, SMALL, "benchmark").collect()]

    kept = stages["language_id"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert {key for key, _ in pairs(kept)} == {key for key, text in pairs(docs) if any(map(str.isalpha, text or ""))}

    copies = stages["exact_dedup"](spark, docs, SMALL)
    assert copies.columns == docs.columns
    stay = {min(rows, key=lambda row: (-len(row[1]), row[0]))[0] for rows in grouped_by_text(pairs(docs)).values()}
    assert {key for key, _ in pairs(copies)} == stay

    near = stages["near_copies"](spark, copies, SMALL)
    assert near.columns == docs.columns
    found = components_by_hand(pairs(copies), 5, 80)
    assert {key for key, _ in pairs(near)} == {key for key, (_, component) in found.items() if key == component}

    clean = stages["decontamination"](spark, near, SMALL)
    assert clean.columns == docs.columns
    held = {key for key, _ in held_by_hand(pairs(near), items)}
    assert {key for key, _ in pairs(clean)} == {key for key, _ in pairs(near)} - held

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(pairs(clean))
    for row in stages["bpe"](spark, clean, SMALL).collect():
        assert row["ids"] == library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["decoded"] == texts[row["doc_id"]]


def test_run(spark):
    docs = corpus_pipeline.run(spark, SMALL)
    assert docs.columns == ["doc_id", "ids", "decoded"]
    assert 0 < docs.count() < table(spark, SMALL, "documents").count()


def test_edges_pass_all_stages(spark, docs_of):
    docs = docs_of(EDGES)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 7
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    numbers = sorted(int(name[2:].split("_")[0]) for name in names if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_queries_match_sql(spark, name):
    connection = duckdb.connect()
    for each in TABLES:
        connection.sql(f"CREATE VIEW {each} AS SELECT * FROM '{SMALL}/{each}.parquet'")
    wanted = connection.sql(oracles.sql()[name])
    columns = sorted(wanted.columns)
    found = queries.queries()[name](spark, SMALL)
    assert sorted(found.columns) == columns
    rows = [tuple(row) for row in found.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted(wanted.select(*columns).fetchall(), key=repr)
