from __future__ import annotations

import pytest

from strataflux.llm.common import workers_find_package

# Columns whose names the operators use inside; they must be ignored.
CLASHING = "id bigint, size bigint, digest string, score double, words string, keep_id bigint, component string"
DOCUMENTS = f"doc_id bigint, text string, lang string, {CLASHING}"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) with columns of clashing names."""
    workers_find_package(spark)

    def make(rows):
        full = [(*row, *[None] * (3 - len(row)), 1, 2, "d", 0.5, "w", 3, "c") for row in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


# Texts every operator must take: null, empty, spaces only, one word, repeated, very long.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "word"),
    (5, "same same same"),
    (6, "same same same"),
    (7, "lorem ipsum dolor " * 30_000),
    (8, "\0 <|endoftext|>  x\x85y  z"),
    (None, "no id"),
    (9, "twice"),
    (9, "twice"),
]
