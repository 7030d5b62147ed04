"""License scan: an exact set-similarity join of text blocks with license templates.

A template's block length is twice its number of words and blocks begin at every multiple of
that number, so a run of words as long as the template lies whole in some block. A block meets a
template when it holds at least ``threshold`` of the template's distinct tokens. The tokens
of all templates are ordered by how often they occur in the whole corpus, rarest first. Then

* prefix filter: a block that meets a template holds one of its first n - needed + 1 tokens;
* positional filter: if the rarest token a block holds stands at place p of the template's
  order, the block can hold n - p of its tokens at most;
* length filter: a block of fewer words than needed cannot meet it.

The templates are a fixed list, so the index from prefix token to template is a literal, and the
join is a lookup inside each row: no text is shuffled, whatever source or copy is hot.
Phrases are templates of threshold 1 whose blocks are then checked for consecutive words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.llm.common import whole

THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the scan and their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Wording of well-known license notices.
TEMPLATES = [
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        "mit",
    ),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "bsd",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
]


@dataclass(frozen=True)
class Template:
    """One template with its tokens in ascending frequency."""

    words: tuple[str, ...]
    label: str
    needed: int
    tokens: tuple[str, ...]

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.tokens[: len(self.tokens) - self.needed + 1]


def lowered(text: Column) -> Column:
    """A-Z in lower case, where only ASCII words matter.

    The two other characters whose lower case begins with an ASCII letter are put out of the
    way by another character that belongs to words as well.
    """
    kept = F.replace(F.replace(whole(text), F.lit("K"), F.lit("ı")), F.lit("İ"), F.lit("ı"))
    return F.lower(kept)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), SEPARATORS), "")


def strings(values) -> Column:
    return F.array(*[F.lit(value) for value in values])


def token_counts(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """How often each of a fixed list of tokens occurs in the whole corpus."""
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    counted = words.where(F.col("word").isin(tokens)).groupBy("word").count()
    return {row["word"]: row["count"] for row in counted.collect()}


def ordered_templates(
    templates: list[tuple[str, str]], threshold: float, counts: dict[str, int]
) -> list[Template]:
    split = [(tuple(text.split()), label) for text, label in templates]
    least = Fraction(str(threshold))
    return [
        Template(
            words,
            label,
            ceil(least * len(set(words))),
            tuple(sorted(set(words), key=lambda token: (counts.get(token, 0), token))),
        )
        for words, label in split
    ]


MET = "array<struct<start:int,end:int,share:double>>"


def met_blocks(words: Column, at: Column, template: Template) -> Column:
    """The blocks of a template's length that meet it, with their share of its tokens.

    ``at`` has the places of the template's prefix tokens in the document.
    """
    span, size = len(template.words), len(template.tokens)
    starts = F.array_distinct(
        F.flatten(
            F.transform(
                at,
                lambda p: F.filter(
                    F.array(F.floor(p / span) * span, F.floor(p / span) * span - span), lambda s: s >= 0
                ),
            )
        )
    )

    def held(start: Column) -> Column:
        block = F.slice(words, (start + 1).cast("int"), 2 * span)
        # Positional filter: nothing before the rarest token held can be held.
        rarest = F.array_intersect(strings(template.prefix), block)[0]
        possible = size - F.array_position(strings(template.tokens), rarest) + 1
        share = F.size(F.array_intersect(strings(template.tokens), block)) / F.lit(float(size))
        # Length filter first, the intersection last.
        long_enough = F.size(block) >= template.needed
        end = start + F.size(block)
        met = F.when(long_enough & (possible >= template.needed), share)
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), met.alias("share"))

    # Whole tokens decide, not the share, which is a rounded quotient.
    least = (template.needed - 0.5) / size
    return F.filter(F.transform(starts, held), lambda block: F.coalesce(block["share"] > least, F.lit(False)))


def phrase_starts(words: Column, places: Column, phrase: Template) -> Column:
    """Where the phrase's words stand one after the other, from the places of its rarest word."""
    lead = phrase.words.index(phrase.tokens[0])
    starts = F.transform(places, lambda p: p - lead)
    wanted, size = strings(phrase.words), len(phrase.words)
    return F.filter(
        starts, lambda s: (s >= 0) & (F.slice(words, F.greatest(s, F.lit(0)) + 1, size) == wanted)
    )


def places_of(words: Column, tokens: tuple[str, ...]) -> Column:
    """Places of any of a few tokens."""
    marked = F.transform(words, lambda word, k: F.when(word.isin(*tokens), k))
    return F.filter(marked, lambda k: k.isNotNull())


def scan(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with its license phrases and labels.

    n_words; n_base, the places where a phrase's words stand consecutively, with the first and
    last word they begin at (null without any); base_labels and labels, distinct, sorted and joined
    by commas, the latter with those of all templates some block meets; score, the largest
    share of a template in a block that meets it, 1 where a phrase stands, else 0; blocks, every block that
    meets a template as label:first word:end, as sorted texts joined by commas. Words are runs of
    digits, letters and non-ASCII characters with A-Z lower-cased. Null and empty texts have no words
    and no labels; repeated rows are answered each; an empty table gives no rows; other columns are
    ignored. A phrase must not repeat the word that is rarest in it.
    """
    counts = token_counts(docs, sorted({word for text, _ in [*phrases, *templates] for word in text.split()}))
    exact = ordered_templates(phrases, 1, counts)
    loose = ordered_templates(templates, threshold, counts)
    # Literal index: which tokens make a document a candidate at all.
    wanted = sorted({token for each in [*exact, *loose] for token in each.prefix})
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words_of(F.col("text")).alias("words"))
    hits = F.array_intersect(F.col("words"), strings(wanted))
    rows = rows.select("doc_id", F.size("words").cast("bigint").alias("n_words"), "words", hits.alias("hits"))

    words, hits = F.col("words"), F.col("hits")
    found = [
        F.when(
            F.array_contains(hits, each.prefix[0]),
            phrase_starts(words, places_of(words, each.prefix), each),
        )
        .otherwise(F.array().cast("array<int>"))
        .alias(f"p{k}")
        for k, each in enumerate(exact)
    ]
    blocks = [
        F.when(
            F.arrays_overlap(hits, strings(each.prefix)),
            met_blocks(words, places_of(words, each.prefix), each).cast(MET),
        )
        .otherwise(F.array().cast(MET))
        .alias(f"t{k}")
        for k, each in enumerate(loose)
    ]
    # Rows without a hit skip all of this: each branch first looks at the hits.
    full = rows.select("doc_id", "n_words", *found, *blocks)
    places = F.concat(*[F.col(f"p{k}") for k in range(len(exact))])
    base = [F.when(F.size(f"p{k}") > 0, each.label) for k, each in enumerate(exact)]
    met = [F.when(F.size(f"t{k}") > 0, each.label) for k, each in enumerate(loose)]
    shares = [F.coalesce(F.array_max(F.col(f"t{k}.share")), F.lit(0.0)) for k in range(len(loose))]

    def named(label: str) -> Callable[[Column], Column]:
        return lambda block: F.concat_ws(":", F.lit(label), block["start"], block["end"])

    shown = [F.transform(f"t{k}", named(each.label)) for k, each in enumerate(loose)]

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")

    return full.select(
        "doc_id",
        "n_words",
        F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"),
        F.array_max(places).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined([*base, *met]).alias("labels"),
        F.greatest(F.when(F.size(places) > 0, 1.0).otherwise(0.0), *shares).alias("score"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(*shown))), ",").alias("blocks"),
    )
