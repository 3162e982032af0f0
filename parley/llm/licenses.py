"""License scan: an exact set-similarity join of text blocks with license templates.

Native: DataFrame functions only. A text is cut into blocks of BLOCK words that overlap by half, so every
run of up to BLOCK / 2 words lies whole in one of them. A block matches a template when it holds at least
the share THRESHOLD of the template's distinct words. Tokens are ordered by how many documents of the
whole table hold them, rarest first (only template tokens can meet, so only these are counted). Then

* prefix filter: a template's first |T| - need + 1 tokens are its prefix; a block that matches holds one;
* length filter: a block must hold `need` template tokens at all;
* positional filter: what is left behind the shared token in both orders must suffice for `need`;

and what remains is verified by a plain intersection. The share alone does not tell short templates apart
(a CC BY-NC line holds 6 of the 7 words of the CC BY-SA one); with `marks` a block must also hold the
template's own words, all of them. Only documents that hold a prefix token are cut
into blocks. The templates are a fixed table, so what is broadcast does not grow.

Base places (a phrase's words, consecutive) come from the same words. Null or empty text: no words, no
labels, score 0. Rows that repeat a doc_id with another text are judged alone. No rows: no rows.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from parley.llm.common import written

#: What a base place is: (label, words that stand consecutively).
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Notices that the method looks for: (label, text).
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "free software you can redistribute it and or modify under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("all-rights-reserved", "copyright all rights reserved no part may be reproduced without permission"),
)
#: Words without which a block is not the template's, template by template: what tells it from its neighbours.
MARKS = (
    ("mit",), (), ("apache",), ("gnu", "3"), ("gnu",), ("redistribution",), ("mozilla", "2"),
    ("creative", "commons", "attribution"), ("cc", "nc"), ("cc", "sa"), ("rights", "reserved"),
)
BLOCK, THRESHOLD = 40, 0.8
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Words after A-Z are lower-cased. Other letters may change in case too: they are in no template and
    stay word characters; the Kelvin sign, whose lower case would be an ASCII k, is put aside first."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.filter(F.split(plain, _APART), lambda w: w != "")


def _texts(tokens) -> Column:
    return F.array(*[F.lit(t) for t in tokens]) if tokens else F.array().cast("array<string>")


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase, from 0."""
    p = phrase.split()
    at = F.sequence(F.lit(0), F.size(words) - len(p))

    def here(i):
        ok = words[i] == p[0]
        for k in range(1, len(p)):
            ok = ok & (words[i + k] == p[k])
        return ok

    return F.when(F.size(words) >= len(p), F.filter(at, here)).otherwise(F.array().cast("array<int>"))


def token_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """Template tokens, rarest in the documents first; at most as many rows come back as there are tokens."""
    vocabulary = sorted({t for _, text in templates for t in text.split()})
    seen = docs.select(F.explode(F.array_intersect(_texts(vocabulary), license_words(F.col("text")))).alias("t"))
    df = {r["t"]: r["n"] for r in seen.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda t: (df.get(t, 0), t))


def matches(words: DataFrame, order: list[str], templates=TEMPLATES, threshold=THRESHOLD, block=BLOCK,
            marks=MARKS) -> DataFrame:
    """Of (key..., words): (key..., label, start, score) for each block and template that match. marks: per
    template, words of it that the block must hold; none for no template if empty."""
    marks = marks or [()] * len(templates)
    keys = [c for c in words.columns if c != "words"]
    rank = {t: i for i, t in enumerate(order)}
    rows, prefixes = [], set()
    for n, (label, text) in enumerate(templates):
        tokens = sorted(set(text.split()), key=rank.get)
        need = math.ceil(threshold * len(tokens))
        for place, t in enumerate(tokens[: len(tokens) - need + 1]):
            prefixes.add(t)
            rows.append((n, label, t, place, len(tokens), need, tokens, list(marks[n])))
    spark = words.sparkSession
    prefix = spark.createDataFrame(rows, "template int, label string, t string, place int, size int, need int, tokens array<string>, marks array<string>")
    half = block // 2
    found = words.filter(F.arrays_overlap("words", _texts(sorted(prefixes))))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - half - 1, F.lit(0)), F.lit(half))
    blocks = found.select(*keys, F.explode(F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.slice("words", s + 1, block).alias("b")))).alias("_b"))
    held = blocks.select(*keys, "_b.start", F.array_intersect(_texts(order), F.col("_b.b")).alias("held"))
    held = held.filter(F.arrays_overlap("held", _texts(sorted(prefixes))))
    at = held.select(*keys, "start", "held", F.posexplode("held").alias("i", "t"))
    near = at.join(F.broadcast(prefix), "t").filter(  # a fixed table of some tens of rows
        (F.size("held") >= F.col("need"))
        & (F.least("i", "place") + F.least(F.size("held") - F.col("i"), F.col("size") - F.col("place")) >= F.col("need")))
    both = F.size(F.array_intersect("held", "tokens"))
    own = F.size(F.array_intersect("held", "marks")) == F.size("marks")
    return near.filter((both >= F.col("need")) & own).select(
        *keys, "label", "start", (both / F.col("size")).alias("score"))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold=THRESHOLD, marks=MARKS) -> DataFrame:
    """One row per document: figures of the base places, labels of both, and the best share as score."""
    docs = docs.select("doc_id", "text")
    order = token_order(docs, templates)
    words = docs.select("doc_id", F.xxhash64("text").alias("_h"), license_words(F.col("text")).alias("words"))
    heads = _texts(sorted({p.split()[0] for _, p in phrases}))
    places = {label: F.when(F.arrays_overlap("words", heads), _places(F.col("words"), p)).otherwise(
        F.array().cast("array<int>")) for label, p in phrases}
    a = words.select("doc_id", "_h", F.size("words").alias("n_words"),
                     *[v.alias(f"_p{i}") for i, v in enumerate(places.values())])
    lists = [F.col(f"_p{i}") for i in range(len(places))]
    every = F.concat(*lists)
    labels = F.array_compact(F.array(*[F.when(F.size(x) > 0, F.lit(k)) for k, x in zip(places, lists)]))
    base = a.select("doc_id", "_h", F.col("n_words").cast("long").alias("n_words"),
                    F.size(every).cast("long").alias("n_base"),
                    F.array_min(every).cast("long").alias("first_word"),
                    F.array_max(every).cast("long").alias("last_word"), labels.alias("_base"))
    base = written(base, "license-base")
    hits = (matches(words, order, templates, threshold, marks=marks).groupBy(F.col("doc_id").alias("_d"), F.col("_h").alias("_g"))
            .agg(F.collect_set("label").alias("_more"), F.max("score").alias("_score")))  # a label each at most
    x = base.join(hits, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
    more = F.coalesce("_more", F.array().cast("array<string>"))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(c)))
    return x.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("_base")).alias("base_labels"),
                    joined(F.concat("_base", more)).alias("labels"),
                    F.greatest(F.coalesce("_score", F.lit(0.0)), F.when(F.size("_base") > 0, 1.0).otherwise(0.0)).alias("score"))
