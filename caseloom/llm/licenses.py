"""License scan: phrases, and an exact containment join with license texts.

DataFrame functions only.  Blocks are windows of words, whatever lines and comment
marks stand between them: for a template of t words the 2 t words from each
multiple of t on, so that any t + 1 words in a row lie in one block.  A template is
in a block if at least ``THRESHOLD`` of its distinct words are among the block's.

Join: the templates' words are ordered by how many documents of the whole table
hold them, rarest first (a count of a fixed vocabulary, so it is small).  For a
template of n distinct words of which ``need`` must be there, a block that meets
the threshold holds at least one of the n - need + 1 rarest, its prefix; so places
of prefix words are joined with templates, which gives the blocks around them.  A
block goes on only if it has ``need`` words of the vocabulary at all (length
filter) and enough of them from the matching word on, in both (position filter).
What is left is counted.  Each place carries only the vocabulary words near it, so
the work grows with the text's length.

Cases: a null text counts as empty and has no words, no labels and null
``first_word`` and ``last_word``.  Repeated rows get equal results each.  Columns named like a result are replaced, all
others are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a word is, in lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# License statements and their labels.
TEMPLATES = (
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-program", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("cc-by-family-notice", "licensed under cc by 4 0"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("bsd-conditions", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def need(size: int, threshold: float) -> int:
    """Words of a template of ``size`` words that a block must have."""
    return max(1, ceil(threshold * size - 1e-9))


def _words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def global_order(df: DataFrame, text: str, vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary, rarest first by the number of documents that have the word."""
    held = df.select(F.explode(F.array_intersect(_words(F.lower(F.col(text))), _strings(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def phrase_places(n_words: Column, line: Column, phrases: Sequence[tuple[str, str]]) -> tuple[Column, Column, Column, Column]:
    """All places, first and last start, and the labels found, of phrases in a line of words.

    In the line each word stands between two spaces of its own, so that
    neighbouring phrases share no space; no phrase overlaps itself.
    """
    spaces = lambda c: ((F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("long")
    n, first, last, labels = F.lit(0).cast("long"), [], [], []
    for phrase, label in phrases:
        size = len(phrase.split())
        p = " " + "  ".join(phrase.split()) + " "
        has = F.contains(line, F.lit(p))
        n = n + F.when(has, ((F.length(line) - F.length(F.replace(line, F.lit(p), F.lit("")))) / len(p)).cast("long")).otherwise(0)
        first.append(F.when(has, spaces(F.substring_index(line, p, 1))))
        last.append(F.when(has, n_words - spaces(F.substring_index(line, p, -1)) - size))
        labels.append(F.when(has, F.lit(label)))
    return n, F.least(*first), F.greatest(*last), F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))


def scan(
    df: DataFrame, text: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest containment among the templates that meet the
    threshold, 0 without one.
    """
    spark = df.sparkSession
    own = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    others = [c for c in df.columns if c != text and c not in own]
    sets = [(label, sorted(set(t.split())), len(t.split())) for label, t in templates]
    vocabulary = sorted({w for _, s, _ in sets for w in s})
    order = global_order(df, text, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    prefix = []
    for label, s, size in sets:
        ranks, least = sorted(rank[w] for w in s), need(len(s), threshold)
        prefix += [(ranks[i], label, i, least, ranks, size) for i in range(len(ranks) - least + 1)]
    table = spark.createDataFrame(prefix, "_rank int, _label string, _i int, _least int, _ranks array<int>, _size int")  # names that no other column is likely to have
    rare = sorted({p[0] for p in prefix})
    far = 2 * max((size for _, _, size in sets), default=1)  # words to both sides that a block may reach

    t = F.coalesce(F.col(text), F.lit(""))
    low = F.lower(t)
    # exact words are made of A-Z lower-cased texts; lower() gives as many words and no ASCII word less
    base = df.select(*others, t.alias("_text"), low.alias("_low")).select("*", _words(F.col("_low")).alias("_words"))
    hint = F.lit(False)
    for phrase, _ in phrases:
        for w in phrase.split()[:1]:
            hint = hint | F.contains("_low", F.lit(w))
    exact = F.when(hint, _words(_ascii_lower(F.col("_text"))))
    base = base.select(
        *others, F.size("_words").cast("long").alias("n_words"), F.concat(F.lit(" "), F.array_join(exact, "  "), F.lit(" ")).alias("_exact"),
        F.when(F.arrays_overlap("_words", _strings([order[r] for r in rare])), F.col("_words")).alias("_words"),
    )
    n, first, last, labels = phrase_places(F.col("n_words"), F.col("_exact"), phrases)
    found = F.col("_exact").isNotNull()
    numbers = F.create_map(*[x for w, r in rank.items() for x in (F.lit(w), F.lit(r))]) if rank else F.lit(None).cast("map<string,int>")
    # places and ranks of vocabulary words; then the places of prefix words, each with the vocabulary words around it
    hits = F.filter(F.transform("_words", lambda w, i: F.struct(i.alias("at"), F.try_element_at(numbers, w).alias("rank"))), lambda x: x["rank"].isNotNull())
    docs = base.select(
        *others, "n_words", F.when(found, n).otherwise(0).cast("long").alias("n_base"), F.when(found, first).alias("first_word"),
        F.when(found, last).alias("last_word"), F.when(found, labels).otherwise(F.array().cast("array<string>")).alias("_base"),
        F.monotonically_increasing_id().alias("_row"), hits.alias("_hits"),
    )
    numbered = F.filter(F.transform("_hits", lambda x, k: F.struct(x["at"].alias("at"), x["rank"].alias("rank"), k.alias("k"))), lambda x: x["rank"].isin(rare) if rare else F.lit(False))
    near = F.transform(numbered, lambda x: F.struct(x["at"], x["rank"], F.slice("_hits", F.greatest(x["k"] + 1 - far, F.lit(1)), F.lit(2 * far + 1)).alias("near")))
    each = docs.withColumn("_p", F.explode_outer(near)).drop("_hits")
    joined = each.join(F.broadcast(table), F.col("_p.rank") == F.col("_rank"), "left")  # a few rows for each template
    step = F.floor(F.col("_p.at") / F.col("_size")).cast("int")
    joined = joined.withColumn("_w", F.explode_outer(F.when(step > 0, F.array(step - 1, step)).when(step == 0, F.array(step))))
    in_block = lambda x: (x["at"] >= F.col("_w") * F.col("_size")) & (x["at"] < (F.col("_w") + 2) * F.col("_size"))
    joined = joined.withColumn("_b", F.array_sort(F.array_distinct(F.transform(F.filter("_p.near", in_block), lambda x: x["rank"]))))
    place = F.array_position("_b", F.col("_rank")).cast("int") - 1
    fits = (F.size("_b") >= F.col("_least")) & (F.size("_b") - place >= F.col("_least")) & (F.size("_ranks") - F.col("_i") >= F.col("_least"))
    overlap = F.when(fits, F.size(F.array_intersect("_b", "_ranks"))).otherwise(0)
    joined = joined.select(*others, "n_words", "n_base", "first_word", "last_word", "_base", "_row", "_label", F.when(overlap >= F.col("_least"), overlap / F.size("_ranks")).alias("_c"))
    keep = [F.first(c).alias(c) for c in [*others, "n_words", "n_base", "first_word", "last_word", "_base"]]
    done = joined.groupBy("_row").agg(*keep, F.max("_c").alias("_score"), F.collect_set(F.when(F.col("_c").isNotNull(), F.col("_label"))).alias("_more"))
    out = done.select(
        *others, "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", "_more")), ",").alias("labels"), F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
    return out


def oracle() -> str:
    """DuckDB SQL for the registered query, by plain counting."""
    size = {p: len(p.split()) for p, _ in PHRASES}
    at = lambda p: " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split()))
    places = ", ".join(f"list_filter(range(0, greatest(len(w) - {size[p] - 1}, 0)), lambda i: {at(p)}) AS p{k}" for k, (p, _) in enumerate(PHRASES))
    every = "list_concat(list_concat(p0, p1), list_concat(p2, p3))"
    base = "list_filter([" + ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(PHRASES)) + "], lambda x: x IS NOT NULL)"
    rows = ", ".join(f"('{label}', {sorted(set(t.split()))!r}, {need(len(set(t.split())), THRESHOLD)}, {len(t.split())})" for label, t in TEMPLATES)
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH t(label, words, least, size) AS (VALUES {rows}),
    d AS (SELECT doc_id, regexp_extract_all({low}, '{WORD}') AS w FROM documents),
    b AS (SELECT doc_id, len(w) AS n_words, {places} FROM d),
    l AS (SELECT doc_id, label, words, least, size, w, unnest(range(0, len(w) // size + 1)) AS k FROM d, t),
    m AS (SELECT doc_id, label, max(c / n) AS c FROM (SELECT doc_id, label, least, len(words) AS n, len(list_intersect(list_distinct(w[k * size + 1 : (k + 2) * size]), words)) AS c FROM l)
          WHERE c >= least GROUP BY ALL),
    g AS (SELECT doc_id, list(label) AS more, max(c) AS score FROM m GROUP BY ALL)
    SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len({every}) AS BIGINT) AS n_base,
           CAST(list_min({every}) AS BIGINT) AS first_word, CAST(list_max({every}) AS BIGINT) AS last_word,
           array_to_string(list_sort({base}), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat({base}, coalesce(more, [])))), ',') AS labels,
           CAST(coalesce(score, 0) AS DOUBLE) AS score
    FROM b LEFT JOIN g USING (doc_id)"""
