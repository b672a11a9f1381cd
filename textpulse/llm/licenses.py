"""License scans by diagonal voting, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import table

# The phrases that are always reported, with their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Opening words of public licenses and of their usual file notices.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2  # words of a gram
DRIFT = 6  # diagonals of one span: so many words may be put in or left out
COVERED = 0.75  # share of a notice's grams that a span must have in place, in order


def with_words(df: DataFrame) -> DataFrame:
    """``df`` with w, the words of its text in order, A-Z lower-cased, and their number n_words.

    Null and empty texts have none. ``lower`` also maps other letters, but never one of them to or
    from a separator.
    """
    parts = F.col("parts")
    # Only the ends can be empty. The split is a column of its own so that it runs once.
    head = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(parts) > 1) & (F.get(parts, F.size(parts) - 1) == ""), 1).otherwise(0)
    split = df.withColumn("parts", F.split(F.lower(F.coalesce("text", F.lit(""))), SEPARATORS))
    return split.withColumn("w", F.slice(parts, head + 1, F.size(parts) - head - tail)).withColumn("n_words", F.size("w").cast("long"))


def _grams(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, position, gram hash and gram words of every rolling gram; texts without one keep a row."""
    shifted = [F.when(F.size("w") > k, F.slice("w", k + 1, F.size("w") - k)).otherwise(F.array().cast("array<string>")).alias(f"w{k}")
               for k in range(GRAM)]
    rows = df.select(*keep, F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "gram"))
    complete = F.col("pos") <= F.col("n_words") - GRAM
    gram = [F.col(f"gram.w{k}") for k in range(GRAM)]
    return rows.select(*keep, "pos", F.when(complete, F.xxhash64(*gram)).alias("hash"), F.col("gram"))


def _values(phrases, notices) -> str:
    rows = [(i, label, i < len(phrases), text) for i, (label, text) in enumerate([*phrases, *notices])]
    return ", ".join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, label, base, text in rows)


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Gram positions of all templates: a table of fixed size."""
    given = spark.sql(f"SELECT * FROM VALUES {_values(phrases, notices)} AS given(template, label, base, text)")
    grams = _grams(with_words(given), ["template", "label", "base", "n_words"]).filter("hash IS NOT NULL")
    return grams.select("template", "label", "base", (F.col("n_words") - (GRAM - 1)).alias("n_grams"), F.col("pos").alias("at"),
                        F.col("hash").alias("template_hash"), F.col("gram").alias("template_gram"))


def votes(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """Matching grams per document row, template and diagonal, with their places in the template.

    A document without a match keeps a row without a template.

    A gram at word p of a text and at place q of a template votes for the diagonal p - q. The
    counts are combined in the map tasks, so what is moved is a row per document and diagonal hit.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    grams = _grams(with_words(rows), ["row", "doc_id", "n_words"])
    met = grams.join(F.broadcast(patterns), (F.col("hash") == F.col("template_hash")) & (F.col("gram") == F.col("template_gram")), "left")
    return (met.groupBy("row", "doc_id", "n_words", "template", "label", "base", "n_grams", (F.col("pos") - F.col("at")).alias("diagonal"))
            .agg(F.count("at").alias("votes"), F.collect_list("at").alias("places")))


def _in_order(diagonals: str) -> Column:
    """How many places of a template some diagonals hold in order: text and template both go forward.

    A fold over the matches by their word in the text. Element k of the state is the least place at
    which k + 1 matches in order can end, so its size is the most that can be in order. A place counts
    once, however often its words stand in the text.
    """
    matches = F.flatten(F.transform(diagonals, lambda d: F.transform(
        d["places"], lambda at: F.struct((d["diagonal"] + at).alias("word"), (-at).alias("back")))))

    def step(ends, match):
        at = -match["back"]
        before = F.size(F.filter(ends, lambda end: end < at))
        return F.concat(F.slice(ends, 1, before), F.array(at), F.slice(ends, before + 2, F.greatest(F.size(ends) - before - 1, F.lit(0))))

    return F.size(F.aggregate(F.array_sort(matches), F.array().cast("array<int>"), step))


def spans(voted: DataFrame) -> DataFrame:
    """``voted`` with coverage and verified: what a span that begins with the diagonal holds of its template.

    A base phrase holds on one diagonal with all its grams. Of other templates, a diagonal and those
    at most ``DRIFT`` behind it form a span; where their votes suffice, the template's grams that stand
    in it in order are counted, each once. ``COVERED`` of them verify it. Documents without a vote
    keep their row.
    """
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(0, DRIFT)
    needed = F.col("n_grams") * COVERED
    enough = ~F.col("base") & (F.sum("votes").over(near) >= needed)
    own = F.struct("diagonal", "places")
    # Only few spans have the votes: the others collect nothing.
    reached = voted.withColumn("enough", enough).withColumn("diagonals", F.collect_list(F.when(~F.col("base"), own)).over(near))
    held = F.when(F.col("enough"), _in_order("diagonals")).otherwise(0)
    return (reached.withColumn("held", held).drop("diagonals", "places")
            .withColumn("verified", F.when(F.col("base"), F.col("votes") == F.col("n_grams")).otherwise(F.col("held") >= needed))
            .withColumn("coverage", F.col("held") / F.col("n_grams")))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per document row: what the voting found.

    n_words; n_base, first_word and last_word: number, least and greatest start of base phrases;
    base_labels, labels: distinct, sorted, comma-joined, empty if none; score: 1 with a base phrase,
    else the greatest share of a notice that a verified span has in place, 0 without one.

    Null and empty texts have no words and no labels; repeated rows and null ids keep a row each;
    an empty table gives an empty one.
    """
    found = spans(votes(docs, templates(docs.sparkSession, phrases, notices)))
    base, noted = F.col("base") & F.col("verified"), ~F.col("base") & F.col("verified")
    share = F.when(base, 1.0).when(noted, F.col("coverage"))
    joined = lambda met: F.array_join(F.array_sort(F.collect_set(F.when(met, F.col("label")))), ",")
    return (found.groupBy("row", "doc_id", "n_words")
            .agg(F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
                 F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"), joined(base).alias("base_labels"),
                 joined(base | noted).alias("labels"),
                 F.round(F.coalesce(F.max(share), F.lit(0.0)), 6).alias("score"))
            .drop("row"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(range(len(w) - 1)) AS p, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM words WHERE len(w) > 1),
given(template, label, base, text) AS (VALUES {_values(PHRASES, NOTICES)}),
patterns AS (
  SELECT template, label, base, len(w) - 1 AS n_grams, unnest(range(len(w) - 1)) AS q, unnest(w[:-2]) AS a, unnest(w[2:]) AS b
  FROM (SELECT *, string_split(text, ' ') AS w FROM given)),
voted AS (
  SELECT doc_id, template, label, base, n_grams, p - q AS diagonal, count(*) AS votes, list(q) AS places
  FROM grams JOIN patterns USING (a, b) GROUP BY ALL),
reached AS (
  SELECT *, sum(votes) OVER (PARTITION BY doc_id, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {DRIFT} FOLLOWING) AS reach FROM voted),
matched AS (
  SELECT a.doc_id, a.template, a.diagonal, list([q] ORDER BY b.diagonal + q, -q) AS matches
  FROM reached a JOIN (SELECT doc_id, template, diagonal, unnest(places) AS q FROM voted) b
    ON a.doc_id = b.doc_id AND a.template = b.template AND b.diagonal BETWEEN a.diagonal AND a.diagonal + {DRIFT}
  WHERE NOT a.base AND a.reach >= {COVERED} * a.n_grams GROUP BY a.doc_id, a.template, a.diagonal),
placed AS (
  SELECT doc_id, template, diagonal, len(list_reduce(list_prepend([]::BIGINT[], matches), lambda ends, x:
    list_concat(list_concat(ends[:len(list_filter(ends, lambda e: e < x[1]))], x), ends[len(list_filter(ends, lambda e: e < x[1])) + 2:]))) AS held
  FROM matched),
judged AS (
  SELECT v.*, base AND votes = n_grams AS met, NOT base AND coalesce(held, 0) >= {COVERED} * n_grams AS noted,
    coalesce(held, 0)::DOUBLE / n_grams AS coverage, diagonal AS start
  FROM voted v LEFT JOIN placed USING (doc_id, template, diagonal))
SELECT doc_id, len(w)::BIGINT AS n_words, count(*) FILTER (met) AS n_base, min(start) FILTER (met) AS first_word,
  max(start) FILTER (met) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (met), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (met OR noted), '') AS labels,
  round(coalesce(max(CASE WHEN met THEN 1.0::DOUBLE WHEN noted THEN coverage END), 0), 6) AS score
FROM words LEFT JOIN judged USING (doc_id) GROUP BY doc_id, w
"""
