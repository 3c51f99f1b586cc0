"""Licence scan with a positional index of rare tokens, in DataFrame operations only.

Templates are short notices. Their words with the highest inverse template
frequency are indexed with their positions. Each such word of a file votes
for (template, file position - template position); a template is found where
enough of its rare words agree on one offset and each of its mandatory
phrases stands in the file.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Separators and base phrases of the scan.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, notice, mandatory phrases.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2 0",)),
    ("mit", "released under the mit license permission is hereby granted free of charge to any person obtaining a copy of this software", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "without restriction")),
    ("gpl-2.0", "gnu general public license version 2 as published by the free software foundation", ("gnu general public license", "version 2")),
    ("gpl-3.0", "gnu general public license version 3 as published by the free software foundation", ("gnu general public license", "version 3")),
    ("lgpl", "gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl-3.0", "gnu affero general public license as published by the free software foundation version 3", ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd", "licensed under the bsd 3 clause license", ("bsd 3 clause",)),
    ("bsd", "licensed under the bsd 2 clause license", ("bsd 2 clause",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("epl-2.0", "eclipse public license v 2 0", ("eclipse public license",)),
)
#: Index words stand in at most this many templates; a template needs this many of them, or all it has, at one offset.
MAX_TEMPLATES, MIN_AGREEING = 5, 2
#: Any base phrase, and one mandatory phrase of any template, needs one of these.
TRIGGER = r"(?i)licen[sc]|permission|redistribut|unencumbered|creative|bsd|cc0|cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by|without[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+fee"


def _index() -> tuple[list[tuple[str, int, int, float]], list[tuple[int, str, int, float]]]:
    """Postings (word, template, position, idf), and per template (number, label, least agreeing words, idf sum)."""
    words = [t[1].split() for t in TEMPLATES]
    df = Counter(w for t in words for w in set(t))
    idf = {w: math.log(1 + len(words) / n) for w, n in df.items()}
    postings = [(w, k, i, idf[w]) for k, t in enumerate(words) for i, w in enumerate(t) if df[w] <= MAX_TEMPLATES]
    per = Counter(k for _, k, _, _ in postings)
    sums = Counter()
    for _, k, _, x in postings:
        sums[k] += x
    return postings, [(k, t[0], min(MIN_AGREEING, per[k]), sums[k]) for k, t in enumerate(TEMPLATES)]


def _row_key() -> Column:
    """A digest of a row's id and text; rows that agree in both share it."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("|"), "text"))


def _stands(joined: Column, phrase: str) -> Column:
    return F.instr(joined, F.lit(f" {phrase} ")) > 0


def _places(words: Column, phrase: str) -> Column:
    first, *rest = phrase.split()
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)))

    def here(i: Column) -> Column:
        found = F.get(words, i) == first
        for k, w in enumerate(rest, 1):
            found = found & (F.get(words, i + k) == w)
        return F.coalesce(found, F.lit(False))

    return F.filter(starts, here)


def _matches(candidates: DataFrame, spark: SparkSession) -> DataFrame:
    """Labels and score of each candidate key from the positional index."""
    postings, templates = _index()
    index = spark.createDataFrame(postings, "word string, template int, at int, idf double")
    per = spark.createDataFrame(templates, "template int, label string, least int, mass double")
    vocabulary = sorted({p[0] for p in postings})
    spots = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("i"))), lambda x: x["word"].isin(vocabulary))
    hits = candidates.select("key", F.explode(spots).alias("s")).select("key", "s.word", "s.i")
    votes = hits.join(F.broadcast(index), "word").groupBy("key", "template", (F.col("i") - F.col("at")).alias("offset")).agg(F.count(F.lit(1)).alias("agree"), F.sum("idf").alias("found"))
    best = votes.join(F.broadcast(per), "template").where("agree >= least").groupBy("key").agg(F.collect_list(F.struct("template", (F.col("found") / F.col("mass")).alias("share"))).alias("shares"))
    phrases = F.array(*(F.when(F.reduce(F.array(*(_stands(F.col("joined"), p) for p in t[2])), F.lit(True), lambda a, b: a & b), F.lit(k)) for k, t in enumerate(TEMPLATES)))
    verified = candidates.select("key", F.filter(phrases, lambda x: x.isNotNull()).alias("verified"))
    labels = F.create_map(*[F.lit(x) for k, t in enumerate(TEMPLATES) for x in (k, t[0])])
    ok = best.join(verified, "key").withColumn("shares", F.filter("shares", lambda s: F.array_contains("verified", s["template"])))
    return ok.where(F.size("shares") > 0).select("key", F.transform("shares", lambda s: labels[s["template"]]).alias("found_labels"), F.least(F.lit(1.0), F.array_max(F.transform("shares", lambda s: s["share"]))).alias("found_score"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence phrases and notices of every document.

    Returns one row per input row: doc_id, n_words, n_base (places of base
    phrases), first_word and last_word (their smallest and largest start),
    base_labels, labels (with those of the index) and score (largest verified
    share of a template's rare words, weighted by idf; 0 if none).

    Null texts count as empty. Repeated rows and null ids are scanned like any
    other; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    plain = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.when(F.col("text").rlike(TRIGGER), F.regexp_extract_all(F.translate("text", upper, upper.lower()), F.lit(f"([^{SEPARATORS}]+)"), 1))
    base = base.select("doc_id", "text", F.regexp_count("text", F.lit(f"[^{plain}]+")).cast("long").alias("n_words"), words.alias("words"), F.when(F.col("text").rlike(TRIGGER), _row_key()).alias("key0"))
    base = base.withColumn("key", F.coalesce("key0", _row_key()))
    candidates = base.where("key0 is not null").select("key", "words").dropDuplicates(["key"]).withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    found = _matches(candidates, spark)
    places = {label: _places(F.col("words"), phrase) for phrase, label in BASE_PHRASES.items()}
    every = F.concat(*places.values())
    names = F.filter(F.array(*(F.when(F.size(p) > 0, F.lit(label)) for label, p in places.items())), lambda x: x.isNotNull())
    scanned = base.select("doc_id", "n_words", "key", F.when(F.col("words").isNotNull(), every).alias("places"), F.when(F.col("words").isNotNull(), names).alias("base_names"))
    none = F.array().cast("array<string>")
    text_of = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    joined = scanned.join(found, "key", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size(F.coalesce("places", F.array().cast("array<int>"))), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        text_of(F.coalesce("base_names", none)).alias("base_labels"),
        text_of(F.concat(F.coalesce("base_names", none), F.coalesce("found_labels", none))).alias("labels"),
        F.coalesce("found_score", F.lit(0.0)).alias("score"),
    )
