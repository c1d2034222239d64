"""Licence notices in texts, found by a positional index of rare words; DataFrame functions only.

Every template is a phrase that must be there and, for longer notices, words that usually follow. Document frequencies over the
whole corpus tell which of a phrase's words are rarest; these are its index entries (word, template, place in the phrase). A
document's words that are entries give (template, start) postings; only starts that all entries of a template agree on are
verified, word by word, against the phrase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postweave.llm.common import ALNUM, lower_ascii
from postweave.session import pin

# Fixed values: (label, phrase that must be there, words that follow it in the full notice). The first three are the base.
BASE = (("mit", "mit license", ""), ("apache", "apache license", ""), ("gpl", "general public license", ""))
TEMPLATES = BASE + (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "and associated documentation files the software to deal in the software without restriction"),
    ("mit", "license identifier mit", ""),
    ("apache", "licensed under the apache license version 2 0", "the license you may not use this file except in compliance with the license"),
    ("apache", "license identifier apache 2 0", ""),
    ("gpl", "gnu general public license", "as published by the free software foundation"),
    ("gpl", "license identifier gpl", ""),
    ("lgpl", "gnu lesser general public license", "as published by the free software foundation"),
    ("lgpl", "license identifier lgpl", ""),
    ("agpl", "gnu affero general public license", "as published by the free software foundation"),
    ("agpl", "license identifier agpl", ""),
    ("bsd", "redistribution and use in source and binary forms", "with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "bsd license", ""),
    ("bsd", "license identifier bsd", ""),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ""),
    ("mpl", "mozilla public license", ""),
    ("mpl", "license identifier mpl", ""),
    ("epl", "eclipse public license", ""),
    ("unlicense", "this is free and unencumbered software released into the public domain", ""),
    ("cc0", "cc0 1 0 universal", ""),
    ("cc-by", "licensed under cc by 4 0", ""),
    ("cc-by", "creative commons attribution 4 0 international license", ""),
    ("cc-by-sa", "cc by sa", ""),
    ("cc-by-sa", "creative commons attribution sharealike", ""),
    ("cc-by-nc", "cc by nc", ""),
    ("cc-by-nc", "creative commons attribution noncommercial", ""),
    ("cc-by-nd", "cc by nd", ""),
    ("cc-by-nd", "creative commons attribution noderivatives", ""),
)
# Words too common to be entries.
COMMON = frozenset("a and any by copy for free in is of or the this to use with without 0 1 2 4".split())
ENTRIES = 3


def _phrase_words() -> list[str]:
    return sorted({w for _, must, _ in TEMPLATES for w in must.split()} - COMMON)


def words(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case."""
    # lower() is faster than the translation; the Kelvin sign is the one letter that it makes an ASCII word letter.
    low = F.when(F.coalesce(text, F.lit("")).contains("\u212a"), lower_ascii(text)).otherwise(F.lower(F.coalesce(text, F.lit(""))))
    return F.regexp_extract_all(low, F.lit(ALNUM), F.lit(0))


def _hits(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, pos, word) wherever a phrase word that may be an entry stands; repeated rows once."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("tkey"), F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return rows.where(F.col("word").isin(_phrase_words())).distinct()


def _entries(hits: DataFrame) -> list[tuple[str, int, int, int]]:
    """(word, template, place, entries of the template): the rarest words of each phrase over all documents."""
    counted = hits.select("doc_id", "tkey", "word").distinct().groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}  # a row per phrase word at most
    out = []
    for t, (_, must, _) in enumerate(TEMPLATES):
        places = [(frequency.get(w, 0), p, w) for p, w in enumerate(must.split()) if w not in COMMON]
        rarest = sorted(places)[:ENTRIES]
        out += [(w, t, p, len(rarest)) for _, p, w in rarest]
    return out


def _literal(rows: list[list[str]]) -> Column:
    return F.array(*[F.array(*map(F.lit, r)) if r else F.array().cast("array<string>") for r in rows])


def _verified(docs: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """(doc_id, tkey, found: template, at, share) of the starts whose phrase is there in full."""
    per = pin(starts.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("template", "at")).alias("starts")))
    per = per.select(F.col("doc_id").alias("s_doc_id"), F.col("tkey").alias("s_tkey"), "starts")
    per = F.broadcast(per) if per.count() <= most else per
    rows = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").join(
        per, F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & F.col("tkey").eqNullSafe(F.col("s_tkey"))
    )
    rows = rows.select("doc_id", "tkey", "starts", words(F.col("text")).alias("words"))
    musts, wholes = [m.split() for _, m, _ in TEMPLATES], [(m + " " + r).split() for _, m, r in TEMPLATES]

    def of(m: Column) -> Column:
        must, whole = F.element_at(_literal(musts), m["template"] + 1), F.element_at(_literal(wholes), m["template"] + 1)
        there = F.slice("words", m["at"] + 1, F.size(must)) == must
        held = F.zip_with(whole, F.slice("words", m["at"] + 1, F.size(whole)), lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))
        share = F.aggregate(held, F.lit(0), lambda s, x: s + x) / F.size(whole)
        return F.struct(m["template"].alias("template"), m["at"].alias("at"), F.when(there, share).alias("share"))

    found = F.filter(F.transform("starts", of), lambda m: m["share"].isNotNull())
    return rows.select("doc_id", "tkey", found.alias("found")).dropDuplicates(["doc_id", "tkey"])


def license_scan(docs: DataFrame, most: int = 200_000) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found.

    n_base counts the places of the base phrases, first_word and last_word are the first and last of them (words from 0).
    labels adds those of the other templates. score is the best share of a found notice's words; 0 without one. found lists
    (template, at, share). Null texts have no words. Repeated rows get equal results. Up to `most` documents with candidates are
    sent to all tasks for verification, more are joined by shuffles. Other columns are not read.
    """
    hits = pin(_hits(docs))
    spark = docs.sparkSession
    index = spark.createDataFrame(_entries(hits), "word string, template int, place int, entries int")
    starts = (
        hits.join(F.broadcast(index), "word")
        .groupBy("doc_id", "tkey", "template", (F.col("pos") - F.col("place")).alias("at"))
        .agg(F.count("*").alias("met"), F.max("entries").alias("entries"))
        .where((F.col("met") == F.col("entries")) & (F.col("at") >= 0))
        .select("doc_id", "tkey", "template", "at")
    )
    found = pin(_verified(docs, starts, most)).select(F.col("doc_id").alias("f_doc_id"), F.col("tkey").alias("f_tkey"), "found")
    found = F.broadcast(found) if found.count() <= most else found
    counted = docs.select("doc_id", F.xxhash64("text").alias("tkey"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"))
    rows = counted.join(found, F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & F.col("tkey").eqNullSafe(F.col("f_tkey")), "left")
    found = F.coalesce("found", F.array().cast("array<struct<template:int,at:int,share:double>>"))
    rows = rows.select("doc_id", "n_words", found.alias("found"))
    base = F.filter("found", lambda m: m["template"] < len(BASE))
    places = F.transform(base, lambda m: m["at"].cast("long"))
    label = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: F.element_at(F.array(*[F.lit(t[0]) for t in TEMPLATES]), m["template"] + 1)))), ",")
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        label(base).alias("base_labels"), label(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["share"])), F.lit(0.0)).alias("score"), "found",
    )
