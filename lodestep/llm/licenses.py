"""Licence scan by a positional index of the rarest licence words."""

from __future__ import annotations

import re
from functools import reduce
from math import log
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.text import ascii_terms
from lodestep.session import stored

# Phrases that give a label by themselves.
PHRASES = (("mit", "under the MIT License"), ("apache-2", "Apache License, Version 2"), ("cc-by-nc", "CC BY-NC"))

# Notices word for word as their licences print them, variants apart; each phrase in brackets is mandatory.
NOTICES = (
    ("mit", "Permission is hereby granted, [free of charge], to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software [without restriction], including without limitation the rights to"
            " use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the [Apache License, Version 2.0] (the \"License\"); you may not use this file except in compliance with"
                 " the License. You may obtain a copy of the License at"),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
              " the following conditions are met: Redistributions of source code must [retain the above copyright notice],"
              " this list of conditions and the following disclaimer"),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
              " the following conditions are met: 1. Redistributions of source code must [retain the above copyright notice],"
              " this list of conditions and the following disclaimer"),
    ("gpl-3", "This work is licensed under the [GNU General Public License, version 3]"),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the [GNU General Public License] as published"
              " by the Free Software Foundation, either [version 3] of the License, or (at your option) any later version"),
    ("gpl-2", "you can redistribute it and/or modify it under the terms of the [GNU General Public License] as published"
              " by the Free Software Foundation, either [version 2] of the License, or (at your option) any later version"),
    ("mpl-2", "This Source Code Form is subject to the terms of the [Mozilla Public License, v. 2.0]"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
            " hereby granted, provided that the above [copyright notice and this permission notice] appear in all copies"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is"
            " hereby granted, provided that the above [copyright notice and this permission notice] appear in all copies"),
    ("cc-by-nc", "This work is licensed under a Creative Commons [Attribution-NonCommercial] 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons [Attribution-ShareAlike] 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons [Attribution 4.0] International License"),
    ("unlicense", "This is free and unencumbered software [released into the public domain]"),
)

#: Least share of a notice's weight that must stand around one alignment.
MIN_SHARE = 0.6
#: A notice's words and further mandatory phrases may stand so many words before or after the alignment of its first mandatory phrase.
DRIFT = 8
#: Words of each phrase or notice that a text must have before its lists are intersected.
RARE = 2
POSTING = "template int, label string, phrase boolean, term string, offset int, mandatory int"


def postings(phrases=PHRASES, notices=NOTICES) -> list[tuple]:
    """``(template, label, phrase, term, offset, mandatory)`` for each word of the phrases and notices; ``mandatory`` numbers the
    template's mandatory phrases from 1, 0 for other words."""
    rows = []
    for template, (label, text) in enumerate([*phrases, *notices]):
        phrase, inside, count, offset = template < len(phrases), False, 0, 0
        for token in re.findall(r"[\[\]]|[0-9A-Za-z]+", text):
            if token in "[]":
                inside = token == "["
                count += inside
                continue
            rows.append((template, label, phrase, token.lower(), offset, 1 if phrase else count if inside else 0))
            offset += 1
    return rows


def document_frequencies(docs: DataFrame, terms: list[str]) -> dict[str, int]:
    """In how many of ``docs`` each term stands, and their number under ``""``. The terms are the index's, a few hundred."""
    listed = F.array(*map(F.lit, sorted(set(terms))))
    seen = docs.select(F.array_intersect(listed, ascii_terms(F.col("text"))).alias("terms"))
    counts = seen.select(F.explode(F.concat("terms", F.array(F.lit("")))).alias("term")).groupBy("term").count()
    return {row["term"]: row["count"] for row in counts.collect()}


def weighted_index(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> list[tuple]:
    """The postings with an integer weight, 1000 * ln(1 + texts / texts with the term), and whether the term is one
    of the template's ``RARE`` rarest. Frequencies count all texts."""
    rows = postings(phrases, notices)
    found = document_frequencies(docs, [row[3] for row in rows])
    rare = {}
    for template in {row[0] for row in rows}:
        own = {row[3] for row in rows if row[0] == template and row[5]}
        rare[template] = sorted(own, key=lambda term: (found.get(term, 0), term))[:RARE]
    return [(*row, round(1000 * log(1 + found.get("", 0) / max(1, found.get(row[3], 0)))), row[3] in rare[row[0]])
            for row in rows]


def license_scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per row: ``doc_id, text_hash, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    A phrase stands where all its words stand consecutively; ``n_base`` counts these places, whose smallest and
    largest starts are ``first_word`` and ``last_word``, words from 0. A notice is found where its first
    mandatory phrase stands, the others stand too, and words worth ``min_share`` of its weight, each phrase and word at an
    alignment at most ``DRIFT`` words off, so words put in or left out between them do no harm. ``score`` is the
    largest share of a label found, 1 for phrases, 0 without labels. Labels are distinct, sorted and comma-joined.

    A text is looked up for a template only if it has the template's rarest mandatory words, which any match
    needs. The positions of its licence words, less their offsets in the template, then meet by alignment. Null texts
    have no words; repeated rows get the same result; other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    index = weighted_index(docs, phrases, notices)
    schema = POSTING + ", weight long, rare boolean"
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), ascii_terms(F.col("text")).alias("terms"))
    wanted = [F.when(F.array_size(F.array_intersect(F.array(*map(F.lit, rare)), F.col("terms"))) == len(rare), F.lit(template))
              for template in sorted({row[0] for row in index})
              if (rare := sorted({row[3] for row in index if row[0] == template and row[7]}))]
    # One test per text for any licence word spares most texts the tests per template.
    listed = F.array(*map(F.lit, sorted({row[3] for row in index if row[7]})))
    sifted = rows.withColumn("templates", F.when(F.arrays_overlap("terms", listed), F.array_compact(F.array(*wanted))))
    sized = sifted.select("doc_id", "text_hash", F.size("terms").cast("long").alias("n_words"),
                          F.when(F.size("templates") > 0, F.col("terms")).alias("terms"), "templates")
    table = spark.createDataFrame(index, schema)
    totals = table.groupBy("template").agg(F.sum("weight").alias("worth"), F.max("mandatory").alias("must"))
    lengths = table.where("mandatory > 0").groupBy("template", "mandatory").agg(F.count("*").alias("length"))
    flat = sized.where(F.col("templates").isNotNull() & F.col("terms").isNotNull()).select(
        "doc_id", "text_hash", "templates", F.posexplode_outer("terms").alias("at", "term"))
    # Used three times below; stored, so that texts are cut into words once.
    hits = stored(flat.join(F.broadcast(table), "term").where(F.array_contains("templates", F.col("template"))).select(
        "doc_id", "text_hash", "template", "label", "phrase", (F.col("at") - F.col("offset")).alias("start"),
        "offset", "mandatory", "weight").distinct(), "hits")
    key = ["doc_id", "text_hash"]
    at = [*key, "template", "label", "phrase"]
    # Each mandatory phrase by itself: all its words at one alignment.
    whole = hits.where("mandatory > 0").groupBy(*at, "mandatory", "start").agg(F.count("*").alias("n")).join(
        F.broadcast(lengths), ["template", "mandatory"]).where("n = length").drop("n", "length")
    bases = whole.where("phrase").select(*at, "start", F.lit(1.0).alias("share"))
    # Alignments are dealt to bins of DRIFT words, so a first phrase meets only those of its own and the two next to it.
    own_bin = F.floor(F.col("start") / DRIFT)
    firsts = whole.where("not phrase and mandatory = 1").select(
        *at, F.col("start").alias("first"), F.explode(F.array(own_bin - 1, own_bin, own_bin + 1)).alias("bin"))
    near = F.abs(F.col("start") - F.col("first")) <= DRIFT
    parts = whole.where("not phrase").select(*at, "start", (-F.col("mandatory")).alias("part"), F.lit(0).cast("long").alias("weight")).union(
        hits.where("not phrase").select(*at, "start", F.col("offset").alias("part"), "weight")).withColumn("bin", own_bin)
    # The hash of a null text is a number, but an id may be null.
    same_at = [parts[name].eqNullSafe(firsts[name]) if name == "doc_id" else parts[name] == firsts[name] for name in [*key, "template", "bin"]]
    gathered = firsts.join(parts, reduce(and_, same_at) & near).select(
        *(firsts[name] for name in at), "first", "part", "weight").distinct()
    notices_found = gathered.groupBy(*at, "first").agg(
        F.sum("weight").alias("weight"), F.count(F.when(F.col("part") < 0, 1)).alias("n_must")).join(F.broadcast(totals), "template").where(
        F.col("n_must") == F.col("must")).select(*at, F.col("first").alias("start"), (F.col("weight") / F.col("worth")).alias("share")).where(
        F.col("share") >= min_share)
    aligned = bases.union(notices_found)
    # Two phrases of one label may start at one place; a place of a label counts once per phrase.
    found = aligned.groupBy(*key).agg(
        F.count(F.when(F.col("phrase"), 1)).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
    ).select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "n_base", "first_word", "last_word",
             "base_labels", "labels", "score")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    return sized.select(*key, "n_words").join(found, same, "left").select(
        *key, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
