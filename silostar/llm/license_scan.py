"""License texts by diagonal voting.

Every rolling word k-gram of every text is hashed and joined to the positions at which the
templates have it. A match votes for its diagonal (position in the text less position in the
template). Within stretches of the text a few times as long as the template, diagonals that
lie close together are merged, as a changed word shifts what follows, wherever in the stretch
their votes lie; a merged alignment counts if enough of the template's k-grams stand in it one
after the other. DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silostar.llm.common import stored

# The phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Public notices that licenses ask to be kept with the work.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "mit-notice": "released under the mit license",
    "apache-notice": "licensed under the apache license version 2 0",
    "cc-by-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file "
    "except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
    "copy of the mpl was not distributed with this file you can obtain one at",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this permission "
    "notice appear in all copies",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
K = 3
# Diagonals at most this far apart are one alignment.
SHIFT = 3
# The least part of a template's k-grams that a span must hold.
COVERAGE = 0.6
# A list of templates is broadcast up to so many k-grams; a table of templates is joined as
# its size allows.
MAX_GRAMS = 1_000_000
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


# The one letter beyond ASCII whose lower case is in ASCII, and a letter to stand for it.
_KELVIN, _KRA = "\u212a", "\u0138"


def words_line(text: Column) -> Column:
    """The words of a text, each followed by one space, in lower case. Other letters than A-Z
    change too, but none of them becomes one of a-z."""
    line = F.concat(F.regexp_replace(text, _BREAKS, " "), F.lit(" "))
    line = F.replace(F.ltrim(line), F.lit(_KELVIN), F.lit(_KRA))
    return F.regexp_replace(F.lower(line), " +$", " ")


def _spaces(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))


def phrase_places(line: Column, phrases=PHRASES) -> Column:
    """Places of the phrases in a line of words: array of (word, label).

    The line is cut in front of every place; the words of the parts before it are its
    position. Lines without a phrase are not cut.
    """
    one = "(?:" + "|".join(re.escape(p) for p in phrases) + ") "
    parts = F.split(line, f"(?<= )(?={one})|^(?={one})", -1)

    def step(done: Column, part: Column) -> Column:
        label = F.lit(None).cast("string")
        for phrase, name in phrases.items():
            label = F.when(part.startswith(phrase + " "), F.lit(name)).otherwise(label)
        place = F.struct(done["at"].alias("word"), label.alias("label"))
        return F.struct(
            (done["at"] + _spaces(part)).alias("at"),
            F.when(label.isNull(), done["places"])
            .otherwise(F.concat(done["places"], F.array(place)))
            .alias("places"),
        )

    kind = "array<struct<word:int,label:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("places"))
    # Of the words that every phrase ends in, one must be there before the parts are cut.
    ends = {p.rsplit(" ", 1)[1] for p in phrases}
    may = F.lit(False)
    for end in sorted(ends):
        may = may | F.contains(line, F.lit(f" {end} "))
    return F.when(may, F.aggregate(parts, zero, step)["places"]).otherwise(F.array().cast(kind))


def _grams(words: Column, k: int) -> Column:
    """The hashes of the word k-grams of an array of at least ``k`` words."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(words, i + j) for j in range(k)))),
    )


def template_grams(spark, templates=TEMPLATES, k: int = K) -> DataFrame:
    """gram (hash), template, at, n_grams: one row per template position. ``templates`` maps
    names to texts, or is a table (name, text) of any size. Templates of fewer than ``k``
    words have no k-gram."""
    if isinstance(templates, DataFrame):
        named, small = templates.select(F.col("name").alias("template"), F.col("text").alias("text")), False
    else:
        count = sum(max(0, len(t.split()) - k + 1) for t in templates.values())
        if count > MAX_GRAMS:
            raise ValueError("too many template k-grams to broadcast; pass the templates as a table")
        named, small = spark.createDataFrame(list(templates.items()), "template string, text string"), True
    words = F.split(F.trim(words_line(F.coalesce("text", F.lit("")))), " ")
    grams = (
        named.select("template", words.alias("words")).filter(F.size("words") >= k)
        .select("template", (F.size("words") - k + 1).alias("n_grams"), F.posexplode(_grams(F.col("words"), k)).alias("at", "gram"))
        .select("gram", "template", "at", "n_grams")
    )
    return F.broadcast(grams) if small else stored(grams, "template-grams")


def votes(lines: DataFrame, templates: DataFrame, k: int = K) -> DataFrame:
    """key, line_hash, template, n_grams, at, word: a row per k-gram that meets a template."""
    words = F.split(F.rtrim("line"), " ")
    grams = _grams(F.col("words"), k)
    return (
        lines.filter(F.col("n_words") >= k)
        .select("key", "line_hash", words.alias("words"))
        .select("key", "line_hash", F.posexplode(grams).alias("word", "gram"))
        .join(templates, "gram")
        .select("key", "line_hash", "template", "n_grams", "at", "word")
    )


_TEXT = ("key", "line_hash", "template", "n_grams")


def _in_order(votes_: Column, longest: Column) -> Column:
    """The longest chain of votes (word, at) that ascend in both: struct of its length, first
    and last word, over less than ``longest`` words.

    The votes come by word. First a chain is kept per length, with the least position that it
    can end at; if the longest one stretches too far, all chains are compared.
    """
    kind = "array<struct<at:int,first:int,last:int>>"
    none = F.array().cast(kind)

    def step(ends: Column, vote: Column) -> Column:
        shorter = F.size(F.filter(ends, lambda e: e["at"] < vote["at"]))
        first = F.when(shorter == 0, vote["word"]).otherwise(F.get(ends, shorter - 1)["first"])
        end = F.struct(vote["at"].alias("at"), first.alias("first"), vote["word"].alias("last"))
        longer = F.slice(ends, shorter + 2, F.size(ends))
        return F.concat(F.slice(ends, F.lit(1), shorter), F.array(end), longer)

    # Votes of one word: the highest position first, so that a chain takes one of them.
    ordered = F.transform(
        F.array_sort(F.transform(votes_, lambda v: F.struct(v["word"].alias("word"), (-v["at"]).alias("back")))),
        lambda v: F.struct(v["word"].alias("word"), (-v["back"]).alias("at")),
    )
    ends = F.aggregate(ordered, none, step)
    best = F.element_at(ends, -1)
    quick = F.struct(F.size(ends).alias("n"), best["first"].alias("first"), best["last"].alias("last"))

    chains = "array<struct<n:int,first:int,at:int,last:int>>"

    def grow(found: Column, vote: Column) -> Column:
        fits = F.filter(
            found,
            lambda c: (c["at"] < vote["at"]) & (c["last"] < vote["word"]) & (vote["word"] - c["first"] < longest),
        )
        before = F.array_max(fits)  # the longest; of these the one that starts last
        chain = F.struct(
            (F.coalesce(before["n"], F.lit(0)) + 1).alias("n"), F.coalesce(before["first"], vote["word"]).alias("first"),
            vote["at"].alias("at"), vote["word"].alias("last"),
        )
        return F.concat(found, F.array(chain))

    slow = F.array_max(F.aggregate(ordered, F.array().cast(chains), grow))
    return F.when(best["last"] - best["first"] < longest, quick).otherwise(
        F.struct(slow["n"].alias("n"), slow["first"].alias("first"), slow["last"].alias("last"))
    )


def spans(found: DataFrame, shift: int = SHIFT, coverage: float = COVERAGE) -> DataFrame:
    """key, line_hash, template, first, last, score of every verified alignment.

    A text is cut into stretches of four times the template's k-grams, each of which overlaps
    the next by half, so that an alignment of less than twice the template lies in one of them,
    and no group is larger than a stretch. Votes are counted per stretch and diagonal;
    diagonals that are at most ``shift`` apart form an alignment, whatever else is voted for
    between them in the text. It is verified by the template's k-grams that follow each other
    in it. An alignment inside another one of the same template is left out.
    """
    stretch = F.floor(F.col("word") / (2 * F.col("n_grams"))).cast("int")
    placed = found.select(
        *_TEXT, "at", "word", (F.col("word") - F.col("at")).alias("diagonal"),
        F.explode(F.array_compact(F.array(stretch, F.when(stretch > 0, stretch - 1)))).alias("stretch"),
    )
    group = [*_TEXT, "stretch"]
    diagonals = placed.groupBy(*group, "diagonal").agg(F.collect_set(F.struct("word", "at")).alias("votes"))
    by_diagonal = Window.partitionBy(*group).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    merged = (
        diagonals.withColumn("run", F.sum(F.coalesce((gap > shift).cast("int"), F.lit(0))).over(by_diagonal))
        .groupBy(*group, "run")
        .agg(F.flatten(F.collect_list("votes")).alias("votes"))
        .filter(F.size(F.array_distinct("votes.at")) >= coverage * F.col("n_grams"))
    )
    chain = _in_order(F.col("votes"), 2 * F.col("n_grams"))
    verified = (
        merged.select(*_TEXT, chain.alias("chain"))
        .select(*_TEXT, "chain.first", "chain.last", (F.col("chain.n") / F.col("n_grams")).alias("score"))
        .filter(F.col("score") >= coverage)
    )
    in_text = Window.partitionBy(*_TEXT).orderBy("first", F.desc("last"), F.desc("score"))
    reached = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    return (
        verified.withColumn("reached", reached)
        .filter(F.col("reached").isNull() | (F.col("reached") < F.col("last")))
        .select("key", "line_hash", "template", "first", "last", "score")
    )


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES,
    k: int = K,
) -> DataFrame:
    """One row per row of ``df``: key, n_words, places of the phrases (word, label), and
    verified template spans (label, first, last, score).

    ``templates`` maps names to texts, or is a table (name, text). Null texts are empty. Rows
    that agree in key and words have the same spans; null keys are a key of their own. Only
    the key and the text are read, so other columns may have any name. A template's label is
    its name up to ``-notice``.
    """
    line = words_line(F.coalesce(F.col(text), F.lit("")))
    lines = df.select(F.col(key).alias("key"), line.alias("line")).select(
        "key", "line", F.xxhash64("line").alias("line_hash"),
        F.when(F.col("line") == " ", 0).otherwise(_spaces(F.col("line"))).cast("long").alias("n_words"),
    )
    lines = lines.withColumn("line", F.when(F.col("n_words") == 0, F.lit("")).otherwise(F.col("line")))
    met = votes(lines, template_grams(df.sparkSession, templates, k), k)
    found = stored(spans(met.distinct()), "license-spans")
    label = F.regexp_replace("template", "-notice$", "")
    per_text = found.groupBy("key", "line_hash").agg(
        F.array_sort(F.collect_list(F.struct("first", "last", label.alias("label"), "score"))).alias("spans")
    )
    kind = per_text.schema["spans"].dataType.simpleString()
    a = lines.select("key", "line_hash", "n_words", phrase_places(F.col("line"), phrases).alias("places")).alias("a")
    b = per_text.alias("b")
    return a.join(
        b, F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.line_hash") == F.col("b.line_hash")), "left"
    ).select(
        F.col("a.key").alias(key), "a.n_words", "a.places",
        F.coalesce("b.spans", F.array().cast(kind)).alias("spans"),
    )
