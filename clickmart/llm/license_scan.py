"""License scans: an exact set-similarity join of text blocks with templates.

A window of twice a template's words meets the template when it holds at
least ``threshold`` of its distinct words, and gives a label when the
words that decide the licence (``RULES``) begin in it too: most words of
"CC BY-SA 4.0" and "CC BY-NC 4.0" are the same. What decides against a
label is looked for in the window and the ``TAIL`` words behind it, so a
window that ends within a notice does not miss its version or its terms; a
version displaces the licence's name alone. Windows run on from line to
line, as notices are wrapped.

Candidates are found by blocks of words so long that every window and its
tail lie in the block in whose first part the window begins. Tokens are ordered by their frequency over all blocks, rarest first.
With ``need = ceil(threshold * size)`` a meeting block must hold one of the
template's first ``size - need + 1`` tokens (prefix filter), must have
``need`` template words at all (length filter), and what stands after
the shared token in both orders must suffice for the rest (positional
filter). Every window of the survivors is verified, so no meeting window
is lost. Only texts and blocks that hold ``need`` words of a template leave
the one pass over the text. DataFrame functions only; the templates, a
parameter of a few dozen words each, are literals and a broadcast table of
that size.

The SQL of the query compares whole lines and has no deciding words; it
says the same where every line that meets a template is that notice and
none is wrapped, as in the given tables.

Defined results: a null text counts as empty and has no words and no
labels; repeated rows each get their own row; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, read_table, staged

THRESHOLD = 0.8
#: Words behind a window that can decide against a label; no rule looks further.
TAIL = 12

# Phrases of known places and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Notices that publishers put above or below a work, and their labels.
TEMPLATES = (
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3"),
    ("You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
    ("All rights reserved", "all-rights-reserved"),
)

_CC = "cc-by"
_NC, _SA, _ND = "non ?commercial", "share ?alike", "no ?deriv[a-z]*"
_GPL = " gnu general public licen[cs]e "


def _cc_rules(name: str, nc: str, sa: str, nd: str) -> tuple:
    return (
        (_CC, f" {name} (?!({nc}|{sa}|{nd}) )"),
        ("cc-by-nc", f" {name} {nc} (?!({sa}|{nd}) )"),
        ("cc-by-sa", f" {name} {sa} (?!{nc} )"),
        ("cc-by-nd", f" {name} {nd} (?!{nc} )"),
        ("cc-by-nc-sa", f" {name} ({nc} {sa}|{sa} {nc}) "),
        ("cc-by-nc-nd", f" {name} ({nc} {nd}|{nd} {nc}) "),
    )


#: A version may stand up to so many words behind the name: "... as published by the Free Software Foundation; either version 3".
_VERSION = r"(\S+ ){0,9}(version |v)"
_BEFORE = r" (version |v)%s (\S+ ){0,3}gnu general public licen[cs]e "
_OTHER_GPL = (("lgpl", " gnu (lesser|library) general public licen[cs]e "), ("agpl", " gnu affero general public licen[cs]e "))
_CC_NAMES = _cc_rules("attribution", _NC, _SA, _ND)
_GPL_RULES = (
    ("gpl-3", f"{_GPL}(?={_VERSION}3 )|{_BEFORE % 3}"),
    ("gpl-2", f"{_GPL}(?={_VERSION}2 )|{_BEFORE % 2}"),
    ("gpl", f"{_GPL}(?!{_VERSION}[23] )"),
    *_OTHER_GPL,
)
#: Where one of these labels is given by a window, the general one is not.
DISPLACED = {"gpl": ("gpl-2", "gpl-3")}

#: Per template the labels it can give, each with a pattern that decides it: it begins in the window
#: (" w1 w2 ... ") and may read on into the tail.
RULES = dict(
    zip(
        (text for text, _ in TEMPLATES),
        (
            (
                ("mit", r" mit (\S+ ){0,3}licen[cs]es? | licen[cs]es? (\S+ )?mit | under the mit "),
                ("bsd", r" bsd (\S+ ){0,3}licen[cs]es? | licen[cs]es? (\S+ )?bsd | under the bsd "),
            ),
            (("mit", r"^(?=.* permission )(?=.* associated )(?=.* documentation )(?=.* files )(?!.* unicode )"),),
            (("apache-2", r" apache (\S+ ){0,3}v?2 | version 2 (\S+ ){0,3}apache "),),
            _cc_rules("cc by", "nc", "sa", "nd"),
            _CC_NAMES,
            _CC_NAMES,
            _GPL_RULES,
            _GPL_RULES,
            (("bsd", r"^(?=.* redistribution )(?=.* source )(?=.* binary )"),),
            (("mpl", " mozilla public licen[cs]e "),),
            (("all-rights-reserved", r" all (\S+ )?rights (\S+ ){0,2}reserved "),),
        ),
        strict=True,
    )
)

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _tokens(text: str) -> list[str]:
    return sorted({w for w in re.split("[^0-9a-z\u0080-\U0010ffff]+", text.lower()) if w})


def _span(text: str) -> int:
    """Words in a window of a template."""
    return 2 * len([w for w in re.split("[^0-9a-z\u0080-\U0010ffff]+", text.lower()) if w])


def _need(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


#: The words of the window that begins at the i-th token, and of its tail.
WINDOW = "transform(slice(tokens, i, span), t -> t.word)"
BEHIND = f"transform(slice(tokens, i + span, {TAIL}), t -> t.word)"


def _strings(values) -> F.Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _place_columns(norm, n_words, phrases):
    """Per phrase: number of places, first and last start. ``norm`` is ' w1 w2 ... '."""
    out = []
    for phrase, _ in phrases:
        parts = F.split(norm, f" {re.escape(phrase)}(?= )")
        n = F.size(parts) - 1
        first = F.size(F.split(parts[0], " ")) - 1
        last = n_words - (F.size(F.split(F.element_at(parts, -1), " ")) - 2) - len(phrase.split())
        out.append(F.when(n > 0, F.struct(n.cast("long").alias("n"), first.cast("long").alias("first"), last.cast("long").alias("last"))))
    return out


def scan_blocks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    phrases=PHRASES,
    threshold: float = THRESHOLD,
    rules=RULES,
) -> tuple[DataFrame, DataFrame]:
    """(per document, matches).

    Per document row: row (an id of this result), doc, n_words, places
    (array per phrase of n, first, last, or null) and found (array of
    (label, containment) over its windows, by ``rules``; a template without
    rules gives its own label). Matches: row, doc, line, template, label,
    shared, size of every line in which a window that holds enough of a
    template's words begins, before the deciding words are asked for.
    """
    spark = docs.sparkSession
    sets = [(i, _tokens(text), label, _span(text)) for i, (text, label) in enumerate(templates)]
    vocabulary = sorted({w for _, ws, _, _ in sets for w in ws})
    reach = max((span for *_, span in sets), default=1)

    low = docs.select(
        F.col(id_col).alias("doc"), ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("low")
    )
    lines = low.withColumn("lines", F.transform(F.split("low", "\n"), lambda line: F.split(line, _GAP)))
    blank = lambda w: F.when(w == "", 1).otherwise(0)
    words_of = lambda ws: (
        F.size(ws) - F.when(F.size(ws) == 1, blank(ws[0])).otherwise(blank(ws[0]) + blank(F.element_at(ws, -1)))
    )
    marked = F.lit(False)
    for phrase, _ in phrases:
        marked = marked | F.col("low").contains(max(phrase.split(), key=len))
    # only texts that hold a phrase's longest word are normalised for the phrase search
    norm = F.when(marked, F.concat(F.lit(" "), F.trim(F.regexp_replace("low", _GAP, " ")), F.lit(" ")))

    def can_meet(words):
        """Whether these distinct words hold enough of any template."""
        out = F.lit(False)
        for _, ws, _, _ in sets:
            out = out | (F.size(F.array_intersect(words, _strings(ws))) >= _need(len(ws), threshold))
        return out

    known = lines.withColumn("known", F.array_intersect(F.flatten("lines"), _strings(vocabulary)))
    numbered = F.flatten(
        F.transform("lines", lambda ws, i: F.transform(F.filter(ws, lambda w: w != ""), lambda w: F.struct(i.alias("line"), w.alias("word"))))
    )
    tokens = known.select("doc", "lines", "low", F.when(can_meet(F.col("known")), numbered).alias("tokens"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(reach))
    cut = F.transform(starts, lambda s: F.slice("tokens", s + 1, 2 * reach + TAIL))
    blocks = F.transform(
        cut, lambda ts: F.struct(F.array_intersect(F.transform(ts, lambda t: t["word"]), _strings(vocabulary)).alias("words"), ts.alias("tokens"))
    )
    rows = staged(
        tokens.select(
            "doc",
            F.aggregate("lines", F.lit(0).cast("long"), lambda acc, ws: acc + words_of(ws)).alias("n_words"),
            norm.alias("norm"),
            F.when(F.col("tokens").isNotNull(), F.filter(blocks, lambda b: can_meet(b["words"]))).alias("blocks"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "license-blocks",
    )

    blocks = rows.select("row", "doc", F.explode("blocks").alias("b")).select("row", "doc", "b.words", "b.tokens")
    # at most one row per vocabulary word reaches the driver
    count = {r["w"]: r["n"] for r in blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefix = []
    for i, ws, label, span in sets:
        ws = sorted(ws, key=rank.__getitem__)
        need = _need(len(ws), threshold)
        first = ws[: len(ws) - need + 1]
        prefix += [(w, i, label, p, len(ws), need, span, first, ws) for p, w in enumerate(first)]
    index = spark.createDataFrame(
        prefix, "token string, template int, label string, place int, size int, need int, span int, first array<string>, whole array<string>"
    )
    candidates = (
        blocks.withColumn("words", F.array_intersect(_strings(order), F.col("words")))  # in the global order
        .select("row", "doc", "tokens", "words", F.posexplode("words").alias("at", "token"))
        .join(F.broadcast(index), "token")
        .where("array_intersect(words, first)[0] = token")  # once by block and template
        .where("size(words) >= need")
        .where("1 + least(size - place - 1, size(words) - at - 1) + least(place, at) >= need")
    )
    window = F.expr(WINDOW)
    # windows begin in a block's first part; what follows belongs to the next block
    places = F.expr(f"filter(sequence(1, least(size(tokens), {reach})), i -> array_contains(whole, tokens[i - 1].word))")
    windows = (
        candidates.select("row", "doc", "template", "label", "size", "need", "span", "whole", "tokens", F.explode(places).alias("i"))
        .withColumn("window", window)
        .withColumn("behind", F.expr(BEHIND))
        .withColumn("shared", F.size(F.array_intersect("window", "whole")))
        .where("shared >= need")
        .select("row", "doc", F.expr("tokens[i - 1].line").alias("line"), "template", "label", "shared", "size", "window", "behind")
    )
    matches = windows.groupBy("row", "doc", "line", "template", "label", "size").agg(F.max("shared").alias("shared"))
    inside = F.concat(F.lit(" "), F.array_join("window", " "), F.lit(" "))
    read = F.concat(F.col("inside"), F.array_join("behind", " "), F.when(F.size("behind") > 0, F.lit(" ")).otherwise(F.lit("")))
    windows = windows.withColumn("inside", inside).withColumn("read", read)
    # the first match of a pattern begins in the window, if any does
    given = F.array_compact(F.array(*[
        F.when((F.col("template") == i) & F.regexp_instr("read", F.lit(pattern)).between(1, F.length("inside") - 1), F.lit(name))
        for i, (template, label) in enumerate(templates) for name, pattern in rules.get(template, ((label, "^"),))
    ])).cast("array<string>")
    for general, specific in DISPLACED.items():
        given = F.when(F.arrays_overlap(given, _strings(specific)), F.array_remove(given, general)).otherwise(given)
    best = windows.select("row", "shared", "size", F.explode(given).alias("label")).groupBy("row").agg(
        F.collect_set(F.struct("label", (F.col("shared") / F.col("size")).alias("containment"))).alias("found")
    )
    places = F.array(*_place_columns(F.col("norm"), F.col("n_words"), phrases))
    out = rows.join(best, "row", "left").select(
        "row", "doc", "n_words", places.alias("places"),
        F.coalesce("found", F.array().cast("array<struct<label:string,containment:double>>")).alias("found"),
    )
    return out, matches


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    rows, _ = scan_blocks(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    held = F.filter("places", lambda p: p.isNotNull())
    base = F.array_compact(
        F.array(*[F.when(F.col("places")[i].isNotNull(), F.lit(label)) for i, (_, label) in enumerate(PHRASES)])
    )
    rows = rows.withColumn("held", held).withColumn("base", F.array_sort(F.array_distinct(base)))
    added = F.transform("found", lambda f: f["label"])
    return rows.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        F.aggregate("held", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_base"),
        F.array_min(F.transform("held", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("held", lambda p: p["last"])).alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", added)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max(F.transform("found", lambda f: f["containment"])), F.lit(0.0)))
        .alias("score"),
    )


def _sql() -> str:
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    templates = ", ".join(
        f"({i}, '{label}', {_tokens(text)!r}, {_need(len(_tokens(text)), THRESHOLD)})" for i, (text, label) in enumerate(TEMPLATES)
    )
    return rf"""
with low as (
  select row_number() over () rid, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
phrases(phrase, label, k) as (values {phrases}),
templates(tid, label, ws, need) as (values {templates}),
d as (select rid, doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from low),
places as (
  select rid, p - 1 place, label
  from (select rid, w, label, phrase, k, unnest(range(1, len(w) - k + 2)) p from d, phrases where len(w) >= k)
  where array_to_string(w[p : p + k - 1], ' ') = phrase),
base as (select rid, count(*) n, min(place) f, max(place) l, list(distinct label) ls from places group by rid),
blocks as (
  select rid, regexp_extract_all(unnest(string_split(t, chr(10))), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') bw from low),
met as (
  select rid, label, len(list_intersect(ws, bw)) / len(ws) c
  from blocks, templates where len(list_intersect(ws, bw)) >= need),
found as (select rid, list(distinct label) ls, max(c) c from met group by rid)
select doc_id, cast(len(w) as bigint) n_words, coalesce(base.n, 0) n_base, f first_word, l last_word,
       array_to_string(list_sort(coalesce(base.ls, [])), ',') base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(found.ls, [])))), ',') labels,
       case when base.n > 0 then 1.0 else coalesce(c, 0.0) end :: double score
from d left join base using (rid) left join found using (rid)
"""


OP10_SQL = _sql()
