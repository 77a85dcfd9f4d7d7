"""License scan by ordered signature rules, in built-in functions only.

A text becomes lower-case words. The rules (``rules()``, some hundreds of
regular expressions over words) are a small table; each names one word that
must occur. A text's words are intersected with these keywords first, so that
only texts with a keyword meet rules at all, and only the rules of their
keywords. Matches become intervals of word positions.

Overlaps are resolved by priority: a detection inside the interval of another
is dropped if that one's tier is better, or the tier is the same and the
interval longer, or both are the same and its rule comes first. In the order
(start, longest first, tier, rule) this is a running maximum of the ends seen,
one for each tier, so no pairs are made. The three base phrases are always
reported, whatever contains them.

Texts stay where they are; only numbers of matches are shuffled, by document. A
document's matches are one task's work at the most.

Defined results: a null or empty text has no words, no labels and score 0; a
null doc_id is kept; equal rows are judged each by itself; an empty table gives
an empty result; positions are words of the whole text; columns beside doc_id
and text are not read.
"""

from __future__ import annotations

import json
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import documents, staged

# What separates words, and the base phrases with their labels.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BASE_KEYWORDS = ("cc", "general", "reserved")

#: Tiers from the best: passages of a license or its grant, identifier lines, names with a version, names; and their weights.
PASSAGE, IDENTIFIER, VERSIONED, NAMED = range(4)
WEIGHTS = (1.0, 0.95, 0.8, 0.5)

LICENSE = "licen[sc]e"

# Signatures: sentences of well-known licenses and notices (label, keyword, words).
SIGNATURES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "sublicense", "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "copyright", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", "neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance"),
    ("apache-2.0", "warranties", "distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "redistribute", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license"),
    ("lgpl", "gnu", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl", "gnu", "you should have received a copy of the gnu affero general public license"),
    ("gfdl", "documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "distribution", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1.0", "boost", "distributed under the boost software license version 1 0"),
    ("zlib", "arising", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "waived", "to the extent possible under law (?:[^ ]+ ){1,12}(?:has|have) waived all copyright"),
    ("ofl", "font", "this font software is licensed under the sil open font license"),
    ("postgresql", "documentation", "permission to use copy modify and distribute this software and its documentation for any purpose without fee"),
    ("python", "psf", "psf is making python available to licensee on an as is basis"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("curl", "copyright", "the name of a copyright holder shall not be used in advertising or otherwise to promote the sale"),
    ("warranty-disclaimer", "warranty", "(?:is )?provided as is without warranty of any kind"),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "prohibited", "unauthorized (?:copying|use|reproduction|distribution) of this (?:file|document|work|material)(?: [^ ]+){0,6} is (?:strictly )?prohibited"),
    ("proprietary", "reproduced", "no part of this (?:publication|book|document|work|material) may be reproduced"),
    ("proprietary", "permission", "(?:may not|must not|cannot) be (?:copied|reproduced|redistributed|published)(?: [^ ]+){0,6} without(?: [^ ]+){0,4} permission"),
)

# Names of licenses without a version (label, keyword, words).
NAMES = (
    ("mit", "mit", f"mit {LICENSE}"), ("mit", "expat", f"expat {LICENSE}"), ("mit-0", "mit", f"mit no attribution(?: {LICENSE})?"),
    ("x11", "x11", f"x11 {LICENSE}"), ("isc", "isc", f"isc {LICENSE}"), ("zlib", "zlib", f"zlib {LICENSE}"), ("zlib", "libpng", f"zlib libpng {LICENSE}"),
    ("bsd", "bsd", f"(?:modified |revised |original )?bsd(?: style)? {LICENSE}"), ("0bsd", "0bsd", "0bsd"),
    ("bsd-2-clause", "bsd", f"(?:2 clause|two clause|simplified) bsd(?: {LICENSE})?"), ("bsd-2-clause", "bsd", f"bsd (?:2|two) clause(?: {LICENSE})?"),
    ("bsd-3-clause", "bsd", f"(?:3 clause|three clause|new) bsd(?: {LICENSE})?"), ("bsd-3-clause", "bsd", f"bsd (?:3|three) clause(?: {LICENSE})?"),
    ("bsd-2-clause", "freebsd", f"freebsd {LICENSE}"), ("apache", "apache", f"apache(?: software)? {LICENSE}"),
    ("gpl", "gpl", "(?:gnu )?gpl"), ("lgpl", "lgpl", "(?:gnu )?lgpl"), ("agpl", "agpl", "(?:gnu )?agpl"), ("gfdl", "gfdl", "(?:gnu )?gfdl"),
    ("gpl", "general", f"gnu general public {LICENSE}"), ("lgpl", "lesser", f"(?:gnu )?lesser general public {LICENSE}"),
    ("lgpl", "library", f"(?:gnu )?library general public {LICENSE}"), ("agpl", "affero", f"(?:gnu )?affero general public {LICENSE}"),
    ("gfdl", "documentation", f"(?:gnu )?free documentation {LICENSE}"), ("mpl", "mozilla", f"mozilla public {LICENSE}"),
    ("epl", "eclipse", f"eclipse public {LICENSE}"), ("cpl", "common", f"common public {LICENSE}"), ("ipl", "ibm", f"ibm public {LICENSE}"),
    ("eupl", "european", f"european union public {LICENSE}"), ("cddl", "development", f"common development and distribution {LICENSE}"),
    ("osl", "open", f"open software {LICENSE}"), ("afl", "academic", f"academic free {LICENSE}"), ("apsl", "apple", f"apple public source {LICENSE}"),
    ("artistic", "artistic", f"artistic {LICENSE}"), ("cecill", "cecill", f"cecill {LICENSE}"), ("ofl", "font", f"(?:sil )?open font {LICENSE}"),
    ("lppl", "latex", f"latex project public {LICENSE}"), ("zpl", "zope", f"zope public {LICENSE}"),
    ("psf", "python", f"python(?: software foundation)? {LICENSE}"), ("php", "php", f"php {LICENSE}"), ("ruby", "ruby", f"ruby {LICENSE}"),
    ("bsl", "boost", f"boost software {LICENSE}"), ("upl", "universal", f"universal permissive {LICENSE}"),
    ("ecl", "educational", f"educational community {LICENSE}"), ("mulan", "mulan", f"mulan (?:psl|permissive software {LICENSE})"),
    ("busl", "business", f"business source {LICENSE}"), ("sspl", "server", f"server side public {LICENSE}"), ("elastic", "elastic", f"elastic {LICENSE}"),
    ("odbl", "database", f"open database {LICENSE}"), ("odc-by", "commons", f"open data commons attribution {LICENSE}"),
    ("pddl", "domain", f"public domain dedication and {LICENSE}"), ("ms-pl", "microsoft", f"microsoft public {LICENSE}"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {LICENSE}"), ("ncsa", "illinois", f"university of illinois ncsa open source {LICENSE}"),
    ("openssl", "openssl", f"openssl {LICENSE}"), ("postgresql", "postgresql", f"postgresql {LICENSE}"), ("vim", "vim", f"vim {LICENSE}"),
    ("w3c", "w3c", f"w3c(?: software(?: notice and)?)? {LICENSE}"), ("wtfpl", "wtfpl", "wtfpl"), ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("beerware", "beerware", f"beerware(?: {LICENSE})?"), ("cc0", "cc0", "cc0"), ("ogl", "government", f"open government {LICENSE}"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?openrail(?: m)?"), ("cdla", "cdla", "cdla (?:permissive|sharing)"),
    ("creative-commons", "creative", f"creative commons(?: {LICENSE})?"), ("public-domain", "domain", "(?:in|into|to) the public domain"),
    ("public-domain", "domain", "public domain dedication"), ("copyright", "copyright", "copyright(?: c)? [12][0-9]{3}(?: [12][0-9]{3})?"),
    ("copyright", "copyrighted", "copyrighted (?:material|work|content)"), ("some-rights-reserved", "reserved", "some rights reserved"),
    ("no-rights-reserved", "reserved", "no rights reserved"), ("non-commercial", "commercial", "(?:for )?non commercial (?:use|purposes)(?: only)?"),
    ("non-commercial", "noncommercial", "(?:for )?noncommercial (?:use|purposes)(?: only)?"),
)

# Names that come with a version: (label, keyword, words, versions).
VERSIONS = (
    ("apache", "apache", f"apache(?: software)?(?: {LICENSE})?", "1.0 1.1 2.0"), ("mpl", "mpl", "mpl", "1.0 1.1 2.0"),
    ("mpl", "mozilla", f"mozilla public {LICENSE}", "1.0 1.1 2.0"), ("epl", "epl", "epl", "1.0 2.0"), ("epl", "eclipse", f"eclipse public {LICENSE}", "1.0 2.0"),
    ("eupl", "eupl", "eupl", "1.0 1.1 1.2"), ("eupl", "european", f"european union public {LICENSE}", "1.0 1.1 1.2"),
    ("cddl", "cddl", "cddl", "1.0 1.1"), ("cddl", "development", f"common development and distribution {LICENSE}", "1.0 1.1"),
    ("osl", "osl", "osl", "1.0 2.0 2.1 3.0"), ("osl", "open", f"open software {LICENSE}", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", f"academic free {LICENSE}", "1.1 1.2 2.0 2.1 3.0"), ("apsl", "apple", f"apple public source {LICENSE}", "1.0 1.1 1.2 2.0"),
    ("artistic", "artistic", f"artistic {LICENSE}", "1.0 2.0"), ("cecill", "cecill", f"cecill(?: {LICENSE})?", "1.0 1.1 2.0 2.1"),
    ("ofl", "ofl", "(?:sil )?ofl", "1.0 1.1"), ("ofl", "font", f"(?:sil )?open font {LICENSE}", "1.0 1.1"),
    ("lppl", "lppl", "lppl", "1.0 1.1 1.2 1.3"), ("lppl", "latex", f"latex project public {LICENSE}", "1.0 1.1 1.2 1.3"),
    ("zpl", "zope", f"zope public {LICENSE}", "1.1 2.0 2.1"), ("psf", "python", f"python(?: software foundation)? {LICENSE}", "2.0"),
    ("php", "php", f"php {LICENSE}", "3.0"), ("bsl", "boost", f"boost software {LICENSE}", "1.0"), ("upl", "universal", f"universal permissive {LICENSE}", "1.0"),
    ("ecl", "educational", f"educational community {LICENSE}", "1.0 2.0"), ("mulan", "mulan", f"mulan (?:psl|permissive software {LICENSE})", "1.0 2.0"),
    ("busl", "business", f"business source {LICENSE}", "1.0 1.1"), ("sspl", "server", f"server side public {LICENSE}", "1.0"),
    ("elastic", "elastic", f"elastic {LICENSE}", "1.0 2.0"), ("odbl", "database", f"open database {LICENSE}", "1.0"),
    ("odc-by", "commons", f"open data commons attribution {LICENSE}", "1.0"), ("cc0", "cc0", "cc0", "1.0"), ("ogl", "government", f"open government {LICENSE}", "1.0 2.0 3.0"),
    ("cdla-permissive", "cdla", "cdla permissive", "1.0 2.0"), ("cdla-sharing", "cdla", "cdla sharing", "1.0"),
)

# Copyleft families: each version also as "only" and "or later": (label, keyword, words, versions).
COPYLEFT = (
    ("gpl", "gpl", "(?:gnu )?gpl", "1.0 2.0 3.0"), ("gpl", "general", f"(?:gnu )?general public {LICENSE}", "1.0 2.0 3.0"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "2.0 2.1 3.0"), ("lgpl", "lesser", f"(?:gnu )?lesser general public {LICENSE}", "2.1 3.0"),
    ("lgpl", "library", f"(?:gnu )?library general public {LICENSE}", "2.0"), ("agpl", "agpl", "(?:gnu )?agpl", "1.0 3.0"),
    ("agpl", "affero", f"(?:gnu )?affero general public {LICENSE}", "1.0 3.0"), ("gfdl", "gfdl", "(?:gnu )?gfdl", "1.1 1.2 1.3"),
    ("gfdl", "documentation", f"(?:gnu )?free documentation {LICENSE}", "1.1 1.2 1.3"),
)
FUSED = ("gplv1", "gplv2", "gplv3", "lgplv2", "lgplv3", "agplv3")
LATER = "(?: published by the free software foundation)?(?: either version)? or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?"

# Creative Commons: short words, long words; each by version.
SHARE, TRADE, CHANGE = "(?:share alike|sharealike)", "(?:non commercial|noncommercial)", "(?:no derivatives|noderivatives|no derivs|noderivs)"
COMMONS = (
    ("by", "by", "attribution"), ("by-sa", "by sa", f"attribution {SHARE}"), ("by-nd", "by nd", f"attribution {CHANGE}"),
    ("by-nc", "by nc", f"attribution {TRADE}"), ("by-nc-sa", "by nc sa", f"attribution {TRADE} {SHARE}"),
    ("by-nc-nd", "by nc nd", f"attribution {TRADE} {CHANGE}"),
)
COMMONS_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

GRANT = "(?:licensed|released|distributed|available|published|covered|provided|governed) (?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    words: str
    tier: int
    base: bool = False


def _version(version: str) -> str:
    major, minor = version.split(".")
    return f"(?: version| v)? v?{major}" + ("(?: 0)?" if minor == "0" else f" {minor}")


def rules() -> list[Rule]:
    """All rules in their order of priority within a tier; the base phrases come last."""
    out = [Rule(label, keyword, words, PASSAGE) for label, keyword, words in SIGNATURES]
    for label, keyword, words, versions in COPYLEFT:
        for v in versions.split():
            numbered = words + _version(v)
            out.append(Rule(f"{label}-{v}-or-later", keyword, numbered + LATER, VERSIONED))
            out.append(Rule(f"{label}-{v}-only", keyword, numbered + " only", VERSIONED))
            out.append(Rule(f"{label}-{v}", keyword, numbered, VERSIONED))
    for word in FUSED:
        label = word.replace("v", "-") + ".0"
        out.append(Rule(f"{label}-or-later", word, f"(?:gnu )?{word}" + LATER, VERSIONED))
        out.append(Rule(label, word, f"(?:gnu )?{word}", VERSIONED))
    for label, keyword, words, versions in VERSIONS:
        out.extend(Rule(f"{label}-{v}", keyword, words + _version(v), VERSIONED) for v in versions.split())
    for label, short, long in COMMONS:
        for v in COMMONS_VERSIONS.split():
            out.append(Rule(f"cc-{label}-{v}", "cc", f"cc {short}" + _version(v), VERSIONED))
            out.append(Rule(f"cc-{label}-{v}", "commons", f"(?:creative )?commons {long}(?: (?:international|generic|unported))?(?: public)?(?: {LICENSE})?" + _version(v), VERSIONED))
        out.append(Rule(f"cc-{label}", "cc", f"cc {short}(?: {LICENSE})?", NAMED))
        out.append(Rule(f"cc-{label}", "commons", f"creative commons {long}(?: {LICENSE})?", NAMED))
    identified = dict.fromkeys(r.label for r in out if r.tier == VERSIONED)
    identified.update(dict.fromkeys(label for label, _, _ in NAMES[:14]))
    out.extend(Rule(label, "spdx", f"spdx {LICENSE} identifier " + label.replace("-", " ").replace(".", " "), IDENTIFIER) for label in identified)
    for label, keyword, words in NAMES:
        if LICENSE in words:
            out.append(Rule(label, keyword, GRANT + words, PASSAGE))
        out.append(Rule(label, keyword, words, NAMED))
    out.extend(Rule(label, keyword, words, NAMED, base=True) for keyword, (words, label) in zip(BASE_KEYWORDS, BASE))
    return out


_RULE = {"rule": "int", "label": "string", "keyword": "string", "pattern": "string", "tier": "int", "base": "boolean"}


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, ordered: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents (``row``, all columns but text, ``n_words``) and their detections.

    A detection is (row, rule, label, tier, base, start, stop, kept): words from
    ``start`` up to ``stop``; ``kept`` is false where another one contains it.
    """
    spark = docs.sparkSession
    ordered = rules() if ordered is None else ordered
    # a rule starts at the space before its first word and leaves the space after its last one
    table = json.dumps([[n, r.label, r.keyword, f" (?:{r.words})(?= )", r.tier, r.base] for n, r in enumerate(ordered)])
    table = F.broadcast(spark.range(1).select(F.explode(F.from_json(F.lit(table), "array<array<string>>")).alias("r")).select(
        *[F.get("r", F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(_RULE.items())]))
    keywords = F.array(*[F.lit(k) for k in dict.fromkeys(r.keyword for r in ordered)])

    low = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("text", "n_words")]).alias("rest")
    read = (docs.select(rest, F.trim(F.regexp_replace(low, GAP, " ")).alias("line"))
            .withColumn("word", F.when(F.col("line") == "", F.expr("cast(array() as array<string>)")).otherwise(F.split("line", " ")))
            .withColumn("keys", F.array_intersect("word", keywords)))
    line = F.when(F.size("keys") > 0, F.concat(F.lit(" "), F.col("line"), F.lit(" ")))
    rows = staged(read.select("rest", F.size("word").cast("long").alias("n_words"), "keys", line.alias("line"))
                  .withColumn("row", F.monotonically_increasing_id()), "lines")

    hits, between = F.regexp_extract_all("line", F.col("pattern"), F.lit(0)), F.split("line", F.col("pattern"), -1)
    found = (rows.where("line is not null").select("row", "line", F.explode("keys").alias("keyword")).join(table, "keyword")
             .where(F.regexp_like("line", F.col("pattern"))).select("row", "rule", "label", "tier", "base", hits.alias("hits"), between.alias("between")))
    each = F.transform("hits", lambda hit, i: F.struct(i.alias("i"), _spaces(F.get("between", i)).alias("before"), _spaces(hit).alias("words")))
    matches = found.select("row", "rule", "label", "tier", "base", F.inline(each)).repartition("row")
    stop = F.sum(F.col("before") + F.col("words")).over(Window.partitionBy("row", "rule").orderBy("i"))
    spans = matches.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("words"))

    before = Window.partitionBy("row").orderBy("start", F.desc("stop"), "tier", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(*[F.when(F.col("tier") == t, F.coalesce(F.max(F.when(F.col("tier") <= t, F.col("stop"))).over(before), F.lit(-1)))
                         for t in range(len(WEIGHTS))])
    kept = spans.withColumn("kept", reach < F.col("stop"))
    return rows.select("row", "rest.*", "n_words"), kept.select("row", "rule", "label", "tier", "base", "start", "stop", "kept")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(labels)), ",")


def op13_licenses(spark, folder):
    """Contract 13."""
    rows, found = scan(documents(spark, folder).select("doc_id", "text"))
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("tier"))
    told = F.col("kept") | F.col("base")
    per_row = found.groupBy("row").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"), _joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        _joined(F.when(told, F.col("label"))).alias("labels"), F.max(F.when(told, weight)).alias("score"))
    return rows.join(per_row, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def _rule_rows() -> str:
    """The rules for SQL: each word between two spaces of its own."""
    def one(number, rule):
        words = rule.words.replace(" ", "  ").replace("[^  ]", "[^ ]")
        return f"({number}, '{rule.label}', '{rule.keyword}', ' (?:{words}) ', {rule.tier}, {'true' if rule.base else 'false'})"
    return ",\n  ".join(one(n, r) for n, r in enumerate(rules()))


def op13_sql() -> str:
    return rf"""
WITH rules(rule, label, keyword, pattern, tier, base) AS (VALUES
  {_rule_rows()}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{GAP}'), lambda w: w <> '') AS word
  FROM documents),
hits AS (
  SELECT r, rule, label, tier, base, regexp_extract_all(line, pattern) AS hit, regexp_split_to_array(line, pattern) AS gap
  FROM (SELECT r, word, ' ' || array_to_string(word, '  ') || ' ' AS line FROM docs), rules
  WHERE list_contains(word, keyword) AND regexp_matches(line, pattern)),
parts AS (
  SELECT r, rule, label, tier, base, i, (length(gap[i]) - length(replace(gap[i], ' ', ''))) // 2 AS before,
    (length(hit[i]) - length(replace(hit[i], ' ', ''))) // 2 AS words
  FROM hits, LATERAL (SELECT unnest(range(1, 1 + len(hit))) AS i)),
spans AS (
  SELECT r, rule, label, tier, base, stop - words AS start, stop
  FROM (SELECT *, CAST(sum(before + words) OVER (PARTITION BY r, rule ORDER BY i) AS BIGINT) AS stop FROM parts)),
judged AS (
  SELECT s.*, base OR NOT EXISTS (
    SELECT 1 FROM spans o WHERE o.r = s.r AND o.start <= s.start AND o.stop >= s.stop
      AND (o.tier < s.tier OR o.tier = s.tier AND (o.stop - o.start > s.stop - s.start OR o.stop - o.start = s.stop - s.start AND o.rule < s.rule))) AS told
  FROM spans s),
found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (told) AS labels,
    max(CASE tier {" ".join(f"WHEN {t} THEN {w}" for t, w in enumerate(WEIGHTS))} END) FILTER (told) AS score
  FROM judged GROUP BY r)
SELECT doc_id, CAST(len(word) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN found USING (r)
"""


OP13_SQL = op13_sql()
