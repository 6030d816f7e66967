"""Licence scans by sentence rules, in DataFrame operations only and without a shuffle.

A text is cut into sentences; those that speak of licences are normalised and mapped to the identifier
of a known licence sentence. The document's sequence of identifiers is then matched against an ordered
list of licence rules, each a run of identifiers: longer and more specific rules come first and consume
the identifiers they match, so a short rule can't claim part of a longer notice. What is left of a
sequence are licence sentences that no rule explains.

Comment marks at the beginning of lines go first. A sentence ends at ``. ! ? ; :`` before white space and at a line
feed, unless the line breaks softly: in front of a lower-case letter or behind a word that can't end a sentence.
Normalising lower-cases, and keeps letters, digits, ``. - +`` inside words.

A sentence speaks of licences if it has one of the words that SPEAKS lists, or that were taken from known sentences
without any of these. The tables of sentences and rules are parameters of fixed size and become literals of the plan.

Cases: a null or empty text has no sentences and no licences; a very long text is one value to Spark and cut like
others; repeated sentences give repeated identifiers and each licence is listed once, in the order of the rules;
rows are judged alone, so repeated or null ids and skewed sources are of no consequence; bytes that aren't UTF-8
are no letters; other columns are kept, and those named like an added one replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.arrow import without

# Sentences of public licence notices, normalised, with identifiers of our own.
SENTENCES = {
    "apache_under": "licensed under the apache license version 2.0",
    "apache_the": "licensed under the apache license version 2.0 the license",
    "apache_may_not": "you may not use this file except in compliance with the license",
    "apache_copy_at": "you may obtain a copy of the license at",
    "apache_as_is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl2_work": "this work is licensed under the gnu general public license version 2",
    "gpl3_under": "licensed under the gnu general public license version 3",
    "gpl2_under": "licensed under the gnu general public license version 2",
    "gpl_free": "this program is free software",
    "gpl3_later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl_details": "see the gnu general public license for more details",
    "lgpl_under": "licensed under the gnu lesser general public license version 3",
    "agpl_under": "licensed under the gnu affero general public license version 3",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd3_under": "licensed under the bsd 3-clause license",
    "bsd2_under": "licensed under the bsd 2-clause license",
    "mpl_subject": "this source code form is subject to the terms of the mozilla public license v",
    "cc_by_nc": "licensed under cc by-nc 4.0",
    "cc_by": "licensed under cc by 4.0",
    "cc_by_sa": "licensed under cc by-sa 4.0",
    "cc_by_nd": "licensed under cc by-nd 4.0",
    "cc0": "licensed under cc0 1.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "rights_reserved": "all rights reserved",
}

# Licences and the runs of sentences that grant them, most specific first.
RULES = [
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_later", "gpl_warranty", "gpl_details"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_later", "gpl_warranty", "gpl_details"]),
    ("Apache-2.0", ["apache_the", "apache_may_not", "apache_copy_at", "apache_as_is", "apache_see"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_as_is"]),
    ("BSD-3-Clause", ["bsd_redistribution", "bsd_endorse"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_later"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_later"]),
    ("Apache-2.0", ["apache_under"]),
    ("Apache-2.0", ["apache_the"]),
    ("MIT", ["mit_grant"]),
    ("MIT", ["mit_released"]),
    ("MIT", ["mit_licensed"]),
    ("BSD-2-Clause", ["bsd_redistribution"]),
    ("BSD-3-Clause", ["bsd3_under"]),
    ("BSD-2-Clause", ["bsd2_under"]),
    ("GPL-3.0-only", ["gpl3_work"]),
    ("GPL-2.0-only", ["gpl2_work"]),
    ("GPL-3.0-only", ["gpl3_under"]),
    ("GPL-2.0-only", ["gpl2_under"]),
    ("LGPL-3.0-only", ["lgpl_under"]),
    ("AGPL-3.0-only", ["agpl_under"]),
    ("MPL-2.0", ["mpl_subject"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC-BY-ND-4.0", ["cc_by_nd"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("All-Rights-Reserved", ["rights_reserved"]),
]

#: A sentence without any of these can't be a licence sentence.
SPEAKS = r"licen[sc]|copyright|warrant|redistribut|permission|free software|public domain|rights reserved|gnu general|may not use this file|as is"
#: The parts of the cutting, which hold for Java's regular expressions and for RE2 alike.
COMMENT = r"(^|\n)[ \t]*(?:#+|//+|/\*+|\*+/|\*+|;+|--+|%+)[ \t]*"
SOFT_BEFORE = r"\n[ \t]*([a-z(])"
SOFT_BEHIND = r"([ \t](?:the|of|a|an|and|to|under|in|or|with|for|by|this))[ \t]*\n"
STOP = r"([.!?;:])[ \t]+"
NOISE = r"[^a-z0-9.+-]+"
EDGES = r"^[ .+-]+|[ .+-]+$"
ADDED = ("n_sentences", "sentence_ids", "licences", "n_unexplained", "n_unknown")


def gate(known: dict[str, str]) -> str:
    """A pattern that every known sentence has, and most others don't: SPEAKS, and the longest word of what it leaves out."""
    left = [s for s in known.values() if not re.search(SPEAKS, s)]
    return "|".join([SPEAKS, *sorted({re.escape(max(s.split(), key=lambda w: (len(w), w))) for s in left if s})])


def sentences(text: Column, speaks: str = SPEAKS) -> Column:
    """The normalised sentences that speak of licences, in order."""
    bare = F.regexp_replace(text, COMMENT, "$1")
    flat = F.regexp_replace(F.regexp_replace(bare, SOFT_BEHIND, "$1 "), SOFT_BEFORE, " $1")
    cut = F.split(F.regexp_replace(flat, STOP, "$1\n"), "\n")
    speaking = F.filter(F.transform(cut, F.lower), lambda s: s.rlike(speaks))
    return F.transform(speaking, lambda s: F.regexp_replace(F.regexp_replace(s, NOISE, " "), EDGES, ""))


def scan_licences(docs: DataFrame, known: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Add n_sentences (that speak of licences), sentence_ids (of known ones), licences, n_unexplained and n_unknown."""
    known, rules = known or SENTENCES, rules or RULES
    docs = without(docs, *ADDED, "__spoken", "__ids", "__match")
    table = F.create_map(*[F.lit(x) for name, sentence in known.items() for x in (sentence, name)])
    ordered = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f",{k};" for k in run)).alias("run")) for name, run in rules])
    empty = F.array().cast("array<string>")
    text = F.coalesce(F.col("text"), F.lit(""))
    # Most texts say nothing of licences; they are not cut at all.
    speaks = gate(known)
    spoken = F.when(F.lower(text).rlike(speaks), sentences(text, speaks)).otherwise(empty)
    ids = F.filter(F.transform("__spoken", lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull())
    start = F.struct(F.concat_ws("", F.transform("__ids", lambda x: F.concat(F.lit(","), x, F.lit(";")))).alias("left"), empty.alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        met = F.contains(state["left"], rule["run"])
        return F.struct(F.replace(state["left"], rule["run"], F.lit("|")).alias("left"), F.when(met, F.array_union(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names"))

    scanned = docs.withColumn("__spoken", spoken).withColumn("__ids", ids).withColumn("__match", F.when(F.size("__ids") > 0, F.aggregate(ordered, start, apply)).otherwise(F.struct(F.lit("").alias("left"), empty.alias("names"))))
    return scanned.select(
        *docs.columns,
        F.size("__spoken").cast("long").alias("n_sentences"),
        F.concat_ws(",", "__ids").alias("sentence_ids"),
        F.concat_ws(",", "__match.names").alias("licences"),
        (F.length("__match.left") - F.length(F.replace("__match.left", F.lit(";"), F.lit("")))).cast("long").alias("n_unexplained"),
        (F.size("__spoken") - F.size("__ids")).cast("long").alias("n_unknown"),
    )


def scan_sql() -> str:
    """The same in DuckDB, one step for each rule."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    steps, last = [], "r0"
    for k, (name, run) in enumerate(RULES, 1):
        pattern = quoted("".join(f",{x};" for x in run))
        steps.append(f"r{k} AS (SELECT * REPLACE (replace(rest, {pattern}, '|') AS rest, CASE WHEN contains(rest, {pattern}) AND NOT list_contains(names, {quoted(name)}) THEN list_append(names, {quoted(name)}) ELSE names END AS names) FROM {last})")
        last = f"r{k}"
    return rf"""
WITH known(sentence, id) AS (VALUES {", ".join(f"({quoted(s)}, {quoted(k)})" for k, s in SENTENCES.items())}),
flat AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), {quoted(COMMENT)}, '\1', 'g'), {quoted(SOFT_BEHIND)}, '\1 ', 'g'), {quoted(SOFT_BEFORE)}, ' \1', 'g'), {quoted(STOP)}, '\1' || chr(10), 'g') AS t
  FROM documents),
cut AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS s, unnest(range(len(string_split(t, chr(10))))) AS pos FROM flat),
spoken AS (
  SELECT doc_id, pos, regexp_replace(regexp_replace(lower(s), {quoted(NOISE)}, ' ', 'g'), {quoted(EDGES)}, '', 'g') AS s
  FROM cut WHERE regexp_matches(lower(s), {quoted(SPEAKS)})),
listed AS (
  SELECT p.doc_id, count(*) AS n_sentences, coalesce(string_agg(k.id, ',' ORDER BY pos) FILTER (k.id IS NOT NULL), '') AS sentence_ids,
         coalesce(string_agg(',' || k.id || ';', '' ORDER BY pos) FILTER (k.id IS NOT NULL), '') AS rest, count(*) FILTER (k.id IS NULL) AS n_unknown, CAST([] AS VARCHAR[]) AS names
  FROM spoken p LEFT JOIN known k ON p.s = k.sentence GROUP BY p.doc_id),
r0 AS (FROM listed),
{", ".join(steps)}
SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids, coalesce(array_to_string(names, ','), '') AS licences,
       coalesce(length(rest) - length(replace(rest, ';', '')), 0) AS n_unexplained, coalesce(n_unknown, 0) AS n_unknown
FROM documents d LEFT JOIN {last} USING (doc_id)"""
