"""Licence scan: normalised sentences become identifiers, identifier sequences are matched against ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "S01": "Released under the MIT License.",
    "S02": "Licensed under the MIT License.",
    "S03": "Licensed under the Apache License, Version 2.0.",
    "S04": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "S05": "This work is licensed under the GNU General Public License, version 3.",
    "S06": "Licensed under CC BY-NC 4.0.",
    "S07": "Licensed under CC BY 4.0.",
    "S08": "Licensed under CC BY-SA 4.0.",
    "S09": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "S10": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "S11": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "S12": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "S13": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "S14": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "S15": "You may not use this file except in compliance with the License.",
    "S16": "You may obtain a copy of the License at",
    "S17": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "S18": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "S19": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "S20": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "S21": "This is free and unencumbered software released into the public domain.",
}

# A licence and the sentences that announce it, in order.  Earlier rules take their sentences first.
RULES = [
    ("BSD-3-Clause", ["S11", "S12", "S13", "S14"]),
    ("BSD-2-Clause", ["S11", "S12", "S13"]),
    ("Apache-2.0", ["S04", "S15", "S16"]),
    ("MIT", ["S09", "S10"]),
    ("MIT", ["S01"]),
    ("MIT", ["S02"]),
    ("Apache-2.0", ["S03"]),
    ("Apache-2.0", ["S04"]),
    ("GPL-3.0", ["S05"]),
    ("GPL-3.0-or-later", ["S17"]),
    ("GPL-2.0-or-later", ["S18"]),
    ("CC-BY-NC-4.0", ["S06"]),
    ("CC-BY-4.0", ["S07"]),
    ("CC-BY-SA-4.0", ["S08"]),
    ("MPL-2.0", ["S19"]),
    ("ISC", ["S20"]),
    ("Unlicense", ["S21"]),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def marked(text: Column) -> Column:
    """Normalised text between two line feeds, sentence ends as ``\\x01``.

    A sentence ends at ``.``, ``!``, ``?``, ``;`` or ``:`` followed by a blank; of what it says only letters a-z (either case)
    and digits count, other runs are one blank.  Blanks and signs around a line feed are dropped.
    """
    ended = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER + "\x01", LOWER + "-"), "[.!?;:](?:[ \\t\\x0B\\f\\r]+|(?=\\n))", "\x01")
    plain = F.regexp_replace(ended, "[^a-z0-9\\n\\x01]+", " ")
    return F.regexp_replace(F.concat(F.lit("\n"), plain, F.lit("\n")), " ?([\\n\\x01]) ?", "$1")


def known_pattern(table: dict[str, str]) -> str:
    """Known sentences that begin and end with a line or a sentence, longest first, a single line feed for a blank."""
    found = sorted(table, key=lambda s: (-len(s), s))
    return "(?<=[\\n\\x01])(?:" + "|".join(s.replace(" ", "[ \\n]") for s in found) + ")(?=[\\n\\x01])"


def _normal(sentence: str) -> list[str]:
    import re

    parts = re.sub(r"([.!?;:])[ \t\x0b\f\r]+", "\\1\n", sentence).lower().split("\n")
    return [p for p in (re.sub(r"[^a-z0-9]+", " ", part).strip() for part in parts) if p]


def sentence_table(known: dict[str, str]) -> dict[str, str]:
    """Normalised sentence to identifier.  A known text that holds several sentences gets letters: ``S18a``, ``S18b``; a sentence that several
    texts hold has one identifier, of the first of them."""
    table: dict[str, str] = {}
    for name, sentence in known.items():
        for at, part in enumerate(_normal(sentence)):
            table.setdefault(part, name + chr(ord("a") + at))
    return table


def rule_table(known: dict[str, str], rules: list[tuple[str, list[str]]]) -> list[tuple[str, str]]:
    """Licence and its identifier sequence, each identifier followed by a blank."""
    table = sentence_table(known)
    return [(licence, "".join(f"{table[part]} " for name in names for part in _normal(known[name]))) for licence, names in rules]


def scan_licenses(docs: DataFrame, known: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """Per row: ``doc_id``, ``n_sentences``, ``sentence_ids`` (known ones in order, ``-`` for unknown ones between them
    left out), ``n_matches``, ``licenses`` (names in the order of the rules, comma-joined).

    A known sentence may be wrapped over lines, with comment signs before them; a blank line or a sentence end parts it.
    ``n_sentences`` counts the pieces between line feeds and sentence ends.

    A rule matches where its identifiers follow each other among the known sentences of the text; a rule's sentences
    are used once, by the first rule in the list that fits.  The rule and sentence tables are program text of fixed
    size.  Null and empty texts have no sentences.  Each row is judged by itself, so ties, repeated rows and empty
    tables need no rule; no other column than ``doc_id`` and ``text`` is read.
    """
    table, ordered = sentence_table(known), rule_table(known, rules)
    ids = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    hits = F.transform(F.regexp_extract_all("marked", F.lit(known_pattern(table)), F.lit(0)), lambda s: F.element_at(ids, F.translate(s, "\n", " ")))
    lines = F.filter(F.split(F.translate("marked", "\x01", "\n"), "\n", -1), lambda s: F.trim(s) != "")
    out = docs.select("doc_id", marked(F.col("text")).alias("marked"))
    out = out.select("doc_id", F.size(lines).cast("long").alias("n_sentences"), hits.alias("ids"))
    out = out.withColumn("rest", F.array_join(F.transform("ids", lambda i: F.concat(i, F.lit(" "))), ""))
    out = out.withColumn("sentence_ids", F.trim("rest"))
    for at, (_, sequence) in enumerate(ordered):
        out = out.withColumn(f"rule{at}", ((F.length("rest") - F.length(F.replace("rest", F.lit(sequence), F.lit("")))) / len(sequence)).cast("long"))
        out = out.withColumn("rest", F.replace("rest", F.lit(sequence), F.lit("| ")))
    names = list(dict.fromkeys(name for name, _ in ordered))
    of = {n: sum((F.col(f"rule{at}") for at, (m, _) in enumerate(ordered) if m == n), F.lit(0)) for n in names}
    return out.select(
        "doc_id", "n_sentences", "sentence_ids",
        sum((F.col(f"rule{at}") for at in range(len(ordered))), F.lit(0)).cast("long").alias("n_matches"),
        F.concat_ws(",", *[F.when(of[n] > 0, F.lit(n)) for n in names]).alias("licenses"),
    )


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    table, ordered = sentence_table(SENTENCES), rule_table(SENTENCES, RULES)
    # Every line feed and sentence end stands twice, so that a match may take one on either side and leave the next its own.
    known = "|".join(s.replace(" ", "(?: |\\n\\n)") for s in sorted(table, key=lambda s: (-len(s), s)))
    mapped = ", ".join(f"'{s}': '{i}'" for s, i in table.items())
    steps, rest = "", "r0"
    for at, (_, sequence) in enumerate(ordered):
        steps += (f", s{at} AS (SELECT *, (length({rest}) - length(replace({rest}, '{sequence}', ''))) // {len(sequence)} AS n{at},"
                  f" replace({rest}, '{sequence}', '| ') AS r{at + 1} FROM {'base' if not at else f's{at - 1}'})")
        rest = f"r{at + 1}"
    names = list(dict.fromkeys(name for name, _ in ordered))
    cases = ", ".join(
        "CASE WHEN " + " + ".join(f"n{at}" for at, (m, _) in enumerate(ordered) if m == n) + f" > 0 THEN '{n}' END" for n in names
    )
    return rf"""
WITH ended AS (
  SELECT doc_id, regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}' || chr(1), '{LOWER}-'),
      '[.!?;:](?:[ \t\x0B\f\r]+|(\n))', chr(1) || '\1', 'g'), '[^a-z0-9\n\x01]+', ' ', 'g') AS plain
  FROM documents
), marked AS (
  SELECT doc_id, regexp_replace(chr(10) || plain || chr(10), ' ?([\n\x01]) ?', '\1', 'g') AS marked FROM ended
), found AS (
  SELECT doc_id, list_filter(string_split(translate(marked, chr(1), chr(10)), chr(10)), lambda s: trim(s, ' ') <> '') AS f,
         regexp_extract_all(regexp_replace(marked, '([\n\x01])', '\1\1', 'g'), '[\n\x01](?:{known})[\n\x01]') AS hits
  FROM marked
), base AS (
  SELECT doc_id, CAST(len(f) AS BIGINT) AS n_sentences,
         coalesce(array_to_string(list_transform(hits, lambda s: MAP {{{mapped}}}[replace(s[2:-2], chr(10) || chr(10), ' ')] || ' '), ''), '') AS r0
  FROM found
){steps}
SELECT doc_id, n_sentences, trim(r0, ' ') AS sentence_ids,
       CAST({" + ".join(f"n{at}" for at in range(len(ordered)))} AS BIGINT) AS n_matches, concat_ws(',', {cases}) AS licenses
FROM s{len(ordered) - 1}
"""


OP6_SQL = _sql()
