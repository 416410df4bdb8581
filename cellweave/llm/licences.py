"""Licence recognition by sentences and ordered rules.

A text is cut into sentences, each is normalised (letters a-z and digits, one space between), and known licence sentences
are replaced by their identifiers. The sequence of identifiers of a document is then read by ordered rules: every rule
is a run of identifiers that names a licence, and what a rule has used is not there for later ones, so that longer and
more specific rules come first. A rule of ``ONLY_ALONE`` names a licence only where no rule before it did. Identifiers
that no rule uses are counted as unmatched.

A sentence may be wrapped over lines, and a line may stand alone without a full stop; so both the sentence across
line breaks and each of its lines are looked up. Sentences that are not known do not interrupt a sequence.

The sentence table is a constant of this module and joins as a broadcast; only known sentences are moved.

Defined cases: a null or empty text has no sentence; every row is a document and has a row in the result, whatever its id:
inside, a document is named by its id and a 64-bit hash of its text, and rows equal in both are recognised once; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts, normalised, with the identifiers they stand for.
SENTENCES = {
    "apache2": ("licensed under the apache license version 2 0",
                "licensed under the apache license version 2 0 the license",
                "this project is licensed under the apache license version 2 0",
                "distributed under the apache license version 2 0"),
    "apache2-use": ("you may not use this file except in compliance with the license",),
    "apache2-copy": ("you may obtain a copy of the license at",
                     "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    "apache2-asis": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed "
                     "on an as is basis without warranties or conditions of any kind either express or implied",),
    "apache2-see": ("see the license for the specific language governing permissions and limitations under the license",),
    "mit": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "mit license",
            "distributed under the mit license"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
                  "files the software to deal in the software without restriction including without limitation the rights to use copy "
                  "modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software "
                  "is furnished to do so subject to the following conditions",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "mit-asis": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
                 "of merchantability fitness for a particular purpose and noninfringement",),
    "gpl3": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"),
    "gpl2": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"),
    "gpl-free": ("this program is free software",),
    "gpl2-later": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
                   "software foundation either version 2 of the license or at your option any later version",),
    "gpl3-later": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
                   "software foundation either version 3 of the license or at your option any later version",),
    "gpl-asis": ("this program is distributed in the hope that it will be useful but without any warranty",),
    "lgpl": ("licensed under the gnu lesser general public license version 3",),
    "lgpl21": ("licensed under the gnu lesser general public license version 2 1",),
    "lgpl-free": ("this library is free software",),
    # The notices of the GNU licences have a semicolon before their version, so it is a sentence of its own.
    "gpl-terms": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
                  "foundation",),
    "lgpl-terms": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
                   "software foundation",),
    "version2-later": ("either version 2 of the license or at your option any later version",),
    "version21-later": ("either version 2 1 of the license or at your option any later version",),
    "version3-later": ("either version 3 of the license or at your option any later version",),
    "lgpl21-later": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
                     "free software foundation either version 2 1 of the license or at your option any later version",),
    "lgpl3-later": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
                    "free software foundation either version 3 of the license or at your option any later version",),
    "lgpl-asis": ("this library is distributed in the hope that it will be useful but without any warranty",),
    "agpl": ("licensed under the gnu affero general public license version 3",),
    "mpl2": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
                  "conditions are met",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
                   "disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd-name": ("neither the name of holder nor the names of its contributors may be used to endorse or promote products derived from this "
                 "software without specific prior written permission",),
    "isc-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                  "provided that the above copyright notice and this permission notice appear in all copies",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "cc0": ("this work is dedicated to the public domain under cc0 1 0",),
    "cc-by": ("licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4 0",),
    "cc-by-nc": ("licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "cc-by-nd": ("licensed under cc by nd 4 0",),
    "reserved": ("all rights reserved",),
}

# Rules in the order they are tried: the licence, and the run of sentences that names it.
RULES = (
    ("Apache-2.0", ("apache2", "apache2-use", "apache2-copy", "apache2-asis", "apache2-see")),
    ("Apache-2.0", ("apache2", "apache2-use", "apache2-copy")),
    ("Apache-2.0", ("apache2",)),
    ("MIT", ("mit", "mit-grant", "mit-notice", "mit-asis")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "version3-later", "gpl-asis")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "version2-later", "gpl-asis")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "version3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "version2-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later", "gpl-asis")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later", "gpl-asis")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later")),
    ("GPL-3.0-only", ("gpl3",)),
    ("GPL-2.0-only", ("gpl2",)),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-terms", "version21-later", "lgpl-asis")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl-terms", "version3-later", "lgpl-asis")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-terms", "version21-later")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl-terms", "version3-later")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-later", "lgpl-asis")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-later", "lgpl-asis")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-later")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-later")),
    ("LGPL-3.0", ("lgpl",)),
    ("LGPL-2.1-only", ("lgpl21",)),
    ("AGPL-3.0", ("agpl",)),
    ("MPL-2.0", ("mpl2",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("Proprietary", ("reserved",)),
)
# Words that also stand in licence texts: they say something only where nothing else does.
ONLY_ALONE = ("Proprietary",)

_CUT = "\x01"
USED = "|"


def normalised(sentence: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    return F.regexp_replace(plain, "^neither the name of .+ nor the names of ", "neither the name of holder nor the names of ")


def run_of(ids: tuple[str, ...]) -> str:
    return "".join(f"<{i}>" for i in ids)


def known_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, at, line, sentence_id`` of every known sentence: its place, and 0 for a whole sentence or the number of its line.

    ``id`` names the document, see ``_name``.
    """
    marked = F.regexp_replace(F.regexp_replace(F.col(f"`{text}`"), r"([.!?;])[ \t\r\n]+", "$1" + _CUT), r"\r?\n[ \t\r]*\n", _CUT)
    sentences = docs.select(_name(key, text).alias("id"), F.posexplode_outer(F.split(marked, _CUT)).alias("at", "sentence"))
    lines = F.when(F.contains("sentence", F.lit("\n")), F.concat(F.array("sentence"), F.split("sentence", "\n"))).otherwise(F.array("sentence"))
    each = sentences.select("id", "at", F.posexplode_outer(lines).alias("line", "sentence"))
    table = docs.sparkSession.createDataFrame([(s, i) for i, forms in SENTENCES.items() for s in forms], "sentence string, sentence_id string")
    return (each.select("id", "at", "line", normalised(F.col("sentence")).alias("sentence"))
            .join(F.broadcast(table), "sentence").select("id", "at", "line", "sentence_id"))


def _name(key: str, text: str) -> Column:
    """What tells documents apart: the id and the text. Structs are equal where nulls meet nulls."""
    return F.struct(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"))


def recognised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_sentences, sequence, licences, n_unmatched``: one row per row; ``licences`` is an array."""
    found = known_sentences(docs, key, text).distinct()
    rows = found.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line", "sentence_id"))),
                                 lambda x: F.concat(F.lit("<"), x["sentence_id"], F.lit(">"))), "").alias("sequence"))
    step = rows.withColumn("read", _read(F.col("sequence"))).select("id", "n_sentences", "sequence", "read.left", "read.named")
    sizes = docs.groupBy(_name(key, text).alias("id")).agg(F.count(F.lit(1)).alias("n_rows"))
    each = F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))
    return sizes.join(step, "id", "left").withColumn("row", each).select(
        F.col("id.doc_id").alias("doc_id"), F.coalesce("n_sentences", F.lit(0).cast("bigint")).alias("n_sentences"),
        F.coalesce("sequence", F.lit("")).alias("sequence"),
        F.coalesce(F.array_distinct("named"), F.array().cast("array<string>")).alias("licences"),
        F.coalesce(F.regexp_count(F.col("left"), F.lit("<")), F.lit(0)).cast("bigint").alias("n_unmatched"))


def _read(sequence: Column) -> Column:
    """``left, named``: rules tried one after the other, each on what the former left.

    One small expression runs over the list of rules; a chain of one column per rule compiles to a method that grows with them.
    """
    rules = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(run_of(ids)).alias("run"), F.lit(licence in ONLY_ALONE).alias("alone"))
                      for licence, ids in RULES])
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("named"))

    def tried(state: Column, rule: Column) -> Column:
        fits = F.contains(state["left"], rule["run"]) & (~rule["alone"] | (F.size(state["named"]) == 0))
        used = F.struct(F.replace(state["left"], rule["run"], F.lit(USED)).alias("left"),
                        F.concat(state["named"], F.array(rule["licence"])).alias("named"))
        return F.when(fits, used).otherwise(state)

    return F.aggregate(rules, start, tried)
