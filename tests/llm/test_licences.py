from cellweave.llm import licences

SCHEMA = "doc_id bigint, text string, id string, at int, line int, sentence string, left string, named string"

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
"""


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 1, 2, "clash", "clash", "clash") for i, t in rows], SCHEMA)
    return licences.recognised(docs)


def test_whole_and_partial_licences(spark):
    got = {r.doc_id: r for r in found(spark, [
        (1, MIT), (2, "Some text.\nReleased under the MIT License.\nMore text"), (3, "Licensed under CC BY-NC 4.0."),
        (4, "This work is licensed under the GNU General Public License, version 3. Released under the MIT License."),
        (5, "junk without a stop\nLicensed under the Apache License, Version 2.0.\n"), (6, "We talk of the MIT License here."),
        (7, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following\ndisclaimer in the "
            "documentation and/or other materials provided with the distribution.\nNeither the name of Foo Bar nor the names of its contributors may be used "
            "to endorse or promote products derived from this software without specific prior written permission."),
        (8, "You may obtain a copy of the License at"), (9, "All rights reserved.\nLicensed under CC BY-SA 4.0; Released under the MIT License!"),
        (10, "Released under the MIT License. " * 20_000), (11, ""), (12, None), (None, "MIT License"), (13, "Licensed under\r\nCC BY 4.0.\r\n\r\nx"),
    ]).collect()}
    names = {i: r.licences for i, r in got.items()}
    assert names == {1: ["MIT"], 2: ["MIT"], 3: ["CC-BY-NC-4.0"], 4: ["MIT", "GPL-3.0-only"], 5: ["Apache-2.0"], 6: [], 7: ["BSD-3-Clause"], 8: [],
                     9: ["MIT", "CC-BY-SA-4.0"], 10: ["MIT"], 11: [], 12: [], None: ["MIT"], 13: ["CC-BY-4.0"]}
    assert got[1].sequence == "<mit><mit-grant><mit-notice><mit-asis>" and got[8].n_unmatched == 1 and got[10].n_sentences == 20_000


def test_rules_are_specific_first_and_use_up_sentences():
    # A run that an earlier rule uses up inside a later one would make the later rule useless.
    runs = [licences.run_of(run) for _, run in licences.RULES]
    assert not any(earlier in later for n, later in enumerate(runs) for earlier in runs[:n])
    assert {i for _, run in licences.RULES for i in run} <= licences.SENTENCES.keys()


def test_sentences_are_normalised(spark):
    from pyspark.sql import functions as F
    forms = [s for known in licences.SENTENCES.values() for s in known]
    assert len(forms) == len(set(forms))
    rows = spark.createDataFrame([(s,) for s in forms], "s string")
    assert rows.where(licences.normalised(F.col("s")) != F.col("s")).count() == 0


LESSER = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version %s of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""


def test_versions_of_the_lesser_licence_and_reserved_rights(spark):
    grant = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    rest = ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution.")
    rows = [(1, LESSER % "2.1"), (2, LESSER % "3"), (3, "This library is free software; come and see."), (4, "Copyright X. All rights reserved.\n\n"
            + "\n\n".join((grant, *rest))), (5, "All rights reserved."), (6, "Distributed under the MIT License. All rights reserved."),
            (7, "Licensed under the GNU Lesser General Public License, version 2.1."),
            (8, (LESSER % "2").replace("Lesser General", "General").replace("library", "program")),
            (9, (LESSER % "3").replace("Foundation; either", "Foundation, either"))]
    got = {r.doc_id: (r.licences, r.n_unmatched) for r in found(spark, rows).collect()}
    assert got == {1: (["LGPL-2.1-or-later"], 0), 2: (["LGPL-3.0-or-later"], 0), 3: ([], 1), 4: (["BSD-2-Clause"], 1), 5: (["Proprietary"], 0),
                   6: (["MIT"], 1), 7: (["LGPL-2.1-only"], 0), 8: (["GPL-2.0-or-later"], 0), 9: (["LGPL-3.0-or-later"], 0)}


def test_every_row_is_a_document_and_empty_table(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "All rights reserved."),
            (None, "MIT License"), (None, "All rights reserved."), (None, None), (None, "MIT License")]
    got = sorted((r.doc_id or 0, r.n_sentences, r.licences) for r in found(spark, rows).collect())
    assert got == [(0, 0, []), (0, 1, ["MIT"]), (0, 1, ["MIT"]), (0, 1, ["Proprietary"]), (1, 1, ["MIT"]), (1, 1, ["MIT"]), (1, 1, ["Proprietary"])]
    empty = found(spark, [])
    assert empty.count() == 0 and "Python" not in empty._jdf.queryExecution().executedPlan().toString()
