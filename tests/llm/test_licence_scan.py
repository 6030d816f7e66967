from quernstone.llm.licence_scan import RULES, SENTENCES, scan_licences

from .frames import awkward, clashing, empty

TEXTS = {
    "Some words.\nReleased under the MIT License.": "MIT",
    "Licensed under the\nApache License, Version 2.0. You may not use this file except in compliance with the License.": "Apache-2.0",
    "# This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "GPL-3.0-or-later",
    "Licensed under CC BY-NC 4.0. Released under the MIT License.": "MIT,CC-BY-NC-4.0",
    "Licensed under CC BY-NC 4.0.\nAgain: licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "The driving licence office is closed.": "",
    "Nothing to see.": "",
    "": "",
}


def test_known_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert {r.text: r.licences for r in scan_licences(docs).collect()} == TEXTS


def test_longer_rules_consume(spark):
    whole = " ".join(f"{SENTENCES[k].capitalize()}." for k in ("mit_grant", "mit_notice", "mit_as_is"))
    row = scan_licences(spark.createDataFrame([(1, whole)], "doc_id long, text string")).first()
    assert (row.sentence_ids, row.licences, row.n_unexplained, row.n_unknown) == ("mit_grant,mit_notice,mit_as_is", "MIT", 0, 0)


def test_every_sentence_is_its_own_normal_form(spark):
    docs = spark.createDataFrame([(k, s) for k, s in SENTENCES.items()], "doc_id string, text string")
    assert all(r.sentence_ids == r.doc_id for r in scan_licences(docs).collect())
    assert {x for _, run in RULES for x in run} <= set(SENTENCES)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "licences", "__ids")
    got = scan_licences(docs)
    assert got.count() == docs.count() and {r.licences for r in got.collect()} == {""}
    assert scan_licences(empty(spark)).count() == 0


MIT_NOTICE = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD_NOTICE = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL_NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_wrapped_notices_in_comments(spark):
    rows = []
    for licence, notice in (("MIT", MIT_NOTICE), ("BSD-2-Clause", BSD_NOTICE), ("GPL-3.0-or-later", GPL_NOTICE)):
        lines = notice.split("\n")
        rows.append((licence, notice))
        rows += [(licence, "code = 1\n" + "\n".join(mark + x for x in lines) + "\nmore()") for mark in ("# ", "// ", " * ", "-- ", ";; ", "% ")]
        rows.append((licence, "/*\n" + "\n".join(" * " + x for x in lines) + "\n */\nint x;"))
    docs = spark.createDataFrame(rows, "wanted string, text string")
    assert [(r.wanted, r.text) for r in scan_licences(docs).collect() if r.licences != r.wanted] == []


def test_known_sentences_of_the_caller_pass_the_gate(spark):
    known, rules = {"beer": "you can do what you like with this stuff"}, [("Beerware", ["beer"])]
    docs = spark.createDataFrame([(1, "Hello. You can do what you like with this stuff. Bye."), (2, "No word of it.")], "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.n_sentences) for r in scan_licences(docs, known, rules).collect()}
    assert got == {1: ("Beerware", 1), 2: ("", 0)}


def test_bytes_that_are_not_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'FF2052656C656173656420756E64657220746865204D4954204C6963656E73652E' AS STRING) AS text")
    assert scan_licences(docs).first().licences == "MIT"
