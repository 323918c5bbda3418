"""Operators on odd and ordinary texts, held against brute force."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventloom.llm.jaccard_join import one_per_class, set_classes
from eventloom.llm.license_scan import scan_licences
from eventloom.llm.order_minhash import compare_with_next
from eventloom.llm.pii import pii_report, redact_documents
from eventloom.llm.quality_rules import keep_good, quality_report
from eventloom.llm.substring_dedup import remove_repeated_windows
from eventloom.llm.suffix_dedup import remove_repeated_bytes, without_repeated_bytes
from tests.llm import brute

# Small blocks, so that even these few documents lie in several.
SMALL = {"block_bytes": 9_000, "bucket_bytes": 20_000}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_set_classes(docs, texts, rows_of, width, percent):
    got = rows_of(
        set_classes(docs, width=width, percent=percent, **SMALL),
        "doc_id", "n_shingles", "component_id",
    )
    want = brute.classes(texts, width, percent)
    assert {i: (n, c) for i, n, c in got} == want
    assert len({c for _, c in want.values()}) < len(want)


def test_long_lists_in_parts(docs, texts, rows_of):
    got = rows_of(set_classes(docs, list_part=2, **SMALL), "doc_id", "n_shingles", "component_id")
    assert {i: (n, c) for i, n, c in got} == brute.classes(texts)


def test_one_per_class(docs, texts):
    stay = {r.doc_id for r in one_per_class(docs, **SMALL).collect()}
    assert stay == {i for i, (_, c) in brute.classes(texts).items() if i == c}


@pytest.mark.parametrize("width", [35, 4])
def test_repeated_windows(docs, texts, rows_of, width):
    got = rows_of(
        remove_repeated_windows(docs, width=width, keep_texts=True, **SMALL),
        "n_words", "n_removed", "kept_sha256", "kept_text",
    )
    want = brute.without_windows(texts, width)
    assert [r[:3] for r in got] == want
    assert [brute.sha(r[3]) for r in got] == [w[2] for w in want]
    assert sum(w[1] for w in want) > 500


@pytest.mark.parametrize("length", [100, 64])
def test_repeated_bytes(docs, texts, rows_of, length):
    got = rows_of(
        remove_repeated_bytes(docs, length=length, **SMALL),
        "n_bytes", "n_removed", "n_spans", "kept_sha256",
    )
    want = brute.without_bytes(texts, length)
    assert got == want
    assert sum(w[1] for w in want) > 2000


def test_texts_without_repeated_bytes(docs, texts):
    rest = {r.doc_id: r for r in without_repeated_bytes(docs, **SMALL).collect()}
    want = {i: w for (i, _), w in zip(texts, brute.without_bytes(texts), strict=True)}
    assert set(rest) == {i for i, w in want.items() if w[1] == 0 or w[1] < w[0]}
    assert rest[10].text is None and rest[11].text == ""
    untouched = [i for i, w in want.items() if w[1] == 0]
    assert all(rest[i].text == dict(texts)[i] for i in untouched)
    assert rest[20].lang == dict((r.doc_id, r.lang) for r in docs.collect())[20]


def test_rule_counts(docs, texts, labels, rows_of):
    got = rows_of(
        quality_report(docs, labels), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )
    for (_, text), row in zip(texts, got, strict=True):
        n, *_, repeated = want = brute.rule_counts(text)
        assert row[:5] == want
        assert row[5] == (n < 10 or 100 * repeated > 20 * n)
        assert not (row[5] and row[6])


def test_base_spans(docs, texts, rows_of):
    got = rows_of(pii_report(docs), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for (_, text), row in zip(texts, got, strict=True):
        spans = brute.base_spans(text)
        joined = ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)
        assert row[:4] == tuple(sum(s[2] == kind for s in spans) for kind in brute.PII)
        assert row[4] == brute.sha(joined)
        assert set(joined.split(",")) <= set(row[5].split(",")) | {""}


def test_redacted(docs, texts):
    rest = {r.doc_id: r.text for r in redact_documents(docs).collect()}
    assert rest[10] is None
    for i, text in texts:
        if not brute.base_spans(text):
            assert rest[i] == text
    assert rest[32] == "write to [EMAIL] or a@b or [EMAIL]; [PHONE] now".replace(
        "[EMAIL];", "[EMAIL]@q.r;"
    )


def test_fingerprints(docs, texts):
    got = {r.doc_id: r for r in compare_with_next(docs).collect()}
    for k, (i, text) in enumerate(texts):
        text, following = text or "", texts[(k + 1) % len(texts)][1] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), brute.sha(changed))
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
        if text == following:
            assert got[i].near_next == 1 and got[i].fingerprint == got[i + 1].fingerprint
        if text == changed:
            assert got[i].near_edited == 1
    long = got[26]
    assert long.near_edited > 0.3 > long.near_next


def test_order_counts_in_fingerprints(spark):
    from eventloom.llm.order_minhash import likeness, with_signature

    words = [f"w{i}" for i in range(400)]
    moved = [w for k in range(0, 400, 4) for w in (words[k + 2 : k + 4] + words[k : k + 2])]
    rows = [(" ".join(words), " ".join(words[:200] + words[210:])), (" ".join(words), " ".join(moved))]
    df = spark.createDataFrame(rows, "a string, b string")
    df = with_signature(with_signature(df, "a", "x"), "b", "y")
    near, far = (r.v for r in df.select(likeness("x", "y").alias("v")).collect())
    assert near > 0.8 and far < near - 0.2


def test_licences(docs, spark, rows_of):
    got = {r.doc_id: r for r in scan_licences(docs).collect()}
    assert (got[31].licences, got[31].n_sentences) == ("Apache-2.0", 1)
    assert got[10].licences == got[11].licences == ""
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on."
    notice = "The above copyright notice and this permission notice shall be included in all copies."
    asis = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.'
    rows = [
        (1, f"Copyright (c) 2020 X\n{grant}\n{notice}\n{asis}"),
        (2, f"{notice} {asis}"),  # no rule begins with these
        (3, f"{asis}\n{grant}"),  # out of order
        (4, "This work is licensed under the GNU General Public License, version 3.\n" * 2),
        (5, "Released under the MIT License. Then: licensed under CC BY-NC 4.0."),
    ]
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found, "doc_id", "n_sentences", "licences", "unmatched") == [
        (1, 4, "MIT", "copyright"), (2, 2, "", "mit_notice,asis_software"),
        (3, 2, "", "asis_software,mit_grant"), (4, 2, "GPL-3.0", ""),
        (5, 2, "MIT,CC-BY-NC-4.0", ""),
    ]


def test_all_licences_of_a_sentence(spark, rows_of):
    gpl = "General Public License, version 3"
    rows = [
        (1, f"Licensed under the GNU Lesser {gpl}."),
        (2, f"It is under the terms of the GNU Affero {gpl}."),
        (3, "Licensed under the MIT License or the Apache License, Version 2.0."),
        (4, "Licensed under either of Apache License, Version 2.0 or MIT license at your option."),
        (5, f"Licensed under the GNU Lesser {gpl} or the GNU {gpl}."),
        (6, "// SPDX-License-Identifier: MIT"),
        (7, "# SPDX-License-Identifier: (Apache-2.0 OR GPL-2.0-or-later) */"),
        (8, "SPDX-License-Identifier: Zlib"),
    ]
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found, "doc_id", "n_sentences", "licences", "unmatched") == [
        (1, 1, "LGPL", ""), (2, 1, "AGPL", ""), (3, 2, "Apache-2.0,MIT", ""),
        (4, 2, "Apache-2.0,MIT", ""), (5, 2, "LGPL,GPL-3.0", ""), (6, 1, "MIT", ""),
        (7, 2, "Apache-2.0,GPL-2.0", ""), (8, 1, "", "spdx_other"),
    ]


MIT = """MIT License

Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files, to deal in the Software.

The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED.
"""
BSD = """Copyright 2019 X
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice in the documentation.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products.

THIS SOFTWARE IS PROVIDED BY THE HOLDERS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
APACHE = """Licensed under the Apache License,
Version 2.0 (the "License"); you may not use this file except
in compliance with the License.

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY.
"""
WRAPPED = {
    MIT: (4, "MIT", "copyright"), BSD: (7, "BSD-3-Clause", "copyright,all_rights"),
    APACHE: (3, "Apache-2.0", ""), GPL: (3, "GPL-or-later", ""),
    "It is placed in the public\ndomain.": (1, "Public-Domain", ""),
}


def test_wrapped_licence_texts(spark, rows_of):
    marked = lambda text, mark: "".join(mark + x for x in text.splitlines(True))
    rows, want = [], []
    for text, result in WRAPPED.items():
        for form in (
            text, text.replace("\n", "\r\n"), f"/*\n{marked(text, ' * ')} */\nint x;",
            marked(text, "# "), marked(text, "// "), marked(text, "dnl "),
        ):
            rows.append((len(rows), form))
            want.append((len(want), *result))
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found, "doc_id", "n_sentences", "licences", "unmatched") == want


OPERATORS = {
    "classes": lambda d, labels: set_classes(d, **SMALL),
    "one": lambda d, labels: one_per_class(d, **SMALL),
    "windows": lambda d, labels: remove_repeated_windows(d, **SMALL),
    "bytes": lambda d, labels: remove_repeated_bytes(d, **SMALL),
    "cut": lambda d, labels: without_repeated_bytes(d, **SMALL),
    "rules": lambda d, labels: quality_report(d, labels),
    "good": lambda d, labels: keep_good(d, labels),
    "pii": lambda d, labels: pii_report(d),
    "redact": lambda d, labels: redact_documents(d),
    "fingerprints": lambda d, labels: compare_with_next(d),
    "licences": lambda d, labels: scan_licences(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, no_docs, labels):
    assert OPERATORS[name](no_docs, labels).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_null_ids_and_clashing_names(name, odd_docs, labels):
    found = OPERATORS[name](odd_docs, labels)
    n = odd_docs.count()
    if name in ("one", "good", "cut", "redact"):
        assert found.columns == odd_docs.columns
        own = found.select("kept", "label", "block").distinct().collect()
        assert [tuple(r) for r in own] == [("own kept", "own label", "own block")]
    if name in ("one", "good", "cut"):
        assert 0 < found.count() < n
    else:
        assert found.count() == n
        assert found.where(F.col("doc_id").isNull()).count() == 1
        twice = found.where("doc_id in (18, 22)").drop("doc_id")
        if name != "bytes":
            assert twice.distinct().count() <= 2


def test_repeated_rows_lose_their_windows(odd_docs):
    found = remove_repeated_windows(odd_docs, **SMALL).where("doc_id = 22")
    assert [(r.n_words - r.n_removed) for r in found.collect()] == [0, 0]
