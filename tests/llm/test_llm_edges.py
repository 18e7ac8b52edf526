"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ctrflow.llm import bpe, components, fm, jaccard, langmix, licences, mtree, passages, secretscan, shards, winnow

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
LONG = " ".join(f"w{i}" for i in range(6000))
SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint, hit string, size int, key string, label int, id string, n int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, WORDS), (2, WORDS), (2, WORDS), (3, None), (4, ""), (5, "  \n\t "), (None, WORDS), (6, LONG), (7, LONG + " end"),
        (8, "123 456"), (None, None), (9, "ünïcode Straße 🎉"),
    ]
    extra = ("en", 7, "x", 1, "k", 2, "i", 3)
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -1")


def count(df):
    return len(df.collect())


def test_secrets_edges(docs, none):
    found = secretscan.find(docs)
    assert found.columns == [*docs.columns, "strong", "spans"] and count(found) == docs.count()
    assert found.where(F.size("spans") > 0).count() == 0
    assert count(secretscan.find(none)) == 0


def test_secret_spans_and_links(spark):
    near = "user=bob then Zx9" + "aB3" * 12 + " at https://host.example/x"
    rows = [
        (1, 'é token = "0123456789abcdef01234567" x'), (2, near), (3, near.replace("user=bob", "nobody is here")),
        (4, "user=bob" + " " * 300 + "Zx9" + "aB3" * 12), (5, "secret=abc password: abcdefg"), (6, None),
        (7, "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " token=token:abcdefgh"), (8, near),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.s for r in secretscan.find(df).select("doc_id", secretscan.listed(F.col("spans")).alias("s")).collect()}
    assert got[1] == "assign:2:35,hex:11:35"
    assert got[2] == got[8] == "ident:0:8,secret:14:53,endpoint:57:79"
    assert got[3] == "" and got[4] == ""
    assert got[5] == "assign:11:28" and got[6] == ""
    assert got[7] == "access:20:40"
    clean = secretscan.find(df).select("doc_id", secretscan.redact(F.col("text"), F.col("spans")).alias("t"))
    got = {r.doc_id: r.t for r in clean.collect()}
    assert got[1] == 'é [secret]" x' and got[6] is None
    assert got[2] == "[secret] then [secret] at [secret]"


def test_positions_of_many_matches(spark):
    text = "é" + " ".join("0123456789abcdef01234567" for _ in range(700))
    df = spark.createDataFrame([(text,)], "text string").select(secretscan.spans(F.col("text"), "hex").alias("s"))
    assert [(s.start, s.stop) for s in df.first().s] == [(1 + 25 * i, 25 + 25 * i) for i in range(700)]


def test_shards_edges(spark, docs, none):
    placed = shards.shard_documents(docs, 5).collect()
    sizes = [sum(r["shard"] == s for r in placed) for s in range(5)]
    assert len(placed) == docs.count() and max(sizes) - min(sizes) <= 1
    assert {(r["size"], r["text_crc32"]) for r in placed if r["text"] is None} == {(8, 0)}
    assert count(shards.shard_documents(none, 5)) == 0
    copies = spark.range(90).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 40, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    placed = shards.shard_documents(copies, 6).collect()
    assert sorted(sum(r["shard"] == s for r in placed) for s in range(6)) == [15] * 6
    assert len({r["shard"] for r in placed if r["text"] == "same"}) <= 4


def test_passages_edges(spark, docs, none):
    got = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} == {6, 7}
    assert {(r.start, r.stop) for r in got} == {(0, 6000)}
    assert count(passages.repeated_passages(none)) == 0
    loop = " ".join(["again"] * 3000)
    one = spark.createDataFrame([(1, loop), (2, "some other words here")], "doc_id int, text string")
    assert count(passages.repeated_passages(one)) == 0
    twice = one.union(one.where("doc_id = 1").select(F.lit(3), "text"))
    assert {(r.doc_id, r.copies) for r in passages.repeated_passages(twice).collect()} == {(1, 2), (3, 2)}


def test_passages_with_a_changed_word(spark):
    body = [f"x{i}" for i in range(300)]
    other = [*body[:100], "changed", *body[101:]]
    rows = [(1, " ".join(["a b c", *body])), (2, " ".join(["q", *other, "z"]))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {(r.doc_id, r.start, r.stop) for r in got} == {(1, 3, 303), (2, 1, 301)}


def test_shared_phrases_do_not_hide_passages(spark):
    """The least document shares only a phrase; the other two share a passage around it."""
    phrase = [f"p{i}" for i in range(20)]
    body = [f"x{i}" for i in range(20)] + phrase + [f"y{i}" for i in range(20)]
    rows = [(i, " ".join([*[f"d{i}{j}" for j in range(40)], *phrase, *[f"e{i}{j}" for j in range(40)]])) for i in range(30)]
    rows += [(100 + i, " ".join([*[f"f{i}{j}" for j in range(30)], *body, *[f"g{i}{j}" for j in range(30)]])) for i in range(2)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {(r.doc_id, r.start, r.stop) for r in got} == {(100, 30, 90), (101, 30, 90)}


def test_licence_edges(spark, docs, none):
    found = licences.recognise(docs)
    assert count(found) == docs.count() and found.where(F.size("licences") > 0).count() == 0
    assert count(licences.recognise(none)) == 0
    s = licences.SENTENCES
    wrapped = "\n# ".join(" ".join(s[k] for k in ("mit-grant", "mit-notice")).split(" "))
    rows = [(1, wrapped), (2, s["mit-notice"] + " " + s["mit-grant"]), (3, "all RIGHTS reserved"), (4, "x\nReleased under the MIT License.\ny")]
    got = {r.doc_id: r.licences for r in licences.recognise(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: ["MIT"], 2: [], 3: ["all-rights-reserved"], 4: ["MIT"]}


MIT = """MIT License

{c}

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC = """ISC License

{c}

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY DAMAGES."""
BSD = """BSD 2-Clause License

{c}

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
APACHE = """{c}

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """frob, a tool
{c}

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_whole_standard_licences(spark):
    whole = {"MIT": MIT, "ISC": ISC, "BSD-2-Clause": BSD, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL}
    rows = []
    for name, words in whole.items():
        for c in ("Copyright (c) 2020 Jane Doe", "Copyright 2020 J. Doe"):
            text = words.format(c=c)
            for mark in ("", "# ", "// ", " * "):
                lines = [(mark + x).rstrip() for x in text.split("\n")]
                rows += [(name, e.join(lines)) for e in ("\n", "\r\n", "\r")]
                # without any blank line too
                rows += [(name, "\n".join(x for x in lines if x.strip(" #/*") and "License" != x[-7:]))]
    found = licences.recognise(spark.createDataFrame(rows, "name string, text string")).collect()
    assert len(found) == len(rows) and all(r["licences"] == [r["name"]] for r in found)


def test_similarity_edges(docs, none):
    got = jaccard.link_groups(docs, n=3, threshold=Fraction(9, 10)).collect()
    assert len(got) == docs.count()
    by = {(r.doc_id, (r.text or "")[:3]): (r.n_shingles, r.component_id) for r in got}
    assert by[1, "one"] == by[2, "one"] == by[None, "one"] == (12, 1)
    assert by[3, ""] == (0, 3) and by[4, ""] == (0, 4) and by[None, ""] == (0, None)
    assert by[6, "w0 "] == (5998, 6) and by[7, "w0 "] == (5999, 6)
    assert by[8, "123"] == (1, 8)
    assert count(jaccard.link_groups(none)) == 0
    left = jaccard.one_of_each(docs).collect()
    assert sorted(str(r.doc_id) for r in left) == sorted(map(str, [1, 3, 4, 5, 6, 8, 9, None]))
    assert count(jaccard.one_of_each(none)) == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(chain.union(chain)).collect()
    assert sorted((r.node, r.component) for r in got) == [(i, 0) for i in range(201)]
    assert count(components.components(chain.where("a < 0"))) == 0


def test_language_edges(spark, docs, none):
    learn = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    model = langmix.fit(learn)
    assert model.languages == ("de", "en")
    got = langmix.identify(docs, model).collect()
    assert len(got) == docs.count()
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {3, 4, 5, 8, None} - {None} | {None}
    mixed = "the cat and the dog and the cat " * 20 + "der Hund und die Katze und der Hund " * 20
    one = langmix.identify(spark.createDataFrame([(mixed,)], "text string"), model).first()
    assert set(one.langs) == {"de", "en"} and 0.3 < one.weights[0] < 0.7
    numerals = spark.createDataFrame([("²³",), ("½ ①",), ("Ⅷ 12",), ("_",), ("ª",), ("字",)], "text string")
    told = {r.text: r.lang_pred for r in langmix.identify(numerals, model).collect()}
    assert {t for t, lang in told.items() if lang == "und"} == {"²³", "½ ①", "Ⅷ 12", "_"}
    nothing = langmix.fit(learn.where("lang = 'none'"))
    assert {r.lang_pred for r in langmix.identify(docs, nothing).collect()} == {"und"}
    assert count(langmix.identify(none, model)) == 0


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (None, 1), (7, None), (1, 1)], "doc_id bigint, quality int")
    machine = fm.fit(docs, labels, "quality", max_rows=10, rounds=1, epochs=1)
    got = fm.score(docs, machine).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert count(fm.score(none, machine)) == 0
    blind = fm.fit(docs, labels.where("doc_id = -1"), "quality")
    assert {r.score for r in fm.score(docs, blind).collect()} == {0.5}


def test_bpe_edges(spark, docs, none):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257, b"bc": 258, b"abc": 259}
    got = bpe.encode(spark.createDataFrame([(1, "abab abc"), (2, None), (3, ""), (4, "a" * 5)], "k int, text string"), ranks, r"\S+|\s")
    by = {r.k: r.ids for r in got.collect()}
    assert by == {1: [257, 32, 259], 2: [], 3: [], 4: [97] * 5}
    back = bpe.decode(got, ranks).collect()
    assert {r.k: bytes(r.decoded) for r in back} == {1: b"abab abc", 2: b"", 3: b"", 4: b"aaaaa"}
    whole = bpe.encode(docs, ranks, r"(?s).", with_ids=False).collect()
    for r in whole:
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert count(bpe.encode(none, ranks, r"\S+")) == 0


def test_lower_ranks_made_on_the_way_go_first():
    """A merge can make a pair of lower rank possible; places further right then have to wait."""
    ranks = {bytes([i]): i for i in range(256)} | {b"xab": 256, b"ab": 300}
    flat, ends = bpe.Replay(ranks).encode([b"abxab", b"xabab", b"aba"])
    assert [x.tolist() for x in __import__("numpy").split(flat, ends[:-1])] == [[300, 256], [256, 300], [300, 97]]


def test_decontamination_edges(spark, docs, none):
    items = spark.createDataFrame([(1, WORDS.upper()), (2, "123, 456"), (3, None), (4, "..."), (None, "straße")], "item_id bigint, text string")
    got = winnow.contamination(docs, items)
    by = {(r.doc_id, (r.text or "")[:3]): (r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()}
    assert got.columns == [*docs.columns, "n_words", "n_hit", "n_items", "items", "contaminated"]
    assert by[1, "one"] == by[None, "one"] == (14, 14, ["1"], True)
    assert by[8, "123"] == (2, 2, ["2"], True)
    assert by[9, "ünï"] == (3, 1, [""], True)  # the picture is a word too
    assert by[3, ""] == (0, 0, [], False) and by[6, "w0 "] == (6000, 0, [], False)
    assert count(got) == docs.count()
    assert count(winnow.contamination(none, items)) == 0
    clean = winnow.contamination(docs, items.where("item_id = -1")).collect()
    assert len(clean) == docs.count() and not any(r.contaminated for r in clean)


def test_nearest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0, 2.0]), (20, [0.25, -0.01]), (20, [0.25, -0.01]),
        (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (40, [1.0]), (41, [2.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1))
    got = mtree.top_k(df, F.col("vec_id") % 20 == 0, k=3).collect()
    by = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert by[:3] == [(0, 1, 1, 64 * 64 + 32 * 32), (0, 2, 2, 64 * 64 + 32 * 32), (0, 3, 20, 64 * 16 - 32)]
    # each of the repeated rows asks for itself, and finds the other one last
    assert [r for r in by if r[0] == 20] == sorted(2 * [(20, i + 1, i, 64 * 16 - 32) for i in range(3)])
    assert [r for r in by if r[0] == 40] == [(40, 1, 41, 64 * 128)]
    assert count(mtree.top_k(df.where("vec_id = -1"), F.col("vec_id") % 20 == 0)) == 0


def test_nearest_with_many_pages(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(mtree, "PAGE", 20)
    monkeypatch.setattr(mtree, "BLOCK", 4)
    rng = np.random.default_rng(0)
    m = np.round(rng.normal(size=(400, 5)), 1)
    m[100:250] = m[100]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id bigint, embedding array<double>")
    got = mtree.top_k(df, F.col("vec_id") % 20 == 0, k=7, routes=6).collect()
    whole = np.floor(64 * m).astype(int)
    scores = whole @ whole.T
    want = []
    for q in range(0, 400, 20):
        order = sorted((x for x in range(400) if x != q), key=lambda x: (-scores[q, x], x))[:7]
        want += [(q, i + 1, x, int(scores[q, x])) for i, x in enumerate(order)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_a_long_phrase_of_other_texts_does_not_hide_a_passage(spark):
    """Most of the passage is a phrase that texts of smaller numbers hold too; whichever least tokens there are."""
    rows = []
    for j in range(6):
        phrase = [f"p{j}_{i}" for i in range(44)]
        body = [f"x{j}_{i}" for i in range(3)] + phrase + [f"y{j}_{i}" for i in range(3)]
        for i in range(12):
            own = [f"d{j}{i}_{k}" for k in range(60)]
            rows.append((100 * j + i, " ".join([*own, *phrase, *reversed(own)])))
        for i in (50, 51):
            own = [f"g{j}{i}_{k}" for k in range(60)]
            rows.append((100 * j + i, " ".join([*own, *body, *reversed(own)])))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r.doc_id for r in got} == {100 * j + i for j in range(6) for i in (50, 51)}
    assert {(r.start, r.stop) for r in got} == {(60, 110)}


def test_passages_with_insertions_and_deletions(spark):
    """One passage, not its pieces, none of which has the length by itself."""
    rows, want = [], set()
    for k, (length, at, cut) in enumerate([(90, (45,), 0), (120, (40, 80), 0), (60, (30,), 0), (90, (45,), 1), (100, (33,), 3), (70, (35,), 2)]):
        body = [f"b{k}_{i}" for i in range(length)]
        other = list(body)
        for i in reversed(at):
            other[i : i + cut] = [] if cut else ["extra"]
        for i, words in enumerate((body, other)):
            own = [f"o{k}{i}_{j}" for j in range(60)]
            rows.append((10 * k + i, " ".join([*own, *words, *reversed(own)])))
            want.add((10 * k + i, 60, 60 + len(words)))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {(r.doc_id, r.start, r.stop) for r in got} == want
    assert all(r.similarity >= 0.8 for r in got)


def test_spans_against_brute_force():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(60):
        a = np.arange(60, dtype=np.int32)
        b = a.tolist()
        for at in sorted(rng.choice(60, 4, replace=False).tolist(), reverse=True):
            new = [1000 + at] * int(rng.integers(0, 3))
            b[at : at + int(rng.integers(0, 3))] = new
        b = np.array([*range(2000, 2004), *b], np.int32)
        good = set()
        for i0 in range(60):
            for j0 in np.flatnonzero(b == a[i0]).tolist():
                for i1 in range(i0 + 9, 60):
                    for j1 in np.flatnonzero(b == a[i1]).tolist():
                        if j1 - j0 >= 9:
                            m = len(set(a[i0 : i1 + 1].tolist()) & set(b[j0 : j1 + 1].tolist()))
                            if 5 * m >= 4 * (i1 - i0 + j1 - j0 + 2 - m):
                                good.add((i0, i1 + 1, j0, j1 + 1, m))
        got = set(passages.aligned_spans(a, b, [4], 10, 4, 5))
        assert got <= good
        for x in good:
            assert any(y[0] <= x[0] and x[1] <= y[1] and y[2] <= x[2] and x[3] <= y[3] for y in got)


def test_two_phrases_of_other_texts_do_not_hide_a_changed_passage(spark):
    """Nearly all of the passage is two phrases that stand alone in many texts; the word between them is changed."""
    rows = []
    for j in range(6):
        first, last = ([f"{p}{j}_{i}" for i in range(44)] for p in "pq")
        for i in range(24):
            own = [f"d{j}{i}_{k}" for k in range(60)]
            rows.append((100 * j + i, " ".join([*own, *(last if i % 2 else first), *reversed(own)])))
        for i in (50, 51):
            own = [f"g{j}{i}_{k}" for k in range(60)]
            body = [*first, *[f"x{j}_{k}" for k in range(5)], f"changed{i}", *[f"y{j}_{k}" for k in range(5)], *last]
            rows.append((100 * j + i, " ".join([*own, *body, *reversed(own)])))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {(r.doc_id, r.start, r.stop) for r in got} == {(100 * j + i, 60, 159) for j in range(6) for i in (50, 51)}


def test_pipeline_language_stage_without_labels(spark):
    import corpus_pipeline

    rows = [(1, "some words", None, "x", 10), (2, "123 _ 4", None, "x", 7), (3, None, None, "x", 0), (4, "é", None, "x", 1), (5, "", None, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.language(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS and sorted(r.doc_id for r in got.collect()) == [1, 4]


def test_small_sets_at_a_low_threshold(spark):
    """Sets of one and two elements share one at 1/2; the other texts of that element are linked with neither."""
    rows, want = [], {}
    for k in range(10):
        texts = [f"a{k}", f"a{k} x{k}", *[" ".join([f"a{k}", *[f"y{k}_{i}_{j}" for j in range(9)]]) for i in range(30)]]
        for i, text in enumerate(texts):
            rows.append((100 * k + i, text))
            want[100 * k + i] = 100 * k + (0 if i == 1 else i)
    for size in range(1, 5):
        # two of four, three of four and so on
        words = [f"z{size}_{i}" for i in range(2 * size)]
        rows += [(5000 + 10 * size, " ".join(words[:size])), (5001 + 10 * size, " ".join(words))]
        want |= {5000 + 10 * size: 5000 + 10 * size, 5001 + 10 * size: 5000 + 10 * size}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard.link_groups(docs, n=1, threshold=Fraction(1, 2)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_copies_beyond_the_threshold_are_not_paired(spark, monkeypatch):
    """A large group of near copies, most of them too far from each other: few pairs are compared, no link is lost."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(240):
        words = list(base)
        # one change each is near enough to another one, three or more are not
        for k, at in enumerate(rng.sample(range(5, 145), (1, 3, 4, 3)[i % 4])):
            words[at] = f"c{i}_{k}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i, w in ((i, t.split(" ")) for i, t in rows)}
    linked = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])
    ]
    root = list(range(len(rows)))
    for _ in rows:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    compared = []
    verified = jaccard._verified

    def counted(pairs, known, threshold):
        compared.append(pairs.count())
        return verified(pairs, known, threshold)

    monkeypatch.setattr(jaccard, "_verified", counted)
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = jaccard.link_groups(docs, n=3, threshold=Fraction(9, 10)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))
    assert sum(compared) < 10 * len(rows)


def test_near_copies_beyond_the_threshold_seldom_meet(spark, monkeypatch):
    """Elements of a large group of near copies that are too far from each other lead to few pairs, linked ones included."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(240):
        words = list(base)
        for k, at in enumerate(rng.sample(range(5, 145), 3 + i % 3)):
            words[at] = f"c{i}_{k}"
        if i % 20 == 0:
            # a copy of the one before with a change of its own
            words = rows[-1][1].split(" ") if rows else words
            words[i % 150] = f"own{i}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split(" ")) for i, t in rows)}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = list(range(len(rows)))
    for _ in rows:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    met = []
    meetings = jaccard._meetings

    def counted(*how):
        found = meetings(*how)
        met.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_meetings", counted)
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = jaccard.link_groups(docs, n=5, threshold=Fraction(4, 5)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))
    assert len(met) == 1 and met[0] < 40 * len(rows)
