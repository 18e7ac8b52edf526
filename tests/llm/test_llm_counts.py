"""Collocations, mixing and the divergence audit: edges, and plain Python versions of the whole results."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ctrflow.llm import collocations, divergence, frames, mixing
from ctrflow.llm.trie import DoubleArrayTrie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, p double, phrase string, size int, key string, rank int"
EXTRA = (1, 0.5, "x", 2, "k", 3)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(parts)


def corpus(seed, n=120):
    """Short texts of few words with marks, nulls, repeated rows and one long text."""
    rng = random.Random(seed)
    words = ["Red", "blue", "É", "new", "york", "city", "a", "b", "c'd", "naïve", "x-y"]
    rows = []
    for i in range(n):
        size = rng.choice([0, 1, 5, 40])
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "-"]) for _ in range(size))
        if rng.random() < 0.6:
            text += "new york city "
        rows.append((i, rng.choice([text, text, text, None]), rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "s2", "s3", None])))
    rows += [rows[3]] * 4 + [(None, "new york city", "en", "s1"), (500, " \n\t ", "en", "s1"), (501, "\x00\x01;", "de", "s9")]
    rows.append((502, "new york city and so on. " * 3000, "en", "s3"))
    return rows


# -- collocations ------------------------------------------------------------------------------------------


def plain_collocations(rows, most, least, absorbed, reported):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    cand = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        held = any(
            lang == other and len(v) > len(w) and 100 * b >= absorbed * a
            and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (other, v), b in cand.items()
        )
        if not held:
            cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]], totals[lang], k))
    found = set()
    for lang, some in out.items():
        for rank, (score, a, phrase, left, right, n, k) in enumerate(sorted(some)[:reported], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, n, -score, k))
    return found


@pytest.mark.parametrize("most, least, trie, block", [(3, 10, 1 << 20, None), (4, 3, 40, None), (3, 5, 1 << 20, 700)])
def test_collocations_equal_plain_counts(spark, monkeypatch, most, least, trie, block):
    rows = corpus(1)
    want = plain_collocations(rows, most, least, 50, 30)
    docs = table(spark, rows)
    if block:
        # long texts are cut; tasks run in other processes, so a whole text is cut here
        whole = [r for r in rows if r[0] == 502]
        want = plain_collocations(whole, most, least, 50, 30)
        got = cut_counts(monkeypatch, whole[0], most, block)
        plain = collections.Counter()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", whole[0][1].translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                plain[k] += max(0, len(w) - k + 1)
        assert got == [plain[k] for k in range(1, most + 1)]
        return
    got = collocations.collocations(docs, most=most, least=least, reported=30, trie=trie).collect()
    assert {tuple(r) for r in got} == want and len(want) >= 5


def cut_counts(monkeypatch, row, most, block):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "BLOCK", block)
    batch = pa.RecordBatch.from_pydict({"text": [row[1]], "lang": ["en"]})
    found, blocks = [0] * most, 0
    for part, _ in collocations._blocks(iter([batch]), most):
        blocks += 1
        for level, (_, alive) in enumerate(part.chains(most, [])):
            if level == 0:
                found[0] += part.own
            else:
                found[level] += int(alive[: part.own].sum())
    assert blocks > 50
    return found


def test_collocation_edges(spark):
    none = table(spark, [(1, "a b", "en", "s")]).where("doc_id = 2")
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(table(spark, [(1, None, None, None), (2, "", "en", ""), (3, "one two", "en", "s")])).collect() == []
    same = table(spark, [(i, "x x x", None, "s") for i in range(10)])
    got = collocations.collocations(same).collect()
    # "x x" stands twenty times and "x x x" ten times, which is half of it
    assert [(r.lang, r.phrase, r.a, r.l, r.r, r.n, r.cut) for r in got] == [("und", "x x x", 10, 30, 20, 30, 1)]


def test_trie_finds_all_paths():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.choice(1 << 40, 3000, replace=False)).astype(np.uint64)
    two = np.unique(np.concatenate([rng.choice(keys, (2500, 2)), np.stack([np.full(700, keys[5]), keys[100:800]], 1)]), axis=0)
    three = np.unique(np.concatenate([two[:900], rng.choice(keys, (900, 1))], axis=1), axis=0)
    trie = DoubleArrayTrie([two, three])
    text = np.concatenate([rng.choice(keys, 4000), three[rng.integers(0, 900, 500)].ravel(), rng.integers(0, 1 << 40, 500).astype(np.uint64)])
    joined = rng.random(len(text)) < 0.9
    found = trie.matches(text, joined, 3)
    known = [set(map(tuple, two.tolist())), set(map(tuple, three.tolist()))]
    for n, (at, state) in enumerate(found, 2):
        want = [
            i for i in range(len(text) - n + 1)
            if joined[i : i + n - 1].all() and tuple(text[i : i + n].tolist()) in known[n - 2]
        ]
        assert at.tolist() == want and len(want) > 300
        assert (trie.phrases(state, n) == text[at[:, None] + np.arange(n)]).all()


# -- mixing ------------------------------------------------------------------------------------------------


def plain_targets(words, weights=(5, 2, 1), most=3):
    names = sorted((n for n in words if n is not None), key=lambda s: s.encode()) + [n for n in words if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, free, left = {}, set(names), float(sum(words.values()))
    while free:
        per = left / sum(weight[n] for n in free)
        over = {n for n in free if per * weight[n] > most * words[n]}
        if not over:
            target.update({n: per * weight[n] for n in free})
            break
        target.update({n: float(most * words[n]) for n in over})
        left -= sum(most * words[n] for n in over)
        free -= over
    return target


@pytest.mark.parametrize("fan", [128, 4])
def test_mixture(spark, fan):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 9, 60])), None, rng.choice(["a", "a", "a", "a", "b", "c", "d", None])) for i in range(900)]
    rows += [(7, "one  two\x0bthree", "x", "a")] * 20 + [(8, None, "x", "a"), (None, "", "x", "none"), (9, " \n", "x", "b"), (10, "few", "x", "tiny")]
    docs = table(spark, rows)
    got = mixing.mix(docs, fan=fan).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() >= {"doc_id", "phrase", "size", "taken", "target"}
    words = collections.Counter()
    for _, text, _, source in rows:
        words[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = plain_targets(words)
    taken, longest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.source_size == words[r.source] and r.target == pytest.approx(target[r.source], rel=1e-9)
        share = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.copies * r.size and (r.size == 0 or share - 1 < r.copies < share + 1) and r.copies <= 3
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for source, want in target.items():
        assert abs(taken[source] - want) < longest[source] + 1e-6
    # other partitions, same result
    again = mixing.mix(docs.repartition(7, "n", "text"), fan=fan).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixture_equals_the_loop(spark):
    """Groups and draws as the operator makes them, rounded one document after the other."""
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 80)), None, "ab"[i % 2]) for i in range(60)]
    fan, seed = 8, 12
    out = mixing.mix(table(spark, rows), keep=["doc_id"], fan=fan, seed=seed).collect()
    order = [r.doc_id for r in table(spark, rows).select("doc_id", F.col("source").alias("s"), F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("h")).orderBy("s", "h").collect()]
    size = {r[0]: len(r[1].split()) for r in rows}
    share = {r.doc_id: r.target / r.source_size for r in out}

    def draw(salt, seq):
        value = 42
        for v, width in ((salt, 4), (seq, 8)):
            value = xxhash.xxh64_intdigest(int(v).to_bytes(width, "little", signed=True), seed=value)
        return (value >> 11) / float(1 << 53)

    copies = {}
    for source in "ab":
        level, salt = [(order.index(d), size[d], share[d] - int(share[d]), order.index(d)) for d in order if rows[d][3] == source], seed
        last = 59
        while True:
            salt += 1
            groups, left = collections.defaultdict(list), []
            for place, words, x, seq in level:
                groups[place // fan].append((words, seq, x))
            for place, group in sorted(groups.items()):
                xs = {seq: x for _, seq, x in group}
                group.sort(reverse=True)
                for i, (words, seq, _) in enumerate(group):
                    rest = group[i + 1 :]
                    x, pool = xs[seq], sum(w for w, _, _ in rest)
                    mass = sum(w * xs[s] for w, s, _ in rest)
                    forth, back = min(words * (1 - x), mass), min(words * x, pool - mass)
                    if forth + back > 1e-9:
                        up = draw(salt, seq) * (forth + back) < back
                        x += (forth if up else -back) / words
                        for _, s, _ in rest:
                            xs[s] = xs[s] * (1 - forth / mass) if up else xs[s] + (1 - xs[s]) * back / (pool - mass)
                    if min(x, 1 - x) < 1e-9:
                        copies[order[seq]] = int(share[order[seq]]) + (x > 0.5)
                    else:
                        left.append((place, words, x, seq))
            level, last = left, last // fan
            if last == 0:
                for _, _, x, seq in level:
                    copies[order[seq]] = int(share[order[seq]]) + (draw(seed, seq) < x)
                break
    assert {r.doc_id: r.copies for r in out} == copies


def test_mixture_edges(spark):
    none = table(spark, [(1, "a b", "en", "s")]).where("doc_id = 2")
    assert mixing.mix(none).collect() == []
    got = mixing.mix(table(spark, [(1, None, "en", "s"), (2, "", "en", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    one = mixing.mix(table(spark, [(1, "a b c", None, None)])).collect()
    assert [(r.size, r.source_size, r.target, r.copies, r.taken) for r in one] == [(3, 3, 3.0, 1, 3)]


def test_side_with_many_keys_is_dealt(spark):
    side = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    rows = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id") % 60).alias("k"), "id")
    got = frames.keyed(rows, side, ["k"], limit=10, salts=8)
    assert sorted(map(tuple, got.select("id", "v").collect())) == sorted(map(tuple, rows.join(side, "k").select("id", "v").collect()))


# -- divergence --------------------------------------------------------------------------------------------


def plain_audit(rows, least, reported):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        holds = collections.Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, k in holds.items() if k >= least}
        count = {s: collections.Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in mine}}
        whole = sum(count.values(), collections.Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s in count:
            pairs = [(-sum((p(count[s], t) - p(count[o], t)) ** 2 // p(count[o], t) for t in kept), o.encode()) for o in count if o != s]
            terms = [
                (-((p(count[s], t) - p(whole, t)) ** 2 // p(whole, t)), t.encode())
                for t in count[s] if p(count[s], t) > p(whole, t)
            ]
            for part, some in (("pair", sorted(pairs)), ("term", sorted(terms)[:reported])):
                out |= {(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(some, 1)}
    return out


@pytest.mark.parametrize("least, reported", [(3, 200), (1, 4), (1000, 5)])
def test_divergence_equals_plain_sums(spark, least, reported):
    rows = corpus(7)
    got = divergence.audit(table(spark, rows), least_docs=least, reported=reported).collect()
    want = plain_audit(rows, least, reported)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r.part == "term" for r in got) == (least < 1000)


def test_divergence_of_many_sources(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(30)), "en", f"s{i % 40}") for i in range(200)]
    got = divergence.audit(table(spark, rows)).collect()
    assert {tuple(r) for r in got} == plain_audit(rows, 3, 200)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Größe 12 next-term\x00end " * 50).encode()
    whole = divergence.terms(text)
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert divergence.terms(text) == whole == collections.Counter({"größe".encode(): 50, b"next": 50, b"term": 50, b"end": 50})


def test_shared_terms_in_blocks(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    cells = [[{"id": int(s), "p": int(rng.integers(2, 10**9)), "p0": int(s) + 1} for s in rng.choice(30, rng.integers(2, 20), replace=False)] for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"cells": cells})

    def total():
        sums = collections.Counter()
        for out in divergence._shared(iter([batch])):
            for x, y, v in zip(*(out.column(i).to_pylist() for i in range(3))):
                sums[x, y] += v
        return sums

    want = collections.Counter()
    for row in cells:
        for a, b in itertools.permutations(row, 2):
            f = lambda p, q: (p - q) ** 2 // q
            want[a["id"], b["id"]] += f(a["p"], b["p"]) - f(a["p"], b["p0"]) - f(a["p0"], b["p"]) + f(a["p0"], b["p0"])
    assert total() == want
    monkeypatch.setattr(divergence, "PAIRS", 10)
    assert total() == want


def test_divergence_edges(spark):
    none = table(spark, [(1, "a b", "en", "s")]).where("doc_id = 2")
    assert divergence.audit(none).collect() == []
    got = divergence.audit(table(spark, [(1, None, None, "a"), (2, "x", None, "b"), (3, "y", "en", None)])).collect()
    assert sorted(map(tuple, got)) == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


def test_tries_share_passes_over_the_corpus(spark, monkeypatch):
    from ctrflow.llm import collocations as co

    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words[i:] + words[:i]) for i in range(30)]
    rows = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    passes, run = [], co._occurrences
    monkeypatch.setattr(co, "_occurrences", lambda *a: passes.append(a) or run(*a))
    _, _, counted = co.count_phrases(rows, 3, 10, trie=8)
    found = sorted((len(r.phrase), r.a) for r in counted.collect())
    assert found == [(2, 29)] * 30 + [(3, 28)] * 30
    assert len(passes) == 1
