"""Every query of the corpus operators on the smallest tables: against SQL, brute force or held-out rows."""

import hashlib
import itertools
import os
import re
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
import tiktoken
from oracle import compare, connect

import corpus_pipeline
from ctrflow.llm.bpe import read_ranks
from ctrflow.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    result, *_ = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert result == "ok"


def test_shards(spark, texts):
    got = rows(spark, "op2_shards")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    shards = defaultdict(list)
    groups = defaultdict(set)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["law"] == "rows" and r["grown_shard"] is None
        shards[r["shard"]].append(r["slot"])
        groups[raw].add(r["shard"])
    sizes = [len(shards[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    assert sum(len(g) > 1 for g in groups.values()) <= 24


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_sets(texts, n):
    out = {}
    for doc, text in texts.items():
        w = words_of(text)
        out[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    return out


def components(sets, p, q):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        m = len(sets[a] & sets[b])
        if m and m * q >= (len(sets[a]) + len(sets[b]) - m) * p:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def test_similarity_groups(spark, texts):
    sets = shingle_sets(texts, 3)
    want = components(sets, 9, 10)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op5_jaccard")}
    assert got == {d: (len(sets[d]), want[d]) for d in texts}
    assert len(set(want.values())) < len(texts)


def test_every_shared_passage_is_found(spark, texts):
    places = defaultdict(set)
    for doc, text in texts.items():
        w = words_of(text)
        for i in range(len(w) - 49):
            places[tuple(w[i : i + 50])].add((doc, i))
    want, got = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len({d for d, _ in found}) > 1:
            for doc, i in found:
                want[doc].update(range(i, i + 50))
    for r in rows(spark, "op3_passages"):
        assert r["similarity"] >= 0.8 and r["stop"] - r["start"] >= 50
        got[r["doc_id"]].update(range(r["start"], r["stop"]))
        if r["similarity"] == 1.0:
            own, other = words_of(texts[r["doc_id"]]), words_of(texts[r["rep_doc_id"]])
            length = r["stop"] - r["start"]
            assert own[r["start"] : r["stop"]] == other[r["rep_start"] : r["rep_start"] + length]
    assert want and all(want[d] <= got[d] for d in want)


def test_tokens(spark, texts):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows(spark, "op8_bpe"):
        text = texts[r["doc_id"]] or ""
        ids = reference.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_language_of_held_out_documents(spark):
    langs = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    got = rows(spark, "op6_language")
    assert len(got) == len(langs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held) > 0


def test_quality_of_held_out_documents(spark):
    marked = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    got = rows(spark, "op7_quality")
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in got if r["held_out"] and r["doc_id"] in marked]
    assert sum(r["predicted"] == marked[r["doc_id"]] for r in held) >= 0.85 * len(held) > 0


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        from ctrflow.scratch import materialize

        docs = materialize(stage(spark, docs, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["language"]) == {d for d, t in texts.items() if t and re.search(r"[^\W\d_]", t)}
    groups = components(shingle_sets(kept["language"], 5), 4, 5)
    assert set(kept["near_duplicates"]) == {d for d, c in groups.items() if d == c}
    assert set(kept["decontamination"]) < set(kept["near_duplicates"])
    assert set(kept["secrets"]) == set(kept["decontamination"])
    assert not any(re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", t) for t in kept["secrets"].values())
    strong = r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}"
    for d, t in kept["decontamination"].items():
        assert ("[secret]" in kept["secrets"][d]) == bool(re.search(strong, t))
        assert kept["secrets"][d] == t or "[secret]" in kept["secrets"][d]
    final = {r.doc_id: r for r in docs.collect()}
    assert set(final) == set(kept["secrets"])
    for d, r in final.items():
        assert r.decoded_sha256 == hashlib.sha256(kept["secrets"][d].encode()).hexdigest()
        assert r.n_tokens == len(r.ids)
