"""Byte-level BPE by replaying merges over all words of a block at once.

The distinct words of a block of the corpus are laid out as one array of tokens. An inverted index
from the rank of a pair to its positions gives, in rank order, all places where
that merge applies; only the pairs next to a merged one are looked up again. Words are independent of
each other, so blocks are too, and no word has to be exchanged between tasks. Each task
keeps the words it has seen, up to a bound, so later blocks replay merges for new words only.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Distinct words kept by a worker, new ones per replay, words of texts held at a time (as numbers).
KEPT_WORDS, NEW_WORDS, HELD_WORDS = 400_000, 250_000, 8_000_000
#: Characters of a text beyond which its words are taken some at a time.
LONG_TEXT = 4_000_000

NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a blank, its rank, per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Replay:
    """The merges of a vocabulary, applied to many words together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        pairs, self.unsafe = {}, set()
        for whole, rank in ranks.items():
            for cut in range(1, len(whole)):
                left, right = ranks.get(whole[:cut]), ranks.get(whole[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
                    # a part of higher rank than the whole: making it may enable an earlier merge
                    self.unsafe.update(x for x in (left, right) if x > rank)
        self.keys = np.array(sorted(pairs) or [-1], np.int64)
        self.values = np.array([pairs.get(int(k), NONE) for k in self.keys], np.int64)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of the words (none of them empty), one after the other, and where each ends."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(size)
        n = int(ends[-1])
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        right = np.arange(1, n + 1)
        right[ends - 1] = -1
        left = np.arange(-1, n - 1)
        left[ends - size] = -1
        alive = np.ones(n, bool)
        rank = np.full(n, NONE, np.int64)
        inner = np.flatnonzero(right >= 0)
        rank[inner] = self.pair_ranks(token[inner], token[inner + 1])
        # positions by rank: single ones, and arrays of them
        index: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        heap: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            if len(ranks) < 16:
                for k, at in zip(ranks.tolist(), places.tolist()):
                    if k not in index:
                        index[k] = ([], [])
                        heapq.heappush(heap, k)
                    index[k][0].append(at)
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for k, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
                if k not in index:
                    index[k] = ([], [])
                    heapq.heappush(heap, k)
                index[k][1].append(places[a:b])

        some = inner[rank[inner] != NONE]
        enter(rank[some], some)
        while heap:
            r = heapq.heappop(heap)
            single, arrays = index.pop(r)
            p = np.concatenate([np.array(single, np.int64), *arrays]) if arrays else np.array(single, np.int64)
            p = p[rank[p] == r]
            if len(p) > 1:
                p.sort()
                p = p[np.concatenate(([True], p[1:] != p[:-1]))]
            elif not len(p):
                continue
            if r in self.unsafe:
                # the new token may enable a merge of lower rank: one place per word at a time
                head = np.ones(len(p), bool)
                head[1:] = word[p[1:]] != word[p[:-1]]
                if not head.all():
                    enter(np.full(len(p) - int(head.sum()), r), p[~head])
                    p = p[head]
            elif len(p) > 1:
                # of places that overlap (a a a), every other one, from the left
                touching = np.zeros(len(p), bool)
                touching[1:] = right[p[:-1]] == p[1:]
                if touching.any():
                    spot = np.arange(len(p))
                    run = spot - np.maximum.accumulate(np.where(touching, 0, spot))
                    p = p[run % 2 == 0]
            gone = right[p]
            after = right[gone]
            token[p] = r
            right[p] = after
            left[after[after >= 0]] = p[after >= 0]
            alive[gone] = False
            rank[gone] = NONE
            before = left[p]
            touched = np.concatenate((p, before[before >= 0]))
            other = right[touched]
            new = np.full(len(touched), NONE, np.int64)
            has = other >= 0
            new[has] = self.pair_ranks(token[touched[has]], token[other[has]])
            rank[touched] = new
            some = new != NONE
            enter(new[some], touched[some])
        counts = np.bincount(word[alive], minlength=len(words))
        return token[alive], np.cumsum(counts)


class _Codes(dict):
    """Numbers for words, given on first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class WordTable:
    """Words by number, with the count and text of their ids, the ids as bytes, and what the ids decode to."""

    def __init__(self, ranks: dict[bytes, int]):
        self.replay = Replay(ranks)
        self.clear()

    def clear(self) -> None:
        self.codes = _Codes()
        self.counts: list[int] = []
        self.texts: list[str] = []
        self.packed: list[bytes] = []
        self.decoded: list[bytes] = []

    def fill(self) -> None:
        """Encode the words that have a number but no ids yet."""
        new = [w.encode("utf-8") for w in itertools.islice(self.codes, len(self.counts), None)]
        ranks, token = self.replay.ranks, self.replay.token
        # a word that is a token needs no merges
        flat, ends = self.replay.encode([w for w in new if w not in ranks])
        ids, packed = flat.tolist(), flat.astype(np.int32).tobytes()
        texts, pieces, ends = list(map(str, ids)), [token[i] for i in ids], iter(ends.tolist())
        a = 0
        for w in new:
            if w in ranks:
                i = ranks[w]
                self.counts.append(1)
                self.texts.append(str(i))
                self.packed.append(i.to_bytes(4, "little"))
                self.decoded.append(token[i])
            else:
                b = next(ends)
                self.counts.append(b - a)
                self.texts.append(",".join(texts[a:b]))
                self.packed.append(packed[4 * a : 4 * b])
                self.decoded.append(b"".join(pieces[a:b]))
                a = b


_TABLES: dict[str, WordTable] = {}


def _word_table(ranks: dict[bytes, int], name: str) -> WordTable:
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = WordTable(ranks)
    return _TABLES[name]


class _Document:
    def __init__(self, keep_ids: bool):
        self.n, self.ids, self.text = 0, hashlib.sha256(), hashlib.sha256()
        self.parts: list[bytes] | None = [] if keep_ids else None

    def add(self, codes: array, table: WordTable) -> None:
        if self.n and codes:
            self.ids.update(b",")
        self.ids.update(",".join([table.texts[c] for c in codes]).encode())
        self.text.update(b"".join([table.decoded[c] for c in codes]))
        self.n += sum([table.counts[c] for c in codes])
        if self.parts is not None:
            self.parts.append(b"".join([table.packed[c] for c in codes]))


def _runs(pattern, text: str) -> Iterator[list[str]]:
    """The matches in a text, some at a time if it is long."""
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    matches = (m[0] for m in pattern.finditer(text))
    while some := list(itertools.islice(matches, LONG_TEXT // 8)):
        yield some


def _encoded(texts: Iterator[str | None], table: WordTable, pattern, keep_ids: bool) -> list[_Document]:
    done: list[_Document] = []
    held: list[tuple[_Document, array]] = []
    n = 0

    def flush() -> None:
        table.fill()
        for document, codes in held:
            document.add(codes, table)
        held.clear()
        if len(table.codes) > KEPT_WORDS:
            table.clear()

    for text in texts:
        done.append(_Document(keep_ids))
        for words in _runs(pattern, text or ""):
            held.append((done[-1], array("I", map(table.codes.__getitem__, words))))
            n += len(words)
            if n >= HELD_WORDS or len(table.codes) - len(table.counts) >= NEW_WORDS:
                flush()
                n = 0
    flush()
    return done


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    keep: list[str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Encode and decode the whole text of every row.

    Adds ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas), ``decoded_sha256`` (of the
    bytes the ids decode to) and, by default, ``ids``. ``keep`` names the columns that stay
    (default: all but those added); a null text counts as empty, with no ids.
    Each match of ``pattern`` is encoded by itself; special tokens are ordinary text. A word
    that is a token as a whole is that token. Text that no match covers is left out.
    Repeated rows stay repeated. A column of an added name is replaced.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    fields = [docs.schema[c] for c in keep]
    out = T.StructType(
        fields
        + [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    )
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _word_table(shared.value, name)
        words = regex.compile(pattern)
        for batch in batches:
            done = _encoded((t.as_py() for t in batch.column(names[text])), table, words, with_ids)
            arrays = [batch.column(names[c]) for c in keep]
            arrays += [
                pa.array([d.n for d in done], pa.int64()),
                pa.array([d.ids.hexdigest() for d in done], pa.string()),
                pa.array([d.text.hexdigest() for d in done], pa.string()),
            ]
            if with_ids:
                ends = np.cumsum([0, *[d.n for d in done]])
                flat = np.frombuffer(b"".join([b"".join(d.parts) for d in done]), np.int32)
                arrays.append(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *added])

    needed = list(dict.fromkeys([*keep, text]))
    names = {c: i for i, c in enumerate(needed)}
    return docs.select(*[docs[f"`{c}`"] for c in needed]).mapInArrow(run, out)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that a column of ids stands for; null ids and unknown ids give null."""
    shared = df.sparkSession.sparkContext.broadcast({i: t for t, i in ranks.items()})
    keep = [c for c in df.columns if c != name]
    out = T.StructType([*[df.schema[c] for c in keep], T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value
        for batch in batches:
            found = []
            for row in batch.column(ids):
                row = row.as_py()
                known = row is not None and all(i in token for i in row)
                found.append(b"".join([token[i] for i in row]) if known else None)
            arrays = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.binary())], [*keep, name])

    return df.mapInArrow(run, out)
