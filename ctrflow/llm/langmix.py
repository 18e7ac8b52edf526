"""Language ID as a mixture: EM over n-gram likelihoods, then the set of languages by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.llm.arrays import ASCII_LOWER, blocks, utf8

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
_BLANK = 32

#: Letters of ASCII in lower case and all bytes of longer characters; other bytes are blanks.
_FOLD = np.full(256, _BLANK, np.uint8)
_FOLD[97:123] = ASCII_LOWER[97:123]
_FOLD[65:91] = ASCII_LOWER[65:91]
_FOLD[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every three bytes that are not all blank, and row offsets; rows are padded by blanks."""
    rows = len(offsets) - 1
    padded = np.full(len(data) + rows + 2, _BLANK, np.uint8)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    padded[np.arange(len(data)) + row + 1] = _FOLD[data]
    a, b, c = (padded[i : len(padded) - 2 + i].astype(np.uint32) for i in range(3))
    code = (a << np.uint32(16)) | (b << np.uint32(8)) | c
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
    # a window that starts at the blank before a row up to its last byte belongs to the row
    starts = offsets + np.arange(rows + 1)
    full = (a != _BLANK) | (b != _BLANK) | (c != _BLANK)
    # windows over the blank between two rows touch both: they start in the earlier row's last byte
    middle = starts[1:-1]
    if len(middle):
        crossing = middle[(middle > 0)] - 1
        full[crossing] &= padded[crossing] != _BLANK
        code_left = (padded[crossing].astype(np.uint32) << np.uint32(16)) | np.uint32(_BLANK << 8 | _BLANK)
        bucket[crossing] = (code_left * np.uint32(2654435761)) >> np.uint32(32 - bits)
    kept = np.flatnonzero(full)
    return bucket[kept].astype(np.int64), np.searchsorted(kept, starts).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """``prob[bucket, language]``; columns in the order of ``languages``."""

    languages: tuple[str, ...]
    prob: np.ndarray
    bits: int

    def mixture(self, bucket: np.ndarray, penalty: float = 3.0, rounds: int = 20):
        """``(full, chosen)``: weights by EM over all languages, and over the chosen set.

        The chosen set has the best likelihood less ``penalty`` times its size times the logarithm of the
        number of n-grams, searched by leaving out the lightest language again and again.
        """
        found, count = np.unique(bucket, return_counts=True)
        like = self.prob[found]
        count = count.astype(float)
        n = count.sum()
        single = count @ np.log(like)

        def em(members: np.ndarray) -> tuple[np.ndarray, float]:
            a = np.ascontiguousarray(like[:, members])
            at = np.ascontiguousarray(a.T)
            weight = np.full(len(members), 1 / len(members))
            for _ in range(rounds):
                weight = weight * (at @ (count / (a @ weight))) / n
            return weight, float(count @ np.log(a @ weight))

        members = np.arange(len(self.languages))
        full, reached = em(members)
        best_one = int(np.argmax(single))
        best = (single[best_one] - penalty * np.log(n + 1), np.array([best_one]), np.ones(1))
        weight = full
        while len(members) > 1:
            worth = reached - penalty * len(members) * np.log(n + 1)
            if worth > best[0]:
                best = (worth, members, weight)
            members = np.delete(members, np.argmin(weight))
            if len(members) > 1:
                weight, reached = em(members)
        chosen = np.zeros(len(self.languages))
        chosen[best[1]] = best[2]
        return full, chosen


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = 14) -> LanguageModel:
    """n-gram frequencies of each language over all rows of ``docs`` with text and language.

    The driver gets one number per language and bucket (2**bits of them). Without any
    such row there are no languages, and every prediction is unknown.
    """
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for block in blocks(batches, "t"):
            data, offsets = utf8(block.column("t"))
            bucket, ends = grams(data, offsets, bits)
            names = np.array(block.column("l").to_pylist(), object)
            row = np.repeat(np.arange(len(names)), np.diff(ends))
            for name in set(names.tolist()):
                here = np.bincount(bucket[(names == name)[row]], minlength=size)
                total[name] = total[name] + here if name in total else here
        for name, here in total.items():
            used = np.flatnonzero(here)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()),
                 pa.array(here[used], pa.int64())],
                ["l", "b", "n"],
            )

    rows = (
        docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
        .where("t is not null and l is not null")
        .mapInArrow(count, "l string, b int, n bigint")
        .groupBy("l", "b")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    labels = np.array(rows.column("l").to_pylist(), object)
    languages = tuple(sorted(set(labels.tolist())))
    counts = np.zeros((size, len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    counts[rows.column("b").to_numpy(), [at[x] for x in labels]] = rows.column("n").to_numpy()
    return LanguageModel(languages, (counts + 0.5) / (counts.sum(0) + 0.5 * size), bits)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``langs`` and ``weights`` to every row, from its whole text.

    ``langs`` is the chosen set, heaviest first, ``weights`` its proportions. ``lang_pred`` is the
    heaviest, ``score`` its proportion among all languages. A null text, one without
    a letter, or a model without languages gives ``und``, 0 and empty lists. Ties go to
    the language first in the alphabet. ``keep`` names the columns that stay
    (default: all but the added ones).
    """
    added = ["lang_pred", "score", "langs", "weights"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    out = T.StructType(
        [docs.schema[c] for c in keep]
        + [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("langs", T.ArrayType(T.StringType())),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    needed = list(dict.fromkeys([*keep, text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for block in blocks(batches, text):
            column = block.column(text)
            bucket, ends = grams(*utf8(column), model.bits)
            preds, scores, sets, weights = [], [], [], []
            for i in range(block.num_rows):
                raw = column[i].as_py()
                if raw is None or not model.languages or not LETTER.search(raw):
                    preds.append(UNKNOWN), scores.append(0.0), sets.append([]), weights.append([])
                    continue
                full, chosen = model.mixture(bucket[ends[i] : ends[i + 1]])
                order = [j for j in np.argsort(-chosen, kind="stable") if chosen[j] > 0]
                preds.append(model.languages[order[0]])
                scores.append(float(min(1.0, full[order[0]])))
                sets.append([model.languages[j] for j in order])
                weights.append([float(chosen[j]) for j in order])
            arrays = [block.column(c) for c in keep]
            arrays += [
                pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                pa.array(sets, pa.list_(pa.string())), pa.array(weights, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *added])

    return docs.select(*[docs[f"`{c}`"] for c in needed]).mapInArrow(run, out)
