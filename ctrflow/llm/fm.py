"""Quality score by a factorisation machine over hashed words, structure figures and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.llm.arrays import blocks, utf8, words
from ctrflow.scratch import materialize

#: Parts of the training sample that are fitted side by side.
PARTS = 4

_LINE = np.ones(256, bool)
_LINE[10] = False


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    lut = np.zeros(256, bool)
    for a, b in ranges:
        lut[a : b + 1] = True
    return lut


_CLASSES = (
    _class((65, 90)), _class((97, 122)), _class((48, 57)), _class((32, 32), (9, 13)), _class((128, 255)),
    _class((33, 33), (63, 63)), _class((124, 124)), _class((35, 38), (42, 43), (60, 62), (64, 64), (94, 96)),
    _class((46, 46), (44, 44), (58, 59)),
)
N_FIGURES = len(_CLASSES) + 10


def _rate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def features(
    column: pa.Array, meta: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word weights (index, value, row offsets; unit length per row) and structure figures."""
    data, offsets = utf8(column)
    rows = len(offsets) - 1
    size = np.diff(offsets)
    figures = [np.log1p(size), np.log1p(meta), (size == 0).astype(float)]
    for lut in _CLASSES:
        figures.append(_rate(np.diff(np.concatenate(([0], np.cumsum(lut[data])))[offsets]), size))
    word, ends = words(data, offsets)
    n = np.diff(ends)
    row = np.repeat(np.arange(rows), n)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    mask = np.uint64((1 << bits) - 1)
    key = (row.astype(np.uint64) << np.uint64(bits)) | (word & mask)
    found, count = np.unique(key, return_counts=True)
    at = (found >> np.uint64(bits)).astype(np.int64)
    index = (found & mask).astype(np.int64)
    cuts = np.searchsorted(at, np.arange(rows + 1))
    most = np.zeros(rows)
    np.maximum.at(most, at, count)
    line, line_ends = words(data, offsets, _LINE)
    line_row = np.repeat(np.arange(rows), np.diff(line_ends))
    order = np.lexsort((line, line_row))
    again = np.zeros(len(line), bool)
    again[1:] = (line[order][1:] == line[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    lines = np.diff(line_ends)
    figures += [
        np.log1p(n), np.log1p(_rate(size, n)), _rate(np.diff(cuts), n), _rate(most, n),
        _rate(np.bincount(row[same], minlength=rows), n), np.log1p(_rate(size, lines)),
        _rate(np.bincount(line_row[order][again], minlength=rows), lines),
    ]
    value = np.log1p(count)
    length = np.sqrt(np.bincount(at, value**2, minlength=rows))
    value = value / np.maximum(length, 1e-12)[at]
    return index, value, cuts, np.column_stack(figures)


@dataclass
class Machine:
    """Logistic factorisation machine; hashed words first, then standardised figures."""

    bits: int
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def joined(self, index, value, cuts, figures):
        """One sparse row per document with its figures behind its words."""
        rows, k = figures.shape
        z = np.clip((figures - self.mean) / self.scale, -4, 4) / np.sqrt(k)
        size = np.diff(cuts) + k
        ends = np.concatenate(([0], np.cumsum(size)))
        idx, val = np.empty(ends[-1], np.int64), np.empty(ends[-1])
        is_figure = np.zeros(ends[-1], bool)
        is_figure[(ends[1:, None] - k + np.arange(k)).ravel()] = True
        idx[is_figure], val[is_figure] = np.tile(np.arange(k) + (1 << self.bits), rows), z.ravel()
        idx[~is_figure], val[~is_figure] = index, value
        return idx, val, ends

    def logits(self, idx, val, ends):
        """Linear part and ½ Σ_f [(Σ v x)² - Σ v² x²], so in time linear in the features."""
        vx = self.factor[idx] * val[:, None]
        sums = np.add.reduceat(vx, ends[:-1], axis=0)
        squares = np.add.reduceat((vx**2).sum(1), ends[:-1])
        linear = np.add.reduceat(self.weight[idx] * val, ends[:-1])
        return self.bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums, vx

    def train(self, idx, val, ends, label, epochs: int, rate: float, decay: float, seed: int) -> None:
        """Adam on the log loss, in mini-batches."""
        rng = np.random.default_rng(seed)
        size, k = self.factor.shape
        m, v = np.zeros((size, k + 1)), np.zeros((size, k + 1))
        mb = vb = 0.0
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(label))
            for some in np.array_split(order, max(1, len(order) // 128)):
                step += 1
                n = ends[some + 1] - ends[some]
                cut = np.concatenate(([0], np.cumsum(n)))
                flat = np.arange(cut[-1]) - np.repeat(cut[:-1], n) + np.repeat(ends[some], n)
                i, x = idx[flat], val[flat]
                z, sums, vx = self.logits(i, x, cut)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[some]) / len(some)
                row = np.repeat(np.arange(len(some)), n)
                push = error[row] * x
                grad = np.empty((size, k + 1))
                grad[:, 0] = np.bincount(i, push, minlength=size)
                inner = push[:, None] * (sums[row] - vx)
                for f in range(k):
                    grad[:, f + 1] = np.bincount(i, inner[:, f], minlength=size)
                grad[:, 0] += decay * self.weight
                grad[:, 1:] += decay * self.factor
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
                self.weight -= move[:, 0]
                self.factor -= move[:, 1:]
                gb = float(error.sum())
                mb += 0.1 * (gb - mb)
                vb += 0.01 * (gb**2 - vb)
                self.bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)


def _meta(batch: pa.RecordBatch, name: str = "m") -> np.ndarray:
    return np.maximum(np.nan_to_num(pc.fill_null(batch.column(name).cast(pa.float64()), 0.0).to_numpy()), 0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    where: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    meta: str | None = "n_chars",
    max_rows: int = 12_000,
    bits: int = 12,
    factors: int = 6,
    rounds: int = 3,
    epochs: int = 3,
    rate: float = 0.02,
    decay: float = 1e-6,
) -> Machine:
    """Fit on a sample of the labelled rows, about ``max_rows`` at most, drawn by a hash of the key.

    Labels join by ``key``; null keys and labels take no part, repeated labels count once. Each round
    fits ``PARTS`` parts of the sample side by side, and the driver averages what they return: one
    machine per part, of a size that does not depend on the data. Without labelled rows of both
    kinds the machine only knows their share (one half if there are none).
    """
    known = labels.where(where) if where is not None else labels
    known = known.select(F.col(key).alias("k"), F.col(label).cast("double").alias("y")).dropna().distinct()
    total = known.count()
    share = min(1.0, max_rows / max(total, 1))
    spread = (F.xxhash64(F.col("k").cast("string"), F.lit(7)).bitwiseAND(F.lit((1 << 30) - 1))) / (1 << 30)
    # near max_rows rows of two numbers, whatever the size of the tables
    sample = F.broadcast(known.where(spread < share))
    rows = docs.select(
        F.col(key).alias("k"), F.col(text).alias("t"),
        (F.col(meta).cast("double") if meta else F.lit(0.0)).alias("m"),
    ).join(sample, "k")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "t"):
            index, value, cuts, figures = features(block.column("t"), _meta(block), bits)
            ends = pa.array(cuts.astype(np.int32))
            per = pa.array(np.arange(len(cuts)) * figures.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("y"),
                    pc.cast(pc.bit_wise_and(pa.array(np.arange(len(cuts) - 1)), PARTS - 1), pa.int32()),
                    pa.ListArray.from_arrays(ends, pa.array(index, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(value)),
                    pa.ListArray.from_arrays(per, pa.array(figures.ravel())),
                ],
                ["y", "part", "i", "x", "z"],
            )

    read = rows.mapInArrow(
        extract, "y double, part int, i array<int>, x array<double>, z array<double>"
    )
    ready = materialize(read, "fm")
    per_figure = ready.select(F.posexplode("z").alias("f", "v")).groupBy("f").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")
    )
    mean, scale = np.zeros(N_FIGURES), np.ones(N_FIGURES)
    for f, a, sd in per_figure.collect():
        mean[f], scale[f] = a, max(sd, 1e-6)
    share_of = ready.agg(F.avg("y"), F.count("y")).first()
    p = min(max(share_of[0] if share_of[1] else 0.5, 1e-3), 1 - 1e-3)
    size = (1 << bits) + N_FIGURES
    start = np.random.default_rng(3).normal(0, 0.05, (size, factors))
    machine = Machine(bits, float(np.log(p / (1 - p))), np.zeros(size), start, mean, scale)
    if not share_of[1] or share_of[0] in (0.0, 1.0):
        machine.factor[:] = 0
        return machine
    for turn in range(rounds):
        begin = docs.sparkSession.sparkContext.broadcast(machine)

        def fitted(part: pa.Table) -> pa.Table:
            here = begin.value
            own = Machine(bits, here.bias, here.weight.copy(), here.factor.copy(), here.mean, here.scale)
            part = part.combine_chunks()

            def flat(name):
                column = part.column(name).combine_chunks()
                return column.values.to_numpy(), column.offsets.to_numpy()

            index, cuts = flat("i")
            figures = flat("z")[0].reshape(-1, N_FIGURES)
            data = own.joined(index, flat("x")[0], cuts, figures)
            own.train(*data, part.column("y").to_numpy(), epochs, rate, decay, turn)
            return pa.table({
                "n": [part.num_rows], "bias": [own.bias], "w": [own.weight.tolist()], "v": [own.factor.ravel().tolist()]
            })

        got = ready.groupBy("part").applyInArrow(
            fitted, "n bigint, bias double, w array<double>, v array<double>"
        ).toArrow().to_pylist()
        n = sum(g["n"] for g in got)
        machine.bias = sum(g["bias"] * g["n"] for g in got) / n
        machine.weight = sum(np.array(g["w"]) * g["n"] for g in got) / n
        machine.factor = (sum(np.array(g["v"]) * g["n"] for g in got) / n).reshape(size, factors)
    return machine


def score(
    docs: DataFrame, machine: Machine, text: str = "text", meta: str | None = "n_chars",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``score`` (probability of label 1) to every row, from its whole text; null counts as empty."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    out = T.StructType([*[docs.schema[c] for c in keep], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for block in blocks(batches, "__t"):
            read = features(block.column("__t"), _meta(block, "__m"), machine.bits)
            z = machine.logits(*machine.joined(*read))[0]
            prob = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*[block.column(c) for c in keep], pa.array(prob)], [*keep, "score"]
            )

    frame = docs.select(
        *[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__t"),
        (docs[f"`{meta}`"].cast("double") if meta else F.lit(0.0)).alias("__m"),
    )
    return frame.mapInArrow(run, out)
