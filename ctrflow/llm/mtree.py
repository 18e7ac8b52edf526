"""Exact top-k by inner product with an M-tree of pages.

Routing objects are vectors of the table; every vector belongs to the nearest one, and each
such node is cut into leaf pages of bounded size that keep, per entry, its distance to the routing object. With
p the routing object, |x - p| stored and |q - p| computed once per node, the inner product of q and x is at most
``q.p + |q| |x - p|`` (Cauchy-Schwarz) and ``(|q|^2 + |x|^2 - (|q - p| - |x - p|)^2) / 2`` (triangle
inequality). A query first searches its own page, whose k-th best score is a floor; then it
goes only to nodes, and is compared only with entries, whose bounds reach the floor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.scratch import local_table, materialize

#: Routing objects (drawn by a hash of the id), entries of a page, queries of a block; all on average.
ROUTES, PAGE, BLOCK = 64, 256, 256
#: Largest integers that doubles hold exactly.
_EXACT = float(1 << 53)


def quantised(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null unless all components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(vector.isNotNull() & ~bad, whole)


@dataclass
class Node:
    """A routing object with what is below it: entries, nearest and farthest distance, largest square norm."""

    route: np.ndarray
    count: int = 0
    near: float = 0.0
    far: float = 0.0
    norm: float = 0.0

    @property
    def pages(self) -> int:
        return max(1, -(-self.count // PAGE))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    if a.size and b.size and np.abs(a).max() * float(np.abs(b).max()) * a.shape[1] >= _EXACT:
        return np.array(a.astype(object) @ b.T.astype(object))
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64)


def _bound(qp, qn, q2, x2, near, far):
    """Upper bound of inner products, where distances to the routing object lie in [near, far]; with slack for rounding."""
    gap = np.maximum(0.0, np.maximum(qp[1] - far, near - qp[1]))
    best = np.minimum(qp[0] + qn * far, (q2 + x2 - gap**2) / 2)
    return best + 1e-6 + 1e-9 * (np.abs(best) + q2 + x2)


def _to_route(vectors: np.ndarray, route: np.ndarray):
    v, r = vectors.astype(float), route.astype(float)
    return v @ r, np.sqrt(np.maximum(((v - r) ** 2).sum(1), 0.0))


def _packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Components of list vectors one after the other, and their offsets."""
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()


def _by_size(column: pa.Array):
    """Vectors of a batch as matrices, one for each dimension: ``(dimension, rows, matrix)``."""
    flat, ends = _matrix(column)
    size = np.diff(ends)
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        yield dim, rows, flat[(ends[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)


def _nodes(vectors: DataFrame, routes: int) -> dict[int, Node]:
    """A bounded number of routing objects by number; the origin, -1 - dimension, where there is none of that size."""
    drawn = vectors.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(routes).select("v").collect()
    return {i: Node(np.array(v, np.int64)) for i, v in enumerate(sorted({tuple(r[0]) for r in drawn}))}


def _placed(vectors: DataFrame, nodes: dict[int, Node]) -> DataFrame:
    """Adds ``node``, ``dist`` and the square norm ``norm`` to each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.empty(batch.num_rows, np.int64)
            dist, norm = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for dim, rows, m in _by_size(batch.column("v")):
                own = [i for i, n in nodes.items() if len(n.route) == dim]
                norm[rows] = (m.astype(float) ** 2).sum(1)
                if own:
                    away = np.column_stack([_to_route(m, nodes[i].route)[1] for i in own])
                    best = away.argmin(1)
                    node[rows], dist[rows] = np.array(own)[best], away[np.arange(len(rows)), best]
                else:
                    node[rows], dist[rows] = -1 - dim, np.sqrt(norm[rows])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "id", "v")], pa.array(node), pa.array(dist), pa.array(norm)],
                ["row", "id", "v", "node", "dist", "norm"],
            )

    return vectors.mapInArrow(run, "row bigint, id bigint, v array<bigint>, node bigint, dist double, norm double")


_PAGE = "node bigint, page int, n int, ids binary, entries binary, dists binary, norms binary, v binary"


def _page(part: pa.Table) -> pa.Table:
    """A leaf page as one row."""
    part = part.combine_chunks()
    return pa.table({
        "node": part.column("node")[:1], "page": part.column("page")[:1], "n": pa.array([part.num_rows], pa.int32()),
        "ids": [_packed(part.column("id").to_numpy())], "entries": [_packed(part.column("row").to_numpy())],
        "dists": [_packed(part.column("dist").to_numpy())], "norms": [_packed(part.column("norm").to_numpy())],
        "v": [_packed(_matrix(part.column("v").chunk(0))[0])],
    })


def _best(scores: np.ndarray, ids: np.ndarray, entries: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((entries[some], ids[some], -scores[some]))[:k]]


def top_k(
    table: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding", scale: int = 64,
    routes: int = ROUTES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each query row the k other rows of highest inner product.

    Components are ``floor(scale * x)``, scores exact integers, ties go to the smaller id. Rows with a null id
    or a vector that is null or holds null or non-finite components take no part; vectors are compared with those of
    their own length. A repeated row is a row of its own, so it can be found, and asks, for itself.
    """
    spark = table.sparkSession
    source = table.select(
        F.col(id).cast("bigint").alias("id"), quantised(F.col(vector), scale).alias("v"), is_query.alias("asks")
    ).where("id is not null and v is not null")
    vectors = materialize(source.withColumn("row", F.monotonically_increasing_id()), "vectors")
    nodes = _nodes(vectors, routes)
    placed = materialize(_placed(vectors.select("row", "id", "v"), nodes).join(
        vectors.where("asks").select(F.col("row").alias("asking")), F.col("row") == F.col("asking"), "left"
    ), "placed")
    for r in placed.groupBy("node").agg(
        F.count(F.lit(1)), F.min("dist"), F.max("dist"), F.max("norm")
    ).collect():
        node = nodes.setdefault(r[0], Node(np.zeros(-1 - r[0], np.int64)) if r[0] < 0 else None)
        node.count, node.near, node.far, node.norm = r[1], r[2], r[3], r[4]
    sizes = local_table(spark, "node bigint, pages int", [(i, n.pages) for i, n in nodes.items()])
    paged = placed.join(F.broadcast(sizes), "node").withColumn(
        "page", F.pmod(F.xxhash64("row"), F.col("pages").cast("bigint")).cast("int")
    )
    pages = materialize(paged.drop("pages", "asking").groupBy("node", "page").applyInArrow(_page, _PAGE), "pages")

    def seed(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        asks = np.flatnonzero(part.column("asking").is_valid().to_numpy())
        n = part.num_rows
        floor = np.full(len(asks), -np.inf)
        column = part.column("v").chunk(0)
        if len(asks) and n > k:
            m = _matrix(column)[0].reshape(n, -1)
            for at in range(0, len(asks), 256):
                some = asks[at : at + 256]
                scores = _products(m[some], m).astype(float)
                scores[np.arange(len(some)), some] = -np.inf
                floor[at : at + len(some)] = np.partition(scores, n - k, axis=1)[:, n - k]
        taken = pa.array(asks)
        return pa.table({
            "q": part.column("row").take(taken), "query": part.column("id").take(taken),
            "v": pa.chunked_array([column.take(taken)]), "floor": pa.array(floor),
        })

    seeded = paged.groupBy("node", "page").applyInArrow(
        seed, "q bigint, query bigint, v array<bigint>, floor double"
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floor = batch.column("floor").to_numpy()
            for dim, rows, m in _by_size(batch.column("v")):
                q2 = (m.astype(float) ** 2).sum(1)
                qn = np.sqrt(q2)
                for i, node in nodes.items():
                    if len(node.route) != dim or not node.count:
                        continue
                    bound = _bound(_to_route(m, node.route), qn, q2, node.norm, node.near, node.far)
                    go = pa.array(rows[bound >= floor[rows]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(go), i)), *[batch.column(c).take(go) for c in ("q", "query", "v", "floor")]],
                        ["node", "q", "query", "v", "floor"],
                    )

    visits = materialize(seeded.mapInArrow(route, "node bigint, q bigint, query bigint, v array<bigint>, floor double"), "visits")
    wanted = {r[0]: r[1] for r in visits.groupBy("node").count().collect()}
    blocks = local_table(spark, "node bigint, blocks bigint, pages int", [
        (i, -(-c // BLOCK), nodes[i].pages) for i, c in wanted.items()
    ])

    def block(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        return pa.table({
            "node": part.column("node")[:1], "pages": part.column("pages")[:1],
            "qs": [_packed(part.column("q").to_numpy())], "queries": [_packed(part.column("query").to_numpy())],
            "floors": [_packed(part.column("floor").to_numpy())], "qv": [_packed(_matrix(part.column("v").chunk(0))[0])],
        })

    asked = (
        visits.join(F.broadcast(blocks), "node")
        .withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")))
        .groupBy("node", "block")
        .applyInArrow(block, "node bigint, pages int, qs binary, queries binary, floors binary, qv binary")
        .withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
        .drop("pages")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _search(row, nodes[row["node"]], k)
                if found is not None:
                    yield found

    found = asked.join(pages, ["node", "page"]).mapInArrow(
        search, "q bigint, query_id bigint, vec_id bigint, entry bigint, score bigint"
    )
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "entry")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _search(row: dict, node: Node, k: int) -> pa.RecordBatch | None:
    """The best entries of one page for each query of a block, as far as bounds let them reach the floors."""
    n, dim = row["n"], len(node.route)
    qs, queries = np.frombuffer(row["qs"], np.int64), np.frombuffer(row["queries"], np.int64)
    floors = np.frombuffer(row["floors"], float)
    q = np.frombuffer(row["qv"], np.int64).reshape(len(qs), dim)
    ids, entries = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["entries"], np.int64)
    dists, norms = np.frombuffer(row["dists"], float), np.frombuffer(row["norms"], float)
    v = np.frombuffer(row["v"], np.int64).reshape(n, dim)
    q2 = (q.astype(float) ** 2).sum(1)
    to_route = _to_route(q, node.route)
    bound = _bound(
        (to_route[0][:, None], to_route[1][:, None]), np.sqrt(q2)[:, None], q2[:, None], norms[None, :], dists[None, :], dists[None, :]
    )
    reach = bound >= floors[:, None]
    some_q, some_x = np.flatnonzero(reach.any(1)), np.flatnonzero(reach.any(0))
    if not len(some_q):
        return None
    scores = _products(q[some_q], v[some_x])
    out = []
    for i, at in enumerate(some_q.tolist()):
        fit = np.flatnonzero((scores[i] >= floors[at]) & (entries[some_x] != qs[at]))
        best = fit[_best(scores[i][fit], ids[some_x][fit], entries[some_x][fit], k)]
        out.append((np.full(len(best), at), some_x[best], scores[i][best]))
    at, x, score = (np.concatenate(c) for c in zip(*out))
    return pa.RecordBatch.from_arrays(
        [pa.array(qs[at]), pa.array(queries[at]), pa.array(ids[x]), pa.array(entries[x]), pa.array(score.astype(np.int64))],
        ["q", "query_id", "vec_id", "entry", "score"],
    )
