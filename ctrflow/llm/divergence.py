"""Source divergence audit: how the sources of a language differ in their terms.

One pass over the bytes of a text with a translate table lowers letters and blanks out separators; splitting and a
counter per document give its terms. Counts are summed per language, source and term, and stay
sparse from there on: a term that a source lacks has one and the same probability in it, so divergences
are computed from the terms that occur, and corrected by how many do not.

The divergence of two sources sums ``f(p, q)`` over all kept terms of the language. With ``p0`` and ``q0`` for
terms that do not occur, that is ``V * f(p0, q0)``, plus what the terms of the first source add to it against
``q0``, plus what those of the second add against ``p0``, plus a correction for terms that
both have. Only the last looks at pairs of sources within a term; it is summed inside tasks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ctrflow.llm.frames import keyed, small_or_not, table
from ctrflow.llm.registry import query
from ctrflow.scratch import discard, materialize

#: Documents of a language that a term must stand in; units of a probability; terms reported per source.
LEAST_DOCS, UNIT, REPORTED = 3, 1_000_000_000, 200
#: Terms that a task holds before it passes counts on, and bytes of a text that are split at a time.
HELD, PIECE = 250_000, 8 << 20
#: Pairs of sources that are looked at together.
PAIRS = 1 << 20

#: Letters of ASCII in lower case and all bytes of longer characters; other bytes are blanks.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes) -> Counter:
    """Number of occurrences of each term of a text."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + PIECE
        # a long text is cut behind a whole term
        while end < len(text) and TABLE[text[end]] != 0x20:
            end += 1
        found.update(text[at:end].translate(TABLE).split())
        at = end
    return found


_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term of a task's texts; without a term, of documents."""
    groups: dict = defaultdict(lambda: (Counter(), Counter()))
    n_docs: Counter = Counter()

    def rows() -> pa.RecordBatch:
        lang, source, term, n, docs = [], [], [], [], []
        for (one, other), (occurs, holds) in groups.items():
            lang += [one] * len(occurs)
            source += [other] * len(occurs)
            term += occurs.keys()
            n += occurs.values()
            docs += [holds[t] for t in occurs]
        for (one, other), k in n_docs.items():
            lang.append(one)
            source.append(other)
            term.append(None)
            n.append(0)
            docs.append(k)
        arrays = [
            pa.array(lang, pa.string()), pa.array(source, pa.string()),
            pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64()),
        ]
        groups.clear()
        n_docs.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=_COUNTS)

    held = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for text, lang, source in zip(texts, batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
            found = terms(text.as_py())
            occurs, holds = groups[lang, source]
            held -= len(occurs)
            occurs.update(found)
            holds.update(found.keys())
            held += len(occurs)
            n_docs[lang, source] += 1
            if held > HELD:
                yield rows()
                held = 0
    if n_docs:
        yield rows()


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What terms of two sources add to both sources' divergence, summed over the terms of a batch."""
    for batch in batches:
        lists = batch.column("cells")
        size = np.diff(lists.offsets.to_numpy())
        start = np.cumsum(size) - size
        cells = lists.flatten()
        ids, number = np.unique(cells.field("id").to_numpy(), return_inverse=True)
        p, p0 = cells.field("p").to_numpy(), cells.field("p0").to_numpy()
        codes, values = [], []
        for m in np.unique(size):
            rows = start[size == m]
            deep, wide = max(1, PAIRS // int(m * m)), max(1, PAIRS // int(m))
            for i in range(0, len(rows), deep):
                second = rows[i : i + deep, None] + np.arange(m)
                for j in range(0, int(m), wide):
                    first = second[:, j : j + wide]
                    a, b = first[:, :, None], second[:, None, :]
                    more = _f(p[a], p[b]) - _f(p[a], p0[b]) - _f(p0[a], p[b]) + _f(p0[a], p0[b])
                    code = (number[a] * len(ids) + number[b])[a != b]
                    found, at = np.unique(code, return_inverse=True)
                    sums = np.zeros(len(found), np.int64)
                    np.add.at(sums, at, more[a != b])
                    codes.append(found)
                    values.append(sums)
        if not codes:
            continue
        found, at = np.unique(np.concatenate(codes), return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, at, np.concatenate(values))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[found // len(ids)]), pa.array(ids[found % len(ids)]), pa.array(sums)], ["x", "y", "value"]
        )


def _sql_p(count: str, total: str) -> str:
    # in decimals: a thousand million times a count need not fit 64 bits
    return f"1 + (cast({UNIT} as decimal(10,0)) * ({count} + 1)) div cast({total} + v as decimal(20,0))"


def _sql_f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    reported: int = REPORTED,
) -> DataFrame:
    """Divergence of each source from the others of its language, and the terms that stand out in it.

    Returns ``lang, source, part, item, value, rank``. ``pair``: the item is another source of the language and the value
    the divergence from it, 0 in a language without kept terms. ``term``: the item is a kept term that is likelier in the
    source than in the language, the value its part of the divergence; the first ``reported`` of a source. Kept are terms of
    ``least_docs`` documents of the language. Null texts, languages and sources are empty ones; every group of documents
    gets its pairs, with terms or not; repeated rows are documents of their own; ranks order by value, ties by item; an empty
    table gives no rows. Other columns play no part. All arithmetic is in whole numbers.
    """
    empty = F.lit("")
    named = docs.select(*[
        F.coalesce(docs[f"`{c}`"].cast("string"), empty).alias(n)
        for c, n in ((text, "text"), (lang, "lang"), (source, "source"))
    ])
    schema = "lang string, source string, term string, n bigint, docs bigint"
    counts = materialize(
        named.mapInArrow(_counted, schema).groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")
        ),
        "counts",
    )
    of_term = Window.partitionBy("lang", "term")
    kept = materialize(
        counts.where("term is not null")
        .select(
            "lang", "source", "term", "n", F.sum("docs").over(of_term).alias("docs"),
            F.sum("n").over(of_term).alias("everywhere"),
            (F.min("source").over(of_term) == F.col("source")).cast("bigint").alias("first"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs"),
        "kept",
    )
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("v"))
    each = counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left")
    each = materialize(each.na.fill(0, ["total", "v"]), "each")
    whole = each.groupBy("lang").agg(F.sum("total").alias("all_total"), F.sum("v").alias("v"))
    groups = materialize(
        each.drop("v").join(whole, "lang").select(
            F.monotonically_increasing_id().alias("id"), "lang", "source", "total", "all_total", "v",
            F.when(F.col("v") > 0, F.expr(_sql_p("0", "total"))).alias("p0"),
        ),
        "groups",
    )
    cells = materialize(
        keyed(kept, groups, ["lang", "source"]).select(
            "id", "lang", "term", "p0", F.expr(_sql_p("n", "total")).alias("p"),
            F.expr(_sql_p("everywhere", "all_total")).alias("q"),
        ),
        "cells",
    )
    discard(counts, kept)
    out = _pairs(cells, groups).unionAll(_terms(cells, groups, reported))
    return out.select("lang", "source", "part", "item", "value", "rank")


def _terms(cells: DataFrame, groups: DataFrame, reported: int) -> DataFrame:
    best = Window.partitionBy("id").orderBy(F.desc("value"), "item")
    found = (
        cells.where("p > q")
        .select("id", F.col("term").alias("item"), F.expr(_sql_f("p", "q")).alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= reported)
    )
    names = small_or_not(groups.select("id", "lang", "source"))
    return found.join(names, "id").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    side = small_or_not(groups.select("lang", F.col("id").alias("y"), F.col("p0").alias("y0")))
    # groups of terms with the same count in a source have the same probability
    alike = materialize(
        cells.groupBy("lang", F.col("id").alias("x"), F.col("p0").alias("x0"), "p").agg(F.count(F.lit(1)).alias("k")), "alike"
    )
    against = alike.join(side, "lang").where("x <> y").groupBy("x", "y").agg(
        F.sum(F.expr(f"k * ({_sql_f('p', 'y0')} - {_sql_f('x0', 'y0')})")).alias("here"),
        F.sum(F.expr(f"k * ({_sql_f('y0', 'p')} - {_sql_f('y0', 'x0')})")).alias("there"),
    )
    against = materialize(against, "against")
    both = (
        cells.groupBy("lang", "term").agg(F.collect_list(F.struct("id", "p", "p0")).alias("cells"))
        .where(F.size("cells") > 1)
        .select("cells")
        .mapInArrow(_shared, "x bigint, y bigint, value bigint")
        .groupBy("x", "y").agg(F.sum("value").alias("value"))
    )
    base = groups.select("lang", "v", F.col("id").alias("x"), F.col("p0").alias("x0")).join(side, "lang").where("x <> y")
    value = materialize(
        base.select("x", "y", F.coalesce(F.expr(f"v * {_sql_f('x0', 'y0')}"), F.lit(0)).cast("bigint").alias("value"))
        .unionAll(against.select("x", "y", F.col("here").alias("value")))
        .unionAll(against.select(F.col("y").alias("x"), F.col("x").alias("y"), F.col("there").alias("value")))
        .unionAll(both)
        .groupBy("x", "y").agg(F.sum("value").alias("value")),
        "divergence",
    )
    first = small_or_not(groups.select(F.col("id").alias("x"), "lang", "source"))
    second = small_or_not(groups.select(F.col("id").alias("y"), F.col("source").alias("item")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return value.join(first, "x").join(second, "y").select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
with src as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text from documents),
found as (
  select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from src),
terms as (
  select lang, term, count(*) as everywhere from found group by all having count(distinct d) >= {LEAST_DOCS}),
cells as (select lang, source, term, count(*) as n from found semi join terms using (lang, term) group by all),
langs as (select lang, count(*) as v, sum(everywhere) as all_total from terms group by lang),
groups as (
  select g.lang, g.source, coalesce(sum(n), 0) as total
  from (select distinct lang, source from src) g left join cells using (lang, source) group by all),
grid as (
  select g.lang, g.source, t.term, coalesce(n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(n, 0) + 1)) // (total + v) as p,
    1 + (1000000000::hugeint * (everywhere + 1)) // (all_total + v) as q
  from groups g join langs using (lang) join terms t using (lang) left join cells using (lang, source, term)),
between_sources as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join between_sources s on s.lang = a.lang and s.source = a.source and s.item = b.source),
outstanding as (
  select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // q as bigint) as value
  from grid where n > 0 and p > q)
select * from (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
  from (select * from pairs union all select * from outstanding))
where part = 'pair' or rank <= {REPORTED}
"""


@query("op13_divergence", SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return audit(table(spark, sf, "documents"))
