"""Query of the secret scan, and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm import secretscan as scan
from ctrflow.llm.frames import table
from ctrflow.llm.registry import query


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_spans(source: str) -> str:
    """CTEs ``strong`` and ``counted`` over ``source(key, text)``: one row per span."""
    per_kind = []
    for i, kind in enumerate(scan.KINDS):
        pattern = _quoted(scan.PATTERNS[kind])
        if kind == "assign":
            kept = f"length(regexp_extract(m, {pattern}, 2)) >= {scan.LEAST_VALUE}"
        elif kind == "secret":
            kept = " and ".join(f"regexp_matches(m, '{p}')" for p in scan.MIXED)
        else:
            kept = "true"
        per_kind.append(f"""
  select key, {i} as kind, '{kind}' as name, stop - length(m) as start, stop from (
    select key, m, sum(length(m) + length(gap)) over (partition by key order by i) as stop
    from (select key, unnest(found) as m, unnest(gaps[:len(found)]) as gap,
                 unnest(range(len(found))) as i
          from (select key, regexp_extract_all(text, {pattern}) as found,
                       regexp_split_to_array(text, {pattern}) as gaps from {source})
          where len(found) > 0))
  where {kept}""")
    weak = ", ".join(str(scan.KINDS.index(k)) for k in scan.WEAK)
    number = {k: scan.KINDS.index(k) for k in scan.KINDS}

    def near(*kinds: str) -> str:
        some = ", ".join(str(number[k]) for k in kinds)
        return f"""exists (select 1 from parts c where c.key = w.key and c.kind in ({some})
      and c.start <= w.stop + {scan.SCOPE} and c.stop >= w.start - {scan.SCOPE})"""

    ids, secrets = near("access", "ident"), near("assign", "hex", "secret")
    return f"""parts as ({' union all '.join(per_kind)}),
strong as (select * from parts where kind < {len(scan.STRONG)}),
counted as (
  select * from strong union all
  select * from parts w where kind in ({weak}) and (
    (kind = {number['ident']} and {secrets}) or (kind = {number['secret']} and {ids})
    or (kind = {number['endpoint']} and {ids} and {secrets}))
)"""


SQL = f"""
with src as (select doc_id as key, coalesce(text, '') as text from documents),
{sql_spans('src')},
base as (
  select key, count(*) filter (name = 'assign') as n_assign, count(*) filter (name = 'access') as n_access,
    count(*) filter (name = 'hex') as n_hex,
    string_agg(name || ':' || start || ':' || stop, ',' order by start, kind) as listed
  from strong group by key
),
total as (
  select key, string_agg(name || ':' || start || ':' || stop, ',' order by start, kind) as listed
  from counted group by key
)
select key as doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base.listed, '')) as base_sha256,
  coalesce(total.listed, '') as spans
from src left join base using (key) left join total using (key)
"""


@query("op1_secrets", SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = scan.find(table(spark, sf, "documents"), keep=["doc_id"])

    def count(kind: str):
        of = F.filter("strong", lambda s: s["kind"] == scan.KINDS.index(kind))
        return F.size(of).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in scan.STRONG],
        F.sha2(scan.listed(F.col("strong")), 256).alias("base_sha256"),
        scan.listed(F.col("spans")).alias("spans"),
    )
