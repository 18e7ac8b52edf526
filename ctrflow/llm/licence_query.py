"""Query of the licence scan, and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm import licences as lic
from ctrflow.llm.frames import table
from ctrflow.llm.registry import query


def _sql() -> str:
    known = lic.dictionary()
    names = list(dict.fromkeys(n for _, n in known))
    rows = ", ".join(f"('{k}', {names.index(n)}, '{n}')" for k, n in known)
    met = " union all ".join(
        f"select doc_id, '{licence}' as licence from sequences where regexp_matches(seq, '{lic.rule_pattern(r, names)}')"
        for licence, r in lic.RULES
    )
    views = " union all ".join(
        f"""select doc_id, {i} as view, unnest(units) as unit, unnest(range(len(units))) as place
        from (select doc_id, regexp_split_to_array(lower(coalesce(text, '')), '{end}') as units from documents)"""
        for i, end in enumerate((lic.SENTENCE_END, lic.LINE_END))
    )
    return f"""
with known(sentence, id, name) as (values {rows}),
units as ({views}),
found as (
  select doc_id, view, place, id, name from units
  join known on trim(regexp_replace(unit, '{lic._OTHER}', ' ', 'g')) = sentence
),
spaced as (
  select *, place - lag(place) over (partition by doc_id, view order by place) as gap from found
),
sequences as (
  select doc_id, view, string_agg(case when gap > {lic.GAP + 1} then '|' else '' end || ' ' || id || ' ', '' order by place) as seq
  from spaced group by doc_id, view
),
met as ({met}),
listed as (select doc_id, string_agg(distinct licence, ',' order by licence) as licences from met group by doc_id),
named as (select doc_id, string_agg(distinct name, ',' order by name) as sentences from found group by doc_id)
select documents.doc_id, coalesce(sentences, '') as sentences, coalesce(licences, '') as licences
from documents left join listed using (doc_id) left join named using (doc_id)
"""


@query("op4_licences", _sql())
def op4(spark: SparkSession, sf: str) -> DataFrame:
    found = lic.recognise(table(spark, sf, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", F.array_join("sentences", ",").alias("sentences"), F.array_join("licences", ",").alias("licences")
    )
