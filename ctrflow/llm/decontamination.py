"""Query of the benchmark decontamination, and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.frames import table
from ctrflow.llm.registry import query
from ctrflow.llm.winnow import WINDOW, contamination


def sql_hits(docs: str) -> str:
    """CTE ``hit_docs`` over ``docs(key, text)``: n_words, n_hit, n_items, items per key."""
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = rf"regexp_extract_all({fold}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
item_words as (select item_id, {split} as w from benchmark),
item_windows as (
  select distinct item_id, len, array_to_string(w[i : i + len - 1], ' ') as words from (
    select item_id, w, least(len(w), {WINDOW}) as len,
           unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as i
    from item_words where len(w) > 0)
),
lens as (select distinct len from item_windows),
doc_words as (select key, {split} as w from {docs}),
doc_hits as (
  select d.key, d.i, d.len, t.item_id from (
    select key, len, i, array_to_string(w[i : i + len - 1], ' ') as words
    from (select key, w, len, unnest(range(1, len(w) - len + 2)) as i
          from doc_words, lens where len(w) >= len)) d
  join item_windows t on t.words = d.words and t.len = d.len
),
hit_words as (
  select key, count(distinct place) as n_hit
  from (select key, unnest(range(i, i + len)) as place from doc_hits) group by key
),
hit_items as (
  select key, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct key, cast(item_id as varchar) as item from doc_hits) group by key
),
hit_docs as (
  select key, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    coalesce(items, '') as items
  from doc_words left join hit_words using (key) left join hit_items using (key)
)"""


SQL = f"""
with src as (select doc_id as key, text from documents),
{sql_hits('src')}
select key as doc_id, n_words, n_hit, n_items, sha256(items) as items_sha256,
  n_hit > 0 and 20 * n_hit >= n_words as contaminated
from hit_docs
"""


@query("op9_decontaminate", SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
