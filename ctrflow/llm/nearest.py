"""Query of the exact top-k search, and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.frames import table
from ctrflow.llm.mtree import top_k
from ctrflow.llm.registry import query

SQL = """
with parts as (
  select vec_id, unnest(embedding) as x, unnest(range(len(embedding))) as i from embeddings
),
good as (
  select vec_id, i, cast(floor(64 * cast(x as double)) as bigint) as x from parts
  where vec_id not in (select vec_id from parts where x is null or not isfinite(x))
),
scores as (
  select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
  from good q join good c on q.i = c.i and q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0 group by 1, 2
)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 20
"""


@query("op10_nearest", SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)
