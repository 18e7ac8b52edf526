"""Feature workflows: fit on training rows, apply the frozen state to any rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.operators import vocab as vocabulary
from ctrflow.operators.transforms import (
    Branch,
    Categorify,
    Group,
    Normalize,
    as_group,
    step_from_dict,
    step_to_dict,
)
from ctrflow.operators.vocab import LookupLimits, VocabSize


class Workflow:
    """A group of transformed columns, not fitted yet."""

    def __init__(self, group: Group | Iterable[str], limits: LookupLimits | None = None):
        self.group = as_group(group)
        self.limits = limits or LookupLimits()
        names = [n for b in self.group.branches for n in b.out_names()]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"more than one output column is named {twice}")

    def __add__(self, other: "Workflow | Group | Iterable[str]") -> "Workflow":
        more = other.group if isinstance(other, Workflow) else as_group(other)
        return Workflow(self.group + more, self.limits)

    def fit(self, train: DataFrame) -> "FittedWorkflow":
        """Learn all state: one aggregation for the moments of every column and one
        unpivoted count for every vocabulary. Steps behind another fitted step of their
        branch take a further round."""
        fitted = FittedWorkflow(self.group.branches, limits=self.limits)
        at = [_next_fitted(b, 0) for b in self.group.branches]
        while any(i is not None for i in at):
            upto = [len(b.steps) if i is None else i for b, i in zip(fitted.branches, at)]
            frame = fitted._apply(train, upto, only=[i is not None for i in at])
            moments: dict[str, Column] = {}
            cats: dict[str, list[str]] = {}
            for b, i in zip(fitted.branches, at):
                if i is None:
                    continue
                for name in b.out_names(i):
                    step = b.steps[i]
                    if isinstance(step, Normalize):
                        for k, agg in step.moments(F.col(name)).items():
                            moments[f"{name}\0{k}"] = agg
                    elif isinstance(step, Categorify):
                        cats.setdefault(step.order, []).append(name)
            if moments:
                row = frame.agg(*[c.alias(f"m{j}") for j, c in enumerate(moments.values())]).first()
                for j, full in enumerate(moments):
                    name, k = full.split("\0")
                    fitted.moments.setdefault(name, {})[k] = row[j]
            for order, names in cats.items():
                table, sizes = vocabulary.build(frame.select(*names), names, order)
                fitted.vocab = table if fitted.vocab is None else fitted.vocab.unionByName(table)
                fitted.sizes.update(sizes)
            at = [
                None if i is None else _next_fitted(b, i + 1) for b, i in zip(fitted.branches, at)
            ]
        return fitted


def _next_fitted(branch: Branch, start: int) -> int | None:
    return next((i for i in range(start, len(branch.steps)) if branch.steps[i].fitted), None)


@dataclass
class FittedWorkflow:
    """Frozen state and its application, to batch or streaming frames alike."""

    branches: tuple[Branch, ...]
    moments: dict[str, dict[str, float]] = field(default_factory=dict)
    vocab: DataFrame | None = None
    sizes: dict[str, VocabSize] = field(default_factory=dict)
    limits: LookupLimits = field(default_factory=LookupLimits)

    def transform(
        self, df: DataFrame, keep: Iterable[str] = (), types: dict[str, str] | None = None
    ) -> DataFrame:
        """Transformed columns after the ``keep`` columns, cast by ``types`` where given.

        Moments enter as literals and codes through lookup joins; no row is lost.
        """
        out = self._apply(df, [len(b.steps) for b in self.branches], keep=list(keep))
        if types:
            out = out.select(
                *[F.col(c).cast(types[c]).alias(c) if c in types else c for c in out.columns]
            )
        return out

    def _apply(self, df, upto, only=None, keep=()):
        small = vocabulary.broadcastable(self.sizes, self.limits)
        shuffled = set(self.sizes) - small
        together = {}
        if shuffled and not df.isStreaming:
            df, together = self._look_up_together(df, upto, only, shuffled, keep)
        if shuffled:
            used = [c for i, b in enumerate(self.branches) if only is None or only[i] for c in b.columns]
            df = vocabulary.with_spread(df, list(dict.fromkeys([*keep, *used])))
        outputs = []
        for index, (branch, end) in enumerate(zip(self.branches, upto)):
            if only is not None and not only[index]:
                continue
            for column in branch.columns:
                name, col = column, F.col(column)
                for at, step in enumerate(branch.steps[:end]):
                    if (index, column, at) in together:
                        col = F.col(together[index, column, at])
                    elif isinstance(step, Categorify):
                        df, col = vocabulary.lookup(
                            df, col, name, self.vocab, self.sizes[name], name in small
                        )
                    else:
                        col = step.apply(col, self.moments.get(name))
                    name = step.out_name(name)
                outputs.append(col.alias(name))
        return df.select(*keep, *outputs)

    def _look_up_together(self, df, upto, only, large, keep):
        """The first lookups of all columns with large vocabularies: the wider frame, and the code column of each."""
        wanted, places, used = {}, {}, []
        for index, (branch, end) in enumerate(zip(self.branches, upto)):
            if only is not None and not only[index]:
                continue
            used += branch.columns
            for column in branch.columns:
                name, col = column, F.col(column)
                for at, step in enumerate(branch.steps[:end]):
                    if isinstance(step, Categorify):
                        if name in large:
                            code = f"__large{len(wanted)}"
                            wanted[code] = (col, name)
                            places[index, column, at] = code
                        break
                    col = step.apply(col, self.moments.get(name))
                    name = step.out_name(name)
        if not wanted:
            return df, {}
        # other columns are not carried through the exchange
        rows = df.select(*dict.fromkeys([*keep, *used]))
        return vocabulary.lookup_all(rows, wanted, self.vocab, self.sizes), places

    def embedding_sizes(self, spark: SparkSession) -> DataFrame:
        """Per categorical column: cardinality with slot 0, and embedding width."""
        if self.vocab is None:
            return spark.createDataFrame([], "column string, cardinality bigint, dim bigint")
        counted = self.vocab.groupBy("column").agg((F.max("code") + 1).alias("cardinality"))
        return counted.withColumn("dim", embedding_dim(F.col("cardinality")))

    def save(self, spark: SparkSession, path: str) -> None:
        """Vocabularies as Parquet, the rest as one small JSON manifest."""
        manifest = {
            "branches": [
                {"columns": list(b.columns), "steps": [step_to_dict(s) for s in b.steps]}
                for b in self.branches
            ],
            "moments": self.moments,
            "sizes": {k: v.to_dict() for k, v in self.sizes.items()},
            "has_vocab": self.vocab is not None,
        }
        if self.vocab is not None:
            vocabulary.write(self.vocab, f"{path}/vocab")
        text = spark.createDataFrame([(json.dumps(manifest),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        path: str,
        functions: dict[str, Callable] | None = None,
        limits: LookupLimits | None = None,
    ) -> "FittedWorkflow":
        manifest = json.loads(spark.read.text(f"{path}/manifest").first().value)
        branches = tuple(
            Branch(tuple(b["columns"]), tuple(step_from_dict(s, functions) for s in b["steps"]))
            for b in manifest["branches"]
        )
        return cls(
            branches,
            manifest["moments"],
            vocabulary.read(spark, f"{path}/vocab") if manifest["has_vocab"] else None,
            {k: VocabSize(**v) for k, v in manifest["sizes"].items()},
            limits or LookupLimits(),
        )


def embedding_dim(cardinality: Column) -> Column:
    """Embedding width for a vocabulary: 1.6 n^0.56, at most 16."""
    return F.least(F.lit(16), F.round(1.6 * F.pow(cardinality, F.lit(0.56)))).cast("bigint")
