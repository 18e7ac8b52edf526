"""Feature transforms. Each is a step that a column group is sent through with ``>>``.

    cats = schema.cats >> Categorify()
    conts = schema.conts >> FillMissing() >> Clip(min_value=0) >> Normalize()
    workflow = Workflow(cats + conts + [schema.label])

Column-wise steps are plain Spark expressions, so a chain of them ends up as one
projection. ``Normalize`` and ``Categorify`` learn from the training rows first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


class Step:
    """One step of a chain."""

    fitted = False

    def apply(self, col: Column, state: dict | None) -> Column:
        raise NotImplementedError

    def out_name(self, name: str) -> str:
        return name

    def params(self) -> dict:
        return {}

    def __rrshift__(self, names: Iterable[str]) -> "Group":
        return Group((Branch(tuple(names)),)) >> self


@dataclass(frozen=True)
class Branch:
    """Columns and the steps they all go through."""

    columns: tuple[str, ...]
    steps: tuple[Step, ...] = ()

    def out_names(self, upto: int | None = None) -> list[str]:
        names = list(self.columns)
        for step in self.steps[:upto]:
            names = [step.out_name(n) for n in names]
        return names


@dataclass(frozen=True)
class Group:
    """Branches side by side: ``>>`` adds a step to all, ``+`` joins groups."""

    branches: tuple[Branch, ...] = field(default=())

    def __rshift__(self, step: Step) -> "Group":
        return Group(tuple(Branch(b.columns, (*b.steps, step)) for b in self.branches))

    def __add__(self, other: "Group | Iterable[str]") -> "Group":
        return Group(self.branches + as_group(other).branches)

    def __radd__(self, other: Iterable[str]) -> "Group":
        return as_group(other) + self


def as_group(names: "Group | str | Iterable[str]") -> Group:
    if isinstance(names, Group):
        return names
    if isinstance(names, str):
        names = [names]
    return Group((Branch(tuple(names)),))


@dataclass
class FillMissing(Step):
    """Replace null and NaN by a constant."""

    value: float = 0.0

    def apply(self, col, state):
        # NaN has to go too: greatest(NaN, 0) is NaN
        number = col.cast("double")
        return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(float(self.value)))

    def params(self):
        return {"value": self.value}


@dataclass
class Clip(Step):
    """Bound values below and/or above. Nulls stay null."""

    min_value: float | None = None
    max_value: float | None = None

    def apply(self, col, state):
        out = col
        # greatest and least skip nulls, hence the guard
        if self.min_value is not None:
            out = F.greatest(out, F.lit(self.min_value))
        if self.max_value is not None:
            out = F.least(out, F.lit(self.max_value))
        return F.when(col.isNotNull(), out)

    def params(self):
        return {"min_value": self.min_value, "max_value": self.max_value}


@dataclass
class Normalize(Step):
    """``(x - mean) / std`` with the sample deviation; ``x - mean`` when that is 0 or null."""

    fitted = True

    def moments(self, col: Column) -> dict[str, Column]:
        return {"mean": F.avg(col), "std": F.stddev_samp(col)}

    def apply(self, col, state):
        mean, std = state["mean"], state["std"]
        if mean is None:
            return col.cast("double")
        centred = col - F.lit(mean)
        return centred / F.lit(std) if std else centred


@dataclass
class Categorify(Step):
    """Category to code: known values 1..n, null and unseen 0.

    ``order="value"`` numbers values in ascending order, ``order="freq"`` by falling
    frequency (then value).
    """

    order: str = "value"
    fitted = True

    def __post_init__(self):
        if self.order not in ("value", "freq"):
            raise ValueError(f"order must be 'value' or 'freq', not {self.order!r}")

    def params(self):
        return {"order": self.order}


@dataclass
class LogOp(Step):
    """``log(1 + x)``."""

    def apply(self, col, state):
        return F.log1p(col)


@dataclass
class HashBucket(Step):
    """Hash a category into one of the buckets 0 to ``n - 1``; missing values have bucket ``n`` to themselves."""

    n: int = 1024

    def apply(self, col, state):
        bucket = F.pmod(F.xxhash64(col), F.lit(self.n)).cast("bigint")
        return F.when(col.isNull(), F.lit(self.n).cast("bigint")).otherwise(bucket)

    def params(self):
        return {"n": self.n}


@dataclass
class Rename(Step):
    """Give the columns new names: a postfix, or a mapping."""

    postfix: str = ""
    names: dict[str, str] | None = None

    def apply(self, col, state):
        return col

    def out_name(self, name):
        return (self.names or {}).get(name, name) + self.postfix

    def params(self):
        return {"postfix": self.postfix, "names": self.names}


@dataclass
class LambdaOp(Step):
    """Any ``Column -> Column`` function.

    Only its ``name`` is saved with a workflow; hand the function in again on load.
    """

    fn: Callable[[Column], Column]
    name: str = ""

    def apply(self, col, state):
        return self.fn(col)

    def params(self):
        if not self.name:
            raise ValueError("a LambdaOp needs a name to be saved")
        return {"name": self.name}


STEPS = {c.__name__: c for c in (FillMissing, Clip, Normalize, Categorify, LogOp, HashBucket, Rename)}


def step_to_dict(step: Step) -> dict:
    return {"step": type(step).__name__, "params": step.params()}


def step_from_dict(saved: dict, functions: dict[str, Callable] | None = None) -> Step:
    if saved["step"] == "LambdaOp":
        name = saved["params"]["name"]
        return LambdaOp((functions or {})[name], name)
    return STEPS[saved["step"]](**saved["params"])
