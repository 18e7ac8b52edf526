"""The click-log schema: column roles, order and types, kept in one place.

Every operator addresses columns by name, so it does not matter in which order
a file or an event lists them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CtrSchema:
    """Column roles of a click log. The defaults are the 13 + 26 column layout."""

    conts: tuple[str, ...] = tuple(f"I{i}" for i in range(1, 14))
    cats: tuple[str, ...] = tuple(f"C{i}" for i in range(1, 27))
    label: str = "label"
    key: tuple[str, ...] = ()
    day: str = "day"

    @property
    def log_columns(self) -> list[str]:
        """Order of the request log: label, continuous, categorical."""
        return [self.label, *self.conts, *self.cats]

    @property
    def feature_columns(self) -> list[str]:
        """Order of transformed features: categorical, continuous, label."""
        return [*self.cats, *self.conts, self.label]

    def raw_type(self) -> T.StructType:
        """Type of a raw day file."""
        return T.StructType(
            [T.StructField(self.label, T.IntegerType())]
            + [T.StructField(c, T.LongType()) for c in self.conts]
            + [T.StructField(c, T.IntegerType()) for c in self.cats]
        )

    def feature_types(self, real: str = "float") -> dict[str, str]:
        """Type of each transformed column."""
        types = {c: "bigint" for c in self.cats}
        types.update({c: real for c in self.conts})
        types[self.label] = real
        return types

    def role(self, name: str) -> str | None:
        if name in self.cats:
            return "categorical"
        if name in self.conts:
            return "continuous"
        return "label" if name == self.label else None


#: Payload of one prediction event.
EVENT = T.StructType(
    [
        T.StructField("input0", T.ArrayType(T.DoubleType())),
        T.StructField("input1", T.ArrayType(T.DoubleType())),
        T.StructField("trueval", T.DoubleType()),
        T.StructField("predval", T.DoubleType()),
    ]
)


def as_columns(names: Iterable[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]
