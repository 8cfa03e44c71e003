"""The table contract: the one configuration object every operator takes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One check on one column. `training` rules apply only when the target is required."""

    column: str
    kind: str  # not_null | ge | le | isin
    bound: float | None = None
    values: tuple[str, ...] = ()
    training: bool = False

    @property
    def check(self) -> str:
        if self.kind == "not_null":
            return "not_nullable"
        if self.kind == "ge":
            return f"greater_than_or_equal_to({self.bound:g})"
        if self.kind == "le":
            return f"less_than_or_equal_to({self.bound:g})"
        return f"isin({list(self.values)})"

    def violated(self) -> Column:
        """True exactly on offending rows; nulls pass every check except not_null."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "ge":
            return c.isNotNull() & (c < F.lit(float(self.bound)))
        if self.kind == "le":
            return c.isNotNull() & (c > F.lit(float(self.bound)))
        if self.kind == "isin":
            return c.isNotNull() & ~c.isin(*self.values)
        raise ValueError(f"unknown rule kind {self.kind!r}")


def not_null(column: str) -> tuple[Rule, ...]:
    return (Rule(column, "not_null"),)


def between(column: str, low: float, high: float) -> tuple[Rule, ...]:
    """Inclusive range; lower and upper limit are reported separately."""
    return (Rule(column, "ge", low), Rule(column, "le", high))


def isin(column: str, *values: str, training: bool = False) -> tuple[Rule, ...]:
    return (Rule(column, "isin", values=tuple(values), training=training),)


@dataclass(frozen=True)
class TableSpec:
    """Columns, roles and rules of one table.

    Rules are kept in schema-column order: reports list failures in that order.
    """

    name: str
    key: tuple[str, ...]
    date: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    positive: str = "Yes"
    negative: str = "No"
    leak: tuple[str, ...] = ()
    sparse: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    version: str = "v1"

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def rules_for(self, require_target: bool) -> list[tuple[int, Rule]]:
        """(ordinal, rule) pairs of the training or the serving variant."""
        return [(i, r) for i, r in enumerate(self.rules) if require_target or not r.training]

    def required_columns(self, require_target: bool) -> list[str]:
        """Columns the contract declares; each of them has to be present."""
        names = dict.fromkeys((self.date, *self.key, *self.features))
        if require_target:
            names[self.target] = None
        return list(names)

    def request_schema(self) -> T.StructType:
        """Every contract column as text, so one bad field never voids the whole request."""
        return T.StructType(
            [T.StructField(c, T.StringType()) for c in self.required_columns(False)]
        )

    def type_of(self, column: str) -> T.DataType:
        if column == self.date:
            return T.DateType()
        return T.DoubleType() if column in self.numeric else T.StringType()


def flatten(groups: Iterable[tuple[Rule, ...]]) -> tuple[Rule, ...]:
    return tuple(rule for group in groups for rule in group)
