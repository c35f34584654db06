"""A mart: keys, measures and distinct counts over one cleaned table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.functions.measures import Cells, Distinct, Measure
from rillmart.operators.aggregate import aggregate, aggregate_once

_KEY_TYPES = {
    "statistic_time": "date",
    "third_platform_provider_type": "string",
    "activity_type": "string",
}


def by(*names: str, **exprs: str) -> dict[str, str]:
    """Grouping keys: plain columns plus ``alias=expression`` pairs."""
    return {**{name: name for name in names}, **exprs}


@dataclass(frozen=True)
class Mart:
    name: str
    source: str
    keys: Mapping[str, str]
    measures: tuple[Measure, ...]
    distincts: tuple[Distinct, ...] = ()
    where: str | None = None
    # constants and ratios computed from the finished columns: (name, SQL, type)
    derived: tuple[tuple[str, str, str], ...] = field(default=())
    cells: Cells | None = None
    # read the input once and carry measures through the distinct counts; for inputs that are joins or windows
    one_pass: bool = False

    def rows(self, cleaned: DataFrame) -> DataFrame:
        return cleaned.where(self.where) if self.where else cleaned

    def build(self, cleaned: DataFrame) -> DataFrame:
        """The mart over the current rows of its cleaned table."""
        rows = self.rows(cleaned)
        if self.one_pass and not self.cells:
            return self.finish(aggregate_once(rows, self.keys, self.measures, self.distincts))
        return self.finish(aggregate(rows, self.keys, self.measures, self.distincts, cells=self.cells))

    def finish(self, grouped: DataFrame) -> DataFrame:
        out = grouped
        for name, expr, kind in self.derived:
            out = out.withColumn(name, F.expr(expr).cast(kind))
        return out.select(*(name for name, _ in self.fields()))

    def fields(self) -> list[tuple[str, str]]:
        """Published columns and types: keys first, then measures, counts and derived columns."""
        return [
            *((k, _KEY_TYPES.get(k, "bigint")) for k in self.keys),
            *((d.name, d.type) for d in self.distincts),
            *((m.name, m.type) for m in self.measures),
            *((name, kind) for name, _, kind in self.derived),
        ]
