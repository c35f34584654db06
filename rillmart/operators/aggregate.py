"""Grouped aggregation with exact, skew-safe distinct counts.

``count(DISTINCT …)`` over several conditions makes Catalyst expand every input
row once per distinct expression and carry all other measures along.  Here the
distinct counts are grouped by the value they look at and each value is
aggregated on its own, narrow: first by (keys, value) with one flag per
condition, then by keys, counting flags.  The measures are aggregated by keys
alone.  The results are zipped on the grouping key, which all of them are already
partitioned by.

Every step combines before its shuffle, and the step that sees single values
spreads a hot group over its values, so one group with a large share of the rows
never lands in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.functions.measures import Cells, Distinct, Measure

FAN = "__fan"
KEY = "__key"
_MERGE = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}


def _value(index: int) -> str:
    return f"__value_{index}"


def _flag(index: int) -> str:
    return f"__flag_{index}"


def distinct_values(distincts: Sequence[Distinct]) -> list[str]:
    """The different value expressions, in first-use order."""
    return list(dict.fromkeys(d.value for d in distincts))


def key_columns(keys: Mapping[str, str]) -> list[Column]:
    return [F.expr(expr).alias(name) for name, expr in keys.items()]


def _published(measure: Measure) -> Column:
    return F.expr(f"CAST({measure.kind}({measure.expr}) AS {measure.type}) AS `{measure.name}`")


def aggregate(
    df: DataFrame,
    keys: Mapping[str, str],
    measures: Sequence[Measure],
    distincts: Sequence[Distinct] = (),
    *,
    cells: Cells | None = None,
) -> DataFrame:
    """Group ``df`` by the key expressions and compute all measures and distinct counts.

    ``df`` is read once for the measures and once per distinct value; each read
    only touches its own columns, so this suits scans.  Use ``aggregate_once``
    above an expensive plan.
    """
    measured = _by_cells if cells else _plain
    if not distincts:
        grouped = measured(df, key_columns(keys), measures, cells)
        return grouped.select(*keys, *(m.name for m in measures))

    # a struct is never NULL itself, so the zip matches NULL keys like any other
    whole_key = F.struct(*key_columns(keys)).alias(KEY)
    out = measured(df, [whole_key], measures, cells)
    for value in distinct_values(distincts):
        mine = [d for d in distincts if d.value == value]
        flags = [F.expr(f"bool_or({d.when})").alias(d.name) for d in mine if d.when]
        seen = df.groupBy(whole_key, F.expr(value).alias("__value")).agg(F.lit(True).alias("__seen"), *flags)
        counts = [
            F.expr(f"CAST(count_if(__value IS NOT NULL AND `{d.name if d.when else '__seen'}`) AS {d.type}) AS {d.name}")
            for d in mine
        ]
        out = out.join(seen.groupBy(KEY).agg(*counts), KEY)
    return out.select(
        *(f"{KEY}.{k}" for k in keys), *(d.name for d in distincts), *(m.name for m in measures)
    )


def _plain(df: DataFrame, by: Sequence[Column], measures: Sequence[Measure], cells: None) -> DataFrame:
    return df.groupBy(*by).agg(*(_published(m) for m in measures))


def _by_cells(df: DataFrame, by: Sequence[Column], measures: Sequence[Measure], cells: Cells) -> DataFrame:
    """Wide conditional measures over few categorical columns.

    Instead of updating every conditional sum for every row, rows are summed per
    category combination, the combinations are pivoted, and each measure adds up
    the combinations its condition covers, once per group.
    """
    combos = list(product(*cells.dims.values()))
    number = "0"
    for column, values in cells.dims.items():
        slots = " ".join(f"WHEN {column} = {v!r} THEN {i}" for i, v in enumerate(values) if v is not None)
        other = f" ELSE {values.index(None)}" if None in values else ""
        number = f"({number}) * {len(values)} + CASE {slots}{other} END"
    rows = df.select(*by, F.expr(number).alias("__cell"), F.expr(cells.amount).alias("__amount"))
    kept = rows.columns[:-2]
    pivoted = (
        rows.groupBy(*kept)
        .pivot("__cell", list(range(len(combos))))
        .agg(F.sum("__amount").alias("s"), F.count(F.lit(1)).alias("n"))
    )

    def added(covered: Sequence[int], side: str, zero: str) -> str:
        return " + ".join(f"coalesce(`{i}_{side}`, {zero})" for i in covered)

    everything = added(range(len(combos)), "n", "0")
    out = []
    for m in measures:
        covered = [
            i for i, combo in enumerate(combos)
            if all(want is None or want == value for want, value in zip(m.cell, combo))
        ]
        count = added(covered, "n", "0")
        if m.kind == "count":
            out.append(f"CAST({count} AS {m.type}) AS {m.name}")
            continue
        zero = f"CAST(0 AS {m.type})"
        some = f"coalesce({', '.join(f'`{i}_s`' for i in covered)}) IS NOT NULL"
        # rows outside the condition add 0; without any, a sum of NULLs stays NULL
        value = f"IF({some} OR {count} <> __all, {added(covered, 's', zero)}, NULL)"
        out.append(f"CAST({value} AS {m.type}) AS {m.name}")
    return pivoted.selectExpr("*", f"{everything} AS __all").selectExpr(*kept, *out)


# --- one pass -----------------------------------------------------------------------


def fan_out(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """One copy of each row per distinct value expression (none for 0 or 1)."""
    if len(values) < 2:
        return df
    return df.withColumn(FAN, F.explode(F.array(*(F.lit(i) for i in range(len(values))))))


def value_columns(values: Sequence[str]) -> list[Column]:
    if len(values) < 2:
        return [F.expr(v).alias(_value(i)) for i, v in enumerate(values)]
    fan = [F.col(FAN)]
    return fan + [
        F.expr(f"IF({FAN} = {i}, {v}, NULL)").alias(_value(i)) for i, v in enumerate(values)
    ]


def on_first_copy(expr: str, values: Sequence[str]) -> str:
    """Measures are taken from copy 0 only, so fanned rows do not count twice."""
    return expr if len(values) < 2 else f"IF({FAN} = 0, {expr}, NULL)"


def counted(index: int, values: Sequence[str], flag: str) -> str:
    """Condition of a first-level group that adds 1 to the distinct count."""
    here = f"{_value(index)} IS NOT NULL AND {flag}"
    return here if len(values) < 2 else f"{FAN} = {index} AND {here}"


def aggregate_once(
    df: DataFrame, keys: Mapping[str, str], measures: Sequence[Measure], distincts: Sequence[Distinct]
) -> DataFrame:
    """Like ``aggregate`` but reads ``df`` once, carrying the measures through both levels."""
    values = distinct_values(distincts)
    partial = [
        F.expr(f"{m.kind}({on_first_copy(m.expr, values)})").alias(m.name) for m in measures
    ]
    flags = [
        F.expr(f"bool_or({d.when})").alias(_flag(j)) for j, d in enumerate(distincts) if d.when
    ]
    inner = (
        fan_out(df, values)
        .groupBy(*key_columns(keys), *value_columns(values))
        .agg(*partial, *flags, F.lit(True).alias("__seen"))
    )
    outer = [
        F.expr(f"{_MERGE[m.kind]}(`{m.name}`)").cast(m.type).alias(m.name) for m in measures
    ]
    for j, d in enumerate(distincts):
        flag = _flag(j) if d.when else "__seen"
        cond = counted(values.index(d.value), values, flag)
        outer.append(F.expr(f"count_if({cond})").cast(d.type).alias(d.name))
    return inner.groupBy(*keys).agg(*outer)
