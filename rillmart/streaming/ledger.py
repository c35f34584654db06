"""Signed ledgers: retractable partial aggregates of a mart.

A ledger has one row per grouping key with signed sums of the measures, and one
narrow row per grouping key and value that is counted distinct, or of which the
least or greatest is wanted, with signed counts: rows that come add, rows that go
subtract.  Sums commute, so batches may arrive in any order, and a value counts,
or is the least or greatest, while its signed count is positive.  Each sum
carries the signed number of its non-NULL inputs, because a group whose inputs
were all retracted must return to NULL and not to 0.  A row may stand for several
equal ones: its sign is then their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.functions.measures import Measure
from rillmart.operators.aggregate import KEY, distinct_values, key_columns
from rillmart.operators.mart import Mart
from rillmart.streaming.log import PART, part_of

ROWS = "__rows"
SLOT = "__slot"  # 0: measures, i: the i-th value kept with counts
_EXTREMES = ("min", "max")


def kept_values(mart: Mart) -> list[str]:
    """Expressions whose values are kept with signed counts: counted distinct, least or greatest."""
    extremes = [m.expr for m in mart.measures if m.kind in _EXTREMES]
    return list(dict.fromkeys([*distinct_values(mart.distincts), *extremes]))


def _value(slot: int) -> str:
    return f"__value_{slot}"


def _flag(index: int) -> str:
    return f"__flag_{index}"


def _present(measure: Measure) -> str:
    return f"__n_{measure.name}"


def _signed_count(cond: str) -> str:
    return f"IF({cond}, sign, 0)"


def _sums(mart: Mart) -> dict[str, str]:
    """Every summed ledger column and its storage type."""
    out = {}
    for m in mart.measures:
        if m.kind in _EXTREMES:
            continue
        out[m.name] = "decimal(38,4)" if m.type.startswith("decimal") else "bigint"
        if m.kind == "sum":
            out[_present(m)] = "bigint"
    out.update({_flag(j): "bigint" for j, d in enumerate(mart.distincts) if d.when})
    return {**out, ROWS: "bigint"}


def _add(expr: str, name: str, kind: str):
    return F.expr(f"CAST(sum({expr}) AS {kind}) AS `{name}`")


def contributions(images: DataFrame, mart: Mart, part: str) -> DataFrame:
    """What a batch of signed cleaned rows adds to the ledger; ``part`` is SQL over the keys."""
    rows = mart.rows(images)
    kinds = _sums(mart)
    exprs = {ROWS: "sign"}
    for m in mart.measures:
        if m.kind == "sum":
            exprs[m.name] = f"({m.expr}) * sign"
            exprs[_present(m)] = _signed_count(f"({m.expr}) IS NOT NULL")
        elif m.kind == "count":
            exprs[m.name] = _signed_count(f"({m.expr}) IS NOT NULL")
    out = rows.groupBy(*key_columns(mart.keys)).agg(*(_add(e, n, kinds[n]) for n, e in exprs.items()))
    out = out.withColumn(SLOT, F.lit(0))
    for slot, value in enumerate(kept_values(mart), start=1):
        counts = {ROWS: "sign"} | {
            _flag(j): _signed_count(d.when)
            for j, d in enumerate(mart.distincts)
            if d.value == value and d.when
        }
        seen = rows.groupBy(*key_columns(mart.keys), F.expr(value).alias(_value(slot))).agg(
            *(_add(e, n, kinds[n]) for n, e in counts.items())
        )
        out = out.unionByName(seen.withColumn(SLOT, F.lit(slot)), allowMissingColumns=True)
    return out.withColumn(PART, part_of(part))


def combine(rows: DataFrame, mart: Mart) -> DataFrame:
    """Add up ledger rows of the same key and value (used to compact old batches)."""
    values = [_value(i) for i, _ in enumerate(kept_values(mart), start=1)]
    sums = (_add(f"`{n}`", n, kind) for n, kind in _sums(mart).items())
    return rows.groupBy(PART, *mart.keys, SLOT, *values).agg(*sums)


def settle(rows: DataFrame, mart: Mart) -> DataFrame:
    """Mart rows (with ``part``) of ledger rows, combined or not; emptied groups disappear."""
    whole_key = F.struct(PART, *mart.keys).alias(KEY)
    merged = []
    for m in mart.measures:
        if m.kind == "sum":
            value = f"IF(sum(`{_present(m)}`) > 0, coalesce(sum(`{m.name}`), 0), NULL)"
        elif m.kind in _EXTREMES:
            continue
        else:
            value = f"greatest(sum(`{m.name}`), 0)"
        merged.append(F.expr(f"CAST({value} AS {m.type}) AS `{m.name}`"))
    measured = rows.where(F.col(SLOT) == 0).groupBy(whole_key)
    out = measured.agg(*merged, F.sum(ROWS).alias(ROWS)).where(f"{ROWS} > 0")
    for slot, value in enumerate(kept_values(mart), start=1):
        extremes = [m for m in mart.measures if m.kind in _EXTREMES and m.expr == value]
        mine = [(j, d) for j, d in enumerate(mart.distincts) if d.value == value]
        counted = [ROWS, *(_flag(j) for j, d in mine if d.when)]
        seen = (
            rows.where(F.col(SLOT) == slot)
            .groupBy(whole_key, _value(slot))
            .agg(*(F.sum(c).alias(c) for c in counted))
            .groupBy(KEY)
            .agg(
                *(
                    F.expr(
                        f"CAST(count_if({_value(slot)} IS NOT NULL AND {_flag(j) if d.when else ROWS} > 0) "
                        f"AS {d.type}) AS `{d.name}`"
                    )
                    for j, d in mine
                ),
                *(
                    F.expr(f"CAST({m.kind}(IF({ROWS} > 0, {_value(slot)}, NULL)) AS {m.type}) AS `{m.name}`")
                    for m in extremes
                ),
            )
        )
        out = out.join(seen, KEY)
    flat = out.select(f"{KEY}.*", *(c for c in out.columns if c not in (KEY, ROWS)))
    for name, expr, kind in mart.derived:
        flat = flat.withColumn(name, F.expr(expr).cast(kind))
    return flat.select(PART, *(n for n, _ in mart.fields()))
