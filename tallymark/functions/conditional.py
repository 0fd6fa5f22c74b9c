"""Rules as data: ordered thresholds, first-match rules, indicator sums, weighted scores, safe ratios."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from itertools import takewhile
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt, "==": operator.eq}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rules(pairs: Iterable[tuple[Column, Any]], default: Any) -> Column:
    """Value of the first predicate that holds; a NULL predicate does not hold."""
    pairs = list(pairs)
    if not pairs:
        raise ValueError("rules: at least one (predicate, value) pair is needed")
    (first, value), *rest = pairs
    chain = reduce(lambda acc, pv: acc.when(pv[0], pv[1]), rest, F.when(first, value))
    return chain.otherwise(default)


def all_of(conditions: Mapping[str, tuple[str, Any]]) -> Column:
    """Conjunction of comparisons, given as ``column: (operator, value)``."""
    return reduce(operator.and_, [_COMPARE[op](F.col(name), value) for name, (op, value) in conditions.items()])


def rule_table(table: Iterable[tuple[Mapping[str, tuple[str, Any]], Any]], default: Any) -> Column:
    """``rules`` whose predicates are written as data: pairs of ``all_of`` conditions and a result."""
    return rules([(all_of(conditions), result) for conditions, result in table], default)


def band(
    c: Column | str, steps: Sequence[tuple[Any, Any]], default: Any, op: str = ">=", null_value: Any = None
) -> Column:
    """Map a measurement to the result of the first threshold it passes.

    A NULL measurement passes no threshold and gets ``default``, unless ``null_value`` is given.
    """
    c, compare = as_column(c), _COMPARE[op]
    pairs = [(compare(c, threshold), result) for threshold, result in steps]
    if null_value is not None:
        pairs.insert(0, (c.isNull(), null_value))
    return rules(pairs, default)


def band_where(
    c: Column | str, steps: Sequence[tuple[Any, Any]], passes: Callable[[Any], bool], op: str = ">="
) -> Column:
    """Rows whose banded value passes a test, as one comparison of the measurement.

    A filter on the banded column itself is pushed below the banding, which repeats the measurement's whole
    expression once per threshold. The passing bands have to come first; the default must not pass.
    """
    leading = list(takewhile(lambda step: passes(step[1]), steps))
    if not leading or any(passes(result) for _, result in steps[len(leading) :]):
        raise ValueError("band_where: the passing bands must come first")
    return _COMPARE[op](as_column(c), leading[-1][0])


def lookup(c: Column | str, table: Mapping[Any, Any], default: Any) -> Column:
    """Result of the first equal entry of a small fixed table."""
    return band(c, list(table.items()), default, op="==")


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, else 0 (also for NULL)."""
    return F.when(predicate, 1).otherwise(0)


def indicator_sum(pairs: Iterable[tuple[Column, float]]) -> Column:
    """Sum of the weights of all predicates that hold."""
    return reduce(operator.add, [F.when(p, w).otherwise(0) for p, w in pairs])


def weighted_score(weights: Mapping[str, float], offset: float | None = None) -> Column:
    """Linear score over columns, in the order given; NULL in any column makes the score NULL."""
    total = reduce(operator.add, [F.col(name) * w for name, w in weights.items()])
    return total if offset is None else total + F.lit(offset)


def ratio(n: Column | str, d: Column | str, policy: str = "positive", eps: float = 0.01) -> Column:
    """Division that never fails.

    ``positive``: NULL unless the denominator is above 0. ``nonzero``: NULL only for a zero denominator.
    ``eps``: a small constant is added to the denominator.
    """
    n, d = as_column(n), as_column(d)
    if policy == "positive":
        return F.when(d > 0, n / d)
    if policy == "nonzero":
        return F.try_divide(n, d)
    if policy == "eps":
        return F.try_divide(n, d + F.lit(eps))
    raise ValueError(f"ratio: unknown policy {policy!r}")
