"""Column helpers that steer the optimizer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluate_once(value: Column) -> Column:
    """``value`` as the output of a one-element ``explode``.

    Filters written above a projection are pushed below it with the projected
    expression copied into the condition, so an expensive expression (a JSON
    parse, a date parse) runs once per reference. A generator output cannot be
    pushed beneath, so the expression runs exactly once per row. The price is
    a whole-stage-codegen boundary at the generator (``from_json`` is
    interpreted in any case); measured, one parse instead of two or three wins.
    """
    return F.explode(F.array(value))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it.

    For values inside a branch that few rows take, where :func:`evaluate_once` would evaluate them for all.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
