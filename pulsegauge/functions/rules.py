"""Alert rules: a range per sensor type, outside of which a reading alerts."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """Readings below ``lo`` or above ``hi`` alert; a bound itself does not."""

    rule_set: str
    sensor_type: str
    lo: float | None = None
    hi: float | None = None


# The three rule sets in use.
UPPER = (
    Rule("upper", "temperature", hi=30.0),
    Rule("upper", "humidity", hi=70.0),
)
HOT = (Rule("hot", "temperature", hi=35.0),)
RANGE = (
    Rule("range", "temperature", lo=15.0, hi=30.0),
    Rule("range", "humidity", lo=30.0, hi=70.0),
    Rule("range", "pressure", lo=1000.0, hi=1030.0),
)


def folded(rules: Sequence[Rule]) -> dict[str, tuple[float | None, float | None]]:
    """One range per type that alerts for the same readings: the largest lo, the smallest hi."""
    ranges: dict[str, tuple[float | None, float | None]] = {}
    for rule in rules:
        lo, hi = ranges.get(rule.sensor_type, (None, None))
        if rule.lo is not None:
            lo = rule.lo if lo is None else max(lo, rule.lo)
        if rule.hi is not None:
            hi = rule.hi if hi is None else min(hi, rule.hi)
        ranges[rule.sensor_type] = (lo, hi)
    return {kind: both for kind, both in ranges.items() if both != (None, None)}


def breaks_rule(
    rules: Sequence[Rule], sensor_type: str = "sensor_type", value: str = "value"
) -> Column:
    """True for a reading that breaks one of the rules, however many there are.

    The bounds of a reading's type are looked up in a literal map. The types, and the
    widest of all bounds, are tested first as plain literals, so on a landed table
    these tests reach the Parquet scan and whole row groups are skipped.
    """
    ranges = folded(rules)
    if not ranges:
        return F.lit(False)
    known, outside = F.col(sensor_type).isin(*ranges), []
    for side, compare, widest in ((0, operator.lt, max), (1, operator.gt, min)):
        bounds = {kind: both[side] for kind, both in ranges.items() if both[side] is not None}
        if bounds:
            table = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
            own = F.try_element_at(table, F.col(sensor_type))
            outside.append((compare(F.col(value), widest(bounds.values())), compare(F.col(value), own)))
    some = functools.reduce(operator.or_, [loose for loose, _ in outside])
    exact = functools.reduce(operator.or_, [F.coalesce(own, F.lit(False)) for _, own in outside])
    return known & some & exact


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table.

    Built from Arrow data it is a local relation, whose size the optimizer knows:
    a join broadcasts it while it is small and shuffles it when it is not.
    """
    fields = pa.schema(
        [
            ("rule_set", pa.string()),
            ("sensor_type", pa.string()),
            ("lo", pa.float64()),
            ("hi", pa.float64()),
        ]
    )
    rows = [rule._asdict() for rule in rules]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=fields))
