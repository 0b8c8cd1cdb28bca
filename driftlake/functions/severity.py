"""Traffic-light severities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Zone = tuple[float, float, str]

# Rank of each severity, worst last, and the severity a status stands for.
SEVERITY_RANK = {"grey": 0, "green": 1, "yellow": 2, "orange": 3, "red": 4}
STATUS_SEVERITY = {"ok": "green", "warn": "orange", "breach": "red", "error": "red", "skip": "grey"}


def zone_severity(value: Column, zones: Sequence[Zone]) -> Column:
    """First zone that holds the value; zones are ``[low, high)``, the last one closed."""
    result = F.lit("grey")
    for number, (low, high, severity) in reversed(list(enumerate(zones))):
        below = value <= high if number == len(zones) - 1 else value < high
        result = F.when((value >= low) & below, severity).otherwise(result)
    return result


def _lookup(mapping: dict[str, object], key: Column, default: object) -> Column:
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def status_severity(status: Column) -> Column:
    return _lookup(STATUS_SEVERITY, status, "grey")


def severity_rank(severity: Column) -> Column:
    return _lookup(SEVERITY_RANK, severity, 0)


def worst_severity(severity: Column) -> Column:
    """Aggregate: the worst severity of a group, grey when there is none."""
    by_rank = F.array(*[F.lit(name) for name in sorted(SEVERITY_RANK, key=SEVERITY_RANK.get)])
    return F.get(by_rank, F.coalesce(F.max(severity_rank(severity)), F.lit(0)))
