"""Threshold and label expressions for status panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Fixed values: (lower bound, status), ascending; None is "below all others".
FRESHNESS_STEPS = ((None, "green"), (129600, "yellow"), (172800, "red"))
COVERAGE_STEPS = ((None, "red"), (0.8, "yellow"), (1.0, "green"))
SNAPSHOT_STEPS = ((None, "red"), (115, "yellow"), (144, "green"))
SUCCESS_LABELS = {1: "OK", 0: "FAIL"}


def status_steps(col: Column | str, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Status of the highest step whose lower bound the value reaches."""
    value = F.col(col) if isinstance(col, str) else col
    status = None
    for bound, name in steps:
        if bound is None:
            status = F.when(value.isNotNull(), F.lit(name))
        else:
            status = F.when(value >= F.lit(float(bound)), F.lit(name)).otherwise(status)
    return status


def map_values(col: Column | str, labels: Mapping[float, str]) -> Column:
    """Replace listed values by text; others are shown as they are."""
    value = F.col(col) if isinstance(col, str) else col
    text = value.cast("string")
    for key, label in labels.items():
        text = F.when(value == F.lit(key), F.lit(label)).otherwise(text)
    return text
