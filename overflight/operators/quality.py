"""Declared data-quality checks, all checks of a relation in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from overflight.config import BACKGROUND, POSITION_SOURCES, REGIONS
from overflight.functions.literals import sql_literal


@dataclass(frozen=True)
class Check:
    """One declared check. ``fails`` is the SQL condition of a failing row;
    ``unique`` checks have none and count the values that occur repeatedly."""

    kind: str
    column: str
    fails: str | None = None
    where: str | None = None
    severity: str = "error"

    def failing(self) -> Column:
        # NULL passes, as a row that a WHERE clause does not return
        scoped = self.fails if self.where is None else f"({self.where}) AND ({self.fails})"
        return F.expr(f"coalesce({scoped}, false)")


def not_null(column: str, **scope) -> Check:
    return Check("not_null", column, f"`{column}` IS NULL", **scope)


def unique(column: str, **scope) -> Check:
    return Check("unique", column, None, **scope)


def accepted_values(column: str, values: Iterable, **scope) -> Check:
    listed = ", ".join(map(sql_literal, values))
    return Check("accepted_values", column, f"`{column}` NOT IN ({listed})", **scope)


def accepted_range(column: str, low: float | None = None, high: float | None = None, **scope) -> Check:
    """Inclusive bounds, at least one."""
    bounds = [(">=", low), ("<=", high)]
    inside = " AND ".join(f"`{column}` {op} {sql_literal(bound)}" for op, bound in bounds if bound is not None)
    return Check("accepted_range", column, f"NOT ({inside})", **scope)


@dataclass(frozen=True)
class Singular:
    """A check given as a query that returns the failing rows."""

    name: str
    query: Callable[[], DataFrame]
    severity: str = "error"


def _status(failing: Column, severity: Column) -> Column:
    return F.when(failing == 0, "pass").when(severity == "warn", "warn").otherwise("error")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows (for ``unique``: the values) that fail one check."""
    if check.kind != "unique":
        return df.where(check.failing())
    scoped = df if check.where is None else df.where(check.where)
    repeated = scoped.where(F.col(check.column).isNotNull()).groupBy(check.column).agg(F.count("*").alias("n"))
    return repeated.where(F.col("n") > 1)


def _result(relation: str, check: Check | Singular, failing: str) -> str:
    kind, column = (check.kind, check.column) if isinstance(check, Check) else (check.name, "")
    shown = zip(
        ("relation", "check_name", "column_name", "severity"), (relation, kind, column, check.severity), strict=True
    )
    named = ", ".join(f"{sql_literal(value)} AS {name}" for name, value in shown)
    return f"struct({named}, {failing} AS failing_rows)"


def _results(counts: DataFrame, rows: Iterable[str]) -> DataFrame:
    """Columns of counts -> one row per check."""
    return counts.select(F.expr(f"inline(array({', '.join(rows)}))"))


def run_checks(df: DataFrame, checks: Sequence[Check], relation: str = "") -> DataFrame:
    """One result row per check.

    All row-level checks are one aggregate over one scan of the columns they
    name. Uniqueness needs its own grouping, one per check.
    """
    rowwise = [c for c in checks if c.kind != "unique"]
    parts = []
    if rowwise:
        counts = df.agg(*[F.count_if(c.failing()).alias(f"c{n}") for n, c in enumerate(rowwise)])
        parts.append(_results(counts, [_result(relation, c, f"c{n}") for n, c in enumerate(rowwise)]))
    parts += [
        _results(failing_rows(df, c).agg(F.count("*").alias("n")), [_result(relation, c, "n")])
        for c in checks
        if c.kind == "unique"
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("status", _status(F.col("failing_rows"), F.col("severity")))


def run_singular(check: Singular, relation: str = "") -> DataFrame:
    counted = _results(check.query().agg(F.count("*").alias("n")), [_result(relation, check, "n")])
    return counted.withColumn("status", _status(F.col("failing_rows"), F.col("severity")))


class GateError(RuntimeError):
    """A check of severity error failed; downstream work must not run."""


def run_gates(results: Iterable[DataFrame]) -> list:
    """Evaluate gate results and raise if one is an error. Warnings pass.

    Collects one row per declared check.
    """
    rows = reduce(DataFrame.unionByName, results).collect()
    errors = [f"{r.relation}.{r.check_name}({r.column_name}): {r.failing_rows}" for r in rows if r.status == "error"]
    if errors:
        raise GateError("; ".join(sorted(errors)))
    return rows


@dataclass
class Audit:
    """Row-wise checks of a relation that are counted while it is written, without reading it again."""

    relation: str
    checks: Sequence[Check]
    seen: Observation

    def gate(self) -> None:
        """After the write: raise if a check of severity error failed. A task that ran twice may count a row
        twice, which turns no pass into a failure."""
        counts = self.seen.get
        errors = [
            f"{self.relation}.{c.kind}({c.column}): {counts[f'c{n}']}"
            for n, c in enumerate(self.checks) if c.severity == "error" and counts[f"c{n}"]
        ]
        if errors:
            raise GateError("; ".join(sorted(errors)))


def audited(df: DataFrame, checks: Sequence[Check], relation: str) -> tuple[DataFrame, Audit]:
    """``df`` to write, and the audit of its row-wise checks."""
    rowwise = [c for c in checks if c.kind != "unique"]
    audit = Audit(relation, rowwise, Observation())
    return df.observe(audit.seen, *[F.count_if(c.failing()).alias(f"c{n}") for n, c in enumerate(rowwise)]), audit


# The declared checks per relation.
_STUDY = [b.region for b in REGIONS]
_ALL_REGIONS = [*_STUDY, BACKGROUND]
_ADSB_ROWS = "position_source = 0"


def declared_checks() -> Mapping[str, list[Check]]:
    return {
        "region_area": [
            not_null("region"),
            unique("region"),
            not_null("area_sqdeg"),
        ],
        "states": [
            not_null("snapshot_time"),
            not_null("region"),
            accepted_values("region", _ALL_REGIONS),
            not_null("icao24"),
            accepted_range("longitude", -180, 180, where=_ADSB_ROWS),
            accepted_range("latitude", -90, 90, where=_ADSB_ROWS),
            accepted_range("velocity", 0, where=_ADSB_ROWS),
            accepted_range("true_track", 0, 360, where=_ADSB_ROWS),
            accepted_values("position_source", POSITION_SOURCES),
        ],
        "grid_counts": [
            not_null("dt"),
            not_null("region"),
            accepted_values("region", _ALL_REGIONS),
            not_null("cell_lon"),
            accepted_range("cell_lon", -10, 70),
            not_null("cell_lat"),
            accepted_range("cell_lat", 18, 60),
            not_null("aircraft_count"),
            accepted_range("aircraft_count", 1),
        ],
        "region_density": [
            not_null("snapshot_time"),
            not_null("region"),
            accepted_values("region", _STUDY),
            not_null("aircraft_count"),
            accepted_range("aircraft_count", 0),
            not_null("area_sqdeg"),
            accepted_range("area_sqdeg", 1),
            not_null("density"),
            accepted_range("density", 0),
        ],
        "aircraft_points": [
            not_null("snapshot_bucket"),
            not_null("region"),
            accepted_values("region", _ALL_REGIONS),
            not_null("longitude"),
            accepted_range("longitude", -180, 180),
            not_null("latitude"),
            accepted_range("latitude", -90, 90),
        ],
        "grid_density": [
            not_null("dt"),
            not_null("region"),
            accepted_values("region", _ALL_REGIONS),
            not_null("cell_lon"),
            accepted_range("cell_lon", -10, 70),
            not_null("cell_lat"),
            accepted_range("cell_lat", 18, 60),
            not_null("aircraft_count"),
            accepted_range("aircraft_count", 1),
            not_null("coverage_pct"),
            accepted_range("coverage_pct", 0),
        ],
    }
