"""Structured Streaming forms of the operators."""

from overflight.streaming.aggregates import coverage, frames, region_density
from overflight.streaming.alert_jobs import alerts, metrics
from overflight.streaming.arrivals import apply_late, close_days, ingest

__all__ = ["alerts", "apply_late", "close_days", "coverage", "frames", "ingest", "metrics", "region_density"]
