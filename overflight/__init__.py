"""Aircraft-snapshot analytics on Spark: raw JSON snapshots to density marts,
quality checks, alerts and their streaming counterparts."""

from overflight.config import Box, Config

__all__ = ["Box", "Config"]
