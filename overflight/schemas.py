"""Fixed schemas; nothing is inferred from data."""

from __future__ import annotations

# Position in the state vector -> (column, type).
STATE_FIELDS = (
    ("icao24", "string"),
    ("callsign", "string"),
    ("origin_country", "string"),
    ("time_position", "bigint"),
    ("last_contact", "bigint"),
    ("longitude", "double"),
    ("latitude", "double"),
    ("baro_altitude", "double"),
    ("on_ground", "boolean"),
    ("velocity", "double"),
    ("true_track", "double"),
    ("vertical_rate", "double"),
    ("sensors", "array<bigint>"),
    ("geo_altitude", "double"),
    ("squawk", "string"),
    ("spi", "boolean"),
    ("position_source", "bigint"),
)
LON, LAT = 5, 6

RAW_SCHEMA = "value STRING, region STRING, dt STRING"
BRONZE_SCHEMA = "snapshot_time TIMESTAMP, region STRING, raw STRING, _loaded_at TIMESTAMP, dt DATE"
STAGING_COLUMNS = ("snapshot_time", "region", "_loaded_at", *(name for name, _ in STATE_FIELDS))
AREA_SCHEMA = "region STRING, area_sqdeg DOUBLE"
BOX_SCHEMA = "region STRING, priority INT, lomin DOUBLE, lomax DOUBLE, lamin DOUBLE, lamax DOUBLE"
METRIC_SCHEMA = "ts TIMESTAMP, metric STRING, label STRING, value DOUBLE"
