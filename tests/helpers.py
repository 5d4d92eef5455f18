"""Small hand-written snapshots."""

import json
from datetime import datetime, timezone

NAMES = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude", "baro_altitude",
    "on_ground", "velocity", "true_track", "vertical_rate", "sensors", "geo_altitude", "squawk", "spi",
    "position_source",
)


def vector(lon, lat, on_ground=False, source=0, **other):
    values = dict.fromkeys(NAMES)
    values.update(icao24="abc123", callsign="TEST01  ", origin_country="Nowhere", time_position=1, last_contact=2,
                  baro_altitude=1000.5, velocity=200, true_track=90.0, vertical_rate=0, squawk="1000", spi=False)
    values.update(other, longitude=lon, latitude=lat, on_ground=on_ground, position_source=source)
    return [values[n] for n in NAMES]


def epoch(*at):
    return int(datetime(*at, tzinfo=timezone.utc).timestamp())


def document(time, states):
    return json.dumps({"time": time, "states": states})


def write_file(root, region, dt, name, text):
    folder = root / f"region={region}" / f"dt={dt}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def raw_frame(spark, documents, region="global", dt="20260702"):
    return spark.createDataFrame([(d, region, dt) for d in documents], "value STRING, region STRING, dt STRING")


def bronze_frame(spark, documents):
    from overflight.sources.bronze import to_bronze

    return to_bronze(raw_frame(spark, documents), loaded_at=datetime(2026, 7, 3))


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
