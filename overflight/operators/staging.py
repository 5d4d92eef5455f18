"""Bronze payload -> one typed row per aircraft and snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from overflight.config import Config
from overflight.functions.geo import in_box, tag_region
from overflight.functions.text import clean_text
from overflight.schemas import LAT, LON, STAGING_COLUMNS, STATE_FIELDS


def _vectors(raw: Column | str) -> Column:
    """The document's state vectors as arrays of text.

    A document holding something else than arrays among its vectors does not
    fit the first schema; it is read element by element, so that one odd
    element does not lose the others.
    """
    plain = F.from_json(raw, "states ARRAY<ARRAY<STRING>>")["states"]
    elements = F.from_json(raw, "states ARRAY<STRING>")["states"]
    return F.coalesce(plain, F.transform(elements, lambda vector: F.from_json(vector, "ARRAY<STRING>")))


def explode_states(bronze: DataFrame) -> DataFrame:
    """One row per state vector; a NULL, empty or absent list gives no row."""
    return bronze.select("snapshot_time", "_loaded_at", F.explode(_vectors("raw")).alias("vector"))


def state_count(raw: Column | str) -> Column:
    """Number of state vectors in a document, 0 if it has none."""
    return F.coalesce(F.size(F.from_json(raw, "states ARRAY<STRING>")["states"]), F.lit(0))


def _field(index: int, strict: bool = True) -> Column:
    # get() gives NULL past the end of a short vector, as a missing path does
    name, dtype = STATE_FIELDS[index]
    if dtype == "string":
        return F.expr(f"get(vector, {index})").alias(name)
    if dtype.startswith("array"):
        return F.expr(f"from_json(get(vector, {index}), '{dtype}')").alias(name)
    return F.expr(f"{'cast' if strict else 'try_cast'}(get(vector, {index}) AS {dtype})").alias(name)


def decode_state_vector(exploded: DataFrame, strict: bool = True) -> DataFrame:
    """Positions 0-16 of ``vector`` -> named, typed columns.

    ``strict`` raises on text that does not fit its type; otherwise such a
    value becomes NULL and ``cast_failures`` finds the row.
    """
    others = [c for c in exploded.columns if c != "vector"]
    fields = [
        clean_text(_field(i, strict)).alias(name) if name == "callsign" else _field(i, strict)
        for i, (name, _) in enumerate(STATE_FIELDS)
    ]
    return exploded.select(*others, *fields)


def cast_failures(exploded: DataFrame) -> DataFrame:
    """Vectors with at least one value that does not fit its type, and which."""
    bad = [
        F.when(F.get("vector", F.lit(i)).isNotNull() & _field(i, strict=False).isNull(), F.lit(name))
        for i, (name, dtype) in enumerate(STATE_FIELDS)
        if dtype != "string"
    ]
    failed = F.array_compact(F.array(*bad))
    return exploded.withColumn("failed_fields", failed).where(F.size("failed_fields") > 0)


def in_study_area(exploded: DataFrame, cfg: Config, strict: bool = True) -> DataFrame:
    """Vectors positioned inside the study area, edges included."""
    return exploded.where(in_box(_field(LON, strict), _field(LAT, strict), cfg.study_area))


def stage(bronze: DataFrame, cfg: Config = Config(), strict: bool = True) -> DataFrame:
    """The staging relation: 20 columns, region derived from the position.

    The position filter sits directly on the exploded vectors, so the other
    15 casts run only for rows that stay. The collection region of bronze is
    not used.
    """
    located = in_study_area(explode_states(bronze), cfg, strict)
    decoded = decode_state_vector(located, strict)
    region = tag_region("longitude", "latitude", cfg.regions, cfg.background).alias("region")
    return decoded.select(*[region if name == "region" else name for name in STAGING_COLUMNS])
