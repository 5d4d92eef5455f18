"""Study parameters. Every operator takes these as arguments; nothing is global."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Box:
    """Axis-aligned lon/lat rectangle with inclusive edges."""

    region: str
    lomin: float
    lomax: float
    lamin: float
    lamax: float

    @property
    def area_sqdeg(self) -> float:
        return (self.lamax - self.lamin) * (self.lomax - self.lomin)


# Study area and region boxes. The order is the priority, because
# the first two boxes share the edge latitude 42 between longitudes 36 and 44.
STUDY_AREA = Box("study_area", -10.0, 70.0, 18.0, 60.0)
REGIONS = (
    Box("ukraine", 18.0, 44.0, 42.0, 55.0),
    Box("middle_east", 36.0, 66.0, 24.0, 42.0),
    Box("west_europe", 2.0, 12.0, 45.0, 52.0),
)
BACKGROUND = "other"

# Codes of the position source field.
POSITION_SOURCES = {0: "ADS-B", 1: "ASTERIX", 2: "MLAT", 3: "FLARM"}
ADSB = 0


@dataclass(frozen=True)
class Config:
    study_area: Box = STUDY_AREA
    regions: tuple[Box, ...] = REGIONS
    background: str = BACKGROUND
    sources: tuple[int, ...] = (ADSB,)
    cell_deg: float = 0.5
    frame_minutes: tuple[int, ...] = (0, 30)
    frame_seconds: int = 1800
    expected_snapshots: int = 144
    min_snapshots: int = 115
    completeness_days: int = 3
    health_days: int = 7
    map_days: int = 3
    freshness_warn_s: int = 36 * 3600
    freshness_error_s: int = 48 * 3600
    max_ingest_lag_min: int = 20
    mart_ready_minute: int = 65  # marts are expected from 01:05 UTC on
    env: str = "prod"
    baseline: str = "west_europe"
    region_names: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "region_names", tuple(b.region for b in self.regions))
