"""Location quality expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrasift.functions.numeric import label_first


class Box(NamedTuple):
    """Inclusive latitude / longitude bounds."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# The three bounding boxes in use (model, business rule, profile).
MODEL_BOX = Box(3, 13, 24, 36)
RULE_BOX = Box(3.5, 12.2, 24, 36)
PROFILE_BOX = Box(3.0, 13.0, 23.0, 36.0)

# Fixed value: kilometres per degree.
KM_PER_DEGREE = 111.32


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_coordinates(lat: Column | str, lon: Column | str) -> Column:
    """P2."""
    return _col(lat).isNull() | _col(lon).isNull()


def inside_box(lat: Column | str, lon: Column | str, box: Box) -> Column:
    """P31."""
    return _col(lat).between(box.lat_min, box.lat_max) & _col(lon).between(box.lon_min, box.lon_max)


def coordinate_quality(lat: Column | str, lon: Column | str, box: Box = MODEL_BOX) -> Column:
    """P20."""
    return label_first(
        [("MISSING", missing_coordinates(lat, lon)), ("VALID", inside_box(lat, lon, box))], "SUSPICIOUS"
    )


def location_confidence(score: Column | str, quality: Column | str) -> Column:
    """P22."""
    s = _col(score)
    return label_first([("HIGH", (s >= 90) & (_col(quality) == "VALID")), ("MEDIUM", s >= 60)], "LOW")


def distance_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Flat-earth distance scaled by the cosine of the first latitude."""
    north = (lat_a - lat_b) * KM_PER_DEGREE
    east = (lon_a - lon_b) * KM_PER_DEGREE * F.cos(F.radians(lat_a))
    return F.sqrt(north * north + east * east)


def valid_code(code: Column | str, looked_up: Column | str, special: tuple[str, ...] = ()) -> Column:
    """The code was found in the lookup, or is one of the special codes."""
    found = _col(code).isNotNull() & _col(looked_up).isNotNull()
    if special:
        found = found | F.coalesce(_col(code).isin(*special), F.lit(False))
    return found


def canonical_name(looked_up: Column | str, raw: Column | str) -> Column:
    """P24."""
    return F.coalesce(F.lower(_col(looked_up)), F.lower(F.trim(_col(raw))))
