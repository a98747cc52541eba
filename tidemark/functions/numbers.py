"""Null-tolerant sums, great-circle distance and histogram buckets."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column

# Mean earth radius in miles, kilometres per mile.
EARTH_RADIUS_MI = 3961
KM_PER_MILE = 1.60934


def safe_add(*fields) -> Column:
    """Sum in which null counts as zero."""
    if not fields:
        raise ValueError("safe_add needs at least one field")
    return reduce(add, [F.coalesce(as_column(f), F.lit(0)) for f in fields])


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    dphi = phi2 - phi1
    dlambda = F.radians(as_column(lon2)) - F.radians(as_column(lon1))
    half_chord = (
        F.pow(F.sin(dphi / 2), F.lit(2))
        + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlambda / 2), F.lit(2))
    )
    # rounding may lift antipodal points a hair above 1, where asin is undefined
    miles = F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(F.least(half_chord, F.lit(1.0))))
    return miles if unit == "mi" else miles * F.lit(KM_PER_MILE)


def width_bucket(value, min_value, max_value, num_buckets: int) -> Column:
    """Bucket 1..n of equal width; 0 below the range, n + 1 from its upper end on."""
    lo = min_value if isinstance(min_value, Column) else F.lit(float(min_value))
    hi = max_value if isinstance(max_value, Column) else F.lit(float(max_value))
    return F.width_bucket(as_column(value), lo, hi, F.lit(num_buckets))
