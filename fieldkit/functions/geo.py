"""Great-circle distances and coordinate rounding.

Distance from the haversine of the central angle: with hav(t) = sin(t/2)^2,

    hav(angle) = hav(lat2 - lat1) + cos(lat1) cos(lat2) hav(lon2 - lon1)

and angle = 2 asin(sqrt(hav)). Rounding can carry the sum past 1 for nearly
opposite points, so it is held at 1 first. One definition serves columns and
numpy arrays: ``_central_angle`` gets the functions of either.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldkit.params import EARTH_RADIUS_KM, HAYFORD_RADIUS_KM

_ON_COLUMNS = SimpleNamespace(radians=F.radians, sin=F.sin, cos=F.cos, asin=F.asin, sqrt=F.sqrt,
                              at_most_1=lambda v: F.least(v, F.lit(1.0)))
_ON_ARRAYS = SimpleNamespace(radians=np.radians, sin=np.sin, cos=np.cos, asin=np.arcsin, sqrt=np.sqrt,
                             at_most_1=lambda v: np.minimum(v, 1.0))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _hav(angle, m):
    half = m.sin(angle / 2)
    return half * half


def _central_angle(lat1, lon1, lat2, lon2, m):
    phi1, phi2 = m.radians(lat1), m.radians(lat2)
    h = _hav(phi2 - phi1, m) + m.cos(phi1) * m.cos(phi2) * _hav(m.radians(lon2 - lon1), m)
    return m.asin(m.sqrt(m.at_most_1(h))) * 2


def haversine(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km between (lat1, lon1) and (lat2, lon2) as a column (SC-18)."""
    return _central_angle(_c(lat1), _c(lon1), _c(lat2), _c(lon2), _ON_COLUMNS) * F.lit(float(radius_km))


def haversine_hayford(lat1, lon1, lat2, lon2) -> Column:
    """The same on the Hayford ellipsoid's radius (SC-19)."""
    return haversine(lat1, lon1, lat2, lon2, HAYFORD_RADIUS_KM)


def distance_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> np.ndarray:
    """The same for numpy arrays (and numbers)."""
    lat1, lon1, lat2, lon2 = (np.asarray(v, np.float64) for v in (lat1, lon1, lat2, lon2))
    return _central_angle(lat1, lon1, lat2, lon2, _ON_ARRAYS) * radius_km


def round6(c) -> Column:
    """Round half up to 6 decimals with plain IEEE arithmetic.

    ``floor(v * 1e6 + 0.5) / 1e6`` gives bit-identical results in any engine
    that follows IEEE doubles, unlike decimal-based ``round``.
    """
    c = _c(c)
    return (F.floor(c * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6))
