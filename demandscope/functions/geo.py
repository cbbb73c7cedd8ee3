"""Map projection as column expressions: WGS 84 to UTM zone 44 north."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the ellipsoid and of the zone.
FLATTENING = 1 / 298.257223563
SEMI_MAJOR = 6378137.0
CENTRAL_MERIDIAN = 81.0
SCALE = 0.9996
FALSE_EASTING = 500000.0

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_SERIES = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_E = 2 * math.sqrt(_N) / (1 + _N)


def utm44n(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres by the Krüger series to third order; null for a missing coordinate."""
    return metres(*angles(conformal(lat), lon))


def conformal(lat: Column) -> Column:
    """Tangent of the conformal latitude: the first step of ``utm44n``, for plans that keep the steps apart."""
    phi = F.radians(lat)
    return F.sinh(F.atanh(F.sin(phi)) - F.lit(_E) * F.atanh(F.lit(_E) * F.sin(phi)))


def angles(t: Column, lon: Column) -> tuple[Column, Column]:
    """The second step: (xi, eta)."""
    dl = F.radians(lon - F.lit(CENTRAL_MERIDIAN))
    return F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(F.lit(1.0) + t * t))


def metres(xi: Column, eta: Column) -> tuple[Column, Column]:
    """The last step: (easting, northing)."""
    x, y = eta, xi
    for j, a in enumerate(_SERIES, 1):
        x = x + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        y = y + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    return F.lit(FALSE_EASTING) + F.lit(_RADIUS) * x, F.lit(_RADIUS) * y


def gaussian_decay(distance: Column, sigma: float) -> Column:
    return F.exp(-(distance * distance) / F.lit(2.0 * sigma * sigma))
