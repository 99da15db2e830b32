"""From the Dutch national grid (EPSG:28992) to WGS84 by the datum transformation itself.

The grid's oblique stereographic projection is undone onto its ellipsoid, the point is moved between
the two datums in space (seven parameters), and brought back to longitude and latitude. Against the
official points this leaves the decimetre or two that only the published correction grid, a table of
its own, takes away; `geometry.rd_to_wgs84` is the fast polynomial.
"""

from __future__ import annotations

from collections.abc import Callable
from math import asin, cos, pi, radians, sin, sqrt, tan

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import let

# The ellipsoids (half axis, flattening), the projection's origin in degrees, its scale and
# false origin, and the shift between the datums: metres, seconds of arc, parts in a million.
BESSEL = (6377397.155, 1 / 299.1528128)
WGS84 = (6378137.0, 1 / 298.257223563)
ORIGIN = (52.15616055555555, 5.38763888888889)
SCALE = 0.9999079
FALSE_ORIGIN = (155000.0, 463000.0)
SHIFT = (565.4171, 50.3319, 465.5524)
TURN = (-0.398957388243134, 0.343987817378283, -1.87740163998045)
STRETCH = 4.0725

_E2 = BESSEL[1] * (2 - BESSEL[1])
_E = sqrt(_E2)
_LAT, _LON = radians(ORIGIN[0]), radians(ORIGIN[1])
#: The sphere that the ellipsoid is first brought to: radius, exponent, factor, latitude of the origin.
RADIUS = sqrt(BESSEL[0] ** 2 * (1 - _E2) / (1 - _E2 * sin(_LAT) ** 2) ** 2)
POWER = sqrt(1 + _E2 * cos(_LAT) ** 4 / (1 - _E2))
_W = ((1 + sin(_LAT)) / (1 - sin(_LAT)) * ((1 - _E * sin(_LAT)) / (1 + _E * sin(_LAT))) ** _E) ** POWER
_SIN = (_W - 1) / (_W + 1)
FACTOR = (POWER + sin(_LAT)) * (1 - _SIN) / ((POWER - sin(_LAT)) * (1 + _SIN))
CENTRE = asin((FACTOR * _W - 1) / (FACTOR * _W + 1))
NEAR = 2 * RADIUS * SCALE * tan(pi / 4 - CENTRE / 2)
FAR = 4 * RADIUS * SCALE * tan(CENTRE) + NEAR
#: Latitude from conformal latitude: factors of the sines of 2, 4, 6 and 8 times the latter.
SERIES = (
    _E2 / 2 + 5 * _E2**2 / 24 + _E2**3 / 12 + 13 * _E2**4 / 360,
    7 * _E2**2 / 48 + 29 * _E2**3 / 240 + 811 * _E2**4 / 11520,
    7 * _E2**3 / 120 + 81 * _E2**4 / 1120,
    4279 * _E2**4 / 161280,
)
GROWTH = 1 + STRETCH * 1e-6
ANGLES = tuple(radians(t / 3600) for t in TURN)


def _from_grid(x: Column, y: Column, then: Callable[[Column, Column], Column]) -> Column:
    """`then` of latitude and longitude on the grid's ellipsoid, in radians."""

    def turned(at: Column, i: Column, j: Column) -> Column:
        lon = (j + 2 * i) / POWER + _LON
        chi = CENTRE + 2 * F.atan((at[1] - at[0] * F.tan(j / 2)) / (2 * RADIUS * SCALE))
        psi = let(F.sin(chi), lambda s: F.ln((1 + s) / (FACTOR * (1 - s))) / (2 * POWER))

        def latitude(c: Column) -> Column:
            total = c
            for k, factor in enumerate(SERIES, 1):
                total = total + factor * F.sin(c * (2 * k))
            return total

        conformal = 2 * F.atan(F.exp(psi)) - pi / 2
        return let(F.array(let(conformal, latitude), lon), lambda p: then(p[0], p[1]))

    return let(
        F.array(x - FALSE_ORIGIN[0], y - FALSE_ORIGIN[1]),
        lambda at: let(
            F.atan(at[0] / (FAR + at[1])),
            lambda i: let(F.atan(at[0] / (NEAR - at[1])) - i, lambda j: turned(at, i, j)),
        ),
    )


def _in_space(lat: Column, lon: Column) -> Column:
    """The point at height 0 as (x, y, z), moved to the other datum."""
    normal = BESSEL[0] / F.sqrt(1 - _E2 * F.sin(lat) * F.sin(lat))

    def moved(p: Column) -> Column:
        rx, ry, rz = ANGLES
        return F.array(
            SHIFT[0] + GROWTH * (p[0] - rz * p[1] + ry * p[2]),
            SHIFT[1] + GROWTH * (rz * p[0] + p[1] - rx * p[2]),
            SHIFT[2] + GROWTH * (-ry * p[0] + rx * p[1] + p[2]),
        )

    placed = let(normal, lambda v: F.array(v * F.cos(lat) * F.cos(lon), v * F.cos(lat) * F.sin(lon), v * (1 - _E2) * F.sin(lat)))
    return let(placed, moved)


def _to_degrees(p: Column) -> Column:
    """(longitude, latitude) in degrees on WGS84, exact to far below a millimetre near the ground."""
    a, f = WGS84
    e2, b = f * (2 - f), a * (1 - f)
    flat = F.sqrt(p[0] * p[0] + p[1] * p[1])
    lat = let(
        F.atan2(p[2] * a, flat * b),
        lambda t: F.atan2(
            p[2] + e2 / (1 - e2) * b * F.sin(t) * F.sin(t) * F.sin(t), flat - e2 * a * F.cos(t) * F.cos(t) * F.cos(t)
        ),
    )
    return F.array(F.degrees(F.atan2(p[1], p[0])), F.degrees(lat))


def rd_to_wgs84(x: Column, y: Column) -> Column:
    """The array (longitude, latitude) of a point of the grid; null where a coordinate is."""
    moved = _from_grid(x.cast("double"), y.cast("double"), lambda lat, lon: let(_in_space(lat, lon), _to_degrees))
    return F.when(x.isNotNull() & y.isNotNull(), moved)
