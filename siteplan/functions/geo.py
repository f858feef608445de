"""Planar geometry on degree coordinates, and WKT text, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length in miles of one degree of longitude, by whole degree of latitude.
LON_DEGREE_MILES = {
    33: 58.07,
    34: 57.41,
    35: 56.72,
    36: 56.02,
    37: 55.31,
    38: 54.58,
    39: 53.83,
    40: 53.07,
    41: 52.28,
    42: 51.38,
    46: 48.13,
    47: 47.26,
    48: 46.37,
}
# Fixed value: length in miles of one degree of latitude.
LAT_DEGREE_MILES = 69

# WGS 84 ellipsoid.
WGS84_A = 6378137.0
WGS84_E2 = 0.00669437999014


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def dist(lon1, lat1, lon2, lat2) -> Column:
    """Euclidean distance in degrees.

    Radius tests compare this rooted value, never its square: lattice neighbours sit
    exactly on the radius and the two forms then round differently.
    """
    dx, dy = _c(lon1) - _c(lon2), _c(lat1) - _c(lat2)
    return F.sqrt(dx * dx + dy * dy)


def rect_area(lon1, lat1, lon2, lat2, strict: bool = False) -> Column:
    """Rectangle area in square miles; NULL (or an error) where the middle latitude has no table entry."""
    lon1, lat1, lon2, lat2 = map(_c, (lon1, lat1, lon2, lat2))
    table = F.create_map(*[F.lit(v) for item in LON_DEGREE_MILES.items() for v in item])
    middle = F.abs(((lat1 - lat2) / F.lit(2.0) + lat2).cast("int"))
    miles = F.try_element_at(table, middle)
    if strict:
        known = middle.isNull() | miles.isNotNull()
        message = F.concat(F.lit("no longitude length for latitude "), middle)
        miles = F.when(known, miles).otherwise(F.raise_error(message).cast("double"))
    return F.abs(lon1 - lon2) * miles * F.abs(lat1 - lat2) * F.lit(LAT_DEGREE_MILES)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, computed once: a lambda's variable stands for it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _edges(ring: Column) -> Column:
    """Edges of the closed ring, relative to its first vertex to keep the products small."""

    def moved(r: Column) -> Column:
        first = lambda o: F.transform(
            r, lambda p: F.struct((p[0] - o["x"]).alias("x"), (p[1] - o["y"]).alias("y"))
        )
        return bind(F.struct(r[0][0].alias("x"), r[0][1].alias("y")), first)

    def edges(m: Column) -> Column:
        shifted = F.concat(F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0))), F.slice(m, 1, 1))
        return F.zip_with(
            m,
            shifted,
            lambda a, b: F.struct(
                (a["x"] * b["y"] - b["x"] * a["y"]).alias("cross"),
                (a["x"] + b["x"]).alias("sx"),
                (a["y"] + b["y"]).alias("sy"),
                F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])).alias("len"),
            ),
        )

    return bind(bind(ring, moved), edges)


def ring_centroid(ring) -> Column:
    """Centroid of a ring as struct<x,y>; a ring without area falls back to its outline's centroid."""
    ring = _c(ring)
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("a", "ax", "ay", "l", "lx", "ly")])
    sums = F.aggregate(
        _edges(ring),
        zero,
        lambda s, e: F.struct(
            (s["a"] + e["cross"]).alias("a"),
            (s["ax"] + e["sx"] * e["cross"]).alias("ax"),
            (s["ay"] + e["sy"] * e["cross"]).alias("ay"),
            (s["l"] + e["len"]).alias("l"),
            (s["lx"] + e["sx"] * e["len"]).alias("lx"),
            (s["ly"] + e["sy"] * e["len"]).alias("ly"),
        ),
        lambda s: F.when(
            s["a"] != 0.0,
            F.struct((s["ax"] / (s["a"] * 3.0)).alias("x"), (s["ay"] / (s["a"] * 3.0)).alias("y")),
        )
        .when(
            s["l"] != 0.0,
            F.struct((s["lx"] / (s["l"] * 2.0)).alias("x"), (s["ly"] / (s["l"] * 2.0)).alias("y")),
        )
        .otherwise(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))),
    )
    return F.when(
        F.size(ring) > 0,
        F.struct((ring[0][0] + sums["x"]).alias("x"), (ring[0][1] + sums["y"]).alias("y")),
    )


def mercator_xy(lon, lat) -> tuple[Column, Column]:
    """Ellipsoidal Mercator metres (EPSG:3395) of a degree position."""
    phi = F.radians(_c(lat))
    e = WGS84_E2**0.5
    sin = F.lit(e) * F.sin(phi)
    x = F.radians(_c(lon)) * F.lit(WGS84_A)
    y = F.lit(WGS84_A) * F.ln(
        F.tan(F.lit(0.7853981633974483) + phi / 2.0) * F.pow((1.0 - sin) / (1.0 + sin), F.lit(e / 2.0))
    )
    return x, y


def ring_area_3395(ring) -> Column:
    """Area in square metres of the ring on the EPSG:3395 map (inflated away from the equator)."""
    ring = _c(ring)

    def projected(p: Column) -> Column:
        x, y = mercator_xy(p[0], p[1])
        return F.array(x, y)

    doubled = F.aggregate(_edges(F.transform(ring, projected)), F.lit(0.0), lambda s, e: s + e["cross"])
    return F.abs(doubled) / 2.0


def rect_to_wkt(lon1, lat1, lon2, lat2) -> Column:
    """Rectangle as a closed POLYGON, starting at the lower left and going round by (lon2, lat1)."""
    lon1, lat1, lon2, lat2 = map(_c, (lon1, lat1, lon2, lat2))
    return F.format_string(
        "POLYGON ((%s %s, %s %s, %s %s, %s %s, %s %s))",
        *[c.cast("string") for c in (lon1, lat1, lon2, lat1, lon2, lat2, lon1, lat2, lon1, lat1)],
    )


def point_to_wkt(lon, lat) -> Column:
    return F.format_string("POINT (%s %s)", _c(lon).cast("string"), _c(lat).cast("string"))


def wkt_to_rect(wkt) -> Column:
    """Bounds struct<lon1,lat1,lon2,lat2> of a rectangle's WKT."""
    numbers = F.transform(
        F.regexp_extract_all(_c(wkt), F.lit(r"(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"), F.lit(1)), lambda t: t.cast("double")
    )
    return F.struct(
        F.get(numbers, F.lit(0)).alias("lon1"),
        F.get(numbers, F.lit(1)).alias("lat1"),
        F.get(numbers, F.lit(4)).alias("lon2"),
        F.get(numbers, F.lit(5)).alias("lat2"),
    )
