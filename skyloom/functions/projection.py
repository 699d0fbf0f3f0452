"""Map projections as columns: UTM on WGS84, Web Mercator, and ECEF.

Transverse Mercator follows the Krueger series to sixth order in the third
flattening (Karney 2011), which is exact to nanometres within a zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The WGS84 ellipsoid and the UTM grid.
A = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
N = FLATTENING / (2 - FLATTENING)
K0 = 0.9996
FALSE_EASTING = 500000.0

_RECTIFYING = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)
# Series coefficients, forward and backward.
_ALPHA = (
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180 - 127 * N**5 / 288 + 7891 * N**6 / 37800,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440 + 281 * N**5 / 630 - 1983433 * N**6 / 1935360,
    61 * N**3 / 240 - 103 * N**4 / 140 + 15061 * N**5 / 26880 + 167603 * N**6 / 181440,
    49561 * N**4 / 161280 - 179 * N**5 / 168 + 6601661 * N**6 / 7257600,
    34729 * N**5 / 80640 - 3418889 * N**6 / 1995840,
    212378941 * N**6 / 319334400,
)
_BETA = (
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360 - 81 * N**5 / 512 + 96199 * N**6 / 604800,
    N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440 + 46 * N**5 / 105 - 1118711 * N**6 / 3870720,
    17 * N**3 / 480 - 37 * N**4 / 840 - 209 * N**5 / 4480 + 5569 * N**6 / 90720,
    4397 * N**4 / 161280 - 11 * N**5 / 504 - 830251 * N**6 / 7257600,
    4583 * N**5 / 161280 - 108847 * N**6 / 3991680,
    20648693 * N**6 / 638668800,
)
_E = E2**0.5


def zone_of(epsg: int) -> tuple[float, float]:
    """(central meridian in degrees, false northing) of EPSG 32601-32660 and 32701-32760."""
    zone, south = epsg % 100, epsg // 100 == 327
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"EPSG:{epsg} is not a UTM zone on WGS84")
    return zone * 6.0 - 183.0, 10_000_000.0 if south else 0.0


def with_utm(df: DataFrame, lon: Column, lat: Column, names: tuple[str, str] = ("easting", "northing"), epsg: int = 32633) -> DataFrame:
    """Add easting and northing in metres.

    Each step is a column of its own, so that expressions stay small and compiled.
    """
    meridian, false_northing = zone_of(epsg)
    steps = df.withColumns({"__s": F.sin(F.radians(lat)), "__l": F.radians(lon - meridian)})
    steps = steps.withColumn("__t", F.sinh(F.atanh("__s") - _E * F.atanh(_E * F.col("__s"))))
    steps = steps.withColumns({"__xi": F.atan2("__t", F.cos("__l")), "__eta": F.atanh(F.sin("__l") / F.sqrt(1 + F.col("__t") * F.col("__t")))})
    x, y = F.col("__eta"), F.col("__xi")
    for k, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * k * F.col("__xi")) * F.sinh(2 * k * F.col("__eta"))
        y = y + a * F.sin(2 * k * F.col("__xi")) * F.cosh(2 * k * F.col("__eta"))
    placed = steps.withColumns({names[0]: FALSE_EASTING + K0 * _RECTIFYING * x, names[1]: false_northing + K0 * _RECTIFYING * y})
    return placed.drop("__s", "__l", "__t", "__xi", "__eta")


def with_lon_lat(df: DataFrame, easting: Column, northing: Column, names: tuple[str, str] = ("lon", "lat"), epsg: int = 32633) -> DataFrame:
    """Add longitude and latitude in degrees."""
    meridian, false_northing = zone_of(epsg)
    steps = df.withColumns({"__xi": (northing - false_northing) / (K0 * _RECTIFYING), "__eta": (easting - FALSE_EASTING) / (K0 * _RECTIFYING)})
    x, y = F.col("__eta"), F.col("__xi")
    for k, b in enumerate(_BETA, 1):
        x = x - b * F.cos(2 * k * F.col("__xi")) * F.sinh(2 * k * F.col("__eta"))
        y = y - b * F.sin(2 * k * F.col("__xi")) * F.cosh(2 * k * F.col("__eta"))
    steps = steps.withColumns({"__x": x, "__y": y})
    steps = steps.withColumn("__bar", F.sin("__y") / F.sqrt(F.pow(F.sinh("__x"), 2) + F.pow(F.cos("__y"), 2)))
    # the conformal latitude back to the geographic one; three Newton steps reach double precision
    steps = steps.withColumn("__tau", F.col("__bar") / (1 - E2))
    tau = F.col("__tau")
    for _ in range(3):
        steps = steps.withColumn("__root", F.sqrt(1 + tau * tau))
        steps = steps.withColumn("__sigma", F.sinh(_E * F.atanh(_E * tau / F.col("__root"))))
        steps = steps.withColumn("__back", tau * F.sqrt(1 + F.pow("__sigma", F.lit(2))) - F.col("__sigma") * F.col("__root"))
        step = (F.col("__bar") - F.col("__back")) / F.sqrt(1 + F.pow("__back", F.lit(2))) * (1 + (1 - E2) * tau * tau) / ((1 - E2) * F.col("__root"))
        steps = steps.withColumn("__tau", tau + step)
    placed = steps.withColumns({names[0]: meridian + F.degrees(F.atan2(F.sinh("__x"), F.cos("__y"))), names[1]: F.degrees(F.atan("__tau"))})
    return placed.drop("__xi", "__eta", "__x", "__y", "__bar", "__tau", "__root", "__sigma", "__back")


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical metres."""
    return F.radians(lon) * A, F.log(F.tan(F.radians(lat) / 2 + 0.7853981633974483)) * A


def with_geodetic(df: DataFrame, x: Column, y: Column, z: Column, names: tuple[str, str, str] = ("lon", "lat", "height")) -> DataFrame:
    """Add longitude and latitude in degrees and the ellipsoidal height of ECEF places (Bowring, two rounds; G04)."""
    b = A * (1 - FLATTENING)
    second = (A * A - b * b) / b
    steps = df.withColumns({"__p": F.sqrt(x * x + y * y), "__z": z})
    steps = steps.withColumn("__beta", F.atan2(F.col("__z") * A, F.col("__p") * b))
    for _ in range(2):
        steps = steps.withColumn("__phi", F.atan2(F.col("__z") + second * F.pow(F.sin("__beta"), 3), F.col("__p") - E2 * A * F.pow(F.cos("__beta"), 3)))
        steps = steps.withColumn("__beta", F.atan2((1 - FLATTENING) * F.sin("__phi"), F.cos("__phi")))
    steps = steps.withColumn("__w", F.sqrt(1 - E2 * F.pow(F.sin("__phi"), 2)))
    height = F.col("__p") * F.cos("__phi") + F.col("__z") * F.sin("__phi") - A * F.col("__w")
    return steps.withColumns({names[0]: F.degrees(F.atan2(y, x)), names[1]: F.degrees("__phi"), names[2]: height}).drop("__p", "__z", "__beta", "__phi", "__w")


def with_utm_of_ecef(df: DataFrame, x: Column, y: Column, z: Column, names: tuple[str, str, str], epsg: int = 32633) -> DataFrame:
    """Add easting, northing and ellipsoidal height."""
    geodetic = with_geodetic(df, x, y, z, ("__lon", "__lat", names[2]))
    return with_utm(geodetic, F.col("__lon"), F.col("__lat"), names[:2], epsg).drop("__lon", "__lat")
