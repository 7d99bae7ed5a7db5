"""Geography: the 5 km grid of a Lambert conformal conic projection, distances and travel time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.clean import coordinate

# The projection's earth radius, cell, standard parallels, origin, offsets and extent.
EARTH_KM, CELL_KM = 6371.00877, 5.0
PARALLELS, ORIGIN, OFFSET, EXTENT = (30.0, 60.0), (38.0, 126.0), (43, 136), (149, 253)
_HALF_COLATITUDE = lambda degrees: math.tan(math.pi / 4 + math.radians(degrees) / 2)
_CONE = math.log(math.cos(math.radians(PARALLELS[0])) / math.cos(math.radians(PARALLELS[1]))) / math.log(_HALF_COLATITUDE(PARALLELS[1]) / _HALF_COLATITUDE(PARALLELS[0]))
_SCALE = EARTH_KM / CELL_KM * _HALF_COLATITUDE(PARALLELS[0]) ** _CONE * math.cos(math.radians(PARALLELS[0])) / _CONE
_RHO0 = _SCALE / _HALF_COLATITUDE(ORIGIN[0]) ** _CONE


def grid(lat: Column, lon: Column) -> Column:
    """struct(nx, ny) of the cell, or null for bad positions and those outside the grid. Plain expressions."""
    lat, lon = coordinate(lat, 90), coordinate(lon, 180)
    rho = _SCALE / F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), _CONE)
    turn = F.radians(lon) - math.radians(ORIGIN[1])
    theta = _CONE * (F.pmod(turn + math.pi, F.lit(2 * math.pi)) - math.pi)
    nx = F.floor(rho * F.sin(theta) + OFFSET[0] + 0.5)
    ny = F.floor(_RHO0 - rho * F.cos(theta) + OFFSET[1] + 0.5)
    inside = (lat > 0) & (lat < 90) & nx.between(1, EXTENT[0]) & ny.between(1, EXTENT[1])
    return F.when(inside, F.struct(nx.alias("nx"), ny.alias("ny")))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    a = F.when(a.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), a)))  # null where a position is unknown
    return 2 * radius * F.atan2(F.sqrt(a), F.sqrt(1 - a))


# The ellipsoid WGS 84, metres.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
#: Rounds of the geodesic's iteration; a round gains three digits or more away from antipodes.
ROUNDS, SETTLED = 8, 1e-12


def with_geodesic(df: DataFrame, lat1: Column, lon1: Column, lat2: Column, lon2: Column, name: str) -> DataFrame:
    """Adds the length in metres of the shortest way on the ellipsoid between two positions in degrees, null where one is null.

    The inverse problem by Vincenty's iteration, unrolled as columns: each step is a projection of its own, so no
    expression is repeated. Positions nearly opposite each other, for which the iteration does not settle (about half a
    degree around the antipode), get the great circle's length on the sphere of mean radius, at most 0.6 percent off.
    """
    f, a = FLATTENING, SEMI_MAJOR
    b = a * (1 - f)
    c = lambda x: F.col(f"_{x}")
    shift = F.radians(lon2.cast("double") - lon1.cast("double"))
    df = df.withColumns({"_f1": F.radians(lat1.cast("double")), "_f2": F.radians(lat2.cast("double")), "_l0": F.pmod(shift + math.pi, F.lit(2 * math.pi)) - math.pi})
    df = df.withColumns({"_u1": F.atan((1 - f) * F.tan(c("f1"))), "_u2": F.atan((1 - f) * F.tan(c("f2"))), "_l": c("l0")})
    df = df.withColumns({"_s1": F.sin("_u1"), "_c1": F.cos("_u1"), "_s2": F.sin("_u2"), "_c2": F.cos("_u2")})
    for _ in range(ROUNDS):
        df = df.withColumns({"_sl": F.sin("_l"), "_cl": F.cos("_l"), "_was": c("l")})
        across, along = c("c2") * c("sl"), c("c1") * c("s2") - c("s1") * c("c2") * c("cl")
        df = df.withColumns({"_ss": F.sqrt(across * across + along * along), "_cs": c("s1") * c("s2") + c("c1") * c("c2") * c("cl")})
        df = df.withColumns({"_sa": F.when(c("ss") == 0, 0.0).otherwise(c("c1") * c("c2") * c("sl") / c("ss")), "_sigma": F.atan2("_ss", "_cs")})
        df = df.withColumn("_ca", 1 - c("sa") * c("sa"))
        df = df.withColumns({"_cm": F.when(c("ca") < 1e-15, 0.0).otherwise(c("cs") - 2 * c("s1") * c("s2") / c("ca")), "_k": f / 16 * c("ca") * (4 + f * (4 - 3 * c("ca")))})
        df = df.withColumn("_l", c("l0") + (1 - c("k")) * f * c("sa") * (c("sigma") + c("k") * c("ss") * (c("cm") + c("k") * c("cs") * (2 * c("cm") * c("cm") - 1))))
    df = df.withColumn("_q", c("ca") * (a * a - b * b) / (b * b))
    df = df.withColumns({"_big": 1 + c("q") / 16384 * (4096 + c("q") * (-768 + c("q") * (320 - 175 * c("q")))), "_small": c("q") / 1024 * (256 + c("q") * (-128 + c("q") * (74 - 47 * c("q"))))})
    turn = c("small") * c("ss") * (c("cm") + c("small") / 4 * (c("cs") * (2 * c("cm") * c("cm") - 1) - c("small") / 6 * c("cm") * (4 * c("ss") * c("ss") - 3) * (4 * c("cm") * c("cm") - 3)))
    same = (c("f1") == c("f2")) & (c("l0") == 0)
    settled = (F.abs(c("l") - c("was")) < SETTLED) & (F.abs(c("l")) <= math.pi)
    round_trip = 1000 * haversine_km(F.degrees("_f1"), F.lit(0.0), F.degrees("_f2"), F.degrees("_l0"), 6371.0087714)
    length = F.when(same, 0.0).when(settled, b * c("big") * (c("sigma") - turn)).otherwise(round_trip)
    steps = "f1 f2 l0 u1 u2 l s1 c1 s2 c2 sl cl was ss cs sa sigma ca cm k q big small".split()
    return df.withColumn(name, F.when(c("f1").isNotNull() & c("f2").isNotNull() & c("l0").isNotNull(), length)).drop(*[f"_{x}" for x in steps])


def travel_minutes(km: Column) -> Column:
    """20 minutes a kilometre, halves to even."""
    return F.bround(km * 20, 0).cast("long")


def weather_link(lat: Column, lon: Column, known: Column | None = None) -> Column:
    """Link state, grid and reason; a grid known otherwise must agree with the computed one."""
    cell = grid(lat, lon)
    reason = F.when(cell.isNull(), "NO_VALID_COORDINATE")
    if known is not None:
        reason = reason.when(known.isNotNull() & ((known["nx"] != cell["nx"]) | (known["ny"] != cell["ny"])), "GRID_MISMATCH")
    return F.struct(F.when(reason.isNull(), "LINKED").otherwise("UNLINKED").alias("state"), F.when(reason.isNull(), cell).alias("grid"), reason.alias("reason"))
