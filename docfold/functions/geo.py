"""Geometry (S4) and great-circle distance (Q10) as native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docfold.functions.arrays import let

# Fixed values of the well-known-binary type word: flag bits sit above the geometry code, and the
# ISO variants add 1000 / 2000 / 3000 for Z, M and ZM.
FLAG_MASK = 0x0FFFFFFF
SRID_FLAG = 0x20000000
ISO_DIMENSION_STEP = 1000
POINT = 1

# Mean earth radius used for every distance, in km.
EARTH_RADIUS_KM = 6371.0087714


def _word(hex_text: Column, start, n_bytes: int, little: Column) -> Column:
    """`n_bytes` of a hex string from byte `start` (0-based), most significant byte first."""
    def byte(i):
        return F.substr(hex_text, (start + F.lit(i)) * 2 + 1, F.lit(2))

    forward = F.concat(*[byte(i) for i in range(n_bytes)])
    backward = F.concat(*[byte(i) for i in reversed(range(n_bytes))])
    return F.when(little, backward).otherwise(forward)


def _double(bits: Column) -> Column:
    """16 hex digits, most significant first -> the IEEE-754 double they hold; NaN and infinities -> NULL."""
    def build(p: Column) -> Column:
        head, mantissa = p["head"], p["mantissa"]
        exponent = head.bitwiseAND(2047)
        sign = F.when(head >= 2048, F.lit(-1.0)).otherwise(F.lit(1.0))
        fraction = mantissa / F.lit(float(2**52))
        normal = (F.lit(1.0) + fraction) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
        subnormal = fraction * F.pow(F.lit(2.0), F.lit(-1022.0))
        return F.when(exponent == 0, sign * subnormal).when(exponent < 2047, sign * normal)

    parts = let(bits, lambda h: F.struct(
        F.conv(F.substring(h, 1, 3), 16, 10).cast("int").alias("head"),
        F.conv(F.substring(h, 4, 13), 16, 10).cast("double").alias("mantissa")))
    return let(parts, build)


def plain_number(col: Column) -> Column:
    """Double -> text without an exponent and without trailing zeros (40.0 -> '40', 1.0E-5 -> '0.00001')."""
    def split(text: Column) -> Column:
        mantissa = F.substring_index(text, "E", 1)
        exponent = F.when(F.instr(text, "E") > 0, F.substring_index(text, "E", -1).cast("int")).otherwise(F.lit(0))
        whole = F.substring_index(mantissa, ".", 1)
        return F.struct(F.concat(whole, F.substring_index(mantissa, ".", -1)).alias("digits"),
                        (F.length(whole) + exponent).alias("point"))     # where the decimal point goes in `digits`

    def pad(p: Column) -> Column:
        before = F.concat(F.repeat(F.lit("0"), F.lit(1) - p["point"]), p["digits"])
        after = F.concat(p["digits"], F.repeat(F.lit("0"), F.greatest(F.lit(0), p["point"] - F.length(p["digits"]))))
        at = F.greatest(p["point"], F.lit(1))
        padded = F.when(p["point"] <= 0, before).otherwise(after)
        return let(padded, lambda d: F.concat(
            F.substr(d, F.lit(1), at), F.lit("."), F.substr(d, at + 1, F.length(d))))

    unsigned = F.regexp_replace(let(let(F.abs(col).cast("string"), split), pad), r"\.?0*$", "")
    return F.when(col < 0, F.concat(F.lit("-"), unsigned)).otherwise(unsigned)


def point_to_latlon(wkb: Column) -> Column:
    """WKB / EWKB point -> 'lat,lon' text, or NULL when it is not a readable point.

    Both byte orders; the SRID is skipped, Z and M are ignored. X is the longitude. An infinite
    coordinate counts as unreadable.
    """
    def read(text: Column) -> Column:
        order = F.substring(text, 1, 2)
        little = order == "01"
        kind = F.conv(_word(text, F.lit(1), 4, little), 16, 10).cast("bigint")
        return let(F.struct(order.alias("order"), little.alias("little"), kind.alias("kind")),
                   lambda h: locate(text, h))

    def locate(text: Column, h: Column) -> Column:
        start = F.when(h["kind"].bitwiseAND(SRID_FLAG) != 0, F.lit(9)).otherwise(F.lit(5))
        is_point = h["kind"].bitwiseAND(FLAG_MASK) % ISO_DIMENSION_STEP == POINT
        size = F.length(text) / 2
        readable = h["order"].isin("00", "01") & (size >= 21) & is_point
        return let(F.when(readable & (size >= start + 16), start), lambda at: let(F.struct(
            _double(_word(text, at, 8, h["little"])).alias("lon"),
            _double(_word(text, at + 8, 8, h["little"])).alias("lat")), show))

    def show(p: Column) -> Column:
        return F.when(p["lat"].isNotNull() & p["lon"].isNotNull(),
                      F.concat(plain_number(p["lat"]), F.lit(","), plain_number(p["lon"])))

    return let(F.hex(wkb), read)


def geometry_to_latlon(df: DataFrame, field: str = "location") -> DataFrame:
    """Replace the struct column `field` (`wkb`, `srid`) by 'lat,lon' text; a frame without it is unchanged.

    A value that is not a struct with a `wkb` binary is unreadable: the column becomes NULL, the row stays.
    """
    if field not in df.columns:
        return df
    dtype = df.schema[field].dataType
    names = dtype.names if isinstance(dtype, T.StructType) else []
    if "wkb" in names and isinstance(dtype["wkb"].dataType, T.BinaryType):
        return df.withColumn(field, point_to_latlon(F.col(field)["wkb"]))
    return df.withColumn(field, F.lit(None).cast("string"))


def parse_latlon(text: Column) -> tuple[Column, Column]:
    """'lat,lon' -> (latitude, longitude) as doubles; NULL when the text is not two numbers."""
    lat = F.substring_index(text, ",", 1).try_cast("double")
    lon = F.when(F.instr(text, ",") > 0, F.substring_index(text, ",", -1)).try_cast("double")
    return lat, lon


def distance_km(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Haversine distance on a sphere of EARTH_RADIUS_KM."""
    dlat = F.radians(lat - F.lit(lat0)) / 2
    dlon = F.radians(lon - F.lit(lon0)) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat)) * F.lit(math.cos(math.radians(lat0))) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def within_km(lat: Column, lon: Column, lat0: float, lon0: float, km: float) -> Column:
    """Radius predicate: a latitude / longitude box first (cheap, prunes row groups), then the exact distance."""
    arc = math.degrees(km / EARTH_RADIUS_KM) * 1.000001
    exact = distance_km(lat, lon, lat0, lon0) <= km
    box = lat.between(lat0 - arc, lat0 + arc)
    if abs(lat0) + arc < 89.9:
        # Widest at the circle's tangent meridians; a box that would cross the date line is left open.
        half = math.degrees(math.asin(min(1.0, math.sin(math.radians(arc)) / math.cos(math.radians(lat0)))))
        half *= 1.000001
        if -180 <= lon0 - half and lon0 + half <= 180:
            box = box & lon.between(lon0 - half, lon0 + half)
    return box & exact
