"""Open Location Code arithmetic (public specification) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayspan.functions.columns import as_column, route_end

# Fixed values of the specification.
ALPHABET = "23456789CFGHJMPQRVWX"
PAIR_DIGITS = 10
GRID_ROWS, GRID_COLUMNS = 5, 4
MAX_DIGITS = 15


def _digit(text: Column, at: int) -> Column:
    """0-based value of digit ``at`` (0-based); -1 when the code is shorter."""
    return F.instr(F.lit(ALPHABET), F.substring(text, at + 1, 1)) - 1


def _prefix(lat: Column, lon: Column, digits: int) -> Column:
    """First ``digits`` digits (2, 4 or 6) of a point."""
    step = 20.0 ** (2 - digits // 2)
    rows, cols = F.floor((lat + 90.0) / step).cast("long"), F.floor((lon + 180.0) / step).cast("long")
    parts = []
    for i in range(digits // 2):
        scale = 20 ** (digits // 2 - 1 - i)
        for value in (rows, cols):
            parts.append(F.substring(F.lit(ALPHABET), (F.floor(value / scale) % 20 + 1).cast("int"), F.lit(1)))
    return F.concat(*parts)


def _decode(digits: Column) -> tuple[Column, Column]:
    """Centre of the cell of a full code without its separator."""
    n = F.length(digits)
    lat, lon = F.lit(-90.0), F.lit(-180.0)
    high, wide = F.lit(20.0), F.lit(20.0)
    for i in range(PAIR_DIGITS // 2):
        step, used = 20.0 ** (1 - i), n >= 2 * i + 2
        lat = lat + F.when(used, _digit(digits, 2 * i) * step).otherwise(0.0)
        lon = lon + F.when(used, _digit(digits, 2 * i + 1) * step).otherwise(0.0)
        high, wide = F.when(used, F.lit(step)).otherwise(high), F.when(used, F.lit(step)).otherwise(wide)
    for g in range(MAX_DIGITS - PAIR_DIGITS):
        at, used = PAIR_DIGITS + g, n > PAIR_DIGITS + g
        row_step, col_step = 20.0**-3 / GRID_ROWS ** (g + 1), 20.0**-3 / GRID_COLUMNS ** (g + 1)
        lat = lat + F.when(used, F.floor(_digit(digits, at) / GRID_COLUMNS) * row_step).otherwise(0.0)
        lon = lon + F.when(used, (_digit(digits, at) % GRID_COLUMNS) * col_step).otherwise(0.0)
        high, wide = F.when(used, F.lit(row_step)).otherwise(high), F.when(used, F.lit(col_step)).otherwise(wide)
    return lat + high / 2.0, lon + wide / 2.0


def locate(df: DataFrame, code: str, ref_lat: Column | float, ref_lon: Column | float, out: str) -> DataFrame:
    """Add ``<out>_code`` (full code), ``<out>_lat`` and ``<out>_lon`` for short or full codes.

    A short code means the matching cell nearest to the reference point. Anything that
    is no plus code gives NULL.
    """
    lat0 = as_column(ref_lat) if not isinstance(ref_lat, float) else F.lit(ref_lat)
    lon0 = as_column(ref_lon) if not isinstance(ref_lon, float) else F.lit(ref_lon)
    text = F.upper(F.col(code))
    valid = text.rlike(rf"^([{ALPHABET}]{{2}}){{1,4}}\+([{ALPHABET}]{{2,7}})?$")
    missing = F.lit(9) - F.instr(text, "+")
    tail = F.replace(text, F.lit("+"), F.lit(""))
    lead = F.lit("")
    for digits in (2, 4, 6):
        lead = F.when(missing == digits, _prefix(lat0, lon0, digits)).otherwise(lead)
    base = df.withColumns({"_ok": valid, "_miss": missing, "_full": F.concat(lead, tail)})
    lat, lon = _decode(F.col("_full"))
    base = base.withColumns({"_lat": lat, "_lon": lon})
    step = F.pow(F.lit(20.0), F.lit(2.0) - F.col("_miss") / 2)
    short = F.col("_miss") > 0

    def nearest(centre: Column, ref: Column, limit: float | None) -> Column:
        down, up = ref + step / 2 < centre, ref - step / 2 > centre
        if limit is not None:
            down, up = down & (centre - step >= -limit), up & (centre + step <= limit)
        return F.when(short & down, centre - step).when(short & up, centre + step).otherwise(centre)

    base = base.withColumns({"_lat": nearest(F.col("_lat"), lat0, 90.0), "_lon": nearest(F.col("_lon"), lon0, None)})
    full = F.col("_full")
    for digits in (2, 4, 6):
        full = F.when(F.col("_miss") == digits, F.concat(_prefix(F.col("_lat"), F.col("_lon"), digits), tail)).otherwise(full)
    pretty = F.concat(F.substring(full, 1, 8), F.lit("+"), F.substring(full, 9, MAX_DIGITS))
    return base.withColumns({
        f"{out}_code": F.when(F.col("_ok"), pretty),
        f"{out}_lat": F.when(F.col("_ok"), F.round("_lat", 14)),
        f"{out}_lon": F.when(F.col("_ok"), F.round("_lon", 14)),
    }).drop("_ok", "_miss", "_full", "_lat", "_lon")


def route_points(routes: DataFrame, ref_lat: float, ref_lon: float) -> DataFrame:
    """Both ends of every route: short and full code, cell centre, and ``lat,lon`` text."""
    ends = routes.withColumn("origin", route_end("route_code", 1)).withColumn("destination", route_end("route_code", 2))
    for end in ("origin", "destination"):
        ends = locate(ends, end, ref_lat, ref_lon, end)
        ends = ends.withColumn(f"{end}_point", F.concat_ws(",", F.col(f"{end}_lat").cast("string"), F.col(f"{end}_lon").cast("string")))
    return ends
