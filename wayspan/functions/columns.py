"""Scalar column expressions: feed text, calendar, labels, formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
TIME_BANDS = [
    (6, "late_night"),
    (8, "morning"),
    (11, "morning_rush"),
    (14, "early_afternoon"),
    (18, "late_afternoon"),
    (21, "evening_rush"),
    (24, "night"),
]
PALETTE = [
    "#1f77b4", "#aec7e8", "#ff7f0e", "#ffbb78", "#2ca02c", "#98df8a", "#d62728",
    "#ff9896", "#9467bd", "#c5b0d5", "#8c564b", "#c49c94", "#e377c2", "#f7b6d2",
    "#7f7f7f", "#c7c7c7", "#bcbd22", "#dbdb8d", "#17becf", "#9edae5",
]
NO_COLOR = "#000000"
MAPS_DIR_URL = "https://www.google.com/maps/dir/?api=1&origin=%s&destination=%s&travelmode=driving"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- feed text -----------------------------------------------------------------

def duration_minutes(text: Column | str) -> Column:
    """Minutes from ``1 hr 5 min`` / ``2 hr`` / ``7 min`` / a bare number; anything else NULL."""
    parts = F.split(F.trim(as_column(text)), r"\s+")

    def before(token: str) -> Column:
        at = F.array_position(parts, token)
        # a token in first place takes the last word as its number
        word = F.when(at == 1, F.element_at(parts, -1)).otherwise(F.try_element_at(parts, at.cast("int") - 1))
        return F.when(word.rlike(r"^[+-]?[0-9]+$"), word.try_cast("int"))

    has_hr, has_min = F.array_contains(parts, "hr"), F.array_contains(parts, "min")
    first = F.try_element_at(parts, F.lit(1))
    bare = F.when(first.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), first.try_cast("double"))
    hours = F.when(has_hr, before("hr") * 60).otherwise(F.lit(0))
    minutes = F.when(has_min, before("min")).otherwise(F.lit(0))
    return F.when(has_hr | has_min, (hours + minutes).cast("double")).otherwise(bare)


def distance_km(text: Column | str) -> Column:
    """Kilometres from ``11.0 km``; the unit is removed literally."""
    return F.replace(as_column(text), F.lit(" km"), F.lit("")).try_cast("double")


def rain_flag(flag: Column | str) -> Column:
    """Rain phrase; phrases that start with "no precipitation" become empty."""
    flag = as_column(flag)
    return F.when(F.lower(flag).startswith("no precipitation"), F.lit("")).otherwise(flag)


def speed_kmh(distance: Column | str, duration: Column | str) -> Column:
    return F.try_divide(as_column(distance), as_column(duration) / F.lit(60.0))


def route_end(route: Column | str, side: int) -> Column:
    """Origin (``side=1``) or destination (``side=2``) of ``ORIG|DEST``; NULL without that part."""
    part = F.split_part(as_column(route), F.lit("|"), F.lit(side))
    return part if side == 1 else F.when(F.contains(as_column(route), F.lit("|")), part)


def is_plus_code(code: Column | str) -> Column:
    return as_column(code).rlike(r"^[2-9A-HJ-NP-Z]{4,7}\+[2-9A-HJ-NP-Z]{2,}$")


def percent_encode(text: Column | str) -> Column:
    """URL path quoting: space is ``%20``, ``/`` and the unreserved marks stay."""
    out = F.url_encode(as_column(text))
    for old, new in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def maps_url(origin: Column | str, destination: Column | str) -> Column:
    return F.format_string(MAPS_DIR_URL, percent_encode(origin), percent_encode(destination))


def feed_timestamp(date: Column | str, time: Column | str) -> Column:
    """Strict ``yyyy-MM-dd HH:mm`` parse; malformed text gives NULL."""
    text = F.concat_ws(" ", as_column(date), as_column(time))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")


# --- calendar --------------------------------------------------------------------

def clock_hour(time: Column | str) -> Column:
    """Hour of ``HH:MM`` text; NULL when the text is no valid time."""
    time = as_column(time)
    ok = time.rlike(r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]$")
    return F.when(ok, F.split_part(time, F.lit(":"), F.lit(1)).try_cast("int"))


def hour_timestamp(year, month, day, hour) -> Column:
    zero = F.lit(0)
    return F.make_timestamp_ntz(*[as_column(c).cast("int") for c in (year, month, day, hour)], zero, zero.cast("decimal(16,6)"))


def hour_number(ts: Column | str) -> Column:
    """Whole hours since 1970-01-01, free of any time zone."""
    ts = as_column(ts)
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def hour_from_number(number: Column | str) -> Column:
    number = as_column(number).cast("int")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), number, F.lit(0), F.lit(0).cast("decimal(18,6)"))


def day_name(date: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.weekday(as_column(date)) + 1)


def is_weekend(date: Column | str) -> Column:
    return F.weekday(as_column(date)) >= 5


def time_band(hour: Column | str) -> Column:
    """Right-closed day bands, 0 to 6 o'clock inclusive being the first."""
    hour = as_column(hour)
    out = F.when(hour < 0, F.lit(None).cast("string"))
    for upper, name in TIME_BANDS:
        out = out.when(hour <= upper, F.lit(name))
    return out


def chart_band(hour: Column | str) -> Column:
    """Four-band map of the facet chart: 6-10, 10-16, 16-20, 20-6 o'clock."""
    hour = as_column(hour)
    return (
        F.when((hour >= 6) & (hour < 10), F.lit("morning_rush"))
        .when((hour >= 10) & (hour < 16), F.lit("midday"))
        .when((hour >= 16) & (hour < 20), F.lit("evening_rush"))
        .when(hour.isNotNull(), F.lit("night"))
    )


def bucket_start(ts: Column | str, level: str) -> Column:
    """Time bucket label: ``H`` hour, ``D`` day, ``W`` week labelled by its Sunday."""
    ts = as_column(ts)
    day = ts.cast("date")
    if level == "H":
        return hour_from_number(hour_number(ts))
    if level == "D":
        return day.cast("timestamp_ntz")
    if level == "W":
        return F.date_add(day, F.lit(6) - F.weekday(day)).cast("timestamp_ntz")
    raise ValueError(f"Unknown aggregation level: {level}. Use 'H', 'D' or 'W'")


def hour_label(hour: Column | str) -> Column:
    hour = as_column(hour)
    twelve = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    return F.concat(twelve.cast("int").cast("string"), F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")))


def timestamp_label(ts: Column | str, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    return F.date_format(as_column(ts), pattern)


# --- labels ------------------------------------------------------------------------

def significance(pvalue: Column | str) -> Column:
    p = as_column(pvalue)
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")


def palette_color(index: Column | str, palette: Sequence[str] = PALETTE) -> Column:
    """Colour for a 0-based index, cycling through the palette."""
    colors = F.array(*[F.lit(c) for c in palette])
    return F.element_at(colors, (as_column(index) % len(palette)).cast("int") + 1)


def reading_detail(label="route_label", ts="timestamp", speed="avg_speed", duration="duration", distance="distance", percentile=None) -> Column:
    """Detail text of one reading, numbers to one digit with halves to even; with ``percentile`` a line more."""
    one = lambda c: F.format_string("%.1f", half_even(c, 1))
    parts = [
        F.lit("<b>"), as_column(label), F.lit("</b><br>Time: "), timestamp_label(ts), F.lit("<br>Speed: "), one(speed),
        F.lit(" km/h<br>Duration: "), one(duration), F.lit(" min<br>Distance: "), one(distance), F.lit(" km"),
    ]
    if percentile is not None:
        parts += [F.lit("<br>Percentile: "), one(percentile), F.lit("%")]
    return F.concat(*parts)


def half_even(c: Column | str, digits: int) -> Column:
    """Round on the scaled double, halves to even."""
    scale = F.lit(10.0**digits)
    return F.rint(as_column(c) * scale) / scale


# --- means that do not depend on the order of rows ------------------------------------------------

PIECE = 26  # bits of a piece of a number: long sums of pieces hold for 2 ** 36 rows


def exact_mean(c: Column | str) -> Column:
    """Mean (an aggregate) that is the same in whatever order rows are added, so that groups with equal values tie.

    Numbers below 2 ** 53 are cut into whole pieces down to 2 ** -104, which add up exactly; larger
    ones, infinities and NaN are added as they are. NULL is left out; no value: NULL.
    """
    x, two, mask = as_column(c).cast("double"), F.lit(2.0 ** (2 * PIECE)), F.lit((1 << PIECE) - 1)
    plain = F.abs(x) < 2.0**53
    pieces, rest = [], F.when(plain, x)
    for _ in range(3):
        whole = rest.cast("bigint")
        pieces += [F.shiftright(whole, PIECE), whole.bitwiseAND(mask)]
        rest = (rest - whole) * two

    def carried(sums: list[Column]) -> list[Column]:
        out = list(sums)
        for i in range(len(out) - 1, 0, -1):
            out[i - 1], out[i] = out[i - 1] + F.shiftright(out[i], PIECE), out[i].bitwiseAND(mask)
        return out

    sums = [F.coalesce(F.sum(p), F.lit(0)) for p in pieces]
    sign = F.when(carried(sums)[0] < 0, F.lit(-1)).otherwise(F.lit(1))
    parts = carried([s * sign for s in sums])
    high, middle, low = (parts[i].cast("double") * F.lit(2.0**PIECE) + parts[i + 1] for i in (0, 2, 4))
    total = sign * (high + (middle + low / two) / two) + F.coalesce(F.sum(F.when(~plain, x)), F.lit(0.0))
    return total / F.nullif(F.count(x), F.lit(0))
