"""Time expressions.

Spark has no per-row time zone type, so a moment is three columns: the instant
as a UTC wall clock (``TIMESTAMP_NTZ``), the venue's wall clock (``TIMESTAMP_NTZ``)
and the zone name.  None of the expressions looks at the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank, strip_wide

# Shapes of listing times.
DATE_ONLY = r"^\d{4}-\d{2}-\d{2}$"
LEADING_DATE = r"^(\d{4}-\d{2}-\d{2})"
ISO_MOMENT = (
    r"^(\d{4}-\d{2}-\d{2})[T ](\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2})?)?$"
)
CITY_TIME_FORMAT = "M/d/yyyy  hh:mm:ss a"
LONG_DATE_FORMAT = "EEEE, MMMM d, yyyy"
SHORT_TIME_FORMAT = "h:mm a"
# Each text form has a cheap shape test, because a failed parse costs an exception.
_DAY, _WORD = r"\d{1,2}", r"[A-Za-z]{3,9}"
FREE_TEXT_FORMATS = [
    (rf"^{_DAY}/{_DAY}/\d{{4}} \d{{1,2}}:\d{{2}}$", "M/d/yyyy H:mm"),
    (rf"^{_DAY}/{_DAY}/\d{{4}} \d{{1,2}}:\d{{2}} [AP]M$", "M/d/yyyy h:mm a"),
    (rf"^{_DAY}/{_DAY}/\d{{4}}$", "M/d/yyyy"),
    (rf"^{_WORD} {_DAY}, \d{{4}} \d{{1,2}}:\d{{2}} [AP]M$", "MMMM d, yyyy h:mm a"),
    (rf"^{_WORD} {_DAY}, \d{{4}}$", "MMMM d, yyyy"),
    (rf"^[A-Za-z]{{3}} {_DAY}, \d{{4}} \d{{1,2}}:\d{{2}} [AP]M$", "MMM d, yyyy h:mm a"),
    (rf"^[A-Za-z]{{3}} {_DAY}, \d{{4}}$", "MMM d, yyyy"),
    (rf"^{_DAY} {_WORD} \d{{4}}$", "d MMMM yyyy"),
    (rf"^{_DAY} [A-Za-z]{{3}} \d{{4}}$", "d MMM yyyy"),
]


def to_zone(utc: Column, tz: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), tz, utc)


def from_zone(local: Column, tz: Column) -> Column:
    """Wall clock to UTC; the repeated hour takes its first pass."""
    return F.convert_timezone(tz, F.lit("UTC"), local)


def from_zone_late(local: Column, tz: Column) -> Column:
    """Wall clock to UTC; the repeated hour takes its second pass."""
    early = from_zone(local, tz)
    late = early + F.expr("interval 1 hour")
    return F.when(to_zone(late, tz) == local, late).otherwise(early)


def _ntz(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def _iso_parts(s: Column) -> tuple[Column, Column]:
    """(written wall clock, offset in minutes or null for a naive text)."""
    rest = F.substr(s, F.lit(12))
    zone = F.regexp_extract(rest, "(Z|[+-][0-9:]+)$", 1)
    clock = F.replace(F.substring_index(F.substring_index(F.substring_index(rest, "Z", 1), "+", 1), "-", 1),
                      F.lit(","), F.lit("."))
    full = F.when(F.length(clock) == 2, F.concat(clock, F.lit(":00"))).otherwise(F.substring(clock, 1, 15))
    written = _ntz(F.concat(F.substring(s, 1, 10), F.lit("T"), full))
    digits = F.replace(F.substr(zone, F.lit(2)), F.lit(":"), F.lit(""))
    minutes = (F.substring(digits, 1, 2).try_cast("int") * 60
               + F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).try_cast("int"), F.lit(0)))
    offset = (F.when(zone == "Z", F.lit(0))
              .when(F.startswith(zone, F.lit("-")), -minutes)
              .when(F.startswith(zone, F.lit("+")), minutes))
    iso = s.rlike(ISO_MOMENT)
    return F.when(iso, written), F.when(iso, offset)


def add_moment(df: DataFrame, source: str, out: str, tz: Column) -> DataFrame:
    """Add ``<out>_local``, ``<out>_utc`` and ``<out>_has_time`` for a time text column.

    A text with a zone moves to the venue's zone, a naive one already is there, a
    bare or leading date is midnight without a clock time, anything else is null.
    The steps are separate projections so that no regex is evaluated twice.
    """
    s, w, o = F.col(f"__{out}_s"), F.col(f"__{out}_w"), F.col(f"__{out}_o")
    written, offset = _iso_parts(s)
    timed = ~s.rlike(DATE_ONLY) & w.isNotNull()
    shifted = w - F.make_dt_interval(mins=o)
    wall, has = F.col(f"{out}_local"), F.col(f"{out}_has_time")
    return (
        df.withColumn(f"__{out}_s", strip_wide(blank(F.col(source))))
        .withColumns({f"__{out}_w": written, f"__{out}_o": offset})
        .withColumns({
            f"{out}_local": F.when(timed & o.isNotNull(), to_zone(shifted, tz)).when(timed, w)
            .otherwise(_ntz(F.regexp_extract(s, LEADING_DATE, 1))),
            f"{out}_has_time": timed,
        })
        .withColumn(f"{out}_utc", F.when(has & o.isNotNull(), shifted).otherwise(from_zone(wall, tz)))
        .drop(f"__{out}_s", f"__{out}_w", f"__{out}_o")
    )


def iso_with_offset(local: Column, utc: Column) -> Column:
    """``2026-07-21T22:00:00-04:00``; microseconds only when there are any."""
    minutes = F.timestamp_diff("MINUTE", utc, local)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    size = F.abs(minutes)
    micros = F.date_format(local, "SSSSSS")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")),
        sign,
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((size % 60).cast("string"), 2, "0"),
    )


def display_time(local: Column, has_time: Column) -> Column:
    return F.when(has_time, F.date_format(local, SHORT_TIME_FORMAT)).otherwise(F.lit("All day"))


def add_lenient(df: DataFrame, source: str, out: str) -> DataFrame:
    """Add struct ``out`` = (written, offset): ISO forms first, then a list of text forms."""
    s = F.col(f"__{out}_s")
    written, offset = _iso_parts(s)
    texts = [F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz"))
             for shape, f in FREE_TEXT_FORMATS]
    day = F.when(s.rlike(DATE_ONLY), _ntz(s))
    return (
        df.withColumn(f"__{out}_s", strip_wide(blank(F.col(source))))
        .withColumn(out, F.struct(F.coalesce(written, day, *texts).alias("written"), offset.alias("offset")))
        .drop(f"__{out}_s")
    )


def city_local(parsed: Column, tz: Column) -> Column:
    """Wall clock in the city for an ``add_lenient`` struct."""
    moved = to_zone(parsed["written"] - F.make_dt_interval(mins=parsed["offset"]), tz)
    return F.when(parsed["offset"].isNotNull(), moved).otherwise(parsed["written"])


def city_time_text(parsed: Column, tz: Column) -> Column:
    """``7/21/2026  10:00:00 PM`` in the city's zone, empty when unreadable."""
    return blank(F.date_format(city_local(parsed, tz), CITY_TIME_FORMAT))


def utc_text(parsed: Column, tz: Column) -> Column:
    """``...Z`` text; a naive text in the repeated hour takes the later instant."""
    utc = F.when(parsed["offset"].isNotNull(),
                 parsed["written"] - F.make_dt_interval(mins=parsed["offset"])).otherwise(
        from_zone_late(parsed["written"], tz))
    return blank(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def has_clock(c: Column) -> Column:
    return c.contains("T") | c.contains(" ") | c.rlike(r":\d{2}")


def long_date(raw: Column, parsed: Column) -> Column:
    """``Tuesday, July 21, 2026``, or the text itself when it is no date."""
    return F.coalesce(F.date_format(parsed["written"], LONG_DATE_FORMAT), blank(raw))


def short_time(raw: Column, parsed: Column) -> Column:
    """``10:00 PM``, a clock text as written, else empty."""
    s = blank(raw)
    as_written = s.rlike(r"(?i)^\d{1,2}:\d{2}\s*(?:AM|PM)") | s.rlike(r"^\d{1,2}:\d{2}$")
    return F.when(~has_clock(s), F.lit("")).otherwise(
        F.coalesce(F.date_format(parsed["written"], SHORT_TIME_FORMAT), F.when(as_written, s), F.lit("")))


def time_range(start: Column, end: Column) -> Column:
    """``start - end`` of two short times, the start alone without an end."""
    return F.when((start != "") & (end != ""), F.concat_ws(" - ", start, end)).otherwise(start)


def date_range(start_raw: Column, start_long: Column, end_raw: Column, end_long: Column) -> Column:
    """One long date, or two when both ends are bare dates that differ."""
    both = blank(start_raw).rlike(DATE_ONLY) & blank(end_raw).rlike(DATE_ONLY) & (start_long != end_long)
    return F.when(both, F.concat(start_long, F.lit(" – "), end_long)).otherwise(start_long)


def day_window_utc(day: Column, tz: Column) -> Column:
    """Struct of the UTC texts bounding a local day."""
    start = day.cast("timestamp_ntz")
    stop = F.date_add(day, 1).cast("timestamp_ntz") - F.expr("interval 1 microsecond")
    text = lambda t: F.date_format(from_zone(t, tz), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.struct(text(start).alias("start_time"), text(stop).alias("end_time"))


def day_span(start: Column, end: Column) -> Column:
    """Array of the days between two dates, bounds in either order."""
    return F.sequence(F.least(start, end), F.greatest(start, end), F.expr("interval 1 day"))


def hour_span(start: Column, end: Column) -> Column:
    """Array of hour starts from ``start`` up to ``end``."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 hour"))).otherwise(
        F.array().cast("array<timestamp_ntz>"))


def join_clock(day: Column, clock: Column) -> Column:
    """A date and a 12-hour clock text as ``dateTHH:MM:00``; the date alone without a clock."""
    d = strip_wide(blank(day))
    t = F.lower(strip_wide(blank(clock)))
    clock_re = r"^(\d{1,2}):(\d{2})\s*([ap]m)?"
    hour = F.regexp_extract(t, clock_re, 1).try_cast("int")
    half = F.regexp_extract(t, clock_re, 3)
    hour24 = (F.when((half == "pm") & (hour != 12), hour + 12)
              .when((half == "am") & (hour == 12), F.lit(0)).otherwise(hour))
    timed = d.rlike(DATE_ONLY) & t.rlike(clock_re)
    return F.when(timed, F.concat(d, F.lit("T"), F.lpad(hour24.cast("string"), 2, "0"), F.lit(":"),
                                  F.regexp_extract(t, clock_re, 2), F.lit(":00"))).otherwise(d)


def date_part_text(c: Column) -> Column:
    return F.substring_index(blank(c), "T", 1)


def us_date_text(c: Column, fallback: Column) -> Column:
    s = strip_wide(blank(c))
    shape = r"^(\d{4})-(\d{2})-(\d{2})"
    return F.when(s.rlike(shape), F.concat_ws("/", F.regexp_extract(s, shape, 2), F.regexp_extract(s, shape, 3),
                                              F.regexp_extract(s, shape, 1))).otherwise(fallback)


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")
