"""Timestamp parsing (F2, F3) and the coverage day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading weekday names are dropped before pattern parsing: an `E` field in
# a parse pattern raises even inside try_to_timestamp.
_WEEKDAY_RE = r"(?i)^\s*(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"

# A month name's letters beyond the third are dropped, so `January`, `Jan.` and
# `Sept` all read as MMM.
_MONTH_RE = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?(?=\s)"

# Feed date forms tried in order after ISO-8601 (RFC 822/1123 and kin, day or
# month first).  `Z` reads +0700, `z` reads GMT/UTC/zone names, `XXX` reads +07:00.
RFC_PATTERNS = tuple(f"{day}[ H:mm[:ss]]{zone}" for day in ("d MMM yyyy", "MMM d yyyy") for zone in ("[ Z]", " z", " XXX")) + (
    "yyyy-MM-dd H:mm:ss Z",
    "yyyy/MM/dd[ H:mm[:ss]]",
)


# Month names and the zones of RFC 822 with their offsets.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONES = {"est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00", "mst": "-07:00", "mdt": "-06:00",
         "pst": "-08:00", "pdt": "-07:00", "utc": "+00:00", "gmt": "+00:00", "ut": "+00:00", "z": "+00:00"}
PIVOT = 70  # years of two digits below it lie in this century

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?(?:\s*([ap])\.?m\b\.?)?"
_ZONE = rf"^\s*((?:{'|'.join(sorted(ZONES, key=len, reverse=True))})\b|[+-]\d{{2}}:?(?:\d{{2}})?(?!\d))"
_NAMED = rf"({'|'.join(MONTHS)})[a-z]*\.?"


def read_parts(t: Column) -> Column:
    """A date by its parts, whatever their order: the clock (with am/pm), the
    zone behind it, a month by name or number, and the numbers beside it.  A
    number of four digits is the year; of two numbers before a year the one
    over 12 is the day, else the month comes first; eight digits are
    yyyyMMdd.  Parts that make no date give NULL."""
    x = F.lower(t)

    def whole(x: Column) -> Column:
        clock = F.regexp_extract(x, _CLOCK, 0)
        after = F.when(clock != "", F.call_function("substring_index", x, clock, F.lit(-1))).otherwise(F.lit(""))
        zone = F.regexp_extract(after, _ZONE, 1)
        date = F.when(clock != "", F.concat(F.call_function("substring_index", x, clock, F.lit(1)), F.lit(" "),
                                            F.regexp_replace(after, _ZONE, " "))).otherwise(x)
        return F.struct(clock.alias("clock"), zone.alias("zone"), date.alias("date"))

    num = lambda c: F.nullif(c, F.lit("")).try_cast("int")

    def numbers(p: Column) -> Column:
        """The month by name with the numbers around it, or the three numbers of a numeric date."""
        date, month = p["date"], F.regexp_extract(p["date"], rf"(?<![a-z]){_NAMED}", 1)
        around = [F.regexp_extract(date, rf"(\d{{1,4}})(?:st|nd|rd|th)?[\s,./-]*{_NAMED}", 1),
                  F.regexp_extract(date, rf"(?<![a-z]){_NAMED}[\s,./-]*(\d{{1,4}})(?!\d)", 2),
                  F.regexp_extract(date, rf"(?<![a-z]){_NAMED}[\s,./-]*\d{{1,2}}(?:st|nd|rd|th)?[\s,./-]+(\d{{2,4}})(?!\d)", 2)]
        numeric = F.regexp_extract(date, r"(?<!\d)(\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.](?:\d{4}|\d{2})|\d{8})(?!\d)", 1)
        parts = F.when(F.length(numeric) == 8, F.regexp_replace(numeric, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")).otherwise(numeric)
        return F.struct(p["clock"].alias("clock"), p["zone"].alias("zone"), month.alias("month"),
                        F.when(month != "", F.array(*around)).otherwise(F.split(parts, "[-/.]")).alias("n"))

    def roles(p: Column) -> Column:
        """Which number is what."""
        x, y, z = (num(F.get(p["n"], F.lit(i))) for i in range(3))
        number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), p["month"]).cast("int")
        by = lambda y, m, d: F.struct(y.alias("y"), m.alias("m"), d.alias("d"))
        year_first = F.length(F.get(p["n"], F.lit(0))) == 4
        named = F.when(x > 31, by(x, number, y)).when(x.isNotNull(), by(y, number, x)).otherwise(by(z, number, y))
        numeric = F.when(year_first, by(x, y, z)).when(x > 12, by(z, y, x)).otherwise(by(z, x, y))
        clock = F.split(F.regexp_replace(p["clock"], r"[^0-9:].*$", ""), ":")
        half = F.regexp_extract(p["clock"], _CLOCK, 4)
        return F.struct(F.when(p["month"] != "", named).otherwise(numeric).alias("date"), clock.alias("clock"), half.alias("half"),
                        p["zone"].alias("zone"))

    def assembled(p: Column) -> Column:
        y, hour, zone = p["date"]["y"], num(F.get(p["clock"], F.lit(0))), p["zone"]
        year = F.when(y < PIVOT, y + 2000).when(y < 100, y + 1900).otherwise(y)
        hour = F.when(p["half"] == "p", hour % 12 + 12).when(p["half"] == "a", hour % 12).otherwise(hour)
        offset = F.when(zone == "", F.lit("")).when(
            F.substring(zone, 1, 1).isin("+", "-"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.coalesce(
                F.nullif(F.substring(F.replace(zone, F.lit(":")), 4, 2), F.lit("")), F.lit("00")))).otherwise(
            F.element_at(F.create_map(*[F.lit(v) for kv in ZONES.items() for v in kv]), zone))
        two = lambda c: F.lpad(F.coalesce(c.cast("string"), F.lit("0")), 2, "0")
        return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(p["date"]["m"].cast("string"), 2, "0"), F.lit("-"),
                        F.lpad(p["date"]["d"].cast("string"), 2, "0"), F.lit("T"), two(hour), F.lit(":"),
                        two(F.get(p["clock"], F.lit(1))), F.lit(":"), two(F.get(p["clock"], F.lit(2))), offset)

    # Each lambda binds what the one before has read, so nothing is read twice.
    read = F.array(x)
    for stage in (whole, numbers, roles, lambda p: assembled(p).try_cast("timestamp")):
        read = F.transform(read, stage)
    return F.get(read, F.lit(0))


def parse_timestamp(s: Column) -> Column:
    """permissive parse to a UTC instant; empty or unknown forms -> NULL.
    Naive values are read in the session zone (UTC)."""
    t = F.trim(s)
    t = F.when(t != "", t)
    iso = t.try_cast("timestamp")
    rest = F.regexp_replace(F.regexp_replace(t, _WEEKDAY_RE, ""), _MONTH_RE, "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, ",", " "), r"\s+", " ")
    # The lambda binds the prepared text once for all patterns; written out per
    # pattern, the expression outgrows a compiled method.
    tried = F.transform(F.array(rest), lambda r: F.coalesce(*[F.try_to_timestamp(r, F.lit(p)) for p in RFC_PATTERNS]))
    return F.coalesce(iso, F.get(tried, F.lit(0)), read_parts(t))


def parse_compact_ts(s: Column) -> Column:
    """`yyyyMMddTHHmmss`, with or without `Z` (discovery API seen-date),
    or anything F2 reads."""
    compact = F.regexp_extract(s, r"^\s*([0-9]{8}T[0-9]{6})", 1)
    return F.coalesce(F.try_to_timestamp(s, F.lit("yyyyMMdd'T'HHmmssX")),
                      F.try_to_timestamp(F.nullif(compact, F.lit("")), F.lit("yyyyMMdd'T'HHmmss")), parse_timestamp(s))


def coverage_day(published_at: Column, ingested_at: Column) -> Column:
    """ISO date of published_at, else ingested_at; NULL = unknown."""
    return F.date_format(F.coalesce(published_at, ingested_at), "yyyy-MM-dd")
