"""Date scalar functions (E1..E6) as native column expressions, with DuckDB twins.

No expression reads the clock: every "now" is an explicit ``as_of`` argument, so a job is
reproducible and a re-run after executor loss computes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Free-form dates (own contract): ISO, "May 6, 2024", "6 May 2024" (weekday, ordinal and abbreviated month
# allowed), "5/6/2024" (month first; day first where the first number is over 12), 20240506; then an
# optional time, AM/PM and zone. The zone is not applied: the wall clock of the text counts.
_TIME = (r"(?:(?:[T\s,]|\s*at\s)\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*([AaPp][Mm])?\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})?)?\s*$")
_DAY = r"^\s*(?:[A-Za-z]{3,9},?\s+)?"
_FORMS = (  # pattern, groups of year, month and day
    (r"^\s*(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TIME, (1, 2, 3)),
    (r"^\s*(\d{4})(\d{2})(\d{2})" + _TIME, (1, 2, 3)),
    (_DAY + r"([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + _TIME, (3, 1, 2)),
    (_DAY + r"(\d{1,2})(?:st|nd|rd|th)?\s+([A-Za-z]{3,9})\.?,?\s+(\d{4})" + _TIME, (3, 2, 1)),
    (r"^\s*(0?[1-9]|1[0-2])[/.-](\d{1,2})[/.-](\d{4})" + _TIME, (3, 1, 2)),
    (r"^\s*(1[3-9]|2\d|3[01])[/.-](\d{1,2})[/.-](\d{4})" + _TIME, (3, 2, 1)),
)
_MONTHS = "|january|february|march|april|may|june|july|august|september|october|november|december"
DUCK_DATE_FORMATS = ("%Y-%m-%d", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S", "%B %-d, %Y", "%b %-d, %Y")
# Minutes per unit of a relative age ("3 hours"); the unit loses every "s" first.
MINUTES_PER_UNIT = {"minute": 1, "hour": 60, "day": 24 * 60, "week": 7 * 24 * 60}
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def _month(text: Column) -> Column:
    """Month number as text, from digits or from the first letters of an English name."""
    at = F.position(F.concat(F.lit("|"), F.lower(text)), F.lit(_MONTHS))
    named = F.size(F.split(F.substring(F.lit(_MONTHS), F.lit(1), at), r"\|")) - 1
    return F.when(text.rlike("^[0-9]+$"), text).when(at > 0, named.cast("string"))


def parse_timestamp(c) -> Column:
    """String -> TIMESTAMP_NTZ, first matching form wins; bad input -> null. The parts are cast
    straight to a timestamp without zone, so the session's zone plays no role. The matching form
    rewrites the text to its seven parts once; the rest is built from the split parts."""
    c = _c(c)
    ordered = F.coalesce(*[F.when(c.rlike(p), F.regexp_replace(c, p, f"${y}|${m}|${d}|$4|$5|$6|$7"))
                           for p, (y, m, d) in _FORMS])

    def two(x: Column) -> Column:
        return F.lpad(F.when(x == "", "0").otherwise(x), 2, "0")

    def build(part: Column) -> Column:
        hour, half = part[3].try_cast("int"), F.lower(part[6])
        hour = F.when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(F.coalesce(hour, F.lit(0)))
        return F.concat(part[0], F.lit("-"), two(_month(part[1])), F.lit("-"), two(part[2]), F.lit(" "),
                        two(hour.cast("string")), F.lit(":"), two(part[4]), F.lit(":"), two(part[5])).try_cast("timestamp_ntz")

    return F.transform(F.array(F.split(ordered, r"\|")), build)[0]


def parse_timestamp_sql(e: str) -> str:
    fmts = ", ".join(f"'{f}'" for f in DUCK_DATE_FORMATS)
    return f"try_strptime({e}, [{fmts}])"


def parse_date(c) -> Column:
    """Free-form date -> 'YYYY-MM-DD' string; unparsable -> null (kept apart from missing)."""
    return F.date_format(parse_timestamp(c), "yyyy-MM-dd")


def parse_date_sql(e: str) -> str:
    return f"strftime({parse_timestamp_sql(e)}, '%Y-%m-%d')"


def relative_minutes(c) -> Column:
    """E3: '<n> <unit>' -> minutes; unknown unit or bad number -> null."""
    parts = F.split(_c(c), " ")
    num = F.try_element_at(parts, F.lit(1)).try_cast("bigint")
    unit = F.replace(F.try_element_at(parts, F.lit(2)), F.lit("s"), F.lit(""))
    factor = F.lit(None).cast("bigint")
    for u, m in reversed(list(MINUTES_PER_UNIT.items())):
        factor = F.when(unit == u, F.lit(m).cast("bigint")).otherwise(factor)
    return num * factor


def relative_minutes_sql(e: str) -> str:
    num = f"TRY_CAST(string_split({e}, ' ')[1] AS BIGINT)"
    unit = f"replace(string_split({e}, ' ')[2], 's', '')"
    factor = "CASE " + " ".join(f"WHEN {unit} = '{u}' THEN CAST({m} AS BIGINT)" for u, m in MINUTES_PER_UNIT.items()) + " END"
    return f"({num} * {factor})"


def minutes_before(as_of_ts: str, minutes: Column) -> Column:
    """The date ``minutes`` before ``as_of_ts`` (a 'YYYY-MM-DD HH:MM:SS' literal)."""
    ts = F.lit(as_of_ts).cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("MINUTE", -minutes, ts), "yyyy-MM-dd")


def minutes_before_sql(as_of_ts: str, minutes: str) -> str:
    return f"strftime(TIMESTAMP '{as_of_ts}' - to_minutes({minutes}), '%Y-%m-%d')"


def window_pair(ts, hours: int) -> tuple[Column, Column]:
    """E5: (start, start + hours) formatted as ISO seconds."""
    ts = _c(ts)
    return (F.date_format(ts, ISO_SECONDS),
            F.date_format(F.timestamp_add("HOUR", F.lit(hours), ts), ISO_SECONDS))


def window_pair_sql(e: str, hours: int) -> tuple[str, str]:
    return (f"strftime({e}, '%Y-%m-%dT%H:%M:%S')",
            f"strftime({e} + to_hours({hours}), '%Y-%m-%dT%H:%M:%S')")
