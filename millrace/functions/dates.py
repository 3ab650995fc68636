"""Date formats: one format per column, read off the first value.

A column is parsed with the format of its first value alone; any other spelling becomes
null. Only when the first value fits no known format does every value count in its own.

A text's format follows from its shape: digits and letters are replaced by signs for their
kind and number, and the shape of the date and that of the time are each looked up. So a
column is parsed once per value, whatever the number of formats.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signs in shapes: 9 one or two digits, # four, Y eight, m a month's short name, M a full
# one, W and w a weekday's, p AM or PM, f a fraction of a second, z an offset, > a first
# number above 12.
_WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
_FULL, _SHORT = "|".join(_WEEKDAYS), "|".join(d[:3] for d in _WEEKDAYS)
_SHAPES = [
    (rf"(?i)^({_FULL})\b", "§W"),
    (rf"(?i)^({_SHORT})\b", "§w"),
    (r"(?i)(?<=[0-9] ?)[ap]m(?=$| )", "§p"),
    (r"(?<!§)\b[A-Za-z]{4,}|\bMay\b", "§M"),
    (r"(?<!§)\b[A-Za-z]{3}\b", "§m"),
    (r"(:[0-9]{2})\.[0-9]+", "$1§f"),
    (r"(?<![0-9])[0-9]{8}(?![0-9])", "Y"),
    (r"(?<![0-9])[0-9]{4}(?![0-9])", "#"),
    (r"(?<![0-9])[0-9]{1,2}(?![0-9])", "9"),
    (r"(:9(?:§f)?)(?:Z|[+-](?:9:9|#))$", "$1§z"),
    ("§", ""),
]

_SIGNS = (("-", "-"), ("/", "/"), (".", "."))
_YEAR_FIRST = {f"#{s}9{s}9": f"yyyy{s}M{s}d" for s, _ in _SIGNS} | {"Y": "yyyyMMdd"}
_NUMBERS = {f"9{s}9{s}#": f"M{s}d{s}yyyy" for s, _ in _SIGNS} | {f">9{s}9{s}#": f"d{s}M{s}yyyy" for s, _ in _SIGNS}
_WORDED = {
    s.replace("m", m): f.replace("MMM", name)
    for m, name in (("m", "MMM"), ("M", "MMMM"))
    for s, f in (
        ("m 9, #", "MMM d, yyyy"), ("m 9 #", "MMM d yyyy"), ("m-9-#", "MMM-d-yyyy"), ("9-m-#", "d-MMM-yyyy"), ("9 m #", "d MMM yyyy"),
    )
}
_WEEKDAY = {
    f"{w}{s}{shape}": f"{name}{s}{form}"
    for w, name in (("W", "EEEE"), ("w", "EEE")) for s in (", ", " ") for shape, form in _WORDED.items()
}
DATES = _YEAR_FIRST | _NUMBERS | _WORDED | _WEEKDAY
_FRACTION = "[SSSSSS][SSSSS][SSSS][SSS][SS][S]"
_CLOCK = {"9:9": "H:mm", "9:9:9": "H:mm:ss", "9:9:9f": f"H:mm:ss.{_FRACTION}"}
_HALF_DAY = {f"{c}{s}p": f"{f}{s}a" for c, f in (("9:9", "h:mm"), ("9:9:9", "h:mm:ss")) for s in ("", " ")}
TIMES = (
    {f" {c}": f" {f}" for c, f in (_CLOCK | _HALF_DAY).items()}
    | {f"T{c}": f"'T'{f}" for c, f in _CLOCK.items()}
    | {f"{s}{c}z": f"{t}{f}[XXX][XX]" for s, t in ((" ", " "), ("T", "'T'")) for c, f in _CLOCK.items()}
)
# Spellings that have no column-wide format; each value stands for itself.
_FREE = {f"9{s}9{s}9": f"M{s}d{s}yy" for s, _ in _SIGNS} | {f">9{s}9{s}9": f"d{s}M{s}yy" for s, _ in _SIGNS}
_FREE |= {s.replace("#", "9"): f.replace("yyyy", "yy") for s, f in _WORDED.items() if s[0] == "9"}
_FREE |= {"m #": "MMM yyyy", "M #": "MMMM yyyy"}
MONTH = {"#-9": "yyyy-M"}
#: Two-digit years are in the hundred years up to this many from now.
YEARS_AHEAD = 50


def _shape(text: Column) -> Column:
    shape = text
    for pattern, sign in _SHAPES:
        shape = F.regexp_replace(shape, pattern, sign)
    return F.when(text.rlike(r"^(1[3-9]|[23][0-9])([-/.])[0-9]{1,2}\2[0-9]"), F.concat(F.lit(">"), shape)).otherwise(shape)


def _found(table: dict[str, str], shape: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), shape)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it.

    The body is evaluated as it is and not compiled into the stage, whose code stays small; what it
    does here is matching patterns and parsing, which is no faster in generated code.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _by_shape(text: Column, dates: dict[str, str]) -> Column:
    def form(shape: Column) -> Column:
        parts = r"^(.*?)([ T]9:9.*)?$"
        return _let(F.regexp_extract(shape, parts, 2), lambda time: _let(
            F.regexp_extract(shape, parts, 1),
            lambda day: F.when(time == "", _found(dates | MONTH, day)).otherwise(F.concat(_found(dates, day), _found(TIMES, time)))))

    return _let(_shape(text), form)


def _plain(text: Column, form: Column) -> tuple[Column, Column]:
    """The text and its format without a weekday, and with six digits of a second at most."""
    weekday = r"^E+,? "
    body = F.when(form.rlike(weekday), F.regexp_replace(text, r"^[A-Za-z]+,? ", "")).otherwise(text)
    return F.regexp_replace(body, r"(\.[0-9]{6})[0-9]+", "$1"), F.regexp_replace(form, weekday, "")


def date_format(first: str) -> Column:
    """The format of a column, from the column of its first value.

    Null when no format fits, when the value is no date in it (February 30), or when its
    names are not written like January.
    """
    text = F.col(f"`{first}`")
    form = _by_shape(text, DATES)
    named = text.rlike(r"^(?:[^A-Za-z]|[A-Z][a-z]{2,}|T|Z|[AP]M)*$")
    body, core = _plain(text, form)
    return F.when(named & F.try_to_timestamp(body, core).isNotNull(), form)


def _parse(c: Column, fmt: str) -> Column:
    """Date-only formats never touch a time zone; texts with an offset give UTC."""
    weekday = re.match(r"^(E+)(,? )", fmt)
    if weekday:
        names = _FULL if weekday[1] == "EEEE" else _SHORT
        prefix = rf"(?i)^({names}){weekday[2]}"
        return F.when(c.rlike(prefix), _parse(F.regexp_replace(c, prefix, ""), fmt[weekday.end() :]))
    if "S" in fmt:
        c = F.regexp_replace(c, r"(\.[0-9]{6})[0-9]+", "$1")
    if "X" in fmt:
        instant = F.try_to_timestamp(c, F.lit(fmt))
        return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")
    if "H" in fmt or "h" in fmt:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return F.try_to_date(c, fmt).cast("timestamp_ntz")


def _free(c: Column) -> Column:
    """Each value in its own format."""

    def parsed(body: Column, form: Column) -> Column:
        return _let(F.try_to_timestamp(body, form), lambda instant: (
            F.when(form.contains("X"), F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz"))
            .when(form.contains(":"), instant.cast("timestamp_ntz"))
            .otherwise(F.call_function("try_to_date", body, form).cast("timestamp_ntz"))))

    def recent(value: Column, form: Column) -> Column:
        late = form.rlike("(?<!y)yy(?!y)") & (F.year(value) >= F.year(F.current_date()) + YEARS_AHEAD)
        return F.when(late, value - F.expr("INTERVAL 100 YEARS")).otherwise(value)

    def in_form(text: Column, form: Column) -> Column:
        body, core = _plain(text, form)
        return _let(core, lambda core: _let(_let(body, lambda body: parsed(body, core)), lambda value: recent(value, core)))

    return _let(c, lambda text: _let(_by_shape(text, DATES | _FREE), lambda form: in_form(text, form)))


def parse_dates(c: Column, fmt: Column, known: Sequence[str | None]) -> Column:
    """Parse `c` with the format named by `fmt`; `known` lists the formats in use."""
    parsed = F.lit(None).cast("timestamp_ntz")
    for name in known:
        if name is not None:
            parsed = F.when(fmt == name, _parse(c, name)).otherwise(parsed)
    if None in known:
        parsed = F.when(fmt.isNull(), _free(c)).otherwise(parsed)
    return parsed
