"""Repair of ambiguous day/month text dates, and tolerant parsing, as column expressions.

A text is read by its shape. One translation removes its digits and turns letters into ``a``: what is left, the mask,
is the separators. The beginning of the mask tells the order of the date's parts, and a table has the
number of time fields and the kind of zone for everything that may follow. The digits are split off once, and timestamps
are built from them once per reading. Known are dates with ``/``, ``-`` or ``.`` between the parts, year or day first, years of
four or two digits, month names (English and Portuguese, ``3 Jun 2026``, ``3-jun-2026``, ``Jun 3, 2026``) and ``20260603``;
times with or without seconds and fractions, after a blank or a T; am and pm; Z, UTC, GMT and numeric offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import codes


@dataclass(frozen=True)
class DateFields:
    """Which list columns hold local events, UTC events, ISO-UTC system fields, manual dates."""

    local: Sequence[str] = field(default_factory=tuple)
    utc: Sequence[str] = field(default_factory=tuple)
    system: Sequence[str] = field(default_factory=tuple)
    manual: Sequence[str] = field(default_factory=tuple)


def text_or_null(c: Column) -> Column:
    """NULL for the tokens that stand for an empty date."""
    text = c.cast("string")
    return F.when(~F.lower(F.trim(text)).isin(list(codes.EMPTY_DATE_TOKENS)), text)


def _shift_hours(local: Column, zone: str) -> Column:
    """A naive UTC timestamp as naive local time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), local)


LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALL_LETTERS = LETTERS + LETTERS.upper()
DIGITS = "0123456789"
SEPARATORS = "/-,+"

# Time of day after a date, as it is left in a mask, and what may follow: a name (Z, UTC, GMT, am, pm) or an offset.
_CLOCKS = (" :", " ::", " ::.", "a:", "a::", "a::.")
NO_ZONE, NAMED, AHEAD, BEHIND = range(4)
_ZONES = {"": NO_ZONE, "a": NAMED, " a": NAMED, "aa": NAMED, " aa": NAMED} | {
    blank + sign + colon: code for blank in ("", " ") for sign, code in (("+", AHEAD), ("-", BEHIND)) for colon in ("", ":")
}
TIMED = 4


def _tails() -> dict[str, int]:
    """Everything that may follow a date, the common ones first: mask -> zone, and :data:`TIMED` where there is a time."""
    common = {"": 0, " ::": TIMED, "a::a": TIMED + NAMED}
    return common | {clock + zone: TIMED + code for clock in _CLOCKS for zone, code in _ZONES.items()}


# Orders of the parts of a date, and for each where its fields stand and how many there are.
DAY_MONTH_YEAR, YEAR_MONTH_DAY, DAY_NAME_YEAR, NAME_DAY_YEAR = range(4)
_YEAR_AT, _DAY_AT, _MONTH_AT, _N_DATES = (2, 0, 1, 2), (0, 2, 0, 1), (1, 1, 0, 1), (3, 3, 2, 3)
Known = Callable[[str], Column]


def _place(value: Column, names: Sequence[str]) -> Column:
    """Place of a value in a list of names without commas, from 1; 0 if it is none of them."""
    return F.call_function("find_in_set", value, F.lit(",".join(names)))


def _cleaned(raw: Column) -> dict[str, Column]:
    """``t``: the text, NULL for the tokens of an empty date; dates of eight digits and those with dots get dashes."""
    text = F.trim(text_or_null(raw))
    compact = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    date = F.substring_index(text, " ", 1)
    dotted = F.contains(text, F.lit(".")) & (F.translate(date, DIGITS, "") == "..")
    dashed = F.concat(F.translate(date, ".", "-"), F.substring(text, F.length(date) + 1, F.length(text)))
    eight = (F.length(text) == 8) & (F.translate(text, DIGITS, "") == "")
    return {"t": F.when(eight, compact).when(dotted, dashed).otherwise(text)}


def _masked(known: Known) -> dict[str, Column]:
    """``m``: the mask, a month name being one ``a``; ``f``: the fields of the date, then the time and the offset, each whole.

    Where a name leads, the first field is empty.
    """
    raw = F.translate(known("t"), ALL_LETTERS + DIGITS, "a" * len(ALL_LETTERS))
    mask = F.when(F.contains(raw, F.lit("aaa")), F.regexp_replace(raw, "aa+", "a")).otherwise(raw)
    return {"m": mask, "f": F.split(F.translate(known("t"), ALL_LETTERS + SEPARATORS, " " * len(ALL_LETTERS + SEPARATORS)), " +")}


def _shaped(known: Known) -> dict[str, Column]:
    """``k``: 16 * order of the date + what follows it, NULL for an unknown shape."""
    mask, fields = known("m"), known("f")
    order = F.when(mask.substr(1, 2).isin("//", "--"), F.when(F.length(F.get(fields, F.lit(0))) == 4, YEAR_MONTH_DAY).otherwise(DAY_MONTH_YEAR))
    order = order.when(mask.substr(1, 3).isin(" a ", "-a-", "/a/"), DAY_NAME_YEAR).when(mask.substr(1, 4) == "a , ", NAME_DAY_YEAR)
    length = F.when(order <= YEAR_MONTH_DAY, 2).otherwise(order + 1)
    tails = _tails()
    place = _place(F.substring(mask, length + 1, F.length(mask)), list(tails))
    code = F.substring(F.lit("".join(map(str, tails.values()))), place, F.lit(1)).cast("int")
    return {"k": F.when(place > 0, order * 16 + code)}


def _zone(shape: Column) -> Column:
    return shape.bitwiseAND(3)


def _field(fields: Column, shape: Column, places: Sequence[int], after: int = 0) -> Column:
    """The field whose place depends on the order of the date."""
    digits = F.lit("".join(str(p + after) for p in places))
    return F.get(fields, F.substring(digits, F.shiftright(shape, 4) + 1, F.lit(1)).cast("int"))


def _parted(known: Known) -> dict[str, Column]:
    """Year ``y``, month ``n`` and day ``d`` as written day first, all as text; clock ``c`` of 24 hours; offset ``o``, if any."""
    text, fields, shape = known("t"), known("f"), known("k")
    year = _field(fields, shape, _YEAR_AT)
    century = F.when(year < str(codes.TWO_DIGIT_YEAR_PIVOT), "20").otherwise("19")
    name = F.substring(F.lower(F.translate(text, DIGITS + SEPARATORS + ":. ", "")), 1, 3)
    month = F.when(shape < 16 * DAY_NAME_YEAR, _field(fields, shape, _MONTH_AT))
    place = _place(name, codes.MONTH_NAMES)
    month = month.otherwise(F.when(place > 0, ((place - 1) % 12 + 1).cast("string")))
    clock = F.when(shape.bitwiseAND(TIMED) == 0, "0:0").otherwise(_field(fields, shape, _N_DATES))
    sign = F.when(_zone(shape) == AHEAD, "+").when(_zone(shape) == BEHIND, "-")
    return {
        "y": F.when(F.length(year) == 2, F.concat(century, year)).when(F.length(year) == 4, year),
        "n": month,
        "d": _field(fields, shape, _DAY_AT),
        "c": F.when(_zone(shape) == NAMED, _named_clock(text, clock)).otherwise(clock),
        "o": F.concat(sign, _field(fields, shape, _N_DATES, 1)),
    }


def _named_clock(text: Column, clock: Column) -> Column:
    """A clock followed by Z, UTC or GMT as it is, one with am or pm in 24 hours, NULL for any other name."""
    ending = F.lower(F.substring(text, -3, 3))
    utc = ending.isin("utc", "gmt") | (ending.endswith("z") & ending.substr(2, 1).isin(*DIGITS, " "))
    hour = F.substring_index(clock, ":", 1).try_cast("int")
    hour24 = hour % 12 + F.when(ending.endswith("pm"), 12).otherwise(0)
    half = F.when(hour.between(1, 12) & F.substring(ending, 2, 2).isin("am", "pm"), F.concat(hour24.cast("string"), F.lit(":"), F.substring(clock, F.instr(clock, ":") + 1, F.length(clock))))
    return F.when(utc, clock).otherwise(half)


def _fixed(known: Known) -> Column:
    """Whether the shape leaves no choice of day and month: the year leads, or the month is a name."""
    return known("k") >= 16 * YEAR_MONTH_DAY


def _read(known: Known) -> dict[str, Column]:
    """``a``: the reading as written day first; ``b``: month first where the shape leaves a choice.

    An offset is applied to reach UTC. NULL when the parts name no real time; most such parts are found before
    a construction, which would cost an exception per value.
    """

    def made(month: Column, day: Column) -> Column:
        text = F.concat_ws(" ", F.concat_ws("-", known("y"), month, day), known("c"))
        moment = F.concat(text, known("o")).try_cast("timestamp").cast("timestamp_ntz")
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment)
        real = known("c").isNotNull() & known("y").isNotNull() & month.try_cast("int").between(1, 12) & day.try_cast("int").between(1, 31)
        return F.when(real, F.when(known("o").isNull(), text.try_cast("timestamp_ntz")).otherwise(utc))

    return {"a": made(known("n"), known("d")), "b": F.when(~_fixed(known), made(known("d"), known("n")))}


# Each step with the columns that are not needed after it.
STEPS = ((_masked, ""), (_shaped, "m"), (_parted, "tf"), (_read, "yndco"))


def _readings(df: DataFrame, zones: Mapping[str, str | None]) -> DataFrame:
    """Adds, per column, the code of its shape and its two readings.

    Done in steps, so that every text is masked and split once.
    """

    def known(name: str) -> Known:
        return lambda key: F.col(f"_{key}_{name}")

    df = df.withColumns({f"_t_{n}": _cleaned(F.col(n))["t"] for n in zones})
    for step, done in STEPS:
        df = df.withColumns({f"_{key}_{n}": c for n in zones for key, c in step(known(n)).items()})
        df = df.drop(*[f"_{key}_{n}" for n in zones for key in done])

    def local(n: str, key: str) -> Column:
        """Event texts in UTC become local; a shape that leaves no choice is taken as written."""
        out = F.col(f"_{key}_{n}")
        return F.when(_fixed(known(n)), out).otherwise(_shift_hours(out, zones[n]))

    return df.withColumns({f"_{key}_{n}": local(n, key) for n in zones if zones[n] for key in "ab"})


def _picked(n: str, created: Column, modified: Column) -> Column:
    """The reading inside ``[created - 2 days, modified + 2 days]``; if both or none are inside, the day-first one."""
    day_first, month_first = F.col(f"_a_{n}"), F.col(f"_b_{n}")
    slack = codes.ANCHOR_TOLERANCE_DAYS
    low = F.timestamp_add("DAY", F.lit(-slack), created)
    high = F.timestamp_add("DAY", F.lit(slack), modified)

    def inside(c: Column) -> Column:
        return F.coalesce(c >= low, F.lit(True)) & F.coalesce(c <= high, F.lit(True))

    month_wins = day_first.isNull() | (month_first.isNotNull() & inside(month_first) & ~inside(day_first))
    return F.when(month_wins, month_first).otherwise(day_first)


def _typed_by_hand(n: str) -> Column:
    """A manually typed date: day first, month first only when that is impossible."""
    return F.coalesce(F.col(f"_a_{n}"), F.col(f"_b_{n}"))


def resolve_dates(df: DataFrame, fields: DateFields, zone: str = codes.LOCAL_ZONE) -> DataFrame:
    """All date columns of a list as naive local time; columns that are absent are skipped.

    Event texts are ``d/m/y`` or ``m/d/y`` and decided by the life of their item: ``Created``
    and ``Modified`` anchor them. System fields that are already timestamps are kept.
    """
    types = dict(df.dtypes)

    def present(names: Sequence[str]) -> list[str]:
        return [n for n in names if n in types]

    system = [n for n in present(fields.system) if types[n] == "string"]
    zones = {n: None for n in (*system, *present(fields.local), *present(fields.manual))}
    zones |= {n: zone for n in present(fields.utc)}
    if not zones:
        return df

    def anchor(name: str) -> Column:
        return F.col(name).cast("timestamp_ntz") if name in types else F.lit(None).cast("timestamp_ntz")

    manual = set(fields.manual)
    out = _readings(df, zones)
    out = out.withColumns({n: _shift_hours(_typed_by_hand(n), zone) for n in system}) if system else out
    final = {n: _typed_by_hand(n) if n in manual else _picked(n, anchor("Created"), anchor("Modified")) for n in zones if n not in system}
    out = out.withColumns(final) if final else out
    # Generated columns: a filter on a date is not pushed into the steps, where it would be expanded many times over.
    kept = [F.col(f"`{c}`") for c in df.columns if c not in zones]
    return out.select(*kept, F.inline(F.array(F.struct(*zones)))).select(*[F.col(f"`{c}`") for c in df.columns])


def parsed_timestamp(c: Column) -> Column:
    """A date text of any known shape, day first where the shape leaves a choice, month first only when day first is impossible."""

    def run(steps: Sequence[Callable[[Known], dict[str, Column]]], found: dict[str, Column]) -> Column:
        if not steps:
            return F.coalesce(found["a"], found["b"])
        new = steps[0](found.__getitem__)
        # A list of one value binds it to a name, so that it is computed once.
        one = F.array(F.struct(*[x.alias(key) for key, x in new.items()]))
        return F.get(F.transform(one, lambda s: run(steps[1:], found | {key: s[key] for key in new})), F.lit(0))

    return run((lambda _: _cleaned(c), *[step for step, _ in STEPS]), {})
