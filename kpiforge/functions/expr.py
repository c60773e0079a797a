"""Column -> Column helpers.

All helpers build JVM-side Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen and are safe under ANSI mode: every parse goes
through a regex guard plus ``try_cast`` and never raises on dirty input.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiforge.functions.constants import (
    CENTURY_PREFIX,
    STATE_ISO_CODES,
    UNKNOWN,
    UNKNOWN_ISO,
)

# --- FIXED VALUES: accepted number / date text shapes (Java regex; ``\z``,
# not ``$``, so a trailing newline does not match) ---
INT_PATTERN = r"^[+-]?[0-9]+\z"
DOUBLE_PATTERN = (
    r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
    r"|^[+-]?(?i:nan|inf|infinity)\z"
)
MMDDYY_PATTERN = r"^[0-9]{2}-[0-9]{2}-[0-9]{2}\z"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_or_zero(c: Column | str) -> Column:
    """Parse a plain integer literal as int; anything else (or overflow) -> 0."""
    c = _c(c)
    return F.coalesce(F.when(c.rlike(INT_PATTERN), c.try_cast("int")), F.lit(0))


def double_or_zero(c: Column | str) -> Column:
    """Parse a decimal/scientific literal or nan/inf as double; anything else -> 0.0.

    The guard rejects Spark-only spellings such as ``'1d'`` or ``' 3 '``.
    """
    c = _c(c)
    return F.coalesce(
        F.when(c.rlike(DOUBLE_PATTERN), c.try_cast("double")), F.lit(0.0)
    )


def mmddyy_parts(c: Column | str) -> tuple[Column, Column, Column]:
    c = _c(c)
    return F.substring(c, 1, 2), F.substring(c, 4, 2), F.substring(c, 7, 2)


def mmddyy_shape_ok(c: Column | str) -> Column:
    return _c(c).rlike(MMDDYY_PATTERN)


def mmddyy_range_ok(c: Column | str) -> Column:
    """Month 1..12 and day 1..31 (parts parse-or-zero, as two-digit ints)."""
    mm, dd, _ = mmddyy_parts(c)
    return (F.coalesce(mm.try_cast("int"), F.lit(0)).between(1, 12)
            & F.coalesce(dd.try_cast("int"), F.lit(0)).between(1, 31))


def mmddyy_date(c: Column | str) -> Column:
    """``MM-DD-YY`` -> DATE in century 20xx; impossible dates (Feb 30) -> NULL."""
    mm, dd, yy = mmddyy_parts(c)
    return F.concat(F.lit(CENTURY_PREFIX), yy, F.lit("-"), mm, F.lit("-"), dd).try_cast(
        "date"
    )


def mmddyy_valid(c: Column | str) -> Column:
    return mmddyy_shape_ok(c) & mmddyy_range_ok(c) & mmddyy_date(c).isNotNull()


def unknown_if_empty(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c == "", F.lit(UNKNOWN)).otherwise(c)


# Characters Python's ``str.strip()`` removes (``str.isspace``): ASCII
# whitespace, separators 0x1C-0x1F, NEL, no-break space and the Unicode spaces.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column | str) -> Column:
    """Strip Unicode whitespace (tabs, newlines, no-break spaces) at both ends.

    ``btrim`` with an explicit character set: a plain scan, no regex."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with 0 when the denominator is 0 (never raises under ANSI)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


# Amounts are added as decimals of this many places: a double from 1 on has no digits beyond them
SUM_SCALE = 16
# amounts from EXACT_BELOW on (and inf, nan), and those below EXACT_FROM that are not 0, are added as doubles
EXACT_FROM, EXACT_BELOW = 1e-3, 1e15


def _amounts(c: Column | str, scale: int) -> tuple[Column, Column]:
    """The amount as a decimal where it is an ordinary one, else as the double it is."""
    x = _c(c).cast("double")
    size = F.abs(x)
    ordinary = (size < EXACT_BELOW) & ((size >= EXACT_FROM) | (size == 0))  # nan is greater than any number
    return F.when(ordinary, x).cast(f"decimal(38,{scale})"), F.when(~ordinary, x)


def _total(exact: Column, odd: Column) -> Column:
    return F.when(odd.isNotNull(), odd + F.coalesce(exact.cast("double"), F.lit(0.0))).otherwise(exact.cast("double"))


def money_sum(c: Column | str, scale: int | None = SUM_SCALE) -> Column:
    """Sum of doubles that no row is rounded for and that does not depend on the order of addition.

    Amounts are added in fixed point, as the decimal numbers their shortest spelling gives, and the sum becomes a
    double once, at the end.  ``scale=None`` is the raw double sum."""
    if scale is None:
        return F.sum(c)
    exact, odd = _amounts(c, scale)
    return _total(F.sum(exact), F.sum(odd))


def money_parts(c: str, scale: int | None = SUM_SCALE) -> list[Column]:
    """Partial sums of ``c`` for an aggregate that ``money_merge`` finishes."""
    if scale is None:
        return [F.sum(c).alias(c)]
    exact, odd = _amounts(c, scale)
    return [F.sum(exact).alias(c), F.sum(odd).alias(f"{c}_odd")]


def money_merge(c: str, scale: int | None = SUM_SCALE) -> Column:
    """The sum of partial sums that ``money_parts`` made."""
    return F.sum(c) if scale is None else _total(F.sum(c), F.sum(f"{c}_odd"))


def fixed_round(c: Column, digits: int) -> Column:
    """Round half up as ``floor(x * 10^d + 0.5) / 10^d``.

    Used for ratios and averages (unit price, AOV averages, forecast level):
    unlike sums of cents they can sit exactly on a rounding tie (r / 8 cents),
    and this spelled-out form breaks ties the same way in any engine.  Valid
    for ``|x| * 10^d`` below 9.2e18 (bigint floor): at 4 digits up to ~9e14,
    above any daily revenue level of the target data size."""
    scale = float(10 ** digits)
    return (F.floor(c * scale + 0.5).cast("double") / scale)


def channel_id(name: Column | str) -> Column:
    """Deterministic non-negative 60-bit id of a channel name (md5 prefix)."""
    return F.conv(F.substring(F.md5(_c(name)), 1, 15), 16, 10).cast("bigint")


def _state_map() -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(STATE_ISO_CODES.items())])


def iso_state_code(state: Column | str) -> Column:
    """ISO 3166-2 code of an Indian state spelling (case-insensitive), else UNKNOWN."""
    return F.coalesce(
        F.try_element_at(_state_map(), F.upper(_c(state))), F.lit(UNKNOWN_ISO)
    )


def month_start(d: Column | str) -> Column:
    return F.trunc(_c(d), "month")
