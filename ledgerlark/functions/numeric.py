"""Numeric parsing of untrusted text.

Spark's ``try_cast`` is looser than the feed contract (it accepts ``1d``,
``1.5f``, ``NaN``, ``Infinity``), so a regex guard decides what is a number
first; only then is the text cast. Everything stays a native expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plain decimal / scientific notation, optional sign (what the feed's numeric
# columns are allowed to contain once formatting is removed).
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


WHITESPACE = " \t\n\r\f\u000b"
# with separators, no-break and other Unicode spaces
ALL_SPACES = (WHITESPACE + "\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _bare(c: Column) -> Column:
    """Whether a text begins and ends with a printable ASCII character, which no
    white space is: trimming leaves it as it is, at several times the cost."""
    return (c >= "!") & (c < "\x7f") & F.substring(c, -1, 1).between("!", "~")


def strip_ws(c: Column) -> Column:
    """Trim leading/trailing whitespace (tabs, CR from CRLF files too).
    A character-set trim, not a regex: this runs on every numeric cell."""
    return F.when(_bare(c), c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def strip_formatting(c: Column) -> Column:
    """Delete every ``$`` and ``,`` (``translate``, no regex), then trim,
    so what a deleted sign leaves at the ends (``$ 72.70``) goes too."""
    plain = _bare(c) & ~c.contains("$") & ~c.contains(",")
    return F.when(plain, c).otherwise(F.trim(F.translate(c, "$,", ""), F.lit(ALL_SPACES)))


def to_double(c: Column, strip_currency: bool = True) -> Column:
    """Parse text to double; junk, and numbers beyond doubles (``1e400``), -> NULL.

    ``strip_currency=False`` is the quality gate's strict reading (C5-C7),
    where ``$72.70`` is *not* a number.
    """
    return number(strip_formatting(c) if strip_currency else strip_ws(c))


def number(stripped: Column, cast: Column | None = None) -> Column:
    """The double that a stripped text holds, as :func:`to_double`. ``cast``: the
    text as a double, where it is at hand."""
    d = stripped.try_cast("double") if cast is None else cast
    return F.when(stripped.rlike(NUMBER_PATTERN) & (F.abs(d) < float("inf")), d)


def with_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with each text column's double as ``_<column>``. In steps, each of which
    reads a result more than once: Spark doesn't merge those, so a text is stripped,
    cast and matched once a row."""
    df = df.withColumns({f"_{c}": strip_formatting(F.col(c)) for c in columns})
    df = df.withColumns({f"_d_{c}": F.col(f"_{c}").try_cast("double") for c in columns})
    return df.withColumns({f"_{c}": number(F.col(f"_{c}"), F.col(f"_d_{c}")) for c in columns}).drop(
        *[f"_d_{c}" for c in columns])


def to_long(c: Column, strip_currency: bool = True) -> Column:
    """Integral values only; a fractional value becomes NULL (quarantined
    downstream) instead of aborting the whole job."""
    return whole(to_double(c, strip_currency))


def whole(d: Column) -> Column:
    """A double's integral value, NULL if it has none."""
    return F.when(d == F.floor(d), d.try_cast("long"))


#: Line amounts from here on are quarantined: money is summed as DECIMAL(38,10),
#: which holds 10**13 lines of less.
AMOUNT_LIMIT = 1e15
#: A discount that leaves a smaller part of the price is no discount.
LEAST_PAID = 1e-6


def amount_in_range(c: Column) -> Column:
    """The amount, NULL if it is out of range."""
    return F.when(F.abs(c) < AMOUNT_LIMIT, c)


def bad_amount(unit_price: Column, line_revenue: Column, discount_pct: Column) -> Column:
    """Whether a line's money can't be summed (never NULL)."""
    paid = F.lit(1.0) - discount_pct / 100.0
    over = [F.abs(c) >= AMOUNT_LIMIT for c in (unit_price, line_revenue, discount_pct)]
    return F.coalesce(over[0], F.lit(False)) | F.coalesce(over[1], F.lit(False)) | F.coalesce(over[2], F.lit(False)) \
        | F.coalesce((paid > 0) & (paid < LEAST_PAID), F.lit(False))


def is_nonnumeric(c: Column) -> Column:
    """Present but not a strict number."""
    return c.isNotNull() & to_double(c, strip_currency=False).isNull()
