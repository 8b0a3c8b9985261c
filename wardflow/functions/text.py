"""Cleaning of text columns that carry codes, periods, numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardflow.schemas import REGION_CODE, REGION_NAME, REGION_WIDTH

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Every character that counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """Text without surrounding white space (tabs and no-break spaces too); empty becomes null.

    Most values pass as they are: a first and a last character between ``!`` and ``~``, told by comparing bytes, need no
    look at the long list of white space characters.
    """
    t = _col(c).cast("string")
    return F.when(_plain(t), t).otherwise(F.nullif(F.btrim(t, F.lit(WHITE_SPACE)), F.lit("")))


def _plain(t: Column) -> Column:
    last = F.substring(t, -1, 1)
    return (t >= "!") & (t < "\x7f") & (last >= "!") & (last < "\x7f")


def texts(columns: list[Column]) -> Column:
    """Array of :func:`text` of each column.

    Steps over the array evaluate each result once. Blanks alone go first, as the search for other white space costs several
    times as much per value.
    """
    bare = F.transform(F.array(*[c.cast("string") for c in columns]), lambda t: F.btrim(t))
    trimmed = F.transform(bare, lambda t: F.when(_plain(t), t).otherwise(F.btrim(t, F.lit(WHITE_SPACE))))
    return F.transform(trimmed, lambda t: F.when(t != "", t))


def bare(c) -> Column:
    """Text without the blanks around it, for :func:`text_of_bare`."""
    return F.btrim(_col(c).cast("string"))


def nearly_bare(c) -> Column:
    """Of a column of :func:`bare` texts, those with tabs and line ends around them without these."""
    t = _col(c)
    return F.when(_plain(t), t).otherwise(F.btrim(t, F.lit(" \t\r\n")))


def text_of_bare(c) -> Column:
    """:func:`text` of a column that holds :func:`bare` or :func:`nearly_bare` texts: generated code, for few columns at a time."""
    t = _col(c)
    return F.when(_plain(t), t).otherwise(F.nullif(F.btrim(t, F.lit(WHITE_SPACE)), F.lit("")))


def has_text(c) -> Column:
    """True where :func:`text` is not null."""
    return F.coalesce(F.ltrim(_col(c).cast("string"), F.lit(WHITE_SPACE)) != "", F.lit(False))


def zero_fill(c, width: int) -> Column:
    """Left-pad with zeros up to ``width``; unlike a bare ``lpad`` never cuts a longer value."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def without_fraction(c) -> Column:
    """Drops the ``.0`` that a float column leaves behind an identifier."""
    c = _col(c)
    return F.when(F.endswith(c, F.lit(".0")), F.substring(c, F.lit(1), F.length(c) - 2)).otherwise(c)


def code(c, width: int | None = None) -> Column:
    """Identifier kept as text, without a trailing ``.0`` and zero-filled."""
    out = without_fraction(text(c))
    return zero_fill(out, width) if width else out


def digits(c) -> Column:
    """Digits alone; a month of six digits passes as it is."""
    c = _col(c)
    return F.when(c.rlike(r"^[0-9]{6}$"), c).otherwise(F.regexp_replace(c, r"[^0-9]", ""))


def period(c) -> Column:
    """Month as ``yyyyMM``: digits only. Check with :func:`bad_period` before relying on it."""
    return digits(text(c))


def bad_period(c) -> Column:
    """True when a non-null value does not hold exactly six digits."""
    return F.coalesce(F.length(period(c)) != 6, F.lit(False))


def whole(t) -> Column:
    """Whole number from trimmed text.

    Patterns decide first which cast cannot fail: a failing ``try_cast`` costs an exception per row.
    """
    t = _col(t)
    n, plain = t.cast("double"), without_fraction(t)
    fits = (n == F.floor(n)) & (F.abs(n) < 2**31)
    return F.when(plain.rlike(r"^[+-]?[0-9]{1,9}\z"), plain.cast("int")).when(
        t.rlike(NUMBER), F.when(fits, n.cast("int"))
    )


def integer(c) -> Column:
    """Whole number, lenient: text that is no number becomes null, ``'12.0'`` becomes 12."""
    return whole(text(c))


def bad_integer(c) -> Column:
    """True for a number that is fractional or does not fit, which must stop a load."""
    return lost_number(text(c), integer(c))


def lost_number(t, n) -> Column:
    """True where trimmed text ``t`` is a number and ``n``, the whole number made of it, is missing."""
    return _col(n).isNull() & F.coalesce(_col(t).rlike(NUMBER), F.lit(False))


def day(c, pattern: str = "yyyyMMdd") -> Column:
    """Date from text; anything unparsable becomes null.

    Text without the pattern's shape, with a month over 12 or with zeros for a month or day is told by its characters: a
    failing parse costs an exception per row.
    """
    t = _col(c).cast("string")
    month = {"yyyyMMdd": 5, "yyyy-MM-dd": 6}.get(pattern)
    if month is None:
        return F.try_to_date(t, pattern)
    shape = r"^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])\z" if month == 5 else r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])\z"
    iso = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)) if month == 5 else t
    return F.when(t.rlike(shape), iso.try_cast("date"))


def without_sentinels(c, *sentinels: str) -> Column:
    """Null where the value is one of the placeholder texts."""
    c = _col(c)
    return F.when(~c.isin(*sentinels), c)


def equals_flag(c, value: str) -> Column:
    """1 / 0 for equal / different, null for null."""
    return (_col(c) == F.lit(value)).cast("int")


def in_region_code(c, region: str = REGION_CODE) -> Column:
    """True for the region's rows by municipality code, however that is padded or typed."""
    return F.coalesce(code(c, REGION_WIDTH) == region, F.lit(False))


def in_region_name(c, region: str = REGION_NAME) -> Column:
    """True for the region's rows by municipality name."""
    return F.coalesce(F.upper(text(c)) == region.upper(), F.lit(False))
