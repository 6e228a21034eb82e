"""Column expressions for parsing raw incident / census text.

Every helper returns a Column built from built-in functions; none of them
is a UDF.  Positions follow Python slicing (0-based start, exclusive end)
so that record layouts can be written the way they are documented, and are
converted to Spark's 1-based ``substring`` here, once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from patrolstat.functions.tables import NULL_TEXT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_slice(line: Column | str, start: int, end: int) -> Column:
    """``line[start:end]``; NULL when the line is too short to hold the field."""
    c = _col(line)
    return F.when(F.length(c) >= end, F.substring(c, start + 1, end - start))


def tail_from(line: Column | str, start: int) -> Column:
    """``line[start:]``; NULL when the line is shorter than ``start``."""
    c = _col(line)
    return F.when(F.length(c) >= start, F.substr(c, F.lit(start + 1)))


def strip_brackets(text: Column | str) -> Column:
    """Remove one leading '(' and one trailing ')'."""
    return F.regexp_replace(_col(text), r"^\(|\)$", "")


def split_pick(text: Column | str, sep: str, index: int) -> Column:
    """Field ``index`` (0-based) of ``text`` split on the literal ``sep``.

    NULL when the text has fewer fields (``get`` never throws under ANSI).
    """
    return F.get(F.split(_col(text), re.escape(sep)), index)


def null_if_missing(text: Column | str, markers: tuple[str, ...] = (NULL_TEXT,)) -> Column:
    """Empty / blank text or a missing-value marker -> NULL, else unchanged."""
    c = _col(text)
    missing = (F.trim(c) == "") | c.isin(*markers)
    return F.when(~missing, c)


def safe_int(text: Column | str) -> Column:
    """String -> int; anything unparsable (incl. ``'null'``) -> NULL."""
    return _col(text).try_cast("int")


def month_of(date_text: Column | str) -> Column:
    """Month from ``yyyy/MM/dd`` text."""
    return safe_int(fixed_slice(date_text, 5, 7))


def day_of(date_text: Column | str) -> Column:
    """Day of month from ``yyyy/MM/dd`` text."""
    return safe_int(fixed_slice(date_text, 8, 10))


def hour_of(time_text: Column | str) -> Column:
    """Hour from ``HH:mm`` text."""
    return safe_int(fixed_slice(time_text, 0, 2))


def minute_of(time_text: Column | str) -> Column:
    """Minute from ``HH:mm`` text."""
    return safe_int(fixed_slice(time_text, 3, 5))


def ratio_percent(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator * 100`` as double; NULL when the denominator is 0."""
    n, d = _col(numerator), _col(denominator)
    return F.try_divide(n.cast("double"), d.cast("double")) * F.lit(100.0)


def percent_text(percent: Column | str) -> Column:
    """Two-decimal percent text, e.g. ``94.19%``."""
    return F.format_string("%.2f%%", _col(percent).cast("double"))


def float_text(value: Column | str, missing: str = "NaN") -> Column:
    """Render a mean the way a 32-bit float prints; NULL -> ``missing``."""
    return F.coalesce(_col(value).cast("float").cast("string"), F.lit(missing))
