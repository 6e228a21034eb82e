"""Category expressions: severity weight, keyword bucket, theft flag, slot.

All builders return plain Catalyst expressions (CASE WHEN / IN / contains),
so they stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from patrolstat.functions.tables import (
    BUCKET_RULES,
    N_SLOTS,
    OTHER_BUCKET,
    SEVERITY_WEIGHTS,
    SLOT_HOURS,
    THEFT_CATEGORIES,
    UNKNOWN_WEIGHT,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def severity_weight(category: Column | str) -> Column:
    """Exact-match severity weight; unknown or NULL category -> 0.

    One lookup in a literal map (constant-folded), so the category is read
    once per row however many weight classes the table has.
    """
    pairs = [F.lit(x) for w, cats in SEVERITY_WEIGHTS for c in cats for x in (c, w)]
    return F.coalesce(F.element_at(F.create_map(*pairs), _col(category)),
                      F.lit(UNKNOWN_WEIGHT)).cast("int")


def keyword_bucket(category: Column | str) -> Column:
    """First bucket whose keyword is contained in the category, else 'other'."""
    c = _col(category)
    expr = None
    for bucket, words in BUCKET_RULES:
        cond = reduce(lambda a, b: a | b, [c.contains(w) for w in words])
        expr = F.when(cond, F.lit(bucket)) if expr is None else expr.when(cond, F.lit(bucket))
    return expr.otherwise(F.lit(OTHER_BUCKET))


def is_theft(category: Column | str) -> Column:
    """True for the theft categories; NULL category -> False."""
    return F.coalesce(_col(category).isin(*THEFT_CATEGORIES), F.lit(False))


def hour_slot(hour: Column | str) -> Column:
    """Slot 1..4 for hours [0,6) [6,12) [12,18) [18,24); NULL otherwise."""
    h = _col(hour)
    in_day = (h >= 0) & (h < SLOT_HOURS * N_SLOTS)
    return F.when(in_day, (F.floor(h / SLOT_HOURS) + 1).cast("int"))
