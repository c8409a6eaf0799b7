"""Hit-level columns: purchase flag, revenue, epoch time, session break, money.

All are native expressions (no UDF); see ``url.py`` for the referrer ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from .text import WHITESPACE_CLASS, regex_literal

# A decimal number as a revenue field may hold it: sign, digits with an
# optional point, optional exponent. ``nan``, ``inf``, ``1_000`` and
# non-ASCII digits are not accepted (they are skipped like any other text).
NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"

_WS = WHITESPACE_CLASS
# In each comma-separated product: three ';'-terminated fields, then the
# revenue field, whose trimmed text must be a whole number literal.
_REVENUE_FIELD = rf"(?:^|,)(?:[^,;]*;){{3}}{_WS}*({NUMBER}){_WS}*(?=[;,]|$)"


def is_purchase(event_list: Column, code: str = "1") -> Column:
    """F5. True iff ``code`` is one of the comma-separated, trimmed events.

    ``11`` or ``12`` do not count as ``1``; NULL or empty lists are false.
    """
    pattern = rf"(?:^|,){_WS}*{regex_literal(code)}{_WS}*(?:,|$)"
    # the plain substring test is cheap and lets most lists skip the regex
    maybe = F.instr(event_list, code) > 0
    return F.coalesce(maybe & event_list.rlike(pattern), F.lit(False))


def hit_revenue(product_list: Column) -> Column:
    """F6. Sum over products of the 4th ``;`` field; 0.0 when nothing counts.

    Products are separated by ``,`` and fields by ``;``. A product with fewer
    than four fields, or a blank or non-numeric 4th field, adds nothing.
    The products are summed left to right.
    """
    values = F.regexp_extract_all(product_list, F.lit(_REVENUE_FIELD), 1)
    total = F.aggregate(values, F.lit(0.0).cast("double"),
                        lambda acc, v: acc + v.cast("double"))
    return F.coalesce(total, F.lit(0.0).cast("double"))


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(c: Column, data_type: DataType | None = None) -> Column:
    """F7. Whole seconds since the epoch, rounded down, as BIGINT.

    Strings are cast strictly (an unparsable time is an error, as in the
    original SQL). ``TIMESTAMP_NTZ`` values are read as UTC wall-clock times,
    independent of the session time zone; ``TIMESTAMP`` values are instants.
    """
    if isinstance(data_type, TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)
        second = F.lit(1_000_000).cast("bigint")
        # whole-number arithmetic that rounds down before 1970 too
        return F.call_function("div", micros - F.pmod(micros, second), second)
    if isinstance(data_type, TimestampType):
        return F.unix_seconds(c)
    return c.cast("bigint")


def session_break(gap: Column, timeout_seconds: int) -> Column:
    """F8. 1 when a hit starts a new session (no previous hit, or gap > timeout)."""
    return F.when(gap.isNull() | (gap > F.lit(timeout_seconds)), 1).otherwise(0)


def money(value: Column) -> Column:
    """F11. Two-decimal text of an amount, e.g. ``480.00``.

    The amount is rounded to cents first, so the text does not depend on how
    a formatter rounds a binary fraction.
    """
    return F.format_string("%.2f", F.round(value, 2))


__all__ = [
    "NUMBER",
    "epoch_seconds",
    "hit_revenue",
    "is_purchase",
    "money",
    "session_break",
]
