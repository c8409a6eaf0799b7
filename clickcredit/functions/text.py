"""Whitespace handling shared by the column functions.

Spark's ``trim`` removes only spaces, and Java's ``\\s`` knows only six
characters. Hit files come from tools that strip and split on every Unicode
whitespace character, so the class below lists that set explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Python ``str.split()`` / ``str.strip()``
# treats as whitespace, in code-point order.
WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def collapse_ws(c: Column) -> Column:
    """Collapse whitespace runs to one space and strip both ends."""
    return F.trim(F.regexp_replace(c, WHITESPACE_CLASS + "+", " "))


def regex_literal(text: str) -> str:
    """Quote ``text`` for use inside a Java regular expression."""
    return "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in text)
