"""String / date / number helpers shared by checks and transforms."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must behave like the reference's validators.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
# Python's str.strip() removes any whitespace, Spark's trim() only spaces.
_EDGE_WS = r"^\s+|\s+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python-style strip(): leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(col), _EDGE_WS, "")


def is_blank(col) -> Column:
    """Non-null and empty after strip (null is *not* blank)."""
    c = _c(col)
    return c.isNotNull() & (strip_ws(c.cast("string")) == "")


def is_null_or_blank(col) -> Column:
    c = _c(col)
    return c.isNull() | (strip_ws(c.cast("string")) == "")


def to_number(col) -> Column:
    """pandas ``to_numeric(errors='coerce')``: non-numeric text becomes null."""
    return _c(col).cast("string").try_cast("double")


# strftime directive → (regex guard, Spark datetime pattern).  strptime accepts
# unpadded month/day/hour fields, so the guard allows one or two digits.
_STRPTIME = {
    "%Y": (r"[0-9]{4}", "y"),
    "%m": (r"[0-9]{1,2}", "M"),
    "%d": (r"[0-9]{1,2}", "d"),
    "%H": (r"[0-9]{1,2}", "H"),
    "%M": (r"[0-9]{1,2}", "m"),
    "%S": (r"[0-9]{1,2}", "s"),
}


def _translate(fmt: str) -> tuple[str, str]:
    regex, pattern, i = ["^"], [], 0
    while i < len(fmt):
        tok = fmt[i : i + 2]
        if tok in _STRPTIME:
            r, p = _STRPTIME[tok]
            regex.append(r)
            pattern.append(p)
            i += 2
        else:
            ch = fmt[i]
            regex.append(re.escape(ch))
            pattern.append("'" + ch + "'" if ch.isalpha() else ch)
            i += 1
    regex.append("$")
    return "".join(regex), "".join(pattern)


def matches_strptime(col, fmt: str = "%Y-%m-%d") -> Column:
    """True when the text parses exactly with the strftime format ``fmt``.

    A regex guard enforces the field widths (``'y-M-d'`` alone would also accept
    two-digit or five-digit years); ``try_to_timestamp`` validates the calendar.
    """
    regex, pattern = _translate(fmt)
    s = _c(col).cast("string")
    return s.rlike(regex) & F.try_to_timestamp(s, F.lit(pattern)).isNotNull()


def iso_date(col) -> Column:
    """Strict ``yyyy-MM-dd`` parse (the ISO style 23 of the T-SQL checks)."""
    s = _c(col).cast("string")
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(s, "yyyy-MM-dd"))
