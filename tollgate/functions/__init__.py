"""Column-level building blocks (all built-in Spark expressions, no Python UDFs)."""
from .text import (  # noqa: F401
    EMAIL_PATTERN,
    is_blank,
    is_null_or_blank,
    iso_date,
    matches_strptime,
    strip_ws,
    to_number,
)
from .metrics import count_if  # noqa: F401
