"""Text helpers for the raw layer (F9 and the list-literal clean-up of N3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numpy >= 2 prints list elements as ``np.int64(7)``; this
# pattern unwraps them back to plain integers before JSON parsing.
NUMPY_INT_PATTERN = r"np\.int64\((-?\d+)\)"


def parse_id_list(text: Column, element_type: str = "bigint", strict: bool = False) -> Column:
    """``"[1, 2]"`` / ``"[np.int64(1)]"`` / ``"[]"`` -> array; malformed -> NULL, or raises if ``strict``."""
    # lists of plain integers are not searched by the pattern
    cleaned = F.when(F.contains(text, F.lit("np.int64(")), F.regexp_replace(text, NUMPY_INT_PATTERN, "$1")).otherwise(text)
    return F.from_json(cleaned, f"array<{element_type}>", {"mode": "FAILFAST"} if strict else None)
