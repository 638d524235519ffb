from __future__ import annotations

from collections import Counter


def same_rows(a, b) -> bool:
    """Order-insensitive equality of two DataFrames with the same columns."""
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return False
    return Counter(tuple(r) for r in a.select(*cols).collect()) == Counter(tuple(r) for r in b.select(*cols).collect())
