from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.config import DATE_FORMAT

# Exactly four, two and two digits ('\z': no trailing newline): on this shape
# Spark's date cast gives the same result as the 'yyyy-MM-dd' parser, much faster.
_ISO_DATE_PLAIN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# Every text the 'yyyy-MM-dd' parser accepts has this wider shape (optional
# sign, four or more year digits); both checked in the tests.
_ISO_DATE_SHAPE = r"^[+-]?[0-9]{4,}-[0-9]{2}-[0-9]{2}$"


def space_trim(c: Column) -> Column:
    """Remove the space character (only) from both ends; '   ' becomes ''."""
    return F.trim(c)


def strict_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """Parse text as a date in exactly ``fmt``; null when it does not parse.

    ``try_to_date`` keeps this null-producing under ANSI mode, where plain
    ``to_date`` raises. For the ISO format the common shape goes through
    Spark's date cast (the formatter-based parse was about a tenth of the
    cleanse CPU), other shapes the parser could accept go to the parser, and
    anything else is null without parsing (a failed parse costs a caught
    exception, about 7x a good parse).
    """
    parsed = F.try_to_date(c, fmt)
    if fmt == "yyyy-MM-dd":
        return F.when(c.rlike(_ISO_DATE_PLAIN), c.try_cast("date")).when(c.rlike(_ISO_DATE_SHAPE), parsed)
    return parsed


def utc_instant(c: Column) -> Column:
    """ISO-8601 instant text (offset, fraction optional) to a timestamp."""
    return F.try_to_timestamp(c)


def json_text(*cols: Column | str) -> Column:
    """One JSON object per row, null fields written as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def opens_with(value: Column, bracket: str) -> Column:
    """True when a text's first character that is no JSON white space is ``bracket``."""
    return F.coalesce(value.rlike("^[ \\t\\n\\r]*[\\" + bracket + "]"), F.lit(False))


def suffix_glob(*suffixes: str) -> str:
    """Case-insensitive Hadoop glob for file suffixes: ('csv',) -> '*.[cC][sS][vV]'."""

    def one(s: str) -> str:
        return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in s.lstrip("."))

    parts = [one(s) for s in suffixes]
    if len(parts) == 1:
        return f"*.{parts[0]}"
    return "*.{" + ",".join(parts) + "}"
