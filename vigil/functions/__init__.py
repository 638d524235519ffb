"""Column expressions shared by batch and streaming transforms.

All built-in Spark functions: they stay inside whole-stage codegen.
"""

from vigil.functions.columns import (
    json_text,
    opens_with,
    space_trim,
    strict_date,
    suffix_glob,
    utc_instant,
)

__all__ = [
    "json_text",
    "opens_with",
    "space_trim",
    "strict_date",
    "suffix_glob",
    "utc_instant",
]
