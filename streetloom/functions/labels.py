"""Column expressions for labels, names and postal codes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the text rules mean it: ASCII blanks, separators \x1c-\x1f, NEL and every Unicode separator.
BLANK = r"\t-\r\x1c-\x1f\x85\p{Z}"
# Letters and numbers of any script, and the underscore; combining marks are not word characters.
WORD = r"\p{L}\p{N}_"


def strip_blank(col: Column) -> Column:
    return F.regexp_replace(col, f"^[{BLANK}]+|[{BLANK}]+$", "")


def normalize_label(col: Column) -> Column:
    """Lower case, stripped, inner white space collapsed; null stays null."""
    return F.regexp_replace(strip_blank(F.lower(col)), f"[{BLANK}]+", " ")


def name_key(col: Column) -> Column:
    return strip_blank(F.lower(col))


def zip_from_text(col: Column) -> Column:
    """First run of five digits after removing a trailing ``.0``; null if there is none."""
    plain = F.regexp_replace(col.cast("string"), r"\.0$", "")
    return F.nullif(F.regexp_extract(plain, r"(\d{5})", 1), F.lit(""))


def zip_from_digits(col: Column) -> Column:
    """First five of all digits of the text; null if there are fewer."""
    digits = F.regexp_replace(col.cast("string"), r"\D", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5))


def has_zip_prefix(col: Column, prefix: str) -> Column:
    return F.coalesce(strip_blank(col.cast("string")).startswith(prefix), F.lit(False))


def snake_case(name: str) -> str:
    """Column name in snake case."""
    kept = re.sub(r"[^\w\s]", "", name.lower().strip())
    return "_".join(re.split(r"\s+", kept))
