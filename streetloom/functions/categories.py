"""Column expressions for business categories."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetloom.fixed_values import BUSINESS_GROUPS, CATEGORY_GROUPS, OTHER, UNCATEGORIZED
from streetloom.functions.binding import bind
from streetloom.functions.labels import BLANK, WORD, strip_blank


def split_categories(col: Column) -> Column:
    """Comma list → array of stripped names; null → [Uncategorized]."""
    names = F.transform(F.split(col, ","), strip_blank)
    return F.coalesce(names, F.array(F.lit(UNCATEGORIZED)))


def normalize_category(col: Column) -> Column:
    """Lower case, stripped, only word characters, white space and ``&`` kept, white space collapsed."""
    kept = F.regexp_replace(strip_blank(F.lower(col)), f"[^{WORD}{BLANK}&]", "")
    return F.regexp_replace(kept, f"[{BLANK}]+", " ")


def _branches(words: Sequence[str], whole: bool) -> str:
    """Pattern of the words as a tree of their beginnings, so that a name is walked once for all of them.

    Where a word ends, longer ones with that beginning matter only if words must be ``whole``.
    """
    by_first: dict[str, list[str]] = {}
    for word in dict.fromkeys(words):
        by_first.setdefault(word[:1], []).append(word[1:])
    ends = by_first.pop("", None) is not None
    if ends and not whole or not by_first:
        return ""
    parts = [re.escape(first) + _branches(rests, whole) for first, rests in sorted(by_first.items())]
    if len(parts) == 1 and not ends:
        return parts[0]
    return f"(?:{'|'.join(parts)})" + ("?" if ends else "")


def keyword_pattern(keywords: Sequence[str], match: str = "substring") -> str:
    """Regular expression that finds any keyword, anywhere or only as whole words.

    Its size is that of the tree of the keywords' beginnings, and the work at a place of a name is bounded by the
    number of different next characters, not by the number of keywords.
    """
    if match == "substring":
        return f"(?:{_branches(keywords, False)})"
    if match == "word":
        return f"(?<![{WORD}])(?:{_branches(keywords, True)})(?![{WORD}])"
    raise ValueError(f"match must be 'substring' or 'word', not {match!r}")


def _any_matches(names: Column, pattern: str) -> Column:
    return F.exists(names, lambda name: name.rlike(pattern))


def map_taxonomy(categories: Column, taxonomy: Mapping[str, Sequence[str]], match: str = "substring") -> Column:
    """Category names → taxonomy groups in taxonomy order, then unmatched names in name order.

    A name counts for every group of which it contains a keyword. The mapping becomes part of the
    expression, so rows are mapped where they are; ``operators.taxonomy`` takes larger tables.
    """
    every_word = [word for words in taxonomy.values() for word in words]
    known = keyword_pattern(every_word, match) if every_word else "(?!)"

    def of_names(names: Column) -> Column:
        hits = [
            F.when(_any_matches(names, keyword_pattern(words, match)), F.lit(group))
            for group, words in taxonomy.items()
            if words
        ]
        rest = F.filter(names, lambda name: (name != UNCATEGORIZED.lower()) & ~name.rlike(known))
        mapped = F.concat(
            F.filter(F.array(*hits) if hits else F.array().cast("array<string>"), lambda g: g.isNotNull()),
            F.array_sort(F.array_distinct(rest)),
        )
        return bind(mapped, lambda m: F.when(F.size(m) > 0, m).otherwise(F.array(F.lit(UNCATEGORIZED))))

    return bind(F.transform(categories, normalize_category), of_names)


def primary_category(mapped: Column, groups: Sequence[str] = CATEGORY_GROUPS) -> Column:
    """First entry that is a taxonomy group, else the first entry."""
    known = F.filter(mapped, lambda name: name.isin(*groups)) if groups else F.array()
    return F.coalesce(F.get(known, F.lit(0)), F.get(mapped, F.lit(0)), F.lit(UNCATEGORIZED))


def business_group(
    categories: Column, rules: Sequence[str] = BUSINESS_GROUPS, default: str = OTHER
) -> Column:
    """Last rule found (as a case-insensitive pattern) in any category; null or no hit → default."""
    group = None
    for rule in reversed(rules):
        found = F.coalesce(_any_matches(categories, f"(?i){rule}"), F.lit(False))
        group = F.when(found, F.lit(rule)) if group is None else group.when(found, F.lit(rule))
    return F.lit(default) if group is None else group.otherwise(F.lit(default))
