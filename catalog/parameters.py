"""Small parameter tables of the registered queries, for Spark and as SQL values."""

from __future__ import annotations

AFFINITY = (
    ("1-urgent", "AUTOMOBILE", 1.0),
    ("1-urgent", "BUILDING", 0.6),
    ("1-urgent", "MACHINERY", 0.3),
    ("2-high", "AUTOMOBILE", 0.2),
    ("2-high", "FURNITURE", 0.7),
    ("3-medium", "HOUSEHOLD", 0.8),
    ("3-medium", "BUILDING", 0.5),
    ("4-not specified", "HOUSEHOLD", 0.4),
    ("4-not specified", "MACHINERY", 0.9),
    ("5-LOW", "BUILDING", 0.15),  # a type that the table has only as written
    ("5-LOW", "FURNITURE", 0.45),
    ("2-HIGH", "BUILDING", 0.99),  # never used, as the table has the type in lower case
)

REQUEST_GROUPS = (
    ("1-urgent", "Safety"),
    ("2-high", "Safety"),
    ("3-medium", "Property"),
    ("4-not specified", "General"),
)  # 5-low is in no group

TAXONOMY = {
    "Food & Restaurants": ("restaurant", "bar", "tea", "tex-mex"),
    "Shopping & Retail": ("furniture", "retail", "store"),
    "Automotive": ("auto", "rv", "machine"),
    "Home Services": ("home service", "building", "household"),
    "Pets": ("pet",),
    "Education": ("school",),
}

LEXICON = (
    ("of", 1.9, "word"),
    ("in", -2.5, "word"),
    ("la", 2.1, "word"),
    ("der", -1.4, "word"),
    ("on", 0.9, "word"),
    ("es", -0.8, "word"),
    ("the", 0.293, "booster"),
    ("de", 0.293, "booster"),
    ("und", -0.293, "booster"),
    ("la", 0.0, "negation"),
    ("and", 0.0, "negation"),
    ("le", 0.0, "negation"),
    ("nicht", 0.0, "negation"),
    ("to the", 0.2, "booster"),
    ("ou la", -0.3, "booster"),
    ("of the", 0.7, "phrase"),
    ("of of", -1.1, "phrase"),
    ("in the and", 2.4, "phrase"),
    ("in the", -0.6, "phrase"),
    ("in onbleea of", 1.3, "phrase"),
    ("the of", 1.7, "phrase"),
    ("der der", 0.0, "phrase"),
    ("the the of", -2.2, "phrase"),
    ("onre enat in", 3.0, "phrase"),
    ("nd rely", -1.6, "phrase"),
    ("the nd rely", 0.9, "phrase"),
    ("ntre in onbleea", -0.4, "phrase"),
    ("ndnd onre", 1.2, "phrase"),
    ("the the", 0.5, "phrase"),
    ("ingre onanshat", 0.25, "booster"),
    ("theaeati ingre onanshat", 0.35, "booster"),
)
CONTRAST = ("that", "ou")
# frequent words of the texts in the places of "least", "never so", "without doubt", "no" and "kind of"
PHRASES = {
    "least": ("to",), "before least": ("is", "that"),
    "never": ("le",), "so": ("it", "les"),
    "without": ("and",), "doubt": ("to", "was"),
    "no": ("der",), "no link": ("die", "or"),
    "kind": ("on",), "of": ("the", "a"),
}


def taxonomy_rows() -> list[tuple[str, str, int]]:
    return [
        (group, keyword, ordinal)
        for ordinal, (group, keywords) in enumerate(TAXONOMY.items())
        for keyword in keywords
    ]


def values_sql(rows, columns: str) -> str:
    def one(value):
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"cast({value} as double)" if isinstance(value, float) else str(value)

    body = ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)
    return f"(select * from (values {body}) as v({columns}))"
