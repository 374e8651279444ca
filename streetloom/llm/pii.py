"""Personal data: overlapping candidates scored by boosted trees, in DataFrame, SQL and Spark ML functions only.

Strict expressions with their checks give the base spans (``KINDS``). Wider expressions propose more candidates, some
overlapping: numbers written like telephone or card numbers, and addresses with a spelt-out ``at`` and ``dot``.
Every candidate gets features of its format and of the words around it, without the marks that only repeat whether the
strict form confirms it: the plus sign of telephone numbers, the signs and blanks of addresses, the separators of card
numbers. Gradient-boosted trees are fitted on the candidates of the table, the confirmed against the others, both sides of a
kind with equal weight, so a score states how much more frequent a look is among confirmed candidates than among
the others, however many of the others are genuine. Features are small whole numbers, so candidates are counted by distinct
feature vector before training, whose work therefore does not grow with the rows. Trees become SQL expressions that score
candidates inside their row: nothing is shuffled to apply them.

Candidates of one part of the rows (by hash) stay out of the training and calibrate each kind: the confirmed ones, marks
hidden, are the positives; those that their place speaks against (``_against``) are the negatives, and genuine spans
that the strict form misses are neither. Both are counted as rates by bands of the score. From the top, bands are accepted
while positives make at least ``MIN_CONFIRMED`` of the two rates; the lowest accepted positive is the threshold, but not
below ``LEAST_SCORE``. Accepted candidates that touch no base span are added, the best score first where they overlap each
other; base spans always stay.

Defined results: a null or empty text has no spans; positions are code points, end exclusive; equal starts are in the
order of ``KINDS``; of a kind without candidates, or with only one class of them, nothing is added. Only key and text columns are
carried, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions.binding import bind
from streetloom.session import checkpointed

KINDS = ("email", "ip", "card", "phone")
MIN_CONFIRMED = 0.98
TREES, DEPTH = 12, 3
SCORE_STEPS = 100
BAND = 5  # steps
LEAST_SCORE = 0.25  # looks over three times as frequent among the others as among the confirmed are not accepted
_HELD_PARTS = 5
_CONTEXT = 24
MAX_DOUBLINGS = 24  # of the reach of running sums: up to 16 million matches in a text

# A run of name characters is entered at its start, or where the last match ended inside it, so long runs cost
# linear time; possessive repeats never go back and need no stack.
_BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9A-Za-z+.])[0-9]{4}(?:[\x20.-]{0,2}[0-9]){9,15}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.(])\(?[0-9](?:[\x20().-]{0,2}[0-9]){8,14}+(?![0-9A-Za-z])",
}
_NEEDS = {"email": r"@|\(at\)|\[at\]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
_WORDS = {
    "near_phone": "(?i)(?:tel|phone|call|fax|mobil)[a-z]*[^a-z]*$",
    "near_card": "(?i)(?:card|visa|credit|debit|amex|karte|carte|tarjeta)[a-z]*[^a-z]*$",
    "near_mail": "(?i)(?:mail|contact|write|kontakt)[a-z]*[^a-z]*$",
    "near_count": "(?i)(?:date|year|isbn|order|page|version|chapter|number)[a-z]*[^a-z]*$",
}
_OWN = {"phone": "near_phone", "card": "near_card", "email": "near_mail"}
FEATURES = ("kind", "digits", "breaks", "groups", "longest", "parens", "dots", "check", "stop", "before", "after", *_WORDS)
#: Features that tell the strict writing of a kind from others; a candidate is judged without them.
_MARKS = {"email": ("breaks", "parens", "dots"), "card": ("breaks", "groups", "longest", "parens", "dots")}


_HIT = "struct<start:int,end:int,hit:string,before:string,after:string>"


def _running_sums(values: Column) -> Column:
    """Sums of each element and all before it, by adding at distances 1, 2, 4, ...: n log n steps, no growing array."""

    def added(reach: int) -> Callable[[Column], Column]:
        def shifted(v: Column) -> Column:
            return F.transform(v, lambda x, i: x + F.coalesce(F.get(v, i - reach), F.lit(0)))

        return lambda v: F.when(F.size(v) <= reach, v).otherwise(shifted(v))

    for doubling in range(MAX_DOUBLINGS):
        values = bind(values, added(1 << doubling))
    return values


def _found(text: Column, pattern: str) -> Column:
    """(start, end, hit, characters before, character after) of all matches, left to right."""

    def spans(h: Column, p: Column, starts: Column) -> Column:
        def span(start: Column, k: Column) -> Column:
            # neighbours come from the pieces between matches, as reaching into a long text costs its length
            before = F.right(F.concat(F.coalesce(F.get(h, k - 1), F.lit("")), F.get(p, k)), F.lit(_CONTEXT))
            after = F.left(F.concat(F.get(p, k + 1), F.coalesce(F.get(h, k + 1), F.lit(""))), F.lit(1))
            hit = F.get(h, k)
            return F.struct(
                start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("hit"), before.alias("before"), after.alias("after")
            )

        return F.transform(starts, span)

    def placed(h: Column, p: Column) -> Column:
        steps = F.transform(h, lambda hit, k: F.coalesce(F.length(F.get(h, k - 1)), F.lit(0)) + F.length(F.get(p, k)))
        return bind(_running_sums(steps), lambda starts: spans(h, p, starts))

    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.array().cast(f"array<{_HIT}>")
    return bind(hits, lambda h: F.when(F.size(h) == 0, empty).otherwise(bind(pieces, lambda p: placed(h, p))))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a number is right."""

    def part(rev: Column):
        def step(total: Column, k: Column) -> Column:
            digit = F.substring(rev, k, F.lit(1)).cast("int")
            twice = digit * 2
            return total + F.when(k % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), step)

    return bind(F.reverse(digits), part) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    count = F.length(_digits(hit))
    return {
        "email": F.lit(True),
        "ip": hit.rlike(_OCTETS),
        "card": F.when(count.between(12, 19), _luhn(_digits(hit))).otherwise(F.lit(False)),
        "phone": count.between(9, 15),
    }[kind]


_SPAN = "array<struct<kind:int,start:int,end:int,hit:string,before:string,after:string>>"


def _spans(text: Column, patterns: dict[str, str], valid: bool) -> Column:
    """Matches of all kinds in one array, kind by kind; texts without the signs of a kind are not searched."""

    def of_kind(number: int, kind: str) -> Column:
        found = _found(text, patterns[kind])
        if valid:
            found = F.filter(found, lambda s: _valid(kind, s["hit"]))
        fields = ("start", "end", "hit", "before", "after")
        typed = F.transform(found, lambda s: F.struct(F.lit(number).alias("kind"), *[s[f].alias(f) for f in fields]))
        return F.when(text.rlike(_NEEDS[kind]), typed).otherwise(F.array().cast(_SPAN))

    return F.concat(*[of_kind(number, kind) for number, kind in enumerate(KINDS) if kind in patterns])


def base_spans(text: Column) -> Column:
    return _spans(F.coalesce(text, F.lit("")), _BASE, True)


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _against(span: Column, base: Column, digits: Column) -> Column:
    """Whether a candidate's place speaks against its kind: words of other kinds or of counts and none of its own before it,
    a base span of another kind at its place, a card's wrong check digit, a full stop inside an address."""
    kind, before = span["kind"], span["before"]
    out = F.exists(base, lambda b: (b["kind"] != kind) & _meets(b, span))
    for name, own in _OWN.items():
        if name == "email":
            found = span["hit"].rlike("\\.\\x20")
        else:
            found = F.lit(False)
            for other in ("near_phone", "near_card", "near_count"):
                if other != own:
                    found = found | before.rlike(_WORDS[other])
        found = found & ~before.rlike(_WORDS[own].replace("[a-z]*[^a-z]*$", ""))
        if name == "card":
            found = found | ~F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
        out = out | ((kind == KINDS.index(name)) & found)
    return out


def _featured(span: Column, confirmed: Column, base: Column) -> Column:
    """Features of one candidate, whether a base span of its kind has its place, and whether its place speaks against it."""
    hit, digits, before, after = span["hit"], _digits(span["hit"]), span["before"], span["after"]

    def number(condition: Column) -> Column:
        return condition.cast("int")

    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    values = {
        "kind": span["kind"],
        "digits": F.least(F.length(digits), F.lit(24)),
        "breaks": F.least(F.regexp_count(hit, F.lit("[\\x20-]")), F.lit(9)),
        "groups": F.least(F.size(groups), F.lit(9)),
        "longest": F.least(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), F.lit(20)),
        "parens": number(hit.contains("(")),
        "dots": F.least(F.regexp_count(hit, F.lit("\\.")), F.lit(5)),
        "check": number(F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))),
        "stop": number(hit.rlike("\\.\\x20")),
        "before": F.when(before == "", 0).when(before.rlike("\\s$"), 1).when(before.rlike("[A-Za-z]$"), 2).otherwise(3),
        "after": F.when(after == "", 0).when(after.rlike("\\s"), 1).when(after.rlike("[A-Za-z]"), 2).otherwise(3),
        **{name: number(before.rlike(pattern)) for name, pattern in _WORDS.items()},
    }
    for kind, marks in _MARKS.items():
        for name in marks:
            values[name] = F.when(span["kind"] == KINDS.index(kind), 0).otherwise(values[name])
    return F.struct(
        span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"), confirmed.alias("confirmed"),
        (~confirmed & _against(span, base, digits)).alias("against"),
        F.struct(*[values[name].cast("int").alias(name) for name in FEATURES]).alias("x"),
    )


def candidates(text: Column, base: Column) -> Column:
    """All candidates of a text with their features; ``base`` are its base spans.

    Strict spans are candidates as well. A wider match with the kind and end of a strict one is confirmed by it, as it may
    leave out no more than the plus sign; one with its start as well is the same candidate. Sorted by kind and end,
    strict before wide, such spans are neighbours. Others that touch a strict span of their kind are left out.
    """
    fields = ("kind", "end", "wide", "start", "hit", "before", "after")

    def tagged(spans: Column, wide: int) -> Column:
        return F.transform(spans, lambda s: F.struct(*[(F.lit(wide) if f == "wide" else s[f]).alias(f) for f in fields]))

    def marked(ordered: Column) -> Column:
        def one(s: Column, k: Column) -> Column:
            ahead = [F.get(ordered, k - back) for back in (1, 2)]
            strict = [(a["wide"] == 0) & (a["kind"] == s["kind"]) & (a["end"] == s["end"]) for a in ahead]
            apart = [F.abs(a["start"] - s["start"]) for a in ahead]
            equal = [F.coalesce(m & (d == 0), F.lit(False)) for m, d in zip(strict, apart)]
            near = [F.coalesce(m & (d <= 4), F.lit(False)) for m, d in zip(strict, apart)]
            wide = s["wide"] == 1
            return F.struct(
                s.alias("span"), (wide & (equal[0] | equal[1])).alias("again"), (~wide | near[0] | near[1]).alias("confirmed")
            )

        return F.transform(ordered, one)

    wide = _spans(F.coalesce(text, F.lit("")), _WIDE, False)
    ordered = F.sort_array(F.concat(tagged(base, 0), tagged(wide, 1)))
    def touches(s: Column) -> Column:
        return F.exists(base, lambda b: (b["kind"] == s["kind"]) & _meets(b, s))

    kept = F.filter(bind(ordered, marked), lambda m: ~m["again"] & (m["confirmed"] | ~touches(m["span"])))
    return F.transform(kept, lambda m: _featured(m["span"], m["confirmed"], base))


def _prepared(docs: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys, base spans, candidates and whether the row is held back from training."""
    held = F.pmod(F.xxhash64(*keys, F.col(text)), F.lit(_HELD_PARTS)) == 0
    found = docs.select(F.struct(*keys).alias("_keys"), F.col(text).alias("_text"), held.alias("held"), base_spans(F.col(text)).alias("base"))
    places = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("_keys", "held", places.alias("base"), candidates(F.col("_text"), F.col("base")).alias("candidates"))


# ---- trees -----------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Boosted trees as nested (feature, threshold, left, right) or leaf values, with their weights."""

    trees: tuple
    weights: tuple[float, ...]
    thresholds: dict[int, float]  # by kind; a kind without one adds nothing

    def score(self, x: Column) -> Column:
        total = sum((self._value(tree, x) * weight for tree, weight in zip(self.trees, self.weights, strict=True)), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))

    def _value(self, node, x: Column) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        feature, threshold, left, right = node
        return F.when(x[FEATURES[feature]] <= threshold, self._value(left, x)).otherwise(self._value(right, x))

    def limit(self, kind: Column) -> Column:
        limit = F.lit(None).cast("double")
        for number, value in self.thresholds.items():
            limit = F.when(kind == number, value).otherwise(limit)
        return limit


def _tree(lines: list[str]):
    """One tree from its printed lines."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split()[1])
    feature, threshold = re.match(r"If \(feature (\d+) <= ([-0-9.eE]+)\)", line).groups()
    left = _tree(lines)
    lines.pop(0)  # the matching Else
    return int(feature), float(threshold), left, _tree(lines)


def train(prepared: DataFrame) -> Trees:
    """Trees and thresholds from all candidates, counted by distinct feature vector."""
    each = prepared.select("held", F.explode("candidates").alias("c")).select("held", *[F.col("c")[n].alias(n) for n in ("x", "confirmed", "against")])
    counted = checkpointed(each.groupBy("held", "x", "confirmed", "against").agg(F.count("*").alias("n")))
    learn = counted.where("not held").groupBy(*[F.col("x")[f].alias(f) for f in FEATURES], F.col("confirmed").cast("double").alias("label")).agg(F.sum("n").cast("double").alias("n"))
    sides = learn.groupBy("kind").agg(*[F.sum(F.when(F.col("label") == side, F.col("n"))).alias(f"n{side}") for side in (0, 1)])
    sides = sides.where("n0 > 0 and n1 > 0")
    share = F.col("n") * (F.col("n0") + F.col("n1")) / 2 / F.when(F.col("label") == 1, F.col("n1")).otherwise(F.col("n0"))
    learn = learn.join(F.broadcast(sides), "kind").select(*FEATURES, "label", share.alias("weight"))  # a row for each kind
    if learn.isEmpty():
        return Trees((), (), {})
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(learn)
    model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1).fit(rows)
    trees = []
    for tree in model.trees:
        lines = [line for line in tree.toDebugString.split("\n")[1:] if line.strip()]
        trees.append(_tree(lines))
    found = Trees(tuple(trees), tuple(map(float, model.treeWeights)), {})
    scored = counted.where("held").select(
        F.col("x")["kind"].alias("kind"), F.floor(found.score(F.col("x")) * SCORE_STEPS).alias("step"), "confirmed", "against", "n"
    )
    sums = [F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias(name) for flag, name in (("confirmed", "good"), ("against", "bad"))]
    table = scored.groupBy("kind", "step").agg(*sums)
    return Trees(found.trees, found.weights, _thresholds(table.collect()))  # at most kinds x (SCORE_STEPS + 1) rows


def _thresholds(rows: list) -> dict[int, float]:
    """Lowest score of positives of each kind in the bands from the top down in which positives prevail."""
    limits = {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r["kind"] == kind and r["step"] >= LEAST_SCORE * SCORE_STEPS]
        goods, bads = (max(1, sum(r[side] for r in rows if r["kind"] == kind)) for side in ("good", "bad"))
        for band in sorted({r["step"] // BAND for r in own if r["good"] + r["bad"]}, reverse=True):
            here = [r for r in own if r["step"] // BAND == band]
            good, bad = sum(r["good"] for r in here) / goods, sum(r["bad"] for r in here) / bads
            if not good or good < MIN_CONFIRMED * (good + bad):
                break
            limits[kind] = min(r["step"] for r in here if r["good"]) / SCORE_STEPS
    return limits


def _with_added(base: Column, found: Column, trees: Trees) -> Column:
    """Base spans and the accepted candidates that touch none of them, by start and kind."""
    scored = F.transform(
        F.filter(found, lambda c: ~c["confirmed"] & ~F.exists(base, lambda b: _meets(b, c))),
        lambda c: F.struct(
            trees.score(c["x"]).alias("score"), (-c["start"]).alias("order"), c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")
        ),
    )
    passed = F.filter(scored, lambda c: F.coalesce(c["score"] >= trees.limit(c["kind"]), F.lit(False)))
    best = bind(passed, lambda all_: F.filter(all_, lambda c: ~F.exists(all_, lambda o: _meets(o, c) & (o > c))))
    plain = [F.transform(side, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("number"), s["end"].alias("end"))) for side in (base, best)]
    names = F.array(*map(F.lit, KINDS))
    return F.transform(
        F.sort_array(F.concat(*plain)), lambda s: F.struct(F.get(names, s["number"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def find_pii(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, spans (kind, start, end) and base, those of the strict forms.

    Candidates are written once, as training and scoring both read them; texts are read once.
    """
    prepared = checkpointed(_prepared(docs, keys, text))
    trees = train(prepared)
    names = F.array(*map(F.lit, KINDS))
    base = F.sort_array(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("number"), s["end"].alias("end"))))
    return prepared.select(
        "_keys.*",
        _with_added(F.col("base"), F.col("candidates"), trees).alias("spans"),
        F.transform(base, lambda s: F.struct(F.get(names, s["number"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first stays."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        grown = F.struct(s["end"].alias("at"), F.concat(acc["out"], piece, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        return F.when(s["start"] >= acc["at"], grown).otherwise(acc)

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text) - acc["at"]))
    return F.aggregate(spans, start, step, rest)
