"""Personal data: candidate spans scored by boosted trees, in DataFrame functions only.

Four patterns with checks give the base spans: email, ip, card, phone. Two wide patterns
propose further, overlapping candidates: ``contact`` (addresses with a spelled-out at or dot)
and ``number`` (any long group of digits). Boosted trees see a candidate's format (length,
digits, groups, separators) and context (neighbouring characters, words before it), but not the
checks. They are trained on the base candidates of all documents, whose labels say whether the
candidate passed its checks; per kind, a threshold is calibrated on all of them too, so that of
what scores above it nearly all is true. For that, each half of the candidates is scored by trees
that were fitted to the other half. (Spark ML takes the split points that its trees try from at
least 10,000 rows.) Wide
candidates above the threshold that don't overlap a base span are redacted too; base spans
always stay. The trees are turned into an expression that is evaluated where the candidate was
found: no row is moved and no Python runs.

Spans count code points, end exclusive. Null text has no spans. Each row is judged by itself,
whatever its ``doc_id``; other columns are ignored. If either half lacks candidates of one
label, no wide candidate is redacted."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES, DEPTH = 8, 3
PRECISION = 0.9
CONTEXT = 24

# Fixed patterns. Quantifiers are possessive where nothing could be given back, so that
# long texts cost no backtracking; an address starts where its run of characters starts.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++"
    r"(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]++)++",
    "number": r"(?<![0-9])[(+]?[0-9](?:[ ().-]{0,2}[0-9]){6,18}+(?![0-9])",
}
HINTS = {
    "mail": "mail|contact|write|courriel|correo",
    "call": "call|phone|tel|mobile|fax|appel|llame|ruf",
    "card": "card|visa|credit|pay|carte|tarjeta|karte",
    "host": "ip|host|server|addr|client|node",
    "code": "hash|order|invoice|ref|sku|isbn|id|no\\\\.|version",
}
FEATURES = [
    "length", "digits", "groups", "letters", "dots", "spaces", "dashes", "brackets", "plus", "at",
    "joined_before", "joined_after", *HINTS,
]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(numbers: Column, rounds: int = 22) -> Column:
    """Running sums of an array, by adding ever more distant partial sums."""

    def add(step: int):
        return lambda a: F.when(
            F.size(a) > step,
            F.transform(
                a, lambda x, i: x + F.when(i >= step, F.get(a, i - step)).otherwise(F.lit(0))
            ),
        ).otherwise(a)

    for k in range(rounds):
        numbers = _let(numbers, add(1 << k))
    return numbers


def _found(text: Column, pattern: str) -> Column:
    """Leftmost, non-overlapping matches: an array of (start, end, span, before, after)."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, pattern: str, matches: Column) -> Column:
    kind = "array<struct<start: int, end: int, span: string, before: string, after: string>>"
    between = F.split(text, pattern, -1)
    steps = _let(
        between,
        lambda parts: F.transform(
            matches,
            lambda m, i: F.length(F.get(parts, i))
            + F.when(i > 0, F.length(F.get(matches, i - 1))).otherwise(F.lit(0)),
        ),
    )
    placed = _let(
        between,
        lambda parts: F.zip_with(
            matches,
            F.transform(_running(steps), lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
            lambda m, at: F.struct(
                at["s"].alias("start"),
                (at["s"] + F.length(m)).alias("end"),
                m.alias("span"),
                F.right(F.get(parts, at["i"]), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(parts, at["i"] + 1), F.lit(CONTEXT)).alias("after"),
            ),
        ),
    )
    return F.when(F.size(matches) > 0, placed.cast(kind)).otherwise(F.array().cast(kind))


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda sum_, i: sum_ + _let(
            F.substr(digits, i, F.lit(1)).cast("int") * (1 + (n - i) % 2),
            lambda d: d - F.when(d > 9, 9).otherwise(0),
        ),
    )
    return total % 10 == 0


def _passes(kind: str, span: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.split(span, r"\.")
        plain = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        value = lambda p: F.when(F.length(p) <= 3, p.cast("int")).otherwise(999)
        return F.forall(plain, lambda p: value(p) <= 255)
    digits = _digits(span)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(False)


def _features(c: Column) -> list[Column]:
    span, before = c["span"], F.lower(c["before"])
    count = lambda pattern: F.length(F.regexp_replace(span, f"[^{pattern}]", ""))
    values = {
        "length": F.length(span),
        "digits": count("0-9"),
        "groups": F.size(F.split(span, "[^0-9]+")),
        "letters": count("A-Za-z"),
        "dots": count("."),
        "spaces": count(" "),
        "dashes": count("-"),
        "brackets": count("()\\[\\]"),
        "plus": count("+"),
        "at": count("@"),
        "joined_before": before.rlike("[a-z0-9._=/-]$").cast("int"),
        "joined_after": F.lower(c["after"]).rlike("^[a-z0-9_=/-]").cast("int"),
        **{name: before.rlike(words).cast("int") for name, words in HINTS.items()},
    }
    return [values[name].cast("double").alias(name) for name in FEATURES]


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with an array of candidates for each kind, base and wide."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kinds = KINDS | WIDE
    docs = docs.select("*", *(_found(F.col("text"), p).alias(f"raw_{k}") for k, p in kinds.items()))
    return docs.select(
        "doc_id",
        *(_placed(F.col("text"), p, F.col(f"raw_{k}")).alias(k) for k, p in kinds.items()),
    )


@dataclass
class Forest:
    """Boosted trees as nested (feature, split, below, above) or leaf values."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, features: list[Column]) -> Column:
        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            at, split, below, above = node
            return F.when(features[at] <= split, walk(below)).otherwise(walk(above))

        margin = F.lit(0.0)
        for weight, tree in zip(self.weights, self.trees, strict=True):
            margin = margin + weight * walk(tree)
        return 1 / (1 + F.exp(-2 * margin))


def _tree(lines: list[str]) -> object:
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return float(line.split(":")[1])
    at, split = re.fullmatch(r"If \(feature (\d+) <= ([-\d.Ee]+)\)", line).groups()
    below = _tree(lines)
    lines.pop(0)  # Else
    return int(at), float(split), below, _tree(lines)


def _grown(rows: DataFrame) -> Forest:
    """Trees fitted to ``rows``, without thresholds."""
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, maxBins=32).fit(rows)
    forest = Forest(weights=[float(w) for w in model.treeWeights])
    for tree in model.trees:
        forest.trees.append(_tree(tree.toDebugString.splitlines()[1:]))
    return forest


def training_rows(docs: DataFrame) -> DataFrame:
    """kind, label, half and features of all base candidates of ``docs``."""
    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda c: F.struct(F.lit(kind).alias("kind"), c.alias("c")))

    found = candidates(docs).select(F.inline(F.concat(*map(tagged, KINDS))))
    label = F.lit(False)
    for kind in KINDS:
        label = F.when(F.col("kind") == kind, _passes(kind, F.col("c.span"))).otherwise(label)
    rows = found.select(
        "kind",
        label.cast("double").alias("label"),
        F.pmod(F.xxhash64("c.span", "c.before"), F.lit(2)).alias("half"),
        *_features(F.col("c")),
    )
    return rows.where("kind <> 'card' or digits >= 7")


def train(docs: DataFrame) -> Forest:
    """Fit and calibrate on the candidates of all documents."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(training_rows(docs))
    rows = rows.persist()
    try:
        if rows.select("half", "label").distinct().count() < 4:
            return Forest()
        forest = _grown(rows)
        halves = [_grown(rows.where(F.col("half") != k)) for k in (0, 1)]
        first, second = (h.score([F.col(name) for name in FEATURES]) for h in halves)
        score = F.when(F.col("half") == 0, first).otherwise(second)
        group = F.when(F.col("kind") == "email", "contact").otherwise("number")
        bins = rows.groupBy(group.alias("kind"), F.floor(score * 100).alias("bin")).agg(
            F.count("*").alias("n"), F.sum("label").alias("true")
        ).collect()
    finally:
        rows.unpersist()
    for kind in WIDE:
        n = true = 0.0
        for row in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, true = n + row["n"], true + row["true"]
            if true < PRECISION * n:
                break
            forest.thresholds[kind] = row["bin"] / 100
    return forest


def _spelled(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda c: F.concat(F.lit(f"{kind}:"), c["start"].cast("string"), F.lit(":"), c["end"].cast("string")),
    )


def find_personal_data(docs: DataFrame, forest: Forest) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, spans (of all kinds), n_model."""
    found = candidates(docs)

    def checked(kind: str) -> Column:
        return F.filter(kind, lambda c: _passes(kind, c["span"])).alias(kind)

    found = found.select("doc_id", *map(checked, KINDS), *WIDE)
    base = F.flatten(F.array(*(F.col(k) for k in KINDS)))

    def likely(kind: str) -> Column:
        if kind not in forest.thresholds:
            return F.filter(kind, lambda c: F.lit(False)).alias(kind)
        return F.filter(
            kind,
            lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
            & (forest.score(_features(c)) >= forest.thresholds[kind]),
        ).alias(kind)

    found = found.select("doc_id", *KINDS, *map(likely, WIDE))
    spelled = F.concat(*(_spelled(k, F.col(k)) for k in KINDS))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(spelled, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(spelled, *(_spelled(k, F.col(k)) for k in WIDE)), ",").alias("spans"),
        sum((F.size(k) for k in WIDE), F.lit(0)).cast("long").alias("n_model"),
    )


def personal_data(docs: DataFrame) -> DataFrame:
    return find_personal_data(docs, train(docs))
