"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic; a cell's size is its tokens. The
tokens are raked: again and again each margin (sources, then languages, then topics) is scaled
to its target shares, until all three hold. A cell's weight is what a token in it counts for
then.

``draw`` takes documents at random: the expected number of copies of a document is the kept
share of all tokens times the weight of its cell. Documents of cells that count more than once
are repeated, so the tokens drawn have the target shares in all three margins and are the kept
share of all, both in expectation. Targets that no weights meet (a source with one language
whose target is larger) are reported as a warning.

``weigh`` is the draw without repeats, as its SQL has it: probabilities are proportional to the
weights, calibrated to the kept share, but stop at 1, and the rest is spread over the other
cells. Where they stop the tokens sampled miss the targets; it doesn't replace ``draw``.

Cells are named by the targets: values without a target, null ones too, are one value
``other``. So the table of cells is bounded by the targets, however many documents there are;
it is summed up in Spark, raked on the driver and broadcast. Documents aren't moved.

Targets of values that don't occur are left out and the others scaled up. Null text has no
tokens. The draw depends on ``doc_id`` and the seed alone: repeated ids fare alike, and so do
rows with a null id. Columns that have the name of an added one are replaced, others stay."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
ROUNDS = 40
# A draw is raked until no margin is off by more, or a limit of rounds is reached.
TOLERANCE, MOST_ROUNDS = 1e-9, 4000
KEEP = 0.5
WORD = r"[^\x20\x09-\x0D]+"
ADDED = (
    "n_tokens", "source_group", "lang_group", "topic", "weight", "keep_probability", "sampled",
)
DRAWN = ("expected_copies", "copy")
TOPICS = ("table", "license", "noisy", "long", "short", "prose")


@dataclass(frozen=True)
class Targets:
    """Shares of tokens by margin; each margin needs a share for ``other``."""

    source: dict[str, float] = field(
        default_factory=lambda: {f"src{k}": 0.0475 for k in range(20)} | {OTHER: 0.05}
    )
    lang: dict[str, float] = field(
        default_factory=lambda: {"en": 0.5, "de": 0.15, "fr": 0.15, "es": 0.15, OTHER: 0.05}
    )
    topic: dict[str, float] = field(
        default_factory=lambda: {
            "prose": 0.35, "long": 0.4, "short": 0.05, "table": 0.1, "license": 0.05,
            "noisy": 0.05, OTHER: 0.0,
        }
    )

    def margins(self) -> dict[str, dict[str, float]]:
        return {"source": self.source, "lang": self.lang, "topic": self.topic}


def tokens() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def topic(n_tokens: Column) -> Column:
    """What kind of text it is, by its form; the first that holds."""
    text = F.coalesce("text", F.lit(""))
    return (
        F.when(F.instr(text, " | ") > 0, TOPICS[0])
        .when((F.instr(text, "License") > 0) | (F.instr(text, "Copyright") > 0), TOPICS[1])
        .when(text.rlike(r"[#$%&*]{3}"), TOPICS[2])
        .when(n_tokens >= 600, TOPICS[3])
        .when(n_tokens < 60, TOPICS[4])
        .otherwise(TOPICS[5])
    )


def _named(value: Column, targets: dict[str, float]) -> Column:
    return F.when(value.isin([k for k in targets if k != OTHER]), value).otherwise(F.lit(OTHER))


def rake(shares: list[np.ndarray], cells: list[np.ndarray], size: np.ndarray, rounds: int = ROUNDS):
    """Sizes of cells scaled to the margins: ``cells[m]`` numbers each cell's value in margin
    m, ``shares[m]`` are that margin's targets. The result sums to 1."""
    fitted = size / size.sum()
    for _ in range(rounds):
        for share, cell in zip(shares, cells, strict=True):
            now = np.bincount(cell, fitted, len(share))
            goal = np.where(now > 0, share, 0)
            goal = goal / goal.sum()
            fitted = fitted * np.where(now > 0, goal / np.where(now > 0, now, 1), 0)[cell]
    return fitted


def calibrate(weight: np.ndarray, size: np.ndarray, keep: float, rounds: int = ROUNDS) -> np.ndarray:
    """Probabilities in proportion to ``weight``, at most 1, that keep a share of ``size``."""
    scale = keep
    for _ in range(rounds):
        kept = (size * np.minimum(1, scale * weight)).sum() / size.sum()
        scale = scale * keep / kept if kept > 0 else scale
    return np.minimum(1, scale * weight)


def misses(shares: list[np.ndarray], cells: list[np.ndarray], fitted: np.ndarray) -> list[np.ndarray]:
    """By margin, what each value's share of ``fitted`` is over its target; values without a
    cell are left out of the targets."""
    out = []
    for share, cell in zip(shares, cells, strict=True):
        goal = np.where(np.bincount(cell, minlength=len(share)) > 0, share, 0)
        out.append(np.bincount(cell, fitted, len(share)) / fitted.sum() - goal / goal.sum())
    return out


def _cells(docs: DataFrame, targets: Targets):
    """``docs`` with the values of the margins, the names of those, and by cell its row, size
    and number in each margin, with the targets."""
    margins = targets.margins()
    n = F.col("n_tokens")
    rows = docs.drop(*ADDED, *DRAWN).withColumn("n_tokens", tokens())
    rows = rows.withColumns(
        {
            "source_group": _named(F.col("source"), targets.source),
            "lang_group": _named(F.col("lang"), targets.lang),
            "topic": _named(topic(n), targets.topic),
        }
    )
    names = ["source_group", "lang_group", "topic"]
    found = rows.groupBy(names).agg(F.sum("n_tokens").alias("size")).orderBy(names).collect()
    size = np.array([r["size"] for r in found], float)
    shares = [np.array(list(t.values())) for t in margins.values()]
    cells = [
        np.array([list(t).index(r[name]) for r in found], int)
        for name, t in zip(names, margins.values(), strict=True)
    ]
    return rows, names, found, size, shares, cells


def _draw(seed: int) -> Column:
    """A number from 0 to 1 by ``doc_id``."""
    return F.conv(
        F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10
    ).cast("double") / float(1 << 32)


def draw(docs: DataFrame, targets: Targets, keep: float = KEEP, seed: int = 0) -> DataFrame:
    """The documents drawn, each as often as it was: ``docs`` with n_tokens, source_group,
    lang_group, topic, weight, expected_copies and copy, the number of the copy from 0."""
    rows, names, found, size, shares, cells = _cells(docs, targets)
    weight = np.ones(len(found))
    there = size > 0
    if there.any():
        fitted, inside = size[there], [cell[there] for cell in cells]
        for _ in range(0, MOST_ROUNDS, ROUNDS):
            fitted = rake(shares, inside, fitted)
            off = misses(shares, inside, fitted)
            if max(np.abs(x).max() for x in off) <= TOLERANCE:
                break
        else:
            missed = ", ".join(
                f"{name} {value} {x:+.4f}"
                for name, target, margin in zip(names, targets.margins().values(), off, strict=True)
                for value, x in zip(target, margin, strict=True)
                if abs(x) > TOLERANCE
            )
            warnings.warn(f"no weights meet these targets, shares over them: {missed}", stacklevel=2)
        weight[there] = fitted / size[there] * size.sum()
    table = [(*(r[k] for k in names), float(w), float(w * keep)) for r, w in zip(found, weight, strict=True)]
    kind = "source_group string, lang_group string, topic string, weight double, expected_copies double"
    more = F.col("expected_copies")
    copies = (F.floor(more) + (_draw(seed) < more - F.floor(more)).cast("long")).cast("int")
    # At most one row per combination of targets.
    rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame(table, kind)), names)
    return rows.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1))))


def weigh(docs: DataFrame, targets: Targets, keep: float = KEEP, seed: int = 0) -> DataFrame:
    """``docs`` with n_tokens, source_group, lang_group, topic, weight, keep_probability and
    sampled."""
    spark = docs.sparkSession
    rows, names, found, size, shares, cells = _cells(docs, targets)
    kind = "source_group string, lang_group string, topic string, weight double, keep_probability double"
    table = []
    if size.sum() > 0:
        fitted = rake(shares, cells, size)
        weight = fitted / np.where(size > 0, size, 1) * size.sum()
        chance = calibrate(weight, size, keep)
        # Cells without tokens take part as if every token counted the same.
        weight, chance = np.where(size > 0, weight, 1.0), np.where(size > 0, chance, keep)
    else:
        weight, chance = np.ones(len(found)), np.full(len(found), keep)
    table = [(*(r[k] for k in names), float(w), float(p)) for r, w, p in zip(found, weight, chance, strict=True)]
    # At most one row per combination of targets.
    return rows.join(F.broadcast(spark.createDataFrame(table, kind)), names).withColumn(
        "sampled", _draw(seed) < F.col("keep_probability")
    )
