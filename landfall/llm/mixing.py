"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic). The cells' weights are raked:
scaled to the target shares of the sources, of the languages, of the topics, and
again, until no scaling changes anything; where cells are so few that no weights meet
all targets, or only after more rounds, that is after `MOST_ROUNDS` rounds, with the
topics' targets met, and a warning says how far each margin's shares are off. A document is then sampled with a
probability in proportion to its cell's weight per token, calibrated so that the
expected number of sampled tokens is the budget; a probability is never above 1.
Whether a document is in follows from its id alone, so a rerun draws the same ones.

The targets are the natural shares to a power below 1, brought to a sum of 1: rare
values gain, frequent ones lose.

All of it is DataFrame operations. Rounds work on the cells, cut off by checkpoint();
per round a single number comes to the driver.

Edge cases: a NULL source, language or text counts as empty; every text has one
token more than words, so an empty text has one. A NULL id is replaced by the text
when drawing. Repeated rows are drawn alike. An empty table gives an empty result.
Other columns are never looked at, and stay as they are in `sample_documents`.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import use_checkpoints
from .common import saved, text_of

MARGINS = ("source", "lang", "topic")
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
# Share of all tokens to sample.
SHARE = 0.6
TOLERANCE = 1e-10
MOST_ROUNDS = 40
WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column) -> Column:
    """A coarse topic by marks in the text, the first that holds."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(F.contains(text, F.lit("icense")), "licence")
        .otherwise("prose")
    )


def draw(doc_id: Column, text: Column) -> Column:
    """An even number from 0 to 1 for each document, by its id."""
    key = F.md5(F.coalesce(doc_id.cast("string"), text).cast("binary"))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def measured(documents: DataFrame) -> DataFrame:
    """Id, margins, tokens and draw of each document."""
    text = text_of()
    return documents.select(
        "doc_id",
        text_of("source").alias("source"),
        text_of("lang").alias("lang"),
        topic(text).alias("topic"),
        (F.regexp_count(text, F.lit(WORD)) + 1).cast("long").alias("n_tokens"),
        draw(F.col("doc_id"), text).alias("draw"),
    )


def targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """The sum of each value of a margin raised to a power; shares of these are the targets."""
    return cells.groupBy(margin).agg(F.pow(F.sum("n"), F.lit(power)).alias(f"goal_{margin}"))


def rake(cells: DataFrame, powers: Mapping[str, float] = POWERS) -> DataFrame:
    """Cells (margins, `n` tokens) with `weight`, whose sums over each margin are its targets.

    Each scaling is a plan of its own, cut off by a checkpoint: one aggregation by the
    margin and a join of its sums.
    """
    use_checkpoints(cells.sparkSession)
    current = cells.withColumn("weight", F.col("n").cast("double")).withColumn("off", F.lit(0.0))
    wholes = {}
    for margin, power in powers.items():
        goals = targets(cells, margin, power)
        current = current.join(goals, margin)
        wholes[margin] = goals.agg(F.sum(f"goal_{margin}")).first()[0]
    current = current.checkpoint()
    for _ in range(MOST_ROUNDS):
        current = current.withColumn("off", F.lit(0.0))
        for margin in powers:
            sums = current.groupBy(margin).agg(F.sum("weight").alias("sum"))
            scale = F.col(f"goal_{margin}") / F.lit(wholes[margin]) / F.col("sum")
            scaled = current.join(sums, margin).select(
                *(c for c in current.columns if c not in ("weight", "off")),
                (F.col("weight") * scale).alias("weight"),
                F.greatest("off", F.abs(scale - 1)).alias("off"),
            )
            current = scaled.checkpoint()
        off = current.agg(F.max("off")).first()[0]
        if off is None or off < TOLERANCE:
            return current.select(*powers, "n", "weight")
    raked = current.select(*powers, "n", "weight")
    missed = ", ".join(f"{margin} {off:.2g}" for margin, off in deviations(raked, powers).items())
    warnings.warn(f"targets not met after {MOST_ROUNDS} rounds, shares are off by: {missed}", NotMet, stacklevel=2)
    return raked


class NotMet(UserWarning):
    """Raked weights whose sums are not the targets."""


def deviations(raked: DataFrame, powers: Mapping[str, float] = POWERS) -> dict[str, float]:
    """For each margin how far the share of a value is from its target at most."""
    out = {}
    for margin, power in powers.items():
        shares = raked.groupBy(margin).agg(F.sum("weight").alias("weight")).join(targets(raked, margin, power), margin)
        whole = shares.agg(F.sum("weight").alias("weight"), F.sum(f"goal_{margin}").alias("goal")).first()
        if whole["weight"]:
            off = F.abs(F.col("weight") / whole["weight"] - F.col(f"goal_{margin}") / whole["goal"])
            out[margin] = shares.agg(F.max(off)).first()[0]
    return out


def calibrate(raked: DataFrame, share: float = SHARE) -> DataFrame:
    """Raked cells with `probability`: the expected tokens are `share` of all.

    Cells whose probability would exceed 1 are taken whole and the others raised in
    turn, until no more cell gets there.
    """
    total = raked.agg(F.sum("n"), F.sum("weight")).first()
    budget = share * (total[0] or 0)
    per_token = F.col("weight") / F.col("n")
    scale = budget / (total[1] or 1.0)
    while True:
        whole = per_token * scale >= 1
        row = raked.agg(
            F.sum(F.when(whole, F.col("n"))).alias("n"),
            F.sum(F.when(~whole, F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            break
        better = (budget - (row["n"] or 0)) / row["weight"]
        if better <= scale * (1 + 1e-12):
            break
        scale = better
    return raked.withColumn("probability", F.least(F.lit(1.0), per_token * F.lit(scale)))


def mixing_cells(documents: DataFrame, share: float = SHARE) -> DataFrame:
    """Weights and probabilities of the cells of measured documents."""
    cells = documents.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n"))
    return calibrate(rake(saved(cells, "cells")), share)


def mix(documents: DataFrame, share: float = SHARE) -> DataFrame:
    """Every document with its margins, tokens, raked share, probability and whether it is in."""
    known = saved(measured(documents), "measured")
    cells = saved(mixing_cells(known, share), "mixing")
    return known.join(cells, list(MARGINS)).select(
        "doc_id",
        *MARGINS,
        "n_tokens",
        F.round("weight", 6).alias("cell_weight"),
        F.round("probability", 6).alias("probability"),
        (F.col("draw") < F.col("probability")).alias("sampled"),
    )


def sample_documents(documents: DataFrame, share: float = SHARE) -> DataFrame:
    """The sampled documents, with all their columns as they were."""
    cells = saved(mixing_cells(saved(measured(documents), "measured"), share), "mixing")
    text = text_of()
    keyed = documents.select(
        F.struct("*").alias("document"),
        text_of("source").alias("source"),
        text_of("lang").alias("lang"),
        topic(text).alias("topic"),
        draw(F.col("doc_id"), text).alias("draw"),
    )
    drawn = keyed.join(cells, list(MARGINS)).filter("draw < probability")
    return drawn.select("document.*")
