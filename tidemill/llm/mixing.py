"""Mixing sources by temperature, realised as block permutations under a budget.

Source shares of tokens are raised to an exponent between 1 (as they are) and 0 (all
alike) and normalised. The exponent is found by bisection: the flattest mix whose
entropy or whose repetition of a source stays within its target. Each source is then
read in passes, every pass a new permutation, until its part of the budget is filled,
and cut into blocks that each hold the sources in proportion to the weights.

Everything is built from DataFrame functions. Only sums over sources reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import WORD_BREAK, column, stage

STEPS = 40
STEPS_AT_ONCE = 6
# Permuted rows are summed up by parts first, so no source is one task's work.
PARTS = 1024


@dataclass(frozen=True)
class Target:
    """`entropy`: in nats, reached from below. `repeats`: most passes over any source.

    `budget`: tokens to draw. None draws what takes the least repeated source through
    exactly once, so no document is left out. `block`: tokens of a block.
    """

    repeats: float = 2.0
    entropy: float | None = None
    budget: float | None = None
    block: int = 1 << 20
    seed: int = 42


def word_count(text: Column) -> Column:
    """Words between white space; none for null."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")
    return F.size(words).cast("long")


def source_totals(counted: DataFrame) -> DataFrame:
    """tokens per source; sources without any token take no part in the weights."""
    return counted.groupBy("source").agg(F.sum("tokens").alias("total")).filter("total > 0")


def _states(totals: DataFrame, exponents: list[float], budget: float | None) -> list[dict[str, float]]:
    """Entropy and repetitions of the mix at each exponent, in one pass over the sources."""
    summed = float(totals.agg(F.sum("total")).first()[0])
    tried = F.explode(F.array(*map(F.lit, exponents))).alias("exponent")
    shares = totals.select("total", (F.col("total") / F.lit(summed)).alias("share"), tried)
    raised = F.pow("share", "exponent")
    found = (
        shares.select("exponent", "total", raised.alias("raised"))
        .groupBy("exponent")
        .agg(
            F.sum("raised").alias("z"),
            F.sum(F.col("raised") * F.log("raised")).alias("zlog"),
            F.max(F.col("raised") / F.col("total")).alias("most"),
            F.min(F.col("raised") / F.col("total")).alias("least"),
        )
        .collect()  # a row per exponent
    )

    def state(row) -> dict[str, float]:
        z = row["z"]
        drawn = z / row["least"] if budget is None else budget
        return {
            "z": z,
            "all": summed,
            "budget": drawn,
            "entropy": math.log(z) - row["zlog"] / z,
            "repeats": row["most"] / z * drawn,
        }

    by_exponent = {row["exponent"]: state(row) for row in found}
    return [by_exponent[e] for e in exponents]


def find_exponent(totals: DataFrame, target: Target) -> tuple[float, dict[str, float]]:
    """The smallest exponent in [0, 1] that keeps within the target, and its state.

    Repetition and entropy both fall as the exponent grows. Where even exponent 1 is
    not within the target, 1 is taken.
    """

    def within(state: dict[str, float]) -> bool:
        if target.entropy is not None:
            return state["entropy"] <= target.entropy
        return state["repeats"] <= target.repeats

    low, high = 0.0, 1.0
    at_low, best = _states(totals, [low, high], target.budget)
    if within(at_low):
        return low, at_low
    done = 0
    while done < STEPS:
        # All middles that the next halvings may come to are looked at in one pass.
        halvings = min(STEPS_AT_ONCE, STEPS - done)
        parts = 1 << halvings
        grid = [low + (high - low) * i / parts for i in range(1, parts)]
        states = _states(totals, grid, target.budget)
        a, b = 0, parts
        for _ in range(halvings):
            middle = (a + b) // 2
            if within(states[middle - 1]):
                b, best = middle, states[middle - 1]
            else:
                a = middle
        width = high - low
        low, high = low + width * a / parts, low + width * b / parts
        done += halvings
    return high, best


def weights(totals: DataFrame, target: Target) -> DataFrame:
    """source, total, weight, quota (tokens to draw), block_quota (tokens per block)."""
    if totals.isEmpty():
        nothing = F.lit(None).cast("double")
        return totals.select("source", "total", *(nothing.alias(c) for c in ("weight", "quota", "block_quota")))
    exponent, state = find_exponent(totals, target)
    weight = F.pow(F.col("total") / F.lit(state["all"]), F.lit(exponent)) / F.lit(state["z"])
    return totals.select("source", "total", weight.alias("weight")).select(
        "*",
        (F.col("weight") * state["budget"]).alias("quota"),
        (F.col("weight") * float(target.block)).alias("block_quota"),
    )


def mix(
    docs: DataFrame,
    target: Target = Target(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    digest: Column | None = None,
) -> DataFrame:
    """One row per drawn copy of a document.

    doc_id, digest, source, pass (from 0), tokens, start (tokens of its source drawn
    before it), block and position (place in the block). A document is drawn if its
    first token lies within the quota of its source. Null texts hold no tokens; a
    source of such texts alone is read once. Null is a source of its own. Equal hash
    values are ordered by id, digest and tokens; repeated rows are drawn as rows.
    """
    counted = stage(
        docs.select(
            column(doc_id).alias("doc_id"),
            (digest if digest is not None else F.lit(0).cast("long")).alias("digest"),
            column(source).alias("source"),
            word_count(column(text)).alias("tokens"),
        ),
        "counts",
    )
    totals = stage(source_totals(counted), "totals")
    share = stage(weights(totals, target), "weights")

    same = lambda a, b: a.eqNullSafe(b)
    w = share.select(F.col("source").alias("of"), "total", "quota", "block_quota")
    passes = F.when(F.col("total").isNull(), F.lit(1)).otherwise(
        F.ceil(F.col("quota") / F.col("total") - 1e-9).cast("int")
    )
    drawn = (
        counted.join(w, same(F.col("source"), F.col("of")), "left")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(passes, F.lit(1)) - 1)))
        .withColumn("order", F.xxhash64(F.lit(target.seed), "pass", "doc_id", "digest"))
        .withColumn("part", F.shiftrightunsigned("order", 64 - PARTS.bit_length() + 1).cast("int"))
    )
    sums = drawn.groupBy("source", "pass", "part").agg(F.sum("tokens").alias("tokens"))
    ahead = Window.partitionBy("source").orderBy("pass", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("b_source"),
        F.col("pass").alias("b_pass"),
        F.col("part").alias("b_part"),
        F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base"),
    )
    unsigned = F.col("order").bitwiseXOR(F.lit(-(1 << 63)))
    within = (
        Window.partitionBy("source", "pass", "part")
        .orderBy(unsigned, "doc_id", "digest", "tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Passes that the quota covers are kept whole, rounding aside.
    whole = F.col("quota").isNull() | (
        (F.col("pass") + 1) * F.col("total") <= F.col("quota") * (1 + 1e-9)
    )
    placed = (
        drawn.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        .join(
            bases,
            same(F.col("source"), F.col("b_source"))
            & (F.col("pass") == F.col("b_pass"))
            & (F.col("part") == F.col("b_part")),
        )
        .withColumn("start", F.col("base") + F.col("inside"))
        .filter(whole | (F.col("start") < F.col("quota") - 1e-6))
        .withColumn("block", F.coalesce(F.floor(F.col("start") / F.col("block_quota")), F.lit(0)))
    )
    shuffled = Window.partitionBy("block", "lane").orderBy("order", "source", "doc_id", "digest", "start")
    lanes = placed.withColumn("lane", F.shiftrightunsigned("order", 58).cast("int"))
    sizes = lanes.groupBy("block", "lane").agg(F.count("*").alias("n"))
    sizes = sizes.select(
        F.col("block").alias("l_block"),
        F.col("lane").alias("l_lane"),
        F.coalesce(
            F.sum("n").over(Window.partitionBy("block").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("lane_base"),
    )
    return (
        lanes.withColumn("nth", F.row_number().over(shuffled))
        .join(sizes, (F.col("block") == F.col("l_block")) & (F.col("lane") == F.col("l_lane")))
        .select(
            F.col("doc_id").alias(doc_id),
            "digest",
            F.col("source").alias(source),
            "pass",
            "tokens",
            "start",
            F.col("block").cast("long").alias("block"),
            (F.col("lane_base") + F.col("nth") - 1).cast("long").alias("position"),
        )
    )
