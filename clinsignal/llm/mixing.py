"""Mixing sources to target token weights by entropy balancing.

Every source gets a token target.  Among all ways to reweight its documents so
that the expected tokens equal the target, entropy balancing takes the one of
least relative entropy to "each document once": the rate of a document is
exp(lambda * x), x its size over the source's token-weighted mean size, cut at
``cap`` copies.  The dual is convex with one multiplier per source; its
gradient (tokens taken minus target) and curvature are sums over documents, so
each safeguarded Newton step is one distributed aggregation over the counts
per (source, size) -- documents are read once.  Sums are decimals, so a rerun
gives the same multipliers bit for bit, whatever the order of tasks.

Rates are then rounded to whole copies.  Documents of one source and size have
one rate; going down the sizes, the running sum of rates is rounded, which
gives each size a whole number of copies and leaves an error of about half the
gap between neighbouring sizes.  Inside a size the copies are dealt by rank of
the id's hash.  Sizes that hold many rows are ranked in several tasks.

Everything here is DataFrame expressions; no Python runs on the executors.

Defined results: a null text has size 0 and is taken once as nothing; a null
source is a source of its own and sorts last; a source without words has
target 0; equal rows share size and rate and get copies by rank; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinsignal.llm.common import salted, store, text_key
from clinsignal.session import drop_scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
TOLERANCE = 1e-9
MAX_STEPS = 200  # a bracketed root of doubles needs fewer
EXACT = "decimal(30,9)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of rows."""
    return F.sum(value.cast(EXACT)).cast("double")


def source_targets(cells: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(skey, source_size, mean_size, target): weights in code-point order of the
    sources, the whole corpus shared out, no target above ``cap`` times its source.

    One row per source reaches the two global windows.  Sources are capped in
    order of (cap * size / weight): the one with the least ratio reaches its cap
    first, so one pass over running sums finds the capped set.
    """
    sources = cells.groupBy("skey", "source").agg(
        F.sum(F.col("size") * F.col("n")).cast("bigint").alias("source_size"),
        exact_sum((F.col("size") * F.col("size") * F.col("n")).cast("double")).alias("squares"),
    )
    order = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("w", weight).withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    earlier = W.orderBy(F.col("limit") / F.col("w"), "skey").rowsBetween(W.unboundedPreceding, -1)

    def before(c: str) -> Column:
        return F.coalesce(F.sum(c).over(earlier), F.lit(0.0))

    level = (F.sum("source_size").over(everything) - before("limit")) / (F.sum("w").over(everything) - before("w"))
    capped = weighed.withColumn("full", F.col("limit") <= F.col("w") * level)
    free = F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(everything)
    free_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything)
    return capped.select(
        "skey",
        "source_size",
        (F.col("squares") / F.nullif(F.col("source_size"), F.lit(0))).alias("mean_size"),
        F.when(F.col("full"), F.col("limit")).otherwise(F.col("w") * free / free_w).alias("target"),
    )


def rate(lam: Column, size: Column, mean: Column, cap: float) -> Column:
    """exp(lambda x) cut at cap; a null multiplier stands for "all at the cap"."""
    tilted = F.least(F.lit(float(cap)), F.exp(F.least(F.lit(50.0), lam * size / mean)))
    return F.when(size == 0, 1.0).when(lam.isNull(), F.lit(float(cap))).otherwise(tilted)


def solve(cells: DataFrame, targets: DataFrame, cap: float = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """Newton's method on the dual, all sources at once: targets plus ``lam``."""
    spark = cells.sparkSession
    state = targets.withColumn("full", F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).select(
        "*",
        F.when(~F.col("full"), F.log(F.col("target") / F.col("source_size"))).alias("lam"),
        F.lit(-math.inf).alias("lo"),
        F.lit(math.inf).alias("hi"),
        F.lit(1.0).alias("off"),
    )
    state, path = store(state, "dual")
    for _ in range(MAX_STEPS):
        joined = cells.join(state.where(~F.col("full")), "skey")
        x = F.col("size") / F.col("mean_size")
        r = rate(F.col("lam"), F.col("size"), F.col("mean_size"), cap)
        sums = joined.groupBy("skey").agg(
            exact_sum(F.col("n") * F.col("size") * r).alias("got"),
            exact_sum(F.when(r < cap, F.col("n") * F.col("size") * x * r).otherwise(0.0)).alias("slope"),
        )
        off = F.col("got") / F.col("target") - 1
        lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(off >= 0, F.col("lam")).otherwise(F.col("hi"))
        # Newton on log(tokens), which is nearly linear in lambda
        newton = F.col("lam") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.col("slope")
        inside = newton.isNotNull() & (newton > F.col("lo2")) & (newton < F.col("hi2"))
        away = (
            F.when(F.col("lo2") == -math.inf, F.col("hi2") - 1 - F.abs(F.col("hi2")))
            .when(F.col("hi2") == math.inf, F.col("lo2") + 1 + F.abs(F.col("lo2")))
            .otherwise((F.col("lo2") + F.col("hi2")) / 2)
        )
        stay = (F.abs(F.col("off2")) <= tolerance) | F.col("full")
        moved = (
            state.join(sums, "skey", "left")
            .withColumn("off2", F.coalesce(F.when(F.col("full"), F.lit(0.0)).otherwise(off), F.lit(0.0)))
            .withColumn("lo2", lo)
            .withColumn("hi2", hi)
            .select(
                *targets.columns,
                "full",
                F.when(stay, F.col("lam")).when(inside, newton).otherwise(away).alias("lam"),
                F.col("lo2").alias("lo"),
                F.col("hi2").alias("hi"),
                F.col("off2").alias("off"),
            )
        )
        moved, new_path = store(moved, "dual")
        drop_scratch(spark, path)
        state, path = moved, new_path
        worst = state.agg(F.max(F.abs("off"))).first()[0]
        if worst is None or worst <= tolerance:
            break
    return state.select(*targets.columns, "lam")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, rate, copies."""
    rows, _ = store(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
        .withColumn("skey", text_key(F.col("source")))
        .withColumn("h", F.xxhash64(F.lit("mix"), F.col("id").cast("string"))),
        "mix-sizes",
    )
    cells, _ = store(rows.groupBy("skey", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    solved = solve(cells, source_targets(cells, weights, cap), cap)
    keys = ["skey", "size", "salt"]
    split = salted(rows, ["skey", "size"], F.col("h"), rows.count())
    bins = (
        split.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(solved, "skey")
        .withColumn("rate", rate(F.col("lam"), F.col("size"), F.col("mean_size"), cap))
    )
    wanted = (F.col("n") * F.col("rate")).cast(EXACT)
    # one row per distinct size of a source, plus the salts of hot sizes
    down = W.partitionBy("skey").orderBy(F.col("size").desc(), "salt")
    upto = F.sum(wanted).over(down.rowsBetween(W.unboundedPreceding, 0))
    half = F.lit(0.5).cast("decimal(2,1)")
    whole = F.floor(upto + half)
    bins = bins.withColumn("whole", whole).withColumn(
        "dealt", F.col("whole") - F.coalesce(F.lag("whole").over(down), F.lit(0))
    )
    # sizes without words take each document once, whatever the running sum says
    dealt = F.when(F.col("size") == 0, F.col("n")).otherwise(F.least(F.col("dealt"), F.lit(cap) * F.col("n"))).cast("bigint")
    bins = bins.select(*keys, "source_size", "target", "rate", "n", dealt.alias("dealt"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("h", "id")) - 1
    ranked = split.withColumn("rank", rank).join(bins, keys)
    copies = F.expr("dealt div n") + F.when(F.col("rank") < F.col("dealt") % F.col("n"), 1).otherwise(0)
    return ranked.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        F.col("size").cast("bigint").alias("size"),
        "source_size",
        "target",
        "rate",
        copies.cast("int").alias("copies"),
    )
