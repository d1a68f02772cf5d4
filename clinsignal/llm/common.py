"""Helpers shared by the operators of this subpackage.

Inputs are read as plain frames; every operator selects the columns it needs
under names of its own first, so extra or clashing columns of the input never
meet its working columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinsignal.session import scratch_path

# Share of all rows above which a group is split over several tasks.  At most
# HOT_GROUPS groups can be larger than that, so their list is always small.
HOT_GROUPS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors and is computed once.  Returns (frame, path)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def text_key(col: Column) -> Column:
    """A non-null string per value (null gets a value of its own)."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("null"))


def salted(rows: DataFrame, keys: list[str], spread: Column, total: int, salt: str = "salt") -> DataFrame:
    """Add a ``salt`` that splits groups holding more than 1 / HOT_GROUPS of the rows.

    Groups are counted with map-side aggregation; fewer than HOT_GROUPS groups
    can be that large, so the joined list of hot groups has a proven bound and
    is broadcast.  ``spread`` is a hash that differs between the rows of a group.
    """
    limit = max(1, total // HOT_GROUPS)
    hot = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > limit)
        .withColumn("_salts", F.ceil(F.col("_n") / F.lit(limit)).cast("bigint"))
        .drop("_n")
    )
    return (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn(salt, F.coalesce(F.pmod(spread, F.col("_salts")), F.lit(0).cast("bigint")).cast("int"))
        .drop("_salts")
    )


SPAN = "struct<start:int,end:int,match:string,left:string>"


STEP = 128


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def running_sums(values: Column, short: bool = False) -> Column:
    """Exclusive running sums of an array<int>, in linear time up to STEP ** 3 entries.

    Sums of blocks, and of blocks of blocks, keep every single sum below STEP
    terms.  ``short`` is the plain form for arrays of a few entries.
    """

    def plain(x):
        return F.transform(x, lambda _, i: total(F.slice(x, F.lit(1), i)))

    def block_sums(x):
        blocks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / STEP).cast("int"))
        return F.transform(blocks, lambda b: total(F.slice(x, b * STEP + 1, F.lit(STEP))))

    def within(x, starts):
        def one(_, i):
            block = F.floor(i / STEP).cast("int")
            return F.get(starts, block) + total(F.slice(x, block * STEP + 1, i - block * STEP))

        return F.transform(x, one)

    if short:
        return let(values, plain)

    def three_levels(x):
        def two_levels(s1):
            return let(block_sums(s1), lambda s2: within(s1, plain(s2)))

        return let(let(block_sums(x), two_levels), lambda starts: within(x, starts))

    return let(values, three_levels)


def match_spans(text: Column, pattern: str, maybe: Column | None = None, tail: bool = False, short: bool = False) -> Column:
    """All leftmost non-overlapping matches of a Java pattern, with positions.

    ``array<struct<start, end, match, left>>`` in text order; positions count
    code points from 0, end exclusive; ``left`` is the text between the
    previous match and this one.  Built from the matches and the pieces between
    them, so it stays native.  ``maybe`` is a cheap necessary condition that
    saves the regex pass.  With ``tail`` a last element without match holds the
    text after the last match.  ``short`` is for texts of a few matches.
    """
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda left, match: F.struct(left.alias("left"), match.alias("match"), F.length(left).alias("gap")),
    )

    def placed(p):
        sizes = F.transform(p, lambda x: x["gap"] + F.coalesce(F.length(x["match"]), F.lit(0)))

        def span(x, before):
            start = before + x["gap"]
            end = start + F.coalesce(F.length(x["match"]), F.lit(0))
            return F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["left"].alias("left"))

        return F.zip_with(p, running_sums(sizes, short), span)

    found = let(pieces, placed)
    if not tail:
        found = F.filter(found, lambda s: s["match"].isNotNull())
    hit = text.rlike(pattern)
    if maybe is not None:
        hit = maybe & hit
    return F.when(hit, found).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def span_text(kind: str, span: Column) -> Column:
    return F.concat_ws(":", F.lit(kind), span["start"].cast("string"), span["end"].cast("string"))
