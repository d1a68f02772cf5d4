"""Feature tables: whitelist, coercion, labels, serving alignment, split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.functions.numeric import coerce_bigint, fill_cast_bigint
from clinsignal.schemas import FEATURES, TARGET

# Label threshold (strict >) on systolic pressure, split seed
# and test share.
LABEL_THRESHOLD = 140
SPLIT_SEED = 42
TEST_FRACTION = 0.2


def select_features(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET, keep: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """Keep the whitelisted columns that exist (plus the target if present).

    Returns the projected frame and the list of features found.  The column
    check is on the schema (driver side, no data); the projection reaches the
    scan as a pruned read schema.
    """
    present = set(df.columns)
    available = [c for c in features if c in present]
    cols = list(keep) + available + ([target] if target in present else [])
    return df.select(*cols), available


def coerce_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Unparsable -> 0 -> int64, for each listed column."""
    return df.withColumns({c: coerce_bigint(c) for c in columns})


def hash_coin(key: Column | str, seed: int) -> Column:
    """Repeatable fair coin from a seeded hash of the key (0 / 1)."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))) < F.lit("8")).cast("int")


def add_label(
    df: DataFrame,
    target: str = TARGET,
    threshold_col: str = "systolic_bp",
    threshold: int = LABEL_THRESHOLD,
    key: str = "event_id",
    seed: int = SPLIT_SEED,
    out_col: str = "label",
) -> DataFrame:
    """Existing target (null -> 0), else ``threshold_col > threshold``, else a seeded coin."""
    present = set(df.columns)
    if target in present:
        label = F.coalesce(F.col(target).cast("int"), F.lit(0))
    elif threshold_col in present:
        label = (F.col(threshold_col) > threshold).cast("int")
    else:
        label = hash_coin(key, seed)
    return df.withColumn(out_col, label.cast("int"))


def training_frame(gold: DataFrame, keep: list[str] = ("event_id",)) -> tuple[DataFrame, list[str]]:
    """Gold -> (key, int64 features, int label): whitelist, coerce, label."""
    selected, available = select_features(gold, keep=list(keep))
    coerced = coerce_features(selected, available)
    labelled = add_label(coerced)
    return labelled.drop(TARGET) if TARGET in labelled.columns else labelled, available


def align_features(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Serving-side: null / NaN -> 0, truncating cast to int64."""
    return df.withColumns({c: fill_cast_bigint(c) for c in columns})


def pack_features(columns: list[str] = FEATURES, name: str = "features") -> Column:
    return F.struct(*columns).alias(name)


def indicator_features(df: DataFrame) -> DataFrame:
    """v1 contract: BPs as double plus two one-hot code indicators."""
    return df.select(
        *[c for c in df.columns if c not in FEATURES],
        F.col("systolic_bp").cast("double").alias("systolic_bp"),
        F.col("diastolic_bp").cast("double").alias("diastolic_bp"),
        (F.col("rxnorm_id").cast("string") == "17767").cast("int").alias("rxnorm_17767_amlodipine"),
        (F.col("snomed_code").cast("string") == "709044004").cast("int").alias("snomed_709044004_kidney_injury"),
    )


# The split orders rows by this many hex digits of a seeded hash, then by key.
HASH_DIGITS = 15
RANGE_BITS = 12  # a pass counts the rows of so many equal hash ranges, as a power of two
FETCHED = 4096  # keys of one range that are ordered at the driver


def split_hash(key: Column, seed: int) -> Column:
    """60-bit number of a key; rows without a key share one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def split_bound(df: DataFrame, key: str, seed: int, share: float) -> tuple[int, str] | None:
    """(hash, key) of the last row of the first ceil(share * n), found without sorting.

    Each pass counts rows per hash range (map-side; at most 2^RANGE_BITS counts)
    and goes on in the one range that holds the wanted row; the keys of the last,
    small range are put in order.  Rows of one key are never parted, so more rows
    than wanted are taken only if the key at the bound repeats.
    """
    rows = df.select(split_hash(F.col(key), seed).alias("h"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"))
    low, width, wanted = 0, 16**HASH_DIGITS, None
    while True:
        step = max(1, width >> RANGE_BITS)
        inside = rows.where((F.col("h") >= low) & (F.col("h") < low + width))
        counts = inside.groupBy(F.shiftright(F.col("h") - low, step.bit_length() - 1).alias("r")).count().collect()
        if wanted is None:
            wanted = math.ceil(share * sum(r["count"] for r in counts))
            if wanted == 0:
                return None
        for r in sorted(counts, key=lambda r: r["r"]):
            if r["count"] >= wanted:
                break
            wanted -= r["count"]
        low, width = low + r["r"] * step, step
        if r["count"] <= FETCHED or width == 1:
            break
    last = rows.where((F.col("h") >= low) & (F.col("h") < low + width)).groupBy("h", "k").count().orderBy("h", "k")
    for r in last.toLocalIterator():
        wanted -= r["count"]
        if wanted <= 0:
            return r["h"], r["k"]
    raise AssertionError("rows changed between passes")


def split(df: DataFrame, key: str = "event_id", seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly ceil(test_fraction * n) test rows for distinct keys.

    Depends on seed and keys only: stable under repartitioning and retries.
    """
    bound = split_bound(df, key, seed, test_fraction)
    if bound is None:
        return df, df.where(F.lit(False))
    h, k = split_hash(F.col(key), seed), F.coalesce(F.col(key).cast("string"), F.lit(""))
    test = (h < bound[0]) | ((h == bound[0]) & (k <= bound[1]))
    return df.where(~test), df.where(test)
