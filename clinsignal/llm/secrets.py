"""Secret scan: fixed patterns, plus random-looking strings by character models.

Two first-order character Markov models are trained from labelled samples --
random strings (digests of sampled ids, and the values the fixed patterns
found in the sampled texts) and ordinary identifiers (the words of the same
texts, as they are, upper-cased, and joined in pairs as CamelCase and
snake_case) -- and a candidate string is a secret when
its log-likelihood ratio per character and in total exceeds two thresholds.
Training reads at most about ``sample_docs`` documents, chosen by hash; the
trained table has one entry per character pair.  Every text is scanned whole,
with native expressions only; nothing is shuffled but the bigram counts.

Defined results: a null text counts as empty; strings of digits alone are no
candidates; model spans that overlap a pattern span are not reported; repeated
rows give repeated results; without training rows the ratio is 0 and the
patterns alone report; an empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.llm.common import let, match_spans, span_text

# The patterns every scan reports, in the order of their kinds.
# (?i) folds ASCII letters only.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more
HEX = r"[0-9a-f]{24,}"
# runs end at an equals sign, but for the padding of base64
CANDIDATE = r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}={0,2}"
ORDINARY = r"[A-Za-z0-9_]{4,}"

SAMPLE_DOCS = 500
MIN_PER_CHAR = 0.5  # nats per character
MIN_TOTAL = 12.0  # nats in all
SMOOTHING = 0.5
ALPHABET = 66  # letters, digits, _+/= and -, give or take: only scales the smoothing


def base_spans(text: Column) -> dict[str, Column]:
    assign = F.filter(
        match_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_MIN
    )
    return {
        "assign": assign,
        "access": match_spans(text, ACCESS, text.contains("AKIA")),
        "hex": match_spans(text, HEX),
    }


def bigrams(samples: DataFrame, column: str) -> DataFrame:
    """Counts of character pairs (start is code 0) of the strings in an array column."""
    chars = F.split(F.col("_s"), "")
    pairs = F.transform(
        F.array(F.concat(F.array(F.lit("\0")), chars)),
        lambda c: F.zip_with(
            F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1),
            lambda a, b: F.ascii(a) * 128 + F.ascii(b),
        ),
    )[0]
    return (
        samples.select(F.explode(column).alias("_s"))
        .select(F.explode(pairs).alias("pair"))
        .where("pair < 16384")
        .groupBy("pair")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratio random / ordinary per character pair (128 * previous + next)."""
    total = docs.select(id_col).count()
    part = F.pmod(F.xxhash64(F.lit("secrets"), F.col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.where(part < F.lit(min(1.0, sample_docs / max(total, 1)))).select(
        F.col(id_col).cast("string").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    )
    found = base_spans(F.col("t"))
    values = F.concat(
        F.transform(found["assign"], lambda s: F.regexp_extract(s["match"], ASSIGN, 2)),
        F.transform(F.concat(found["access"], found["hex"]), lambda s: s["match"]),
    )
    digest = F.sha2(F.coalesce(F.col("k"), F.lit("")), 256)
    mixed = F.base64(F.unhex(digest))
    digests = F.array(digest, mixed, F.upper(F.reverse(mixed)))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = F.filter(F.regexp_extract_all(plain, F.lit(ORDINARY), F.lit(0)), lambda w: w.rlike("[A-Za-z]"))
    after = F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1)))
    ordinary = F.concat(
        "w",
        F.zip_with("w", after, lambda a, b: F.concat_ws("/", a, b)),
        F.transform("w", lambda w: F.upper(w)),
        F.zip_with("w", after, lambda a, b: F.concat(F.initcap(a), F.initcap(F.coalesce(b, F.lit(""))))),
        F.zip_with("w", after, lambda a, b: F.concat_ws("_", a, b)),
    )
    # no more than 128 * 128 pairs of each come back
    counts = {
        name: {r["pair"]: r["n"] for r in bigrams(strings, "s").collect()}
        for name, strings in (
            ("random", sample.select(F.concat(values, digests).alias("s"))),
            ("ordinary", sample.select(words.alias("w")).select(ordinary.alias("s"))),
        )
    }
    return ratio_table(counts["random"], counts["ordinary"])


def ratio_table(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    import math

    def logs(counts):
        rows = [0] * 128
        for pair, n in counts.items():
            rows[pair // 128] += n
        return [
            math.log((counts.get(p, 0) + SMOOTHING) / (rows[p // 128] + SMOOTHING * ALPHABET)) for p in range(128 * 128)
        ]

    if not random or not ordinary:
        return [0.0] * (128 * 128)
    return [round(a - b, 6) for a, b in zip(logs(random), logs(ordinary))]


def log_ratio(string: Column, ratios: Column) -> Column:
    """Sum of the pair ratios along a string of ASCII characters."""
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        F.split(string, ""),
        start,
        lambda acc, c: F.struct(
            F.ascii(c).alias("last"), (acc["sum"] + F.get(ratios, acc["last"] * 128 + F.ascii(c))).alias("sum")
        ),
        lambda acc: acc["sum"],
    )


HALVINGS = 31  # of an array's indices


def overlaps(spans: Column, s: Column) -> Column:
    """Does a span meet one of an array of disjoint spans in text order?  By halving:
    the first of them that ends after the span's start is the only one to look at."""

    def halve(x, _):
        middle = F.shiftright(x["low"] + x["high"], 1)
        past = F.get(spans, middle)["end"] <= s["start"]
        moved = F.when(past, F.struct((middle + 1).alias("low"), x["high"].alias("high"))).otherwise(
            F.struct(x["low"].alias("low"), middle.alias("high"))
        )
        return F.when(x["low"] < x["high"], moved).otherwise(x)

    ends = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    steps = F.sequence(F.lit(1), F.least(F.lit(HALVINGS), F.ceil(F.log2(F.size(spans) + 1.0)).cast("int") + 1))
    first = F.aggregate(steps, ends, halve, lambda x: x["low"])
    return F.when(F.size(spans) > 0, F.coalesce(F.get(spans, first)["start"] < s["end"], F.lit(False))).otherwise(F.lit(False))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ratios: list[float] | None = None,
    min_per_char: float = MIN_PER_CHAR,
    min_total: float = MIN_TOTAL,
) -> DataFrame:
    """One row per document: id, and arrays of spans assign, access, hex, random."""
    ratios = ratios if ratios is not None else train(docs, id_col, text_col)
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("_id"),
        *[c.alias(k) for k, c in base_spans(text).items()],
        F.filter(
            match_spans(text, CANDIDATE),
            lambda s: s["match"].rlike("[A-Za-z]"),
        ).alias("candidates"),
    )

    def is_random(s):
        # words joined by slashes are a path unless they mix cases and digits
        mixed = s["match"].rlike("[a-z]") & s["match"].rlike("[A-Z]") & s["match"].rlike("[0-9]")
        return F.when(s["match"].contains("/") & ~mixed, F.lit(False)).otherwise(
            let(
                log_ratio(s["match"], table),
                lambda score: (score >= min_total) & (score >= min_per_char * F.length(s["match"])),
            )
        )

    clear = F.filter(
        "candidates", lambda s: ~(overlaps(F.col("assign"), s) | overlaps(F.col("access"), s) | overlaps(F.col("hex"), s))
    )
    return base.select(
        F.col("_id").alias(id_col), "assign", "access", "hex", F.filter(clear, is_random).alias("random")
    )


def joined_spans(kinds: list[str]) -> Column:
    """kind:start:end by start, then kind in the order given, comma-joined."""
    def tag(rank: int, kind: str) -> Column:
        return F.transform(
            F.col(kind),
            lambda s: F.struct(
                s["start"].alias("at"), F.lit(rank).alias("rank"), s["end"].alias("to"), span_text(kind, s).alias("t")
            ),
        )

    tagged = F.concat(*[tag(i, k) for i, k in enumerate(kinds)])
    return F.concat_ws(",", F.transform(F.array_sort(tagged), lambda s: s["t"]))
