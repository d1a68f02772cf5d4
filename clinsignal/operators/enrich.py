"""Silver -> gold: code medication and notes text, carry lineage time.

Two equivalent coders: the native CASE expressions of ``functions.vocab``
(``standardize``), and a table-driven form for long vocabularies
(``code_join`` / ``standardize_by_table``) that codes the rows where they are,
in Arrow batches: nothing is shuffled, a text that repeats within a batch is
coded once, and the rules are broadcast in runs of ``RULES_AT_ONCE``.
"""

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.functions.text import normalize_text
from clinsignal.functions.vocab import (
    RXNORM_DEFAULT,
    RXNORM_RULES,
    SNOMED_DEFAULT,
    SNOMED_RULES,
    required_words,
    rxnorm_code,
    snomed_code,
)

# Rules per broadcast; a longer list is applied run after run, in priority order.
RULES_AT_ONCE = 100_000


def standardize(silver: DataFrame) -> DataFrame:
    """Gold = silver + rxnorm_id + snomed_code + enriched_at (= ingested_at).

    Pure projection: no shuffle, one codegen stage.
    """
    return silver.select(
        "*",
        rxnorm_code("medication_prescribed").alias("rxnorm_id"),
        snomed_code("clinical_notes").alias("snomed_code"),
        F.col("ingested_at").alias("enriched_at"),
    )


def standardize_by_table(silver: DataFrame) -> DataFrame:
    """Same result as ``standardize`` through broadcast rule tables (long vocabularies)."""
    spark = silver.sparkSession
    out = code_join(
        silver, "medication_prescribed", rules_frame(spark, RXNORM_RULES), "rxnorm_id", RXNORM_DEFAULT
    )
    out = code_join(
        out, "clinical_notes", rules_frame(spark, SNOMED_RULES), "snomed_code", SNOMED_DEFAULT
    )
    return out.withColumn("enriched_at", F.col("ingested_at"))


_RULE_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("pattern", T.StringType(), False),
        T.StructField("code", T.StringType(), False),
    ]
)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rule list as a (priority, pattern, code) table."""
    rows = [(i, p, c) for i, (p, c) in enumerate(rules)]
    return spark.createDataFrame(rows, _RULE_TABLE_SCHEMA)


def first_match(rules_bc):
    """Column function: the code of the first matching rule of a run, or None.

    Patterns are compiled once per task.  An Aho-Corasick automaton over the
    rules' required words finds, in one pass over a text, the rules that can
    match; only those are regex-tested, in priority order.  Rules without
    required words are always tested.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        rules = rules_bc.value  # [(pattern, code, required words or None)] in priority order
        compiled = [re.compile(p) for p, _, _ in rules]
        always, automaton = [], ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for i, (_, _, words) in enumerate(rules):
            if not words:
                always.append(i)
            for w in words or []:
                by_word.setdefault(w, []).append(i)
        for w, idx in by_word.items():
            automaton.add_word(w, idx)
        if by_word:
            automaton.make_automaton()

        def code(text):
            if text is None:
                return None
            candidates = set(always)
            if by_word:
                for _, idx in automaton.iter(text):
                    candidates.update(idx)
            return next((rules[i][1] for i in sorted(candidates) if compiled[i].search(text)), None)

        for texts in batches:
            names, distinct = pd.factorize(texts, use_na_sentinel=True)
            codes = [code(t) for t in distinct] + [None]
            yield pd.Series([codes[n] for n in names], dtype=object)

    return F.pandas_udf(run, T.StringType())


def rule_runs(rules: DataFrame):
    """The rules in priority order, in lists of at most RULES_AT_ONCE."""
    run = []
    for r in rules.orderBy("priority").toLocalIterator():
        run.append((r["pattern"], r["code"], required_words(r["pattern"])))
        if len(run) == RULES_AT_ONCE:
            yield run
            run = []
    if run:
        yield run


def code_join(df: DataFrame, text_col: str, rules: DataFrame, out_col: str, default: str) -> DataFrame:
    """Table-driven coder, same result as ``code_expr`` (first match wins, every rule counts)."""
    context = df.sparkSession.sparkContext
    text = normalize_text(F.col(text_col))
    found = [first_match(context.broadcast(run))(text) for run in rule_runs(rules)]
    return df.withColumn(out_col, F.coalesce(*found, F.lit(default)))


# The batch kernel ships to executors by value (workers need pyahocorasick,
# not this package).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
