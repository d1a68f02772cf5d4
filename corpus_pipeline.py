"""Corpus pipeline: language, near duplicates, benchmark passages, mixing, token files.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns the documents it keeps -- the last one the rows read back from the token
files.  Every stage works on all that its predecessor kept.  Rows that repeat
an id and text are one document, of which the second stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinsignal.llm import decontaminate, langid, minhash, mixing, tokens
from clinsignal.llm.common import store, table
from clinsignal.llm.queries import tokenizer_file
from clinsignal.session import configure

MIN_LANGUAGE_SCORE = 0.4  # below, the network cannot tell the language


def _named(docs: DataFrame, wanted: str) -> str:
    """A column name that the documents do not have."""
    while wanted in docs.columns:
        wanted = f"_{wanted}"
    return wanted


def _with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """A key per document: its id and the hash of its text."""
    key = _named(docs, "_key")
    return docs.withColumn(key, F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))), key


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters go."""
    pred, score = _named(docs, "lang_pred"), _named(docs, "lang_score")
    said = langid.identify(docs, langid.train(docs), pred_col=pred, score_col=score)
    return said.where((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document -- that of the smallest id -- of each near-duplicate group."""
    keyed, key = _with_key(docs)
    groups, _ = store(minhash.near_groups(keyed.select(key, "text"), id_col=key), "near-groups")
    gone = groups.where(~F.col("kept")).select(key).distinct()
    left = keyed.join(gone, key, "left_anti")
    repeated = groups.where("kept").groupBy(key).count().where("count > 1").limit(1).count()
    if repeated:
        left = left.dropDuplicates([key])
    return left.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    key = _named(docs, "_text")
    hashed = docs.withColumn(key, F.xxhash64("text"))
    found = decontaminate.contamination(hashed.select(key, "text"), table(spark, sf_dir, "benchmark"), id_col=key)
    gone = found.where(F.size("items") > 0).select(key).distinct()
    return hashed.join(gone, key, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    keyed, key = _with_key(docs)
    rates = mixing.mix(keyed.select(key, "text", "source"), id_col=key)
    copies, _ = store(rates.groupBy(key).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")), "copies")
    if copies.where("_rows > 1").limit(1).count():
        keyed = keyed.dropDuplicates([key])
    taken = keyed.join(copies.where("_copies > 0").select(key, F.col("_copies").alias(f"{key}_n")), key)
    return taken.withColumn(f"{key}_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"{key}_n")))).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back."""
    _, path = tokens.write_tokens(docs, tokenizer_file())
    return tokens.read_tokens(spark, path)


def _configured(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        return stage(spark, docs, sf_dir)

    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


STAGES = [
    ("language_id", _configured(keep_languages)),
    ("near_dedup", _configured(drop_near_copies)),
    ("decontaminate", _configured(drop_contaminated)),
    ("mix_sources", _configured(mix_sources)),
    ("token_files", _configured(write_token_files)),
]

#: The language network, the near-duplicate search and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
