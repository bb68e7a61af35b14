"""Corpus pipeline: documents in, token shards out, one operator per stage.

STAGES run in order. Each stage works on all rows that its predecessor kept;
its result is written as Parquet and read again as the next stage's `docs`.
Every stage takes an empty table, texts of any length, and columns of any
other name, which keep their values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.llm.common import set_aside, staged
from logsieve.llm.decontam import drop_contaminated
from logsieve.llm.langid import ADDED as LANGUAGE_COLUMNS
from logsieve.llm.langid import fit_languages, identify_languages, rejected
from logsieve.llm.mixing import ADDED as MIX_COLUMNS
from logsieve.llm.mixing import mix_sources
from logsieve.llm.simhash import keep_one_of_each
from logsieve.llm.wavelet import read_token_shards, write_token_shards
from logsieve.sources import scratch_path

#: The tables name no domain: sources are dealt into three by a hash of their name.
MIX_DOMAIN_SQL = "case when md5(source) < '8' then 'web' when md5(source) < 'c' then 'books' else 'forum' end"
#: Target weights by path from the root, or by ("*", name) wherever the name occurs.
MIX_WEIGHTS: Mapping[tuple[str, ...], int] = {
    ("web",): 5, ("books",): 3, ("forum",): 2,
    ("*", "en"): 4, ("*", "de"): 2, ("*", "fr"): 2, ("*", "es"): 2,
}


def mix_levels() -> dict[str, Column]:
    return {"domain": F.expr(MIX_DOMAIN_SQL), "lang": F.col("lang"), "source": F.col("source")}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go in which no language is found (no letter, so null and empty
    texts too), and those whose `lang` the model, fitted on a sample of the same
    table, contradicts with a score of `langid.SURE` or more. A null `lang`
    contradicts nothing; repeated rows fare alike."""
    model = fit_languages(docs.select("text", "lang"))
    docs, own = set_aside(docs, LANGUAGE_COLUMNS)
    return identify_languages(docs, model).where(~rejected("lang")).select(*own)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays. Null and empty texts are a
    group like any other; ids may repeat or be null (`keep_one_of_each`)."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows
    go; one without words stays, and with an empty benchmark all do."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of a mixture of four fifths of the tokens, each at most
    once. Null sources and languages are nodes of their own; the budget is met
    whatever the ids are; the document at a leaf's cut stays whole."""
    docs, own = set_aside(docs, MIX_COLUMNS)
    return mix_sources(docs, mix_levels(), MIX_WEIGHTS, budget_share=(4, 5), max_epochs=1).select(*own)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards on the shared folder; the row of each document read back
    from them. A null text is empty: its end id alone."""
    path = scratch_path(spark, "corpus-shards")
    write_token_shards(docs, path)
    return read_token_shards(spark, path)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dups),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
    ("token_shards", token_shards),
]

#: Learned models, fingerprints and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the whole `documents` table of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
