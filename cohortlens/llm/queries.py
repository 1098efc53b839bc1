"""The corpus operators as registered queries, with the SQL that states a result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import align, ann, decontam, jaccard, lm, mixing, phrases, pii, repeats, sharding, spans, tokenfile, toxicity
from cohortlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Production mix: three domains, four languages, all sources alike.
MIX = mixing.Mix(
    domain_of={f"src{i}": "web" if i < 10 else "books" if i < 15 else "forums" for i in range(20)},
    weights={"domain": {"web": 50, "books": 30, "forums": 20}, "lang": {"en": 55, "fr": 15, "de": 15, "es": 15}},
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        return fn

    return add


@query("op1_mixing")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(table(spark, folder, "documents"), MIX)


ORACLE["op1_mixing"] = mixing.sql(MIX)


@query("op2_token_files")
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.token_table(table(spark, folder, "documents"), TOKENIZER, end_id=2)


@query("op3_lm_scores")
def op3_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(table(spark, folder, "documents"), TOKENIZER)


@query("op4_sharding")
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), shards=24)


@query("op5_decontamination")
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op5_decontamination"] = decontam.SQL


@query("op6_nearest_neighbours")
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op7_sentence_spans")
def op7_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    return spans.deduplicate(table(spark, folder, "documents"), least_words=0)


@query("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents"))


ORACLE["op8_jaccard_join"] = jaccard.SQL


@query("op9_repeated_strings")
def op9_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removed_bytes(table(spark, folder, "documents"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


@query("op12_collocations")
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


ORACLE["op12_collocations"] = phrases.SQL


@query("op13_cross_alignment")
def op13_cross_alignment(spark: SparkSession, folder: str) -> DataFrame:
    both = align.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return align.alignment(table(spark, folder, "documents"), both)
