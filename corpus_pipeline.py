"""From raw documents to token ids: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import byte_bpe, dart_minhash, decontaminate, language_id, queries, substring_dedup
from pageloom.llm.common import saved

#: A text is rejected if no language reaches this score.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters (null and empty ones too) and those that look like no language learned.

    The network learns from the stage's own labelled rows but a fifth; without any, texts with letters all stay.
    """
    model = language_id.train(docs.where(F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0, F.lit(False))))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, only the document of the least id stays."""
    return dart_minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that stand earlier; documents of which nothing is left go.  Other texts stay as they are."""
    cut = substring_dedup.substring_dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    values = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.where("n_removed < n_words").select(*[values[c].alias(c) if c in values else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more is passages of the benchmark."""
    out = decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit(F.col("hits"))
    return out.where(~((hit > 0) & (20 * hit >= F.col("n_words")))).select("row.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids.  Every document's ids are decoded again; the stage fails if that isn't its text."""
    ids = byte_bpe.encode(docs, byte_bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY)), public_tokenizers.PATTERN, decode=False, verify=True)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_tokens),
]

#: Language ID and near-duplicate classes are beyond SQL; tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table documents."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
