"""From raw documents to token ids: the corpus pipeline.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last keep the columns of ``documents``; the last
gives the token ids.

Defined cases: further columns, of whatever name, are kept by all stages but the
last. Null and empty texts fail the counted rules; in the other stages they are
one empty line (line dedup, which writes a null text as empty), similar to
nothing (near dedup), of no size (mixing) and without ids (encoding). Rows with a
null id pass near dedup; rows that repeat an id stay or go together there. A null
language or source is a leaf of its own in the mixing. Empty tables give empty
tables; without labels of both classes the counted rules alone decide.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import line_dedup, mixing, near_dedup, pieces, quality
from wordmill.llm.common import quoted, table, unused_name
from wordmill.plans.physical import bounded_broadcast, materialize

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
MIX_EPOCHS = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the counted rules or the classifier go."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).filter("kept").select(*map(quoted, docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in one; ``n_chars`` is
    counted anew."""
    done = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    return done.select(*map(quoted, docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the smallest id.
    Only the ids that go are joined with the documents."""
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    goes = unused_name(docs, "near_id")
    gone = found.groupBy("doc").agg(F.min("component").alias("first")).filter("doc <> first").select(F.col("doc").alias(goes))
    gone = bounded_broadcast(materialize(gone, "near-gone"))
    return docs.join(gone, quoted("doc_id") == F.col(goes), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, by target weights, in two epochs at most.
    Tokens are counted with the model of the last stage."""
    tokens = pieces.counted_tokens(docs, pieces.read_model(PIECE_MODEL))
    mixed = mixing.mix_sources(
        docs, mixing.document_levels(), mixing.DOCUMENT_WEIGHTS, share=1.0, tokens=tokens, max_epochs=MIX_EPOCHS
    )
    return mixed.select(*map(quoted, docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    proto = pieces.read_model(PIECE_MODEL)
    return pieces.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), proto).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("source mixing", mix_sources),
    ("piece encoding", encode),
]

# The classifier and the piece model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
