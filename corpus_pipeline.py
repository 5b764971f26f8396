"""Corpus pipeline over the documents table.

Stages, in order: quality rules, near-duplicates, benchmark decontamination,
secrets, byte-level BPE ids. Each takes (spark, docs, sf_dir) and returns a
DataFrame; ``run`` writes its rows to the shared folder and hands what it
reads back to the next. All but the last return the columns of ``docs``.

Every stage takes columns of any other names and passes them on as they are
(they travel in a struct, so none can clash with a working column), NULLs in
any column, texts of any length, repeated rows and an empty table, which gives
an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.llm import bpe, decontamination, minhash, quality, secrets
from tickroll.llm.common import stage, table

# No SQL for the tokenizer's merges: tests compare the rows with a plain version.
ORACLE_SQL = None


def _identity(doc_id: str, text_key):
    """The two join keys of a document: its id (the least long for NULL) and a hash of its text."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-2**63)).alias("_d"), text_key.alias("_k")


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row in a struct (so that no column can clash) with its identity."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), *_identity("doc_id", F.xxhash64(F.col("text").cast("string"))))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table.

    A NULL or empty text has no words and goes. Rows are judged one by one:
    repeated rows fare alike, a NULL id or other column changes nothing.
    """
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8), and once each repeated row.

    The smallest id of a group stays (a tie of two texts under one id is broken
    by a hash of the text); rows without an id go if any member has one.
    NULL and wordless texts are like nothing and stay.
    """
    found = minhash.near_duplicates(docs)
    keys = found.filter("kept").select(*_identity("doc_id", F.col("text_key"))).distinct()
    kept = _keyed(docs).join(keys, ["_d", "_k"], "left_semi")
    return kept.dropDuplicates(["_d", "_k"]).select("_doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (less than a twentieth of their words in 13-word windows).

    NULL and wordless texts stay. Rows are told apart by id and text, so of two
    texts under one id only the contaminated one goes, with its repeated rows.
    """
    documents, matches = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = (decontamination.contamination_digest(documents, matches).filter("contaminated")
           .select(*_identity("doc_id", F.col("text_key"))).distinct())
    return _keyed(docs).join(bad, ["_d", "_k"], "left_anti").select("_doc.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked but widely copied placeholders; ``n_chars`` follows the text.

    A NULL text stays NULL, a NULL source counts as one owner; repeated rows
    are masked alike; a text without secrets is passed on unchanged.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text", "source", "lang")
    masked = secrets.redact(rows)
    changed = ~F.col("text").eqNullSafe(F.col("_doc.text"))

    def column(name: str):
        old = F.col("_doc").getField(name)
        if name == "text":
            return F.col("text")
        return F.when(changed, F.length("text")).otherwise(old).cast(docs.schema[name].dataType) if name == "n_chars" else old

    return masked.select(*[column(c).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of every document left; ids that do not decode to its text fail the run.

    A NULL text is read as empty and has no ids; repeated rows and NULL ids are
    encoded row by row.
    """
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN, verify=True)
    return coded.withColumn("ids", bpe.verified_ids()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("redact_secrets", redact_secrets), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``: doc_id, n_tokens, ids of what is left."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
