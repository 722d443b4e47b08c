"""A training corpus from raw documents: quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next one's ``docs``. All but the last return the columns of ``documents``. A document is an id (maybe null) and a
text: other texts under the same id are decided on their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace, free_shuffles, read_table
from riskrank.llm.packing import pack_documents
from riskrank.llm.quality import classify, fit_quality
from riskrank.llm.simhash import one_of_each, text_hash
from riskrank.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Kept tables of the stages, which ``run`` clears once a stage's result is written.
_scratch: list[Workspace] = []


def _workspace(spark: SparkSession) -> Workspace:
    _scratch.append(Workspace(spark))
    return _scratch[-1]


def _chosen(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The documents that are (``left_semi``) or are not (``left_anti``) among ``keys`` (doc_id, text_hash)."""
    hashed = docs.select(*COLUMNS, text_hash("text").alias("text_hash"))
    same = hashed.doc_id.eqNullSafe(keys.doc_id) & (hashed.text_hash == keys.text_hash)
    return hashed.join(keys, same, how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects as of low quality or toxic go.

    Rows that repeat an id and a text share its fate: they go if one of them is rejected. Null texts count as
    empty ones; rows with a null id are judged like others. An empty table stays empty.
    """
    ws = _workspace(spark)
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    judged = classify(docs, model, ws).where("reject").select("doc_id", "text_hash").distinct()
    judged = ws.keep(judged, "rejected")
    free_shuffles(spark)
    return _chosen(docs, judged, "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (SimHash of three-word shingles, linked at two bits) one document stays.

    It is that with the smallest id, null ids last, then with the smallest text hash. Texts without words are a group too.
    Of rows that repeat its id and text one stays, the first by lang, source and n_chars. An empty table
    stays empty.
    """
    ws = _workspace(spark)
    stay = ws.keep(one_of_each(docs, ws, words=3, radius=2), "stay")
    free_shuffles(spark)
    kept = _chosen(docs, stay, "left_semi")
    # Without repeated rows the grouping below would give all rows as they are: a shuffle of all texts for nothing.
    names = docs.select("doc_id", text_hash("text").alias("text_hash"))
    repeats = names.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    if not repeats.isEmpty():
        first = F.min(F.struct("lang", "source", "n_chars", "text")).alias("row")
        kept = kept.groupBy("doc_id", "text_hash").agg(first).select("doc_id", "row.*")
    return kept.select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a smaller doc_id holds too are cut out of the text.

    Of different texts under one id only that with the smallest text hash is held against others; the rest, and rows with a
    null id, are returned whole. Null texts become empty. An empty table stays empty.
    """
    hashed = docs.select(*COLUMNS, text_hash("text").alias("text_hash"))
    shared = hashed.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("text_hash").alias("least")).where("n > 1 and doc_id is not null")
    ws = _workspace(spark)
    shared = ws.keep(shared.select("doc_id", "least"), "shared_ids")
    id_type, carry = docs.schema["doc_id"].dataType, ["lang", "source"]
    if not shared.isEmpty():
        joined = hashed.join(shared.withColumnRenamed("doc_id", "shared"), F.col("doc_id") == F.col("shared"), "left")
        alone = F.when(F.col("least").isNull() | (F.col("least") == F.col("text_hash")), F.col("doc_id"))
        hashed = joined.withColumns({"own_id": F.col("doc_id"), "doc_id": alone})
        carry.append("own_id")
    cut = remove_repeats(hashed, ws, unit="word", threshold=50, keep_content=True, carry=tuple(carry))
    text = F.col("kept").cast("string")
    id = F.col("carried.own_id") if "own_id" in carry else F.col("doc_id")
    n_chars = F.length(text).cast(docs.schema["n_chars"].dataType)
    return cut.select(id.cast(id_type).alias("doc_id"), text.alias("text"), "carried.lang", "carried.source", n_chars.alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, as few as can be; every row is packed, null texts as empty ones."""
    return pack_documents(docs, _workspace(spark), tokenizer=public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

# Classifier, fingerprints and tokenizers are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written before the next."""
    ws = Workspace(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        _scratch.clear()
        docs = ws.keep(stage(spark, docs, sf_dir), name)
        for used in _scratch:
            used.clear()
        free_shuffles(spark)
    return docs
