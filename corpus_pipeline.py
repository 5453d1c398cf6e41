"""A training-data pipeline over `documents`: five stages, each written before the next."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dielens.llm import lines, packing, simhash, suffixes, toxicity
from dielens.llm.common import table
from dielens.llm.queries import WORD_TOKENIZER
from dielens.plans.hold import keeping, remove, shared_folder

#: run() has no SQL: a trained classifier, XXH64 fingerprints and a tokenizer take part.
ORACLE_SQL = None

#: Near duplicates share this much of their shingles of five words (Jaccard). Fingerprints of
#: such pairs differ in 10 of 64 bits on average; 20 is beyond all that were seen (17).
SIMILAR = {"width": 5, "at_least": 0.8, "radius": 20}

#: Texts passed to an encoder at a time: by now the executors' heaps are as large as they get.
TEXTS_AT_ONCE = 1000

#: The columns stages know; others are carried under names of their own meanwhile.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stage makes of docs, whose other columns it neither sees nor overwrites."""
    hidden = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c not in KNOWN}
    plain = [hidden.get(c, c) for c in docs.columns]
    return work(docs.toDF(*plain)).select(*plain).toDF(*docs.columns)


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of docs with another text, its length kept in step."""
    changed = docs.withColumn("text", text)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


# All stages but the last keep the columns of documents and every other column as it is, give
# an empty table for an empty one, and take a null text for an empty text.


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; rows without a doc_id are scored too."""
    labels = table(spark, sf_dir, "labels")
    return _apart(docs, lambda d: toxicity.score_documents(d, labels).where("predicted = 0"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share (`lines.drop_shared_lines`)."""
    return _apart(docs, lambda d: _with_text(lines.drop_shared_lines(d), F.col("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id. Rows that repeat a
    doc_id and a text are one document; rows without a doc_id are kept only where all of the
    group have none, one for each text."""
    groups = simhash.near_duplicates(docs.select("doc_id", "text"), **SIMILAR)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    same = docs["doc_id"].eqNullSafe(first["doc_id"])
    kept = docs.join(first, same, "left_semi")
    often = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("_often"))
    repeated = kept["doc_id"].eqNullSafe(often["_often"])
    once = _apart(
        kept.join(often, repeated, "left_semi"),
        lambda d: d.withColumn("_row", F.xxhash64("text")).dropDuplicates(["doc_id", "_row"]),
    )
    return kept.join(often, repeated, "left_anti").unionByName(once)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that stand in several places."""

    def work(d: DataFrame) -> DataFrame:
        return _with_text(suffixes.remove_repeats(d), suffixes.whole_characters("kept"))

    return _apart(docs, work)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), rows_at_once=TEXTS_AT_ONCE))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written to the shared folder. What
    it held on the way, and its predecessor's rows, go once that is done."""
    docs = table(spark, sf_dir, "documents")
    folder, before = shared_folder(docs), None
    for name, stage in STAGES:
        with keeping() as held:
            docs = stage(spark, docs, sf_dir)
            if folder:
                path = f"{folder.rstrip('/')}/pipeline-{uuid4().hex}/{name}"
                docs.write.parquet(path)
                docs = spark.read.schema(docs.schema).parquet(path)
                held.release()
                if before:
                    remove(spark, before)
                before = path
            else:
                docs = docs.persist()
    return docs
