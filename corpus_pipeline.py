"""The corpus pipeline: documents through the stages below, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm._shared import delete, shared_folder
from tideline.llm.decontaminate import mark_contamination
from tideline.llm.linededup import drop_repeated_lines
from tideline.llm.neardup import drop_near_duplicates
from tideline.llm.queries import in_training, table
from tideline.llm.spiece import encode_documents, read_model
from tideline.llm.toxicity import score_toxicity, train

KEYS = ["doc_id", "text"]


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id and text, and all other columns in one, so that no operator's result can take the place of a column of docs."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in KEYS]
    return docs.select(*KEYS, (F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))).alias("rest"))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    return packed.select(*(F.col(c) if c in KEYS else F.col("rest").getField(c).alias(c) for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels that may be learned from, doesn't reject.

    Labels without a document among docs teach nothing. A null or empty text gets the score of no n-grams; texts of any
    length are scored whole; repeated rows stay or go together; no rows in, no rows out; all columns stay, whatever
    their names.
    """
    model = train(docs.select(*KEYS), table(spark, sf_dir, "labels").where(in_training()))
    return _unpacked(score_toxicity(_packed(docs), model).where("predicted = 0"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; where lines went n_chars follows.

    A null text becomes an empty one. Rows that share an id are one document in the counts. No rows in, no rows out;
    all columns stay, whatever their names.
    """
    out = drop_repeated_lines(_packed(docs))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("rest.n_chars"))
        out = out.withColumn("rest", F.col("rest").withField("n_chars", changed.cast(docs.schema["n_chars"].dataType)))
    return _unpacked(out, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Empty and null texts have no duplicates and stay, as do rows without an id; rows equal in id and text are one
    document; rows that share an id only follow their own texts. No rows in, no rows out; all columns stay.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item.

    Null and empty texts have none and stay; an empty benchmark rejects nothing; repeated rows stay or go together; no
    rows in, no rows out; all columns stay, whatever their names.
    """
    return _unpacked(mark_contamination(_packed(docs), table(spark, sf_dir, "benchmark")).where("NOT contaminated"), docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, with proof that they decode to the text and equal the library's; all columns but the text stay before them.

    A null or empty text has no tokens; a text of any length is encoded whole; repeated rows get equal tokens; no rows
    in, no rows out. Where a column of docs has the name of a result, the result takes its place.
    """
    results = ["n_tokens", "token_ids", "ids_sha256", "decoded_sha256", "round_trip", "parity"]
    out = encode_documents(_packed(docs), read_model()).withColumn("decoded_sha256", F.sha2("decoded", 256))
    keep = [c for c in docs.columns if c != "text" and c.lower() not in results]
    return out.select(*(F.col(c) if c in KEYS else F.col("rest").getField(c).alias(c) for c in keep), *results)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("SentencePiece encoding and decoding", sentencepiece)]

#: The first stage is a trained classifier, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, read from the shared folder; what earlier stages wrote is deleted as soon as it is used, the last when the driver's process ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
