"""Corpus pipeline: language, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet under the session's ``spark.checkpoint.dir`` and reads it again as the next stage's
documents.  All stages but the last return the columns of ``documents``, extra columns
included.  A row whose id is null is never linked to another one and passes the
near-duplicate stage; rows repeated with one id stand for one document and stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, ppm_langid, secrets, sentencepiece_dropout, simhash_vptree
from quarry.llm.common import read_table
from quarry.llm.queries import is_held_out
from quarry.session import scratch_path

#: A document whose best language has a lower posterior is rejected.
MIN_LANGUAGE_SCORE = 0.5
#: A document is rejected if its code is longer per byte than the mean of its language by so many standard
#: deviations, and at least so large a share of the mean; texts shorter than the mean get more room.
MAX_DEVIATIONS = 8.0
MIN_EXCESS = 0.5


def _carried(docs: DataFrame) -> DataFrame:
    """What the operators read, with the whole row beside it."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    return docs.select("doc_id", "text", lang, F.octet_length("text").alias("_size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter, without a clear language, or whose code length per byte is far
    from that of all learned rows of their language (strings of random letters, languages never learned).
    With no row to learn from every document is rejected; without a column ``lang`` there is none."""
    train = ~is_held_out()
    docs_ = docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(None).cast("string"))
    model = ppm_langid.learn(docs_, train)
    rates = ppm_langid.usual_rates(docs_, model, train)
    judged = ppm_langid.predict(_carried(docs), train, keep=("_row", "_size"), model=model)
    clear = (F.col("lang_pred") != ppm_langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    usual = F.lit(True)
    for lang, (mean, spread, size) in rates.items():
        room = max(MAX_DEVIATIONS * spread, MIN_EXCESS * mean) * F.greatest(F.lit(1.0), F.sqrt(F.lit(size) / F.col("_size")))
        usual &= (F.col("lang_pred") != lang) | (F.col("bits_per_byte") <= mean + room)
    return judged.where(clear & usual).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component."""
    linked = simhash_vptree.near_duplicates(docs, shingle=3, max_bits=2)
    gone = linked.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    judged = decontam.decontaminate(_carried(docs), read_table(spark, sf_dir, "benchmark"), keep=("_row",))
    return judged.where(~F.col("contaminated")).select("_row.*")


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by its kind in brackets; ``n_chars`` follows the text."""
    judged = secrets.scan(_carried(docs), keep=("_row",), redact=True)
    changed = F.col("spans") != ""
    new = {"text": F.col("redacted"), "n_chars": F.when(changed, F.length("redacted").cast("long")).otherwise(F.col("_row.n_chars"))}
    return judged.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document under merge-dropout."""
    return sentencepiece_dropout.encode(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scans", secret_spans),
    ("sentencepiece", tokens),
]

#: Language models, fingerprints, guess costs and merges have no SQL form; tests compare each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    base = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        out = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
