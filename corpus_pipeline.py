"""From raw documents to packed training sequences, stage by stage.

Every stage works on all rows its predecessor kept. All but the last return the columns of
documents. Between stages the rows are written as Parquet in the shared folder and read again, so
a lost executor never sets the pipeline back by more than one stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import jaccard, language, packing, substrings, toxicity
from terrace.workspace import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the languages of ``docs``; documents without a language (no text, no letter) go."""
    return language.keep_identified(docs, language.learn(docs))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of ``docs``; documents predicted toxic go."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the document with the smallest id stays."""
    return jaccard.keep_representatives(docs, n=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the texts; ``n_chars`` follows."""
    out = substrings.remove_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Full sequences of 4096 tokens: one row per piece."""
    import public_tokenizers as public

    return packing.pack_documents(docs, public.path(packing.VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: No stage but the join could be said in SQL: models, rolling hashes and a tokenizer are not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = materialise(stage(spark, rows, sf_dir), name)
    return rows
