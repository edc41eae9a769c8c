"""The corpus pipeline: each stage works on what its predecessor kept, written as Parquet and read again between them; a stage's table goes once the next stage's is written.

Columns of any name beside doc_id, text and source go through the first four stages unchanged (n_chars is counted anew
where texts change); an empty table stays empty.
"""

from pyspark.sql import functions as F

from skylattice.llm import bpe, decontam, langid, pii, simhash
from skylattice.llm._store import discard, saved


def language(spark, docs, sf_dir):
    """Keeps texts in a known language; the source counts as the host, a null one as none.  Null texts, and those without letters, go; repeated rows stay."""
    return langid.accept(docs, langid.fit(docs), F.col("text"), host=F.col("source"))


def near_duplicates(spark, docs, sf_dir):
    """Keeps one row of each group, that of the smallest id; a null id only if the group has no other."""
    return simhash.deduplicate(docs)


def decontaminate(spark, docs, sf_dir):
    """Keeps documents that hold no benchmark window of 10 words; items that are null or without words have none."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)


def redact(spark, docs, sf_dir):
    """Replaces personal data by its kind; null texts stay null."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokenize(spark, docs, sf_dir):
    """Adds token count and digests to each document's id; a null text is empty."""
    return docs.select("doc_id", "lang", "source", "n_chars", bpe.digests(F.col("text")).alias("d")).select("doc_id", "lang", "source", "n_chars", "d.*")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("redact", redact), ("tokenize", tokenize)]
#: No SQL: language posteriors, fingerprints' components and the field's marginals aren't SQL-expressible; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs)
            if before is not None:
                discard(before)
            before = docs
    return docs
