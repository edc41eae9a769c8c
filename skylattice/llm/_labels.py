"""Labelled rows for the classifiers: a bounded sample of the training fold, and the held-out flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(parts))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y) of at most ``rows`` distinct labelled texts whose remainder is not 0, by the hashes of their id and text.

    A repeated label counts once, as its largest value, and rows of equal id and text count once; rows without id
    or label don't count.
    """
    clean = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (remainder(F.col(id_col)) != 0))
    few = clean.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)
    # At most ``rows`` rows of two numbers, so both broadcasts are bounded; an id may still have any number of texts.
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")).join(F.broadcast(few), "id")
    picked = marked.select("id", "h").distinct().orderBy(F.xxhash64("id"), "id", "h").limit(rows)
    return marked.join(F.broadcast(picked), ["id", "h"]).dropDuplicates(["id", "h"]).select("id", "text", "y")
