"""Benchmark decontamination with DataFrame functions only.

A window is ``size`` consecutive normalised words of a benchmark item, or the whole of a shorter
item.  The windows' hashes form a hash set, broadcast while its counted size is below
``BROADCAST_WINDOWS`` and joined by shuffle beyond.  A document's word windows meet it by hash and
are verified word for word.

Before that, a fixed-size bit table of word blocks spares most documents the join: any occurrence of a
window of m words holds a block of (m + 1) // 2 words that starts at a multiple of that number, so
a document none of whose aligned blocks is in the table holds no window.

Null text has no words.  Items without words are no items, and so are items without an id.  Repeated
item ids are one item with the windows of all their texts.  Rows with equal doc_id and text are equal
documents and each gets the result; null doc_ids are kept.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that are no part of a word: everything in ASCII but letters and digits, after lower-casing.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before lower-casing.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Windows up to which the hash set is broadcast (about 100 bytes each).
BROADCAST_WINDOWS = 500_000

#: Bits of the block table as a power of two; with more blocks it lets more documents through to the join, and loses none.
TABLE_BITS = 20


def words(text: Column) -> Column:
    """The normalised words of a text: array<string>, empty for null."""
    text = F.coalesce(text, F.lit(""))
    # lower() also maps letters beyond ASCII, so it serves where there are none; translate() is slower.
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def item_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (item, window): item_id, m words long, grams array<string>."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.col("item_id").isNotNull() & (F.size("w") > 0))
    m = F.least(F.size("w"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("w") - m + 1)
    return items.select("item_id", m.alias("m"), F.explode(F.transform(starts, lambda i: F.slice("w", i, m))).alias("grams")).distinct()


def _bit_table(windows: DataFrame) -> list[int]:
    """The bits of every (m + 1) // 2 words in each window of m, as 64-bit integers; at most 2 ** TABLE_BITS bits reach the driver."""
    k = ((F.col("m") + 1) / 2).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.col("m") - k + 1), lambda i: F.xxhash64(k, F.slice("grams", i, k)))
    bits = windows.select(F.explode(blocks).alias("h")).select(F.explode(F.array(*(_probe(F.col("h"), p) for p in range(3)))).alias("bit"))
    table = [0] * ((1 << TABLE_BITS) // 64)
    for r in bits.groupBy((F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits")).collect():
        table[r.at] = r.bits
    return table


def _probe(h: Column, p: int) -> Column:
    return F.shiftrightunsigned(h, TABLE_BITS * p).bitwiseAND(F.lit((1 << TABLE_BITS) - 1)).cast("int")


def _known_blocks(w: Column, m: int, bits: Column) -> Column:
    """The numbers of the aligned blocks of ``w`` that the bit table knows."""
    k = (m + 1) // 2

    def block_known(i: Column) -> Column:
        h = F.xxhash64(F.lit(k), F.slice(w, i * k + 1, F.lit(k)))
        tests = [F.getbit(F.element_at(bits, (_probe(h, p) / 64).cast("int") + 1), _probe(h, p) % 64) == 1 for p in range(3)]
        return tests[0] & tests[1] & tests[2]

    return F.filter(F.sequence(F.lit(0), (F.size(w) / k).cast("int") - 1), block_known)


def _windows(w: Column, m: int, bits: Column) -> Column:
    """Position and words of each window of m words round a known block."""
    k = (m + 1) // 2
    starts = F.transform(_known_blocks(w, m, bits), lambda i: F.sequence(F.greatest(F.lit(0), i * k - (m - k)), F.least(i * k, F.size(w) - m)))
    found = F.transform(F.array_distinct(F.flatten(starts)), lambda p: F.struct(p.alias("p"), F.slice(w, p + 1, F.lit(m)).alias("grams")))
    return F.when(F.size(w) >= m, found).otherwise(F.array().cast("array<struct<p:int,grams:array<string>>>"))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per (id, text hash) that holds a window: at array<int> of the hit word positions (from 0), items array of item ids.

    The documents' candidates are grouped by (id, text hash), each group no larger than a document.
    """
    windows = item_windows(benchmark, size)
    per_length = {r.m: r["count"] for r in windows.groupBy("m").count().collect()}  # at most ``size`` rows
    lengths = sorted(per_length)
    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if not lengths:
        return ids.where(F.lit(False)).select("_id", F.xxhash64("_text").alias("_hash"), F.lit(None).cast("array<int>").alias("at"), F.lit(None).cast("array<string>").alias("items"))
    # Exploding a one-element array keeps Spark from splitting the text anew wherever its words are used.
    split = ids.select("_id", F.xxhash64("_text").alias("_hash"), F.explode(F.array(words(F.col("_text")))).alias("_w"))
    bits = F.from_json(F.lit(json.dumps(_bit_table(windows))), "array<bigint>")  # folded to one literal
    spots = split.select("_id", "_hash", F.explode(F.concat(*(_windows(F.col("_w"), m, bits) for m in lengths))).alias("s")).select("_id", "_hash", F.col("s.p").alias("p"), F.col("s.grams").alias("grams"))
    spots = spots.withColumn("h", F.xxhash64("grams"))
    known = windows.groupBy("grams").agg(F.max("m").alias("m"), F.collect_set(F.col("item_id").cast("string")).alias("ids")).select(F.xxhash64("grams").alias("h"), F.col("grams").alias("known"), "m", "ids")
    if sum(per_length.values()) <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    found = spots.join(known, "h").where(F.col("grams") == F.col("known"))
    return (
        found.groupBy("_id", "_hash")
        .agg(F.collect_set(F.struct("p", "m")).alias("spots"), F.collect_set("ids").alias("ids"))
        .select("_id", "_hash", F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s["p"], s["p"] + s["m"] - 1)))).alias("at"), F.array_sort(F.array_distinct(F.flatten("ids"))).alias("items"))
    )


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs, benchmark, size, id_col, text_col)
    base = docs.select(F.col(id_col), F.xxhash64(F.col(text_col)).alias("_h"), F.size(words(F.col(text_col))).cast("bigint").alias("n_words"))
    joined = base.join(found, base[id_col].eqNullSafe(found["_id"]) & (base["_h"] == found["_hash"]), "left")
    n_hit = F.when(F.col("at").isNull(), F.lit(0)).otherwise(F.size("at")).cast("bigint")
    return joined.select(
        base[id_col], "n_words", n_hit.alias("n_hit"), F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, size: int = 10, unit: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated documents, or (unit="spans") with the hit words cut out of their texts; other columns stay."""
    if unit not in ("documents", "spans"):
        raise ValueError(f"unit must be documents or spans, not {unit}")
    found = hits(docs, benchmark, size, id_col, text_col)
    # Rows in a struct, so that no column of theirs clashes with the operator's.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    same = rows["id"].eqNullSafe(found["_id"]) & (rows["hash"] == found["_hash"])
    if unit == "documents":
        return rows.join(found, same, "left_anti").select("row.*")
    text, at = F.col("row")[text_col], F.col("at")
    gaps, own = F.split(text, ANY_CASE_WORD), F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    kept = F.concat_ws("", F.transform(gaps, lambda g, i: F.concat(g, F.when((i < F.size(own)) & ~F.array_contains(at, i), F.get(own, i)).otherwise(""))))
    cut = F.when(at.isNull(), text).otherwise(kept)
    return rows.join(found, same, "left").select(*((cut if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))
