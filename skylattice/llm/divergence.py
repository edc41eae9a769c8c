"""How far the sources of a language differ in their use of its words, in exact integers.

Plain relational: regexp matches are exploded and counted by (language, source, term); the terms of enough documents
are crossed with every source of their language, so that absent words count as zeros; a self-join on (language, term)
sums the differences of every two sources, and windows rank them.

Null texts, languages and sources are empty ones; a row is a document, so repeated rows count again and ids aren't
read.  Texts of any length are counted whole.  A source whose texts have no terms still is a source of its language; a
language without kept terms gives its sources differences of 0.  An empty table gives no rows.  Columns besides text,
lang and source aren't looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._batch import LOWER
from ._store import discard, saved

#: Fixed values of the contract: a term's bytes in lower-cased UTF-8, the unit of shares and the count added to every term.
TERM = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, PRIOR = 1_000_000_000, 5

#: Parts into which a language's terms are dealt where they meet its sources.
SALTS = 64

#: Counts that a task holds before it gives them out, and bytes of a text whose matches it holds at once.
HELD, STRETCH = 200_000, 1 << 20

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_LOWER, _matches, _gap = LOWER.tobytes(), re.compile(TERM).findall, re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]").search


def _stretches(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a lower-cased text, stretch by stretch; a stretch ends behind a term."""
    at = 0
    while at < len(data):
        end = _gap(data, at + STRETCH) if len(data) - at > STRETCH else None
        yield _matches(data, at, end.start() if end else len(data))
        at = end.start() if end else len(data)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Explodes the texts of (lang, source, text) into their terms, those of a task added up before they are shuffled."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    fields = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            size = len(n) + 1
            yield pa.record_batch([pa.repeat(lang, size), pa.repeat(source, size), pa.array([None, *n], pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(docs.__getitem__, n)], pa.int64())], schema=fields)
        groups.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            n, docs = groups.setdefault((lang.as_py() or "", source.as_py() or ""), (Counter(), Counter()))
            before, own = len(n), set()
            for terms in _stretches((text.as_py() or "").encode().translate(_LOWER)):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            held += len(n) - before
            if held > HELD:
                yield from given()
                held = 0
    yield from given()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each source and the documents that hold it.

    Every group also has one row with a null term, so that none is lost; its n and docs are 0.
    """
    rows = docs.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    return rows.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * size)), exactly, for counts of up to 63 bits."""
    return F.expr("1L") + F.call_function("div", (n + PRIOR).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + size * PRIOR).cast("decimal(20,0)"))


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of ``docs`` (text, lang, source).

    Part ``pair``: item is another source of the language, value the sum over all kept terms of the two shares'
    differences.  Part ``term``: item is a kept term that the source uses with a greater share than its language, value
    the difference, the ``top`` first.  Ranks start at 1 for each source and part, by falling value and then by item.

    The dense counts are one row for each source and kept term of a language, and each of them meets the language's
    other sources: this grows with the square of the number of sources, not of documents.
    """
    counts = saved(term_counts(docs))
    found, groups = counts.where("term is not null"), counts.where("term is null").select("lang", "source")
    terms = saved(found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs).drop("docs"))
    sizes = terms.groupBy("lang").agg(F.count("*").alias("size"), F.sum("lang_n").alias("lang_total"))
    used = saved(found.join(terms.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    described = groups.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["size", "lang_total", "total"])
    # A language's terms are dealt into parts and its sources copied to all of them, as a few languages hold most terms.
    # Each language also gets an empty term that no source has, so that every two sources meet even without kept terms.
    marks = groups.select("lang").distinct().select("lang", F.lit("").alias("term"), F.lit(0).cast("bigint").alias("lang_n"), F.lit(0).alias("salt"))
    dealt = terms.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).unionByName(marks)
    dense = dealt.join(described.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["lang", "salt"]).join(used, ["lang", "source", "term"], "left")
    kept, n = F.col("term") != "", F.coalesce("n", F.lit(0))
    shares = saved(dense.select("lang", "source", "term", n.alias("n"), F.when(kept, share(n, F.col("total"), F.col("size"))).otherwise(0).alias("p"), F.when(kept, share(F.col("lang_n"), F.col("lang_total"), F.col("size"))).otherwise(0).alias("q")))
    discard(counts, terms, used)
    one, other = shares.select("lang", "term", "source", "p"), shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"))
    half = one.join(other, ["lang", "term"]).where(F.col("source") < F.col("item")).groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("r"))).alias("value"))
    both = half.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    words = shares.where(kept & (F.col("n") > 0) & (F.col("p") > F.col("q"))).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(both).unionByName(ranked(words).where(F.col("rank") <= top))
