"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, divergence, langid, lm, media, pii, quality, repeats, sequences, simhash, toxicity, whitening
from ._labels import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: benchmark windows of 10 words that occur in it."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


ORACLES["op4_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
spots AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
          FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
found AS (SELECT doc_id, s.m, i, item_id FROM spots s JOIN win USING (m, g)),
pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count and hashes of its ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.digests(F.col("text")).alias("d"))
    return docs.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprint and the smallest doc_id of its group of near-duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, budget=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its language from text, markup and host, with the evidence."""
    model = langid.fit(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = langid.identify(pages, model, langid.visible_text(F.col("html")), langid.declared_language(F.col("html")), langid.host_of(F.col("url")))
    return found.select("page_id", "language.*")


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: personal data by pattern and by the skip-chain field."""
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: probability of the label toxic, with the nearest labelled examples."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), toxicity.score(F.col("text"), index).alias("s"))
    return scored.select("doc_id", "held_out", "s.score", F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"), "s.evidence")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: probability of the label quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), quality.score(F.col("text"), machine).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes covered by 100-byte strings that also start earlier, and the hash of the rest."""
    return repeats.report(table(spark, sf_dir, "documents"), length=100)


@query
def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: log10 probabilities by word counts and by the attention model."""
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector, drawn as a raster: its corners, verified links and group of copies.  The tables hold no images."""
    images = media.rendered(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return media.copies(images).withColumnRenamed("image_id", "vec_id")


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and source: differences of word use from every other source, and the words that mark it."""
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, top=50)


ORACLES["op12_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
per AS (SELECT k, lang, source, term, count(*) AS n FROM (SELECT k, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM per GROUP BY lang, term HAVING count(*) >= 30),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cnt AS (SELECT lang, source, term, sum(n) AS n FROM per GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN kept k USING (lang) LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
tot AS (SELECT lang, source, sum(n) AS total FROM dense GROUP BY ALL),
p AS (SELECT lang, source, term, d.n, CAST(1 + (1000000000::HUGEINT * (d.n + 5)) // (t.total + 5 * s.v) AS BIGINT) AS p, CAST(1 + (1000000000::HUGEINT * (d.lang_n + 5)) // (s.total + 5 * s.v) AS BIGINT) AS q
      FROM dense d JOIN tot t USING (lang, source) JOIN size s USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its place among all tokens and a digest of its ids, read back from the written Arrow files."""
    return sequences.report(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector and component: whitened coordinates from the exact scatter of the distinct integer vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
