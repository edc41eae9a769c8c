"""Language identification by Bayesian evidence fusion.

The posterior of a language multiplies, per row, the likelihood of its text (letter trigrams counted over all
labelled documents), the likelihood of its declared markup language, and a prior of its host.  Host priors are
smoothed down a hierarchy (all rows, address suffix, registered domain, host): each level's counts, which are
sums of text posteriors from a grouped aggregation, are added to the level above as pseudo-counts, and a row's
own share is taken out before it is used for that row.

A flat background model stands for "none of these": it wins on texts that look like no known language.  Text
without letters has no text evidence; with neither declared language nor host it is ``und``.  Null texts are
empty, null markup, url or host is no evidence.  Repeated rows are rows; an empty labelled table knows only ``und``.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._batch import LOWER, mix64, pieces
from ._store import saved

UNKNOWN = "und"
#: Trigram buckets of the text model.
BUCKETS = 1 << 15
#: Pseudo-counts that each level of the hierarchy takes from the level above.
STRENGTH = 5.0
#: Overlapping trigrams count as this share of independent evidence.
TEXT_WEIGHT = 0.3
#: Languages whose counts a task holds at once, 256 KB each, before it hands them on.
HELD_LANGUAGES = 64
#: Bytes of texts scored at once; each takes about 60 bytes of a task's memory.
PIECE = 1 << 18
#: Hosts up to which their counts are broadcast (about 200 bytes each); beyond, they are joined by shuffle.
BROADCAST_HOSTS = 50_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True

_MARKUP = re.compile(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>")
_DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,8})"


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each trigram that holds at least two letters in a row; other bytes count as one space."""
    low = LOWER[data]
    letter = _LETTER[low]
    low = np.where(letter, low, 32).astype(np.uint32)
    n = len(low)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.ones(n - 2, dtype=bool)
    cut = offsets[1:-1]
    for k in (1, 2):
        at = cut - k
        inside[at[(at >= 0) & (at < n - 2)]] = False
    keep = np.flatnonzero(inside & letter[1:-1] & (letter[:-2] | letter[2:]))
    code = low[keep] << 16 | low[keep + 1] << 8 | low[keep + 2]
    return np.searchsorted(offsets, keep, side="right") - 1, (mix64(code) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class TextModel:
    languages: list[str]
    scores: np.ndarray  # log-likelihood of each bucket under each language and, last, the background

    def log_likelihoods(self, column: pa.Array) -> np.ndarray:
        """(rows, languages + 1); zeros for a text without trigrams."""
        parts = [np.zeros((0, len(self.languages) + 1))]
        for i, j, data, offsets in pieces(column, PIECE):
            row, bucket = _trigrams(data, offsets)
            sums = np.zeros((j - i, self.scores.shape[1]))
            for k in range(sums.shape[1]):
                sums[:, k] = np.bincount(row, weights=self.scores[bucket, k], minlength=j - i)
            parts.append(TEXT_WEIGHT * sums)
        return np.concatenate(parts)

    def posteriors(self, ll: np.ndarray) -> np.ndarray:
        """The share of each language in ``log_likelihoods``, and zeros for a text without trigrams."""
        if len(ll) == 0:
            return ll
        p = np.exp(ll - ll.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return np.where((ll.max(axis=1) != ll.min(axis=1))[:, None], p, 0.0)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Trigram counts of every language over all labelled rows; a task hands on at most ``BUCKETS`` numbers for each ``HELD_LANGUAGES`` or fewer that it holds.

    The model is a dense table of 128 KB a language.
    """
    names = [r.lang for r in labelled.groupBy(F.col(lang_col).alias("lang")).count().where("lang is not null").orderBy(F.desc("count"), "lang").collect()]
    at = {name: k for k, name in enumerate(names)}

    def flushed(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, total in held.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen + k * BUCKETS), pa.array(total[seen])], ["k", "n"])
        held.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = np.array([at.get(x, -1) for x in batch["lang"].to_pylist()], dtype=np.int64)
            for i, j, data, offsets in pieces(batch["text"], PIECE):
                row, bucket = _trigrams(data, offsets)
                of = lang[i:j][row]
                for k in np.unique(of[of >= 0]).tolist():
                    if k not in held and len(held) == HELD_LANGUAGES:
                        yield from flushed(held)
                    held[k] = held.get(k, 0) + np.bincount(bucket[of == k], minlength=BUCKETS)
        yield from flushed(held)

    scores = np.full((BUCKETS, len(names) + 1), -np.log(BUCKETS), dtype=np.float32)
    if names:
        counted = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
        key, n = counted["k"].to_numpy(), counted["n"].to_numpy()
        order = np.argsort(key)
        key, n = key[order], n[order]
        for k in range(len(names)):
            s, e = np.searchsorted(key, [k * BUCKETS, (k + 1) * BUCKETS])
            row = np.full(BUCKETS, 0.5)
            row[key[s:e] - k * BUCKETS] += n[s:e]
            scores[:, k] = np.log(row / row.sum())
    return TextModel(names, scores)


def visible_text(html: Column) -> Column:
    """The text of a page outside of tags, comments, scripts and styles."""

    @F.arrow_udf("string")
    def strip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([None if x is None else html_entities.unescape(_MARKUP.sub(" ", x)) for x in column.to_pylist()], pa.string())

    return strip(html)


def declared_language(html: Column) -> Column:
    """The primary subtag of the page's lang attribute, in lower case; null if there is none."""
    found = F.lower(F.regexp_extract(html, _DECLARED, 1))
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def identify(rows: DataFrame, model: TextModel, text: Column, declared: Column | None = None, host: Column | None = None) -> DataFrame:
    """``rows`` with a struct column ``language``: lang, posterior, text_lang, text_posterior, declared, host, prior (of lang at the host).

    A third of the rows may share a host: its counts are summed before the shuffle, and the rows meet them by broadcast or in a join that Spark may split.
    """
    names = [*model.languages, UNKNOWN]
    k = len(names)
    known = {n: i for i, n in enumerate(names)}

    @F.arrow_udf("array<double>")
    def posterior(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            p = model.posteriors(model.log_likelihoods(column))
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * k), pa.array(p.ravel()))

    none = F.lit(None).cast("string")
    base = rows.select(F.struct(*rows.columns).alias("_row"), text.alias("_x"), (none if declared is None else declared).alias("_d"), (none if host is None else host).alias("_h"))
    sums = [F.sum(F.col("_p")[i]).alias(f"s{i}") for i in range(k)]
    pack = F.array(*(F.col(f"s{i}") for i in range(k)))
    domain = F.regexp_extract("_h", r"([^.]+\.[^.]+|[^.]+)$", 1)
    suffix = F.regexp_extract("_h", r"([^.]+)$", 1)

    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]
    truth = F.when(F.col("_d").isNotNull(), F.when(F.col("_d").isin(*names), F.col("_d")).otherwise("other"))
    # One small table of sums; the texts are scored once for it and once for the result, not written out.
    counted = saved(base.withColumn("_p", posterior("_x")).groupBy("_h", truth.alias("_said")).agg(*sums))
    hosts = counted.where("_h is not null").groupBy("_h").agg(*again).withColumns({"_dom": domain, "_suf": suffix})
    domains, suffixes = hosts.groupBy("_dom").agg(*again), hosts.groupBy("_suf").agg(*again)
    levels = hosts.select("_h", "_dom", "_suf", pack.alias("n0")).join(domains.select("_dom", pack.alias("n1")), "_dom").join(suffixes.select("_suf", pack.alias("n2")), "_suf")
    levels = saved(levels.select("_h", "n0", "n1", "n2"))
    total = counted.agg(*again).select(*(F.coalesce(f"s{i}", F.lit(0.0)) for i in range(k))).first()
    wide = base.join(F.broadcast(levels) if levels.count() <= BROADCAST_HOSTS else levels, "_h", "left")

    # How a declared language goes with the text's: smoothed counts, at most one row a declared name.
    pairs = {r._said: [r[f"s{i}"] or 0.0 for i in range(k)] for r in counted.where("_said is not null").groupBy("_said").agg(*again).collect()}
    said = np.full((k + 1, k), 0.5)
    for d, s in pairs.items():
        said[known.get(d, k)] += s
    said = np.log(said / said.sum(axis=0))
    all_rows = np.array(list(total))

    @F.arrow_udf("struct<lang:string,posterior:double,text_lang:string,text_posterior:double,declared:string,host:string,prior:double>")
    def fuse(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, declared, host, *levels in batches:
            n = len(texts)
            if n == 0:
                yield pa.StructArray.from_arrays([pa.array([], x) for x in (pa.string(), pa.float64(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.float64())], ["lang", "posterior", "text_lang", "text_posterior", "declared", "host", "prior"])
                continue
            ll = model.log_likelihoods(texts)
            own = model.posteriors(ll)
            informed = own.any(axis=1)
            prior = np.maximum(all_rows + 1 / k - own, 1e-9)
            prior /= prior.sum(axis=1, keepdims=True)
            for level in levels[::-1]:
                have = np.array(level.is_valid())
                counts = np.zeros((n, k))
                counts[have] = np.array(level.flatten()).reshape(-1, k)
                counts = np.maximum(counts - own, 0.0)
                smoothed = (counts + STRENGTH * prior) / (counts.sum(axis=1, keepdims=True) + STRENGTH)
                prior = np.where(have[:, None], smoothed, prior)
            names_said = declared.to_pylist()
            score = ll + np.log(np.maximum(prior, 1e-12)) + np.stack([np.zeros(k) if d is None else said[known.get(d, k)] for d in names_said])
            best = score.argmax(axis=1)
            posterior = 1 / np.exp(score - score.max(axis=1, keepdims=True)).sum(axis=1)
            blind = ~informed & np.array(declared.is_null()) & np.array(host.is_null())
            text_best = own.argmax(axis=1)
            yield pa.StructArray.from_arrays(
                [
                    pa.array([UNKNOWN if x else names[i] for i, x in zip(best, blind)], pa.string()), pa.array(np.where(blind, 0.0, posterior)),
                    pa.array([names[i] if x else None for i, x in zip(text_best, informed)], pa.string()), pa.array(own.max(axis=1), mask=~informed),
                    declared, host, pa.array(prior[np.arange(n), best]),
                ],
                ["lang", "posterior", "text_lang", "text_posterior", "declared", "host", "prior"],
            )

    return wide.select(*(F.col("_row")[c].alias(c) for c in rows.columns if c != "language"), fuse("_x", "_d", "_h", "n0", "n1", "n2").alias("language"))


def accept(rows: DataFrame, model: TextModel, text: Column, declared: Column | None = None, host: Column | None = None, least: float = 0.5, languages: list[str] | None = None) -> DataFrame:
    """``rows`` whose text is in a known language (of ``languages``, if given) with posterior ``least`` or more; texts without letters go."""
    spare = "_language"
    while spare in rows.columns:
        spare = f"_{spare}"
    found = identify(rows.withColumnRenamed("language", spare), model, text, declared, host)
    lang = F.col("language.lang")
    ok = (lang != UNKNOWN) & (F.col("language.posterior") >= least) & F.col("language.text_lang").isNotNull()
    kept = found.where(ok if languages is None else ok & lang.isin(*languages)).drop("language")
    return kept.withColumnRenamed(spare, "language").select(*rows.columns)
