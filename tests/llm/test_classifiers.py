import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skylattice.llm import _batch, _labels, quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    r = np.random.default_rng(0)
    plain = ["house", "river", "the", "of", "tree", "road", "cloud", "stone", "light", "water"]
    rows, labels = [], []
    for i in range(600):
        w = list(r.choice(plain, 40))
        bad, poor = i % 4 == 0, i % 5 == 0
        if bad:
            w[3:5] = r.choice(["idiot", "scummy", "moron"], 2)
        t = " ".join(x.upper() + "!!" for x in w) if poor else " ".join(w) + "."
        rows.append((i, t))
        labels.append((i, int(not poor), int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "idiot " * 30000), (1003, "!!! ???"), (None, "the river"), rows[1], rows[1]]
    labels += [(None, 1, 1), (5000, 1, 1), (3, None, None), labels[4], labels[4]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("label", F.lit("x")).withColumn("score", F.lit(1))
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 5 == 0


def test_remainder_and_sample(spark, tables):
    docs, labels = tables
    got = docs.select("doc_id", (_labels.remainder(F.col("doc_id")) == 0).alias("h")).collect()
    assert all(r.h == held(r.doc_id) for r in got)
    ids = [r.id for r in _labels.sample(docs, labels, "toxic", 50).select("id").distinct().collect()]
    assert 0 < len(ids) <= 50 and not any(held(i) for i in ids)


def test_toxicity_on_held_out(spark, tables):
    docs, labels = tables
    index = toxicity.fit(docs, labels)
    got = docs.select("doc_id", toxicity.score(F.col("text"), index).alias("s")).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None and r.doc_id < 600 and held(r.doc_id):
            assert (r.s.score >= 0.5) == (r.doc_id % 4 == 0)
    by = {r.doc_id: r.s for r in got}
    assert by[1002].score > 0.5 and by[1002].evidence and by[1000].score == by[1001].score == by[1003].score < 0.5 and not by[1000].evidence


def dense(index):
    out = np.zeros((len(index.first), len(index.vocabulary.hashes)))
    term = np.repeat(np.arange(len(index.vocabulary.hashes)), np.diff(index.start))
    out[index.entry, term] = index.weight
    return out


@pytest.mark.parametrize("block,frequent", [(512, 0.02), (8, 0.02), (8, 2.0)])
def test_neighbours_equal_brute_force(spark, tables, monkeypatch, block, frequent):
    """Every term is in the index, and block bounds, frequent terms and postings give the cosines of all entries."""
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "FREQUENT", frequent)
    docs, labels = tables
    index = toxicity.fit(docs, labels)
    index._slot = None
    d = dense(index)
    assert np.allclose(np.linalg.norm(d, axis=1), 1, atol=1e-5) and {b"house", b"idiot", b"river"} <= {w for w in (b"house", b"idiot", b"river", b"none") if _batch.hash_of(w) in index.vocabulary.hashes}
    rng = np.random.default_rng(3)
    for _ in range(50):
        t = np.sort(rng.choice(d.shape[1], min(5, d.shape[1]), replace=False))
        w = rng.random(len(t))
        w /= np.sqrt(w @ w)
        want = d[:, t] @ w
        got = index.nearest(t, w)
        best = np.sort(want[want > 1e-9])[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose([c for c, _ in got], best, atol=1e-5) and all(abs(want[at] - c) < 1e-5 for c, at in got)


def test_score_and_evidence_equal_brute_force(spark, tables):
    docs, labels = tables
    index = toxicity.fit(docs, labels)
    d = dense(index)
    of_hash = {int(h): i for i, h in enumerate(index.vocabulary.hashes)}
    texts = [r.text for r in docs.where("doc_id < 40").collect()]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", toxicity.score(F.col("text"), index).alias("s")).orderBy("i").collect()
    for text, r in zip(texts, got):
        words = re.findall(r"[0-9a-z]+", text.lower())
        q = np.zeros(d.shape[1])
        for w in set(words):
            if (i := of_hash.get(_batch.hash_of(w.encode()))) is not None:
                q[i] = (1 + np.log(words.count(w))) * index.vocabulary.weight[i]
        q /= np.linalg.norm(q)
        cosine = d @ q
        near = sorted(range(len(cosine)), key=lambda i: (-round(cosine[i], 6), i))[: toxicity.NEIGHBOURS]
        yes = 0.05 + sum(index.counts[i, 1] / (1 - min(cosine[i], 1) + toxicity.NEAR) for i in near if cosine[i] > 1e-9)
        total = 0.5 + sum(index.counts[i].sum() / (1 - min(cosine[i], 1) + toxicity.NEAR) for i in near if cosine[i] > 1e-9)
        assert r.s.score == pytest.approx(index.probability(yes / total), abs=0.02)
        assert [round(e.cosine, 4) for e in r.s.evidence] == pytest.approx([round(cosine[i], 4) for i in near[:3]], abs=2e-4)


def test_samples_hold_their_bound_with_repeated_ids_and_rows(spark):
    docs = spark.range(3_000).selectExpr("1L AS doc_id", "'same' AS text").union(spark.range(3_000).selectExpr("2L AS doc_id", "concat('text ', id) AS text"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "doc_id bigint, toxic int")
    rows = _labels.sample(docs, labels, "toxic", 10).collect()
    assert len(rows) == 10 and {r.y for r in rows} == {1} and len({(r.id, r.text) for r in rows}) == 10
    assert sorted(rows) == sorted(_labels.sample(docs.repartition(7), labels, "toxic", 10).collect())


def test_quality_on_held_out_and_identity(spark, tables):
    docs, labels = tables
    m = quality.fit(docs, labels)
    got = docs.select("doc_id", quality.score(F.col("text"), m).alias("s")).collect()
    assert all((r.s >= 0.3) == (r.doc_id % 5 != 0) for r in got if r.doc_id is not None and r.doc_id < 600 and held(r.doc_id))
    assert all(0 <= r.s <= 1 for r in got)
    # The sum-of-squares identity equals the sum over pairs.
    (of, bucket, share, stats), = list(quality.features(pa.array(["a b c a", "", None, "X! y"])))
    row, i, x = m.inputs(of, bucket, share, stats)
    z, _ = m.margin(row, i, x, 4)
    for k in range(4):
        mine = np.flatnonzero(row == k)
        pairs = sum(m.factor[i[a]] @ m.factor[i[b]] * x[a] * x[b] for a in mine for b in mine if a < b)
        assert z[k] == pytest.approx(m.bias + (m.weight[i[mine]] * x[mine]).sum() + pairs)


def test_nothing_labelled(spark, tables):
    docs, labels = tables
    none = labels.limit(0)
    assert {r.s for r in docs.select(quality.score(F.col("text"), quality.fit(docs, none)).alias("s")).collect()} == {0.5}
    assert {r.s.score for r in docs.select(toxicity.score(F.col("text"), toxicity.fit(docs, none)).alias("s")).collect()} == {0.5}
    empty = docs.limit(0)
    assert empty.select(quality.score(F.col("text"), None)).count() == 0
