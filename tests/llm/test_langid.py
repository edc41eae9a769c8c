import math

import pytest
from pyspark.sql import functions as F

from skylattice.llm import langid

EN = ["the house and the river of the king", "this is the end of that thing and the other", "where are they going with the others"]
FR = ["la maison et le fleuve du roi", "ceci est la fin de cette chose et les autres", "elle était très belle dans la forêt"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t * 3, "en") for t in EN] + [(t * 3, "fr") for t in FR] + [(None, "en"), ("", None), ("no label", None)]
    return langid.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_model_equals_direct_counts(model):
    import numpy as np
    import pyarrow as pa

    assert sorted(model.languages) == ["en", "fr"]
    e = model.languages.index("en")
    counts = np.zeros(langid.BUCKETS)
    for t in EN:
        raw = np.frombuffer((t * 3).encode(), np.uint8)
        np.add.at(counts, langid._trigrams(raw, np.array([0, len(raw)]))[1], 1)
    assert np.allclose(model.scores[:, e], np.log((counts + 0.5) / (counts + 0.5).sum()), atol=1e-5)
    whole = model.log_likelihoods(pa.array(["the king", "le roi"]))
    apart = np.concatenate([model.log_likelihoods(pa.array([x])) for x in ("the king", "le roi")])
    assert np.allclose(whole, apart)


def test_texts_and_edge_cases(spark, model):
    rows = [(1, "the king of the river", None), (2, "la forêt et les autres", None), (3, None, None), (4, "", None), (5, "12345 !!", None), (6, "the king " * 20000, None), (None, "the other thing", None), (1, "the king of the river", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, language string")
    got = langid.identify(df, model, F.col("text")).collect()
    assert len(got) == 8
    by = {r.doc_id: r.language for r in got}
    assert by[1].lang == "en" and by[2].lang == "fr" and by[6].lang == "en" and by[None].lang == "en"
    assert all(by[i].lang == "und" and by[i].text_lang is None for i in (3, 4, 5))
    assert sorted(str(r.doc_id) for r in langid.accept(df, model, F.col("text")).collect()) == ["1", "1", "2", "6", "None"]
    assert langid.identify(df.limit(0), model, F.col("text"), host=F.lit("a.b")).count() == 0


def test_host_and_markup_decide_short_texts(spark, model):
    rows = [(i, "la maison et le fleuve", "fr", "http://x.blog.fr/a") for i in range(30)] + [(i + 100, "the king of the river", "en", "http://y.site.com/b") for i in range(30)]
    rows += [(900, "", "fr", "http://x.blog.fr/c"), (901, "42", None, "http://y.site.com/c"), (902, "", "fr", None)]
    df = spark.createDataFrame(rows, "page_id int, text string, declared string, url string")
    got = {r.page_id: r.language for r in langid.identify(df, model, F.col("text"), F.col("declared"), langid.host_of(F.col("url"))).collect()}
    assert got[900].lang == "fr" and got[901].lang == "en" and got[902].lang == "fr"
    assert got[0].lang == "fr" and math.isclose(got[900].posterior, 1, abs_tol=0.2)


def test_html(spark):
    page = "<!DOCTYPE html><HTML class=x LANG='FR-ca'><style>p{}</style><p>a&amp;b</p><script>var t='</p>';</script><!-- no --></html>"
    r = spark.createDataFrame([(page,), (None,)], "h string").select(langid.visible_text(F.col("h")).alias("t"), langid.declared_language(F.col("h")).alias("d"), langid.host_of(F.lit("https://u@WWW.a.org:80/x")).alias("u")).collect()
    assert r[0].t.split() == ["a&b"] and r[0].d == "fr" and r[1].t is None and r[1].d is None and r[0].u == "www.a.org"


def test_unlabelled_knows_only_und(spark):
    m = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert [r.language.lang for r in langid.identify(spark.createDataFrame([("abc",)], "text string"), m, F.col("text")).collect()] == ["und"]


def test_every_labelled_language_is_known(spark, monkeypatch):
    import numpy as np

    # More languages than a task holds at once and than 64; the last ones are the rarest.
    r = np.random.default_rng(4)
    words = [["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(8)] for _ in range(70)]
    rows = [(k * 10 + i, " ".join(r.permutation(words[k])), f"l{k:02d}") for k in range(70) for i in range(5 if k < 60 else 3)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    monkeypatch.setattr(langid, "HELD_LANGUAGES", 7, raising=False)
    m = langid.fit(df)
    assert sorted(m.languages) == [f"l{k:02d}" for k in range(70)]
    assert langid.accept(df, m, F.col("text")).count() == len(rows)
    assert all(x.language.lang == x.lang for x in langid.identify(df, m, F.col("text")).collect())


def test_fusion_equals_brute_force(spark, model):
    """Text, declared language and the hierarchy of host priors, each row's own share left out."""
    import numpy as np
    import pyarrow as pa

    hosts = ["a.news.fr", "b.news.fr", "x.site.com", "y.site.com", "solo", None]
    texts = [*EN, *FR, "the", "le", "", None, "123", "la the"]
    rows = [(i, texts[i * 7 % len(texts)], ["fr", "en", None, "xx"][i * 3 % 4], hosts[i * 5 % 6]) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id int, text string, said string, host string")
    got = {r.page_id: r.language for r in langid.identify(df, model, F.col("text"), F.col("said"), F.col("host")).collect()}
    names = [*model.languages, langid.UNKNOWN]
    k = len(names)
    ll = model.log_likelihoods(pa.array([r[1] for r in rows], pa.string()))
    own = np.zeros((60, k))
    for i, x in enumerate(ll):
        if x.max() != x.min():
            own[i] = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    levels = [lambda h: h.split(".")[-1], lambda h: ".".join(h.split(".")[-2:]), lambda h: h]
    said = np.full((k + 1, k), 0.5)
    for (_, _, d, _), p in zip(rows, own):
        if d is not None:
            said[names.index(d) if d in names else k] += p
    said = np.log(said / said.sum(axis=0))
    for i, (page, _, d, h) in enumerate(rows):
        prior = np.maximum(own.sum(axis=0) + 1 / k - own[i], 1e-9)
        prior /= prior.sum()
        for level in levels if h is not None else []:
            counts = sum((own[j] for j, r in enumerate(rows) if r[3] is not None and level(r[3]) == level(h)), np.zeros(k)) - own[i]
            counts = np.maximum(counts, 0)
            prior = (counts + langid.STRENGTH * prior) / (counts.sum() + langid.STRENGTH)
        score = ll[i] + np.log(np.maximum(prior, 1e-12)) + (0 if d is None else said[names.index(d) if d in names else k])
        best = int(score.argmax())
        if not own[i].any() and d is None and h is None:
            assert got[page].lang == langid.UNKNOWN and got[page].posterior == 0
            continue
        assert got[page].lang == names[best]
        assert got[page].posterior == pytest.approx(1 / np.exp(score - score[best]).sum(), abs=1e-5) and got[page].prior == pytest.approx(prior[best], abs=1e-6)
        assert (got[page].text_lang is None) == (not own[i].any())


def test_accept_keeps_clashing_columns(spark, model):
    df = spark.createDataFrame([(1, EN[0], "a", "b", "c")], "doc_id int, text string, language string, _language string, _row string")
    assert [tuple(r) for r in langid.accept(df, model, F.col("text")).collect()] == [(1, EN[0], "a", "b", "c")]
