from pyspark.sql import functions as F
import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skylattice.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+ -()9é0b\n", max_size=40))
def test_base_equals_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["a@b.c@d.e", "x@y@z.com", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+1 (980) 555-6268 ", "a@b", "1.2.3.999", "0001.2.3.4", "@@a@b.c", "9" * 5000 + "." + "a." * 50])
def test_base_examples(text):
    assert pii.base_spans(text) == plain(text)


def test_marginals_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    s = pii.STATES
    field = pii.Field(rng.normal(size=(pii.FEATURES, s)), rng.normal(size=(s, s)), rng.normal(size=(s, s)))
    n = pii.Nodes(np.zeros(4, int), np.arange(4), np.arange(4) + 1, rng.integers(0, pii.FEATURES, (4, 5)), np.array([True, False, False, False]), np.array([[1, 2], [1, 3]]))
    phi = field.unary[n.features].sum(axis=1)
    joint = np.zeros((s,) * 4)
    for y in itertools.product(range(s), repeat=4):
        joint[y] = np.exp(sum(phi[i, y[i]] for i in range(4)) + field.chain[y[0], y[1]] + field.skip[y[1], y[2]] + field.skip[y[1], y[3]])
    joint /= joint.sum()
    want = np.stack([joint.sum(axis=tuple(j for j in range(4) if j != i)) for i in range(4)])
    assert np.allclose(field.marginals(n), want, atol=5e-3)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"call +1 (980) 555-{1000 + i} or 10.0.{i % 250}.7 then mail me{i}@mail.example.com in {1900 + i % 99} x{i} ok") for i in range(200)]
    rows += [(900, "write to +1 (980) 555-6268 today. Later (980) 555-6268 again, and 980.555.6268"), (901, None), (902, ""), (903, "plain words only"), (903, "plain words only"), (None, "a@b.co"), (904, "7 " * 30000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_field_adds_repeats_and_keeps_base(spark, docs):
    got = pii.report(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        text = next(t for d, t in [(x.doc_id, x.text) for x in docs.collect()] if d == r.doc_id) or ""
        base = plain(text)
        assert r.base_sha256 == hashlib.sha256(pii.digest(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
        assert set(filter(None, pii.digest(base).split(","))) <= set(r.spans.split(","))
    by = {r.doc_id: r.spans for r in got}
    assert by[900].count("phone") >= 2 and by[903] == "" and by[902] == "" and by[901] == "" and by[904] == ""
    assert "card" not in by[5] and by[5].count(",") == 2


def test_redact(spark, docs):
    by = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert by[3] == "call <PHONE> or <IP> then mail <EMAIL> in 1903 x3 ok"
    assert by[901] is None and by[902] == "" and by[903] == "plain words only" and by[None] == "<EMAIL>"


def test_nothing_to_learn_from(spark):
    assert pii.report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    assert pii.report(spark.createDataFrame([(1, "words")], "doc_id bigint, text string")).first().spans == ""


def test_weights_hold_their_bound_however_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_DOCUMENTS", 20)
    monkeypatch.setattr(pii, "SAMPLE_WORDS", 150)
    rows = [(1, "mail a@b.example now 10.0.0.1")] * 3_000 + [(i, f"call +33 6 12 34 56 {i:02d} or user{i}@host.example at 192.168.0.{i % 250}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"h": F.lit("x"), "at": F.lit(1), "f": F.lit(2)})
    a, b = pii.fit(docs), pii.fit(docs.repartition(7))
    assert np.allclose(a.unary, b.unary) and np.allclose(a.skip, b.skip) and (a.unary != pii.NOTHING.unary).any()
    assert pii.redact(docs).columns == docs.columns
