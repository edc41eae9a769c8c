import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.llm import repeats


def brute(rows, length):
    """(id, n_bytes, n_removed, n_spans, sha) of rows (id, text) with distinct ids."""
    seen, out = set(), []
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        runs = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, length, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(1, 9)))
    passage = [" ".join(word() for _ in range(40)) for _ in range(4)]
    texts = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(3)]
        p = r.choice(passage)
        a, b = sorted(r.sample(range(len(p)), 2))
        texts.append(parts[0] + p[a:b] + parts[1] + (p if r.random() < 0.5 else "") + parts[2])
    texts += texts[:5] + [t[: len(t) // 2] + "X" + t[len(t) // 2 :] for t in texts[:8]] + ["ab" * 200, "ab" * 210, "z" * 500, "", None, "short"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,entries,split,length", [(1, 50_000, 2_000, 100), (2, 50_000, 2, 100), (3, 2, 2, 100), (4, 50_000, 1, 57)])
def test_matches_brute_force(spark, seed, entries, split, length, monkeypatch):
    """Whole grams, grams dealt out again by cuts, and groups of windows give the same spans."""
    monkeypatch.setattr(repeats.spans, "__defaults__", (100, repeats.GRAM, entries, split))
    rows = corpus(seed, length)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.lit(1)).withColumn("s", F.lit("x"))
    got = sorted((tuple(r) for r in repeats.report(docs, length).collect()), key=str)
    assert got == brute(rows, length)


def common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_maximal_repeats_have_all_pairs():
    r = random.Random(5)
    make = lambda: bytes(r.choice(b"ab") for _ in range(r.randint(0, 6)))
    group = np.sort(np.array([r.randint(0, 40) for _ in range(300)]))
    left, right = [make() for _ in group], [make() for _ in group]
    got = {(i, j): set() for i in range(300) for j in range(i) if group[i] == group[j]}
    for a, b, members in repeats.maximal_repeats(group, left, right, 5):
        assert len({left[m][:a] for m in members}) == 1 == len({right[m][:b] for m in members})
        for i in members:
            for j in members:
                if j < i:
                    got[i, j].add((a, b))
    for (i, j), sets in got.items():
        a, b = common(left[i], left[j]), common(right[i], right[j])
        assert ((a, b) in sets) == (a + b >= 5), (left[i], left[j], right[i], right[j])


def test_a_long_text_is_cut_into_slices_alike(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 105, 30_000).astype(np.uint8)
    off = np.array([0, len(data)])
    want = repeats.anchors(data, off, 100)
    monkeypatch.setattr(repeats, "_PLACE_BITS", 12)
    got = repeats.anchors(data, off, 100)
    # Fewer place bits keep more hash bits: the anchors may only differ where 42 bits tie, which is nowhere here.
    pairs = lambda x: sorted(set(zip(x[1].tolist(), x[2].tolist(), x[3].tolist())))
    assert pairs(got) == pairs(want)


def test_repeated_rows_nulls_and_removal(spark):
    a, b = "".join(chr(97 + i * i % 23) for i in range(150)), "x" * 20
    docs = spark.createDataFrame([(1, a), (1, a), (2, b + a), (None, a + "é"), (3, None)], "doc_id bigint, text string")
    got = sorted((tuple(r)[:4] for r in repeats.report(docs).collect()), key=str)
    n = brute([(1, a)], 100)[0][2]
    assert got.count((1, 150, n, int(n > 0))) == 2 and (3, 0, 0, 0) in got
    assert (2, 170, 150, 1) in got and (None, 152, 150, 1) in got
    out = {r.doc_id: r.text for r in repeats.remove(docs).collect()}
    assert out[2] == b and out[None] == "é" and out[3] is None
    assert repeats.report(docs.limit(0)).count() == 0


def test_clashing_columns_and_text_ids(spark):
    a = "".join(chr(97 + i * i % 23) for i in range(150))
    docs = spark.createDataFrame([("1", a, "keep", 5, 6, 7), ("2", a, "too", 8, 9, 10)], "doc_id string, text string, row string, d int, t int, ranges int")
    out = sorted(map(tuple, repeats.remove(docs).collect()))
    assert [r[0] for r in out] == ["1", "2"] and [r[2:] for r in out] == [("keep", 5, 6, 7), ("too", 8, 9, 10)] and out[1][1] == ""


def passage(seed, n=150):
    r = random.Random(seed)
    return "".join(r.choice("abcdefgh") for _ in range(n))


def test_texts_of_one_id_are_told_apart(spark):
    """Many texts without id, and several of one id: only what also stands before them goes."""
    p = passage(0)
    rows = [(1, p), (None, passage(1) + p), (2, passage(2)), (2, p + passage(3)), (2, passage(4))]
    rows += [(None, f"{passage(10 + i, 157)}") for i in range(3000)]
    got = {}
    for r in repeats.report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed))
    assert got[1] == [(150, 0)] and sorted(got[2]) == [(150, 0), (150, 0), (300, 150)]
    assert sorted(got[None]) == [(157, 0)] * 3000 + [(300, 150)]


def test_places_of_texts_with_null_ids_stay_apart(spark):
    """Of null ids none is earlier: a passage twice in one text goes once there and stays in the other."""
    p = passage(5)
    rows = [(None, p + "-" + p), (None, "+" * 30 + p), (None, p)]
    got = sorted((r.n_bytes, r.n_removed) for r in repeats.report(spark.createDataFrame(rows, "doc_id int, text string")).collect())
    assert got == [(150, 0), (180, 0), (301, 150)]


@pytest.mark.parametrize("kind,ids", [("string", ["b", "a", "x1", None, "10", "9"]), ("double", [2.5, -1.0, 7.0, None, 3.0, 2.0]), ("date", None), ("decimal(20,2)", None)])
def test_ids_of_any_type_stand_in_their_order(spark, kind, ids):
    import datetime
    import decimal

    ids = ids or ([datetime.date(2020, 1, i) for i in (5, 3, 9, 7, 8, 1)] if kind == "date" else [decimal.Decimal(i) for i in (5, 3, 9, 7, 8, 1)])
    p = passage(6)
    rows = [(i, passage(20 + k) + str(k) + p) for k, i in enumerate(ids)]
    got = {r.doc_id: r.n_removed for r in repeats.report(spark.createDataFrame(rows, f"doc_id {kind}, text string")).collect()}
    first = min(i for i in ids if i is not None)
    assert got == {i: 0 if i == first else 150 for i in ids}
