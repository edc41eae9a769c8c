import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from skylattice.llm import lm


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(rows):
    c = Counter()
    for d, t in rows:
        if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        tokens = [*words(t), None]
        held = zlib.crc32(str("" if d is None else d).encode()) % 5 == 1
        out.append((d, held, len(tokens), sum(c[x] > 0 for x in tokens), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens), 6)))
    return sorted(out, key=str)


def corpus():
    rng = np.random.default_rng(0)
    vocabulary = [a + b for a in ("thé", "Ab", "zo", "ki", "rn") for b in ("x", "yt", "qua", "", "lo", "12,", "m")]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 90)))) for i in range(150)]
    return rows + [(500, None), (501, ""), (502, " \t\n"), (503, "word " * 5000), (None, "zo zo nowhere"), (504, "unseen<|endoftext|>  x"), rows[0], rows[0]]


@pytest.mark.parametrize("common", [10**6, 7, 0])
def test_base_and_counts_match_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(lm.train, "__defaults__", (2, 64, 0.01))
    rows = corpus()
    got = lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), common=common).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == brute(rows)
    assert all(r.score < 0 and r.model_score < 0 for r in got)


def small_model(seed=0, scale=0.5):
    rng = np.random.default_rng(seed)
    bucket = np.minimum(np.arange(lm.VOCABULARY), lm.IDS - 1)
    bucket[lm.END] = 5
    group = rng.integers(0, lm.CLASSES, lm.IDS)
    group[: lm.CLASSES] = np.arange(lm.CLASSES)
    pair = rng.random((lm.IDS, lm.IDS))
    pair /= pair.sum(axis=1, keepdims=True)
    shared = np.bincount(bucket, minlength=lm.IDS)
    classes = np.stack([np.bincount(group, weights=r, minlength=lm.CLASSES) for r in pair])
    normal = lambda *s: rng.normal(0, scale, s)
    return lm.Model(bucket, group, np.log(pair), -np.log(shared[bucket]), np.log(classes), normal(lm.IDS, lm.WIDTH), normal(lm.WINDOW, lm.WIDTH), *(normal(lm.WIDTH, lm.WIDTH) for _ in range(3)), normal(lm.WIDTH, lm.CLASSES))


def test_next_id_probabilities_sum_to_one():
    m = small_model()
    context = np.array([3, 900, 77, 2000])
    nexts = np.arange(lm.VOCABULARY)
    for pick in (0, 4):
        texts = [np.concatenate([context[:pick], [x]]) for x in nexts]
        off = np.arange(len(texts) + 1) * (pick + 1)
        logs = m.log_probabilities(np.concatenate(texts), off)
        assert abs(np.exp(logs[pick :: pick + 1]).sum() - 1) < 1e-4


def test_windows_score_each_id_once_with_causal_context():
    m = small_model(1)
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 3000, 200)
    alone = m.log_probabilities(ids, np.array([0, 200]))
    both = m.log_probabilities(np.concatenate([ids[:50], ids]), np.array([0, 50, 250]))
    assert np.allclose(both[50:], alone, atol=1e-4) and np.allclose(both[:50], alone[:50], atol=1e-4)
    later = ids.copy()
    later[120:] = 7
    assert np.allclose(m.log_probabilities(later, np.array([0, 200]))[:120], alone[:120], atol=1e-4)


def plain(m, text):
    """Natural logs of one text's ids by loops over ids, windows and positions."""
    x = [int(m.bucket[i]) for i in [lm.END, *text[:-1].tolist()]]
    out = []
    for t, i in enumerate(text.tolist()):
        start = 0 if t < lm.WINDOW else -(-(t - lm.WINDOW + 1) // lm.STRIDE) * lm.STRIDE
        q = (m.embed[x[t]] + m.place[t - start]) @ m.q / np.sqrt(lm.WIDTH)
        weights, values = [], []
        for s in range(start, t + 1):
            e = m.embed[x[s]] + m.place[s - start]
            weights.append(math.exp(q @ (e @ m.k)))
            values.append(e @ m.v)
        h = sum(w * v for w, v in zip(weights, values)) / sum(weights)
        z = m.group_pair[x[t]] + h @ m.out
        b = m.bucket[i]
        g = m.group[b]
        log_class = z[g] - math.log(sum(math.exp(v) for v in z))
        out.append(log_class + m.pair[x[t], b] - m.group_pair[x[t], g] + m.within[i])
    return out


def test_attention_equals_plain_loops():
    m = small_model(4)
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 3000, n) for n in (1, 31, 32, 33, 100)]
    got = m.log_probabilities(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert np.allclose(got, np.concatenate([plain(m, t) for t in texts]), atol=2e-3)


def test_gradients_are_those_of_the_loss():
    m = small_model(6, 0.3)
    rng = np.random.default_rng(7)
    xs, ys = rng.integers(0, lm.IDS, (3, lm.WINDOW)), rng.integers(0, lm.CLASSES, (3, lm.WINDOW))
    valid = np.arange(lm.WINDOW) < np.array([[32], [7], [20]])
    p = {n: getattr(m, n).astype(np.float64) for n in lm._PARAMETERS}

    def loss(p):
        e = p["embed"][xs] + p["place"]
        a = np.where(np.tri(lm.WINDOW, dtype=bool), (e @ p["q"]) @ (e @ p["k"]).transpose(0, 2, 1) / np.sqrt(lm.WIDTH), -1e9)
        a = np.exp(a - a.max(axis=2, keepdims=True))
        z = m.group_pair[xs] + (a / a.sum(axis=2, keepdims=True)) @ (e @ p["v"]) @ p["out"]
        return -((np.take_along_axis(z, ys[..., None], 2)[..., 0] - np.log(np.exp(z).sum(axis=2))) * valid).sum()

    g, n = lm.gradients(p, m.group_pair, xs, ys, valid)
    assert n == 59
    for name in lm._PARAMETERS:
        at = tuple(rng.integers(0, s) for s in p[name].shape) if name != "embed" else (xs[0, 3], 2)
        up, down = ({**p, name: p[name].copy()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert g[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-6)


@pytest.mark.parametrize("scale", [0.3, 3.0])
def test_gradients_in_floats_equal_those_in_doubles(scale):
    m = small_model(8, scale)
    rng = np.random.default_rng(9)
    xs, ys = rng.integers(0, lm.IDS, (5, lm.WINDOW)), rng.integers(0, lm.CLASSES, (5, lm.WINDOW))
    valid = np.ones(xs.shape, np.float32)
    # Far-off numbers are led to 0 before powers of e are taken, near ones aren't.
    assert lm._wide(m.embed @ m.q @ m.k.T @ m.embed.T) == (scale > 1)
    (f, _), (d, _) = (lm.gradients({n: getattr(m, n).astype(kind) for n in lm._PARAMETERS}, m.group_pair.astype(kind), xs, ys, valid.astype(kind)) for kind in (np.float32, np.float64))
    assert all(np.isfinite(f[n]).all() and np.abs(f[n] - d[n]).max() <= 0.02 * np.abs(d[n]).max() for n in lm._PARAMETERS)


def test_training_lowers_the_loss_however_rows_are_dealt(spark):
    text = "alpha beta gamma delta " * 60
    df = spark.createDataFrame([(text + str(i),) for i in range(12)], "text string")
    path = lm.default_path()
    m = lm.corpus_model(lm.counts(df, "text", path).where("kind = 1"), path)
    ids, off = lm.encode([text.encode()], path)
    m.group_pair[:] = np.log(1 / lm.CLASSES)
    a = lm.train(m, df, "text", path, rounds=4, deal=40, rate=0.05)
    b = lm.train(m, df.repartition(5), "text", path, rounds=4, deal=40, rate=0.05)
    assert a.log_probabilities(ids, off).mean() > lm.Model(*(getattr(m, f) for f in m.__dataclass_fields__)).log_probabilities(ids, off).mean() + 0.5
    assert np.allclose(a.out, b.out, atol=1e-6)


@pytest.mark.parametrize("gather", [8_192, 2])
def test_shares_hold_every_window_once_with_its_count(spark, monkeypatch, gather):
    monkeypatch.setattr(lm, "GATHER", gather)
    path = lm.default_path()
    texts = [t for _, t in corpus()] * 2 + ["one " * 31, "one " * 32, "one " * 33]
    bucket = np.arange(lm.VOCABULARY) % 300
    want = Counter()
    for text in texts:
        ids = [lm.END, *lm.encode([(text or "").encode()], path)[0].tolist()]
        for i in range(0, len(ids) - 1, lm.WINDOW):
            own = [int(bucket[x]) for x in ids[i : i + lm.WINDOW + 1]]
            want[tuple(own + [-1] * (lm.WINDOW + 1 - len(own)))] += 1
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    deals = []
    for docs in (df, df.repartition(7)):
        got = lm.windows(docs, "text", path, bucket, 3, 5).collect()
        assert {r["round"] for r in got} == {0, 1, 2} and all(0 < r.n <= 5 for r in got)
        led = [np.frombuffer(r.led, np.int16).reshape(r.n, -1).tolist() for r in got]
        found = [(tuple(w), n) for r, l in zip(got, led) for w, n in zip(l, np.frombuffer(r.times, np.int64).tolist())]
        assert len(found) == len(want) and dict(found) == want
        deals.append(sorted((r["round"], l) for r, l in zip(got, led)))
    assert deals[0] == deals[1]


def test_texts_with_ids_are_not_encoded_again(spark):
    path = lm.default_path()
    with_ids = lm.encoded(spark.createDataFrame([("zo ki",), (None,)], "text string"), "text", path)
    assert sorted((r.size, len(r.ids)) for r in with_ids.collect()) == [(1, 2), (len(lm.encode([b"zo ki"], path)[0]), 2 * len(lm.encode([b"zo ki"], path)[0]))]
    other = spark.createDataFrame([("zo ki", np.array([7, 9, lm.END], np.uint16).tobytes(), 3)], "text string, ids binary, size bigint")
    assert sorted((r.key >> 32, r.key & 0xFFFFFFFF) for r in lm.counts(other, "text", path).where("kind = 1").collect()) == [(7, 9), (9, lm.END), (lm.END, 7)]


def test_far_off_numbers_leave_scores_finite():
    m = small_model(4, 3.0)
    ids = np.random.default_rng(5).integers(0, 3000, 100)
    m._out = m._out * 0  # the classes' sums of powers of e are another matter
    assert np.isfinite(m.log_probabilities(ids, np.array([0, 100]))).all()


@pytest.mark.parametrize("common", [10**6, 3])
def test_scores_mix_word_and_base_by_brute_force(spark, monkeypatch, common):
    seen = {}
    monkeypatch.setattr(lm, "train", lambda m, *a, **k: seen.setdefault("m", m))
    rows = corpus() + [(600, "no\u00a0 break \u00a0space\u00a0 \u00a0 here"), (601, "a" * 3000 + " zo")]
    got = {(r.doc_id, r.n_tokens): r for r in lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), common=common).collect()}
    c = Counter()
    for d, t in rows:
        if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1:
            c.update([*words(t), None])
    n = sum(c.values())
    for d, t in rows:
        ids, off = lm.encode([(t or "").encode()], lm.default_path())
        logs = seen["m"].log_probabilities(ids, off)
        begin = np.flatnonzero(lm.heads(lm.default_path())[ids])
        own = np.add.reduceat(logs, begin)
        tokens = [*words(t), None]
        assert len(own) == len(tokens)
        want = sum(math.log10((1 - lm.MIX) * math.exp(s) + lm.MIX * c[w] / n) if s > -600 else s / math.log(10) + math.log10(1 - lm.MIX) for w, s in zip(tokens, own))
        assert got[d, len(tokens)].score == pytest.approx(want, rel=1e-4, abs=1e-3)
        assert got[d, len(tokens)].model_score == pytest.approx(own.sum() / math.log(10), rel=1e-4, abs=1e-3)


def test_long_words_that_sums_of_powers_confuse_are_told_apart(spark):
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame([(0, a), (2, "x"), (5, b)], "doc_id bigint, text string")).collect()}
    assert [zlib.crc32(str(i).encode()) % 5 == 1 for i in (0, 2, 5)] == [got[i].held_out for i in (0, 2, 5)]
    trained = {w for i, w in ((0, a), (2, "x"), (5, b)) if not got[i].held_out}
    assert all(got[i].n_known == 1 + (w in trained) for i, w in ((0, a), (5, b)))
    from skylattice.llm import _batch

    assert _batch.hash_of(a.encode()) != _batch.hash_of(b.encode())


def test_empty(spark):
    assert lm.score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_words_are_encoded_once_while_the_process_keeps_them(monkeypatch):
    path = lm.default_path()
    real, seen = lm.encoder(path), []

    class Encoder:
        def encode_to_numpy(self, text):
            seen.append(text)
            return real.encode_to_numpy(text)

    monkeypatch.setattr(lm, "_words", lm.defaultdict(lm._Words))
    lm.heads(path)
    monkeypatch.setattr(lm, "encoder", lambda path: Encoder())
    first = lm.encode([b"Zo ki zo", b"", b"ki rn"], path)
    again = lm.encode([b"Zo ki zo", b"", b"ki rn"], path)
    assert sorted(seen[0].split()) == ["ki", "rn", "zo"] and len(seen) == 1
    assert all(np.array_equal(a, b) for a, b in zip(first, again))
    lm.encode([b"rn new"], path)
    assert seen[1:] == [" new"]


@pytest.mark.parametrize("most", [1, 6, 40, 1 << 19])
def test_ids_are_those_of_each_word_however_many_are_kept(monkeypatch, most):
    path = lm.default_path()
    monkeypatch.setattr(lm, "_words", lm.defaultdict(lm._Words))
    monkeypatch.setattr(lm._Words, "BITS", 5)  # words take each other's slots
    monkeypatch.setattr(lm, "MET", most)
    texts = [t.encode() for _, t in corpus() if t] + ["no\u00a0 break \u00a0space\u00a0 \u00a0 here".encode(), b"", b" \t\n"]
    for low in range(0, len(texts), 10):
        own = texts[low : low + 10]
        ids, at = lm.encode(own, path)
        want = [[*(int(x) for w in t.lower().split() for x in lm._word_ids(w, path)), lm.END] for t in own]
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_weights_of_queries_and_keys_are_one_product():
    m = small_model(3)
    assert m._tokens.shape[1] == 2 * lm.WIDTH
    assert np.allclose(m._tokens[:, : lm.WIDTH] @ m._tokens[:, lm.WIDTH :].T, (m.embed @ m.q) @ (m.embed @ m.k).T / np.sqrt(lm.WIDTH), atol=1e-3)
