import numpy as np
import pytest

from skylattice.operators import metrics

SCHEMA = "image bigint, cls int, ord bigint, x0 double, y0 double, x1 double, y1 double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0.0, w) * max(0.0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if inter else 0.0


def brute(preds, labels):
    """The measures by whole curves: {class: (n_labels, n_preds, p, r, ap50, ap)}."""
    right = {}
    for t, thr in enumerate(metrics.THRESHOLDS):
        claims = {}
        for image, cls, ord_, *box, score in preds:
            over = [(iou(box, l[3:]), -l[2], l[2]) for l in labels if l[:2] == (image, cls) and iou(box, l[3:]) >= thr]
            if over:
                claims.setdefault((image, cls, max(over)[2]), []).append((-score, ord_))
        for (image, cls, _), found in claims.items():
            right.setdefault((image, cls, min(found)[1]), set()).add(t)
    out, ps, rs = {}, {}, {}
    classes = sorted({l[1] for l in labels})
    for c in classes:
        mine = sorted((p for p in preds if p[1] == c), key=lambda p: (-p[-1], p[0], p[2]))
        n = sum(l[1] == c for l in labels)
        tp = np.array([[t in right.get((p[0], c, p[2]), ()) for t in range(10)] for p in mine]).reshape(-1, 10)
        conf = np.array([p[-1] for p in mine])
        if not mine:
            out[c], ps[c], rs[c] = [n, 0, [0.0] * 10], np.zeros(1000), np.zeros(1000)
            continue
        hits = tp.cumsum(axis=0)
        recall, precision = hits / n, hits / np.arange(1, len(mine) + 1)[:, None]
        aps = []
        for t in range(10):
            mrec, mpre = np.concatenate([[0.0], recall[:, t], [1.0]]), np.concatenate([[1.0], precision[:, t], [0.0]])
            mpre = np.maximum.accumulate(mpre[::-1])[::-1]
            x = np.linspace(0, 1, 101)
            y = np.interp(x, mrec, mpre)
            aps.append(float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum()))
        grid = np.linspace(0, 1, 1000)
        rs[c], ps[c] = np.interp(-grid, -conf, recall[:, 0], left=0), np.interp(-grid, -conf, precision[:, 0], left=1)
        out[c] = [n, len(mine), aps]
    f1 = np.mean([2 * ps[c] * rs[c] / (ps[c] + rs[c] + 1e-16) for c in classes], axis=0)
    padded = np.concatenate([np.full(50, f1[0]), f1, np.full(50, f1[-1])])
    i = int(np.round(np.convolve(padded, np.ones(101) / 101, "valid"), 12).argmax())
    return {c: (n, m, ps[c][i], rs[c][i], aps[0], float(np.mean(aps))) for c, (n, m, aps) in out.items()}


def drawn(seed, images=12, missing=0.2, noise=0.15):
    rng = np.random.default_rng(seed)
    labels, preds = [], []
    for k in range(120):
        image, cls = int(rng.integers(images)), int(rng.integers(3))
        x, y, w, h = (*rng.uniform(0, 300, 2).tolist(), *rng.uniform(2, 90, 2).tolist())
        labels.append((image, cls, k, x, y, x + w, y + h))
        for _ in range(int(rng.integers(0, 4)) if rng.random() > missing else 0):
            d = (rng.normal(0, noise, 4) * [w, h, w, h]).tolist()
            preds.append((image, cls if rng.random() > 0.1 else (cls + 1) % 3, len(preds), x + d[0], y + d[1], x + w + d[2], y + h + d[3], float(rng.integers(0, 40)) / 40))
    return preds, labels


@pytest.mark.parametrize("seed,noise", [(1, 0.02), (2, 0.1), (3, 0.3)])
def test_measures_match_whole_curves(spark, seed, noise):
    preds, labels = drawn(seed, noise=noise)
    got = {r.cls: tuple(r)[1:] for r in metrics.by_class(spark.createDataFrame(preds + preds[:9], SCHEMA + ", score double").repartition(5), spark.createDataFrame(labels + labels[:4], SCHEMA)).collect()}
    want = brute(preds, labels)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c][:2] == want[c][:2] and np.allclose(got[c][2:], want[c][2:], atol=1e-9), (c, got[c], want[c])


def test_cells_lose_no_pair(spark):
    rng = np.random.default_rng(8)
    box = lambda n: [(0, 0, i, x, y, x + w, y + h) for i, (x, y, w, h) in enumerate(np.column_stack([rng.uniform(-50, 50, (n, 2)), 2 ** rng.uniform(-3, 6, (n, 2))]).tolist())]
    a, b = box(700), box(700)
    b += [(*r[:2], 1000 + r[2], r[3] * 1.01, *r[4:]) for r in a[:300]] + [(0, 0, 2000 + i, 0.0, 0.0, 2.0**i, 2.0**-i) for i in range(-4, 5)]
    a += [(0, 0, 2000 + i, 0.0, 0.0, 2.0**i * 2, 2.0**-i) for i in range(-4, 5)] + [(0, 0, 3000, 1.0, 1.0, 1.0, 5.0)]
    a = [r for r in a if r[5] > r[3]] + [a[-1]]
    for least in (0.5, 0.3):
        pairs = metrics.overlapping(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), least).collect()
        want = {(p[2], q[2]) for p in a for q in b if iou(p[3:], q[3:]) >= least}
        assert len(pairs) == len({(r.pred, r.label) for r in pairs}) and {(r.pred, r.label) for r in pairs} == want and len(want) > 300


def test_perfect_none_and_empty(spark):
    _, labels = drawn(4)
    perfect = [(*l, 0.9 - l[2] / 1000) for l in labels]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA + ", score double")
    known = spark.createDataFrame(labels, SCHEMA)
    top = metrics.summary(metrics.by_class(frame(perfect), known)).first()
    assert top.mp == 1.0 and top.mr == 1.0 and top.verdict == "ATTEINT" and abs(top.map50 - brute(perfect, labels)[0][4]) < 1e-9 > abs(top.map - top.map50)
    none = metrics.summary(metrics.by_class(frame([]), known)).first()
    assert tuple(none) == (0.0, 0.0, 0.0, 0.0, "NON ATTEINT")
    assert tuple(metrics.summary(metrics.by_class(frame(perfect), known.limit(0))).first()) == (None,) * 5
    odd = frame([(None, 0, 1, 0.0, 0.0, 1.0, 1.0, 0.5), (1, 0, 2, 0.0, 0.0, 1.0, 1.0, None), (1, 9, 3, 0.0, 0.0, 1.0, 1.0, 0.7)])
    assert metrics.summary(metrics.by_class(odd, known)).first().mp == 0.0


def test_cells_are_never_broadcast(spark):
    boxes = spark.createDataFrame([(0, 0, 1, 0.0, 0.0, 2.0, 2.0)], SCHEMA)
    plan = metrics.overlapping(boxes, boxes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_boxes_are_moved_once(spark):
    from skylattice import queries

    plan = metrics.judged(*queries._boxes(spark, "/root/testdata/sf0.01"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # lines with orders, and labels


@pytest.mark.parametrize("least", [0.5, 0.3])
def test_crowded_image_finds_each_best_label(monkeypatch, least):
    monkeypatch.setattr(metrics, "PAIRS", 1000)
    rng = np.random.default_rng(6)
    box = lambda n, top: np.column_stack([at := rng.uniform(-8, 8, (n, 2)), at + 2 ** rng.uniform(-1, top, (n, 2))])
    labels = np.concatenate([box(900, 4), some := box(300, 1), some])
    boxes = np.concatenate([box(500, 5), labels[::5] + rng.normal(0, 0.05, (300, 4)), some[:50], box(1, 9)])
    boxes = boxes[(boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])]
    look = metrics._Labels(labels, least)
    assert len(look.steps) > 1 and len(boxes) * len(labels) > metrics.FEW
    at, over = look.best(boxes)
    all_ = np.array([[iou(b, l) for l in labels.tolist()] for b in boxes.tolist()])
    most = all_.max(axis=1)
    assert np.array_equal(at, np.where(most >= least, all_.argmax(axis=1), -1)) and np.allclose(over, np.where(most >= least, most, 0), rtol=0, atol=1e-12) and (at < 0).any() and (at >= 900).sum() > 50
