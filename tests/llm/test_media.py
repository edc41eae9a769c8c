import numpy as np
import pytest

from skylattice.llm import media


def sampled(a, y, x):
    y0, x0 = np.floor(y).astype(int).clip(0, a.shape[0] - 2), np.floor(x).astype(int).clip(0, a.shape[1] - 2)
    fy, fx = y - y0, x - x0
    return a[y0, x0] * (1 - fy) * (1 - fx) + a[y0 + 1, x0] * fy * (1 - fx) + a[y0, x0 + 1] * (1 - fy) * fx + a[y0 + 1, x0 + 1] * fy * fx


def texture(seed, n=120):
    rng = np.random.default_rng(seed)
    a = rng.random((n // 6 + 2, n // 6 + 2)) * 255
    at = np.linspace(0, a.shape[0] - 1.01, n)
    return sampled(a, at[:, None] + np.zeros(n), at[None] + np.zeros((n, 1)))


def row(i, a):
    a = np.clip(a, 0, 255).round().astype(np.uint8)
    return (i, a.tobytes(), a.shape[1], a.shape[0])


def turned(a, degrees):
    n = a.shape[0]
    y, x = np.mgrid[0:n, 0:n] - (n - 1) / 2
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    return sampled(a, np.clip(s * x + c * y + (n - 1) / 2, 0, n - 1), np.clip(c * x - s * y + (n - 1) / 2, 0, n - 1))


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(9)
    rows = [row(i, texture(i)) for i in range(20)]
    a = texture(0)
    rows += [row(100, a[20:110, 10:115]), row(101, a * 0.7 + 30), row(102, a + rng.normal(0, 3, a.shape)), row(103, turned(a, 20)), row(104, a), row(104, a)]
    rows += [row(105, texture(3)[:90, 25:])]
    rows += [(200, None, 10, 10), (201, b"", 0, 0), (202, b"abc", 5, 5), (203, bytes(4096), 64, 64), (204, bytes(4096), 64, 64), (205, None, None, None), (None, b"x" * 100, 10, 10)]
    return spark.createDataFrame(rows, "image_id bigint, pixels binary, width int, height int")


def test_edited_copies_meet_and_others_do_not(groups):
    got = media.copies(groups).collect()
    assert len(got) == groups.count()
    group = {r.image_id: r.component_id for r in got}
    assert [group[i] for i in (100, 101, 102, 103, 104)] == [0] * 5 and group[105] == 3
    assert all(group[i] == i for i in range(20))
    assert group[203] == group[204] == 203 and group[200] == 200 and group[205] == 205 and group[202] == 202
    assert {r.image_id: r.n_copies for r in got}[7] == 1 and {r.image_id: r.n_copies for r in got}[0] == 7 and sum(r.image_id == 104 for r in got) == 2
    assert {r.image_id: r.n_corners for r in got}[203] == 0


def of(a):
    c = media.corners(np.clip(a, 0, 255).round().astype(np.uint8)[None])
    c.pop("image")
    return c


def test_descriptors_turn_with_the_image():
    a = texture(5)
    p, q = of(a), of(a[::-1, ::-1])
    assert media.inliers(p, q) >= 12 and media.inliers(p, q) == media.inliers(q, p)
    assert media.inliers(p, of(texture(6))) < media.LEAST_INLIERS


def test_crops_to_a_quarter_and_smaller_copies_of_large_images():
    for seed in range(4):
        a = texture(seed, 400)
        whole = of(a)
        at = np.arange(200) * 2 + 0.5
        small = sampled(sampled(a, *np.meshgrid(np.arange(400.0), np.arange(400.0), indexing="ij")), at[:, None] + np.zeros(200), at[None] + np.zeros((200, 1)))
        assert media.inliers(whole, of(a[100:300, 150:350])) >= 4 * media.LEAST_INLIERS
        assert media.inliers(whole, of(small)) >= media.LEAST_INLIERS
        assert media.inliers(whole, of(texture(seed + 50, 200))) < media.LEAST_INLIERS


def test_strips_change_nothing(monkeypatch):
    a = texture(8, 300)
    whole = of(a)
    monkeypatch.setattr(media, "_PIXELS", 300 * 20)
    strips = of(a)
    sort = lambda c: np.lexsort((c["x"], c["y"], c["size"]))
    assert len(whole["x"]) == len(strips["x"]) > 100 and all(np.allclose(whole[k][sort(whole)], strips[k][sort(strips)], atol=1e-3) for k in ("x", "y", "size"))
    assert (media._distance(whole["bits"][sort(whole)], strips["bits"][sort(strips)]) <= 2).all()


def test_empty_and_rendered(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert media.copies(media.rendered(empty, "vec_id", "embedding")).count() == 0
    v = np.random.default_rng(1).normal(size=64).astype(float).tolist()
    df = spark.createDataFrame([(1, v), (2, v), (3, None), (4, [])], "vec_id bigint, embedding array<float>")
    assert {r.image_id: r.component_id for r in media.copies(media.rendered(df, "vec_id", "embedding")).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


@pytest.mark.parametrize("block", [4_096, 7])
def test_seeds_equal_brute_force_in_full_buckets(spark, monkeypatch, block):
    # Many descriptors of one bucket, between copies that differ in a high bit of the first word; a third of the images is one component already.
    monkeypatch.setattr(media, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, (4, 2))
    rows = []
    for key in range(30):
        bits = base ^ (np.int64(1) << rng.integers(0, 63, (4, 2))) ^ (np.int64(1) << rng.integers(0, 63, (4, 2)))
        if key % 3 == 0:
            bits = bits ^ rng.integers(0, 2**63, (4, 2)) & ~np.int64(0xFFFFF)
        rows.append((key, bits[:, 0].tolist(), bits[:, 1].tolist(), 1 if key % 3 == 1 else key))

    def parts(bits):
        return np.stack([bits[:, w].view(np.uint64) >> np.uint64(s) & np.uint64((1 << media.WIDTH) - 1) for w, s in map(media._part, range(media.TABLES))], axis=1)

    want = set()
    for a, p0, p1, la in rows:
        for b, q0, q1, lb in rows[a + 1 :]:
            p, q = (np.array(x, dtype=np.int64).T.copy() for x in ((p0, p1), (q0, q1)))
            shared = (parts(p)[:, None] == parts(q)[None]).any(axis=2)
            if la != lb and ((media._distance(p[:, None], q[None]) <= media.SEED_DISTANCE) & shared).any(axis=1).sum() >= media.LEAST_SEEDS:
                want.add((a, b))
    described = spark.createDataFrame(rows, "key bigint, b0 array<bigint>, b1 array<bigint>, label bigint")
    assert len(want) > 100 and {(r.a, r.b) for r in media.seeds(described).collect()} == want


def test_every_part_covers_its_word():
    covered = np.zeros((2, 64), dtype=int)
    for w, s in map(media._part, range(media.TABLES)):
        assert 0 <= s <= 64 - media.WIDTH
        covered[w, s : s + media.WIDTH] += 1
    assert (covered > 0).all()


def test_groups_equal_all_pairs_by_brute_force_and_recall(spark):
    """Groups of vectors near each other, however many: components of all pairs that the verifier accepts."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 64))
    v = np.concatenate([centres, centres[:3].repeat((30, 4, 1), axis=0) + rng.normal(0, 0.1, (35, 64))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    drawn = media.rendered(df, "vec_id", "embedding")
    got = {r.image_id: r.component_id for r in media.copies(drawn.repartition(7)).collect()}
    assert got == {r.image_id: r.component_id for r in media.copies(drawn.coalesce(1)).collect()}
    images = [np.frombuffer(r.pixels, np.uint8).reshape(64, 64) for r in drawn.orderBy("image_id").collect()]
    found = [of(a) for a in images]
    root = list(range(len(found)))
    for a in range(len(found)):
        for b in range(a):
            if media.inliers(found[a], found[b]) >= media.LEAST_INLIERS:
                x, y = sorted((root[a], root[b]))
                root = [x if z == y else z for z in root]
    assert [got[i] for i in range(len(found))] == root
    near = [(i, j) for i in range(len(v)) for j in range(i) if v[i] @ v[j] / np.linalg.norm(v[i]) / np.linalg.norm(v[j]) > 0.9]
    assert sum(got[i] == got[j] for i, j in near) >= 0.9 * len(near) and len(near) > 400


def test_null_rasters_of_one_id_are_no_copies(spark):
    df = spark.createDataFrame([(1, None, 10, 10), (1, None, 10, 10), (None, None, 10, 10), (None, None, 10, 10), (2, b"x" * 100, 10, 10), (2, b"x" * 100, 10, 10)], "image_id bigint, pixels binary, width int, height int")
    got = sorted(((r.image_id, r.n_corners, r.n_copies, r.component_id) for r in media.copies(df).collect()), key=str)
    assert got == [(1, 0, 1, 1)] * 2 + [(2, 0, 2, 2)] * 2 + [(None, 0, 1, None)] * 2
