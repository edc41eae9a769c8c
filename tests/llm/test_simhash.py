import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skylattice.llm import simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(d)
    return sorted((d, f"{p:016x}", min(ids[root(i)])) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def texts():
    base = [" ".join(f"w{(i * 7 + k * k) % 97}" for k in range(60)) for i in range(30)]
    near = [f"{b} Extra{i % 3}" for i, b in enumerate(base)] + [b.replace("w3 ", "W3  ", 1) for b in base]
    rows = list(enumerate(base + near + ["", None, " \t ", "one", "ONE", "two words", "ß é x y z", "long " * 3000]))
    return rows + rows[:2]


def test_matches_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    out = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert sorted(map(tuple, out.collect())) == brute_components(rows)


@pytest.mark.parametrize("cluster", [4, 20, 63])
def test_trie_links_equal_brute_force(cluster):
    rng = np.random.default_rng(cluster)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, cluster, 3, dtype=np.uint64)) for _ in range(600)]
    v = np.unique(centres[rng.integers(0, 40, 600)] ^ np.array(flips, dtype=np.uint64))
    got = simhash.trie_links(v, np.zeros(len(v), int), 4, 0)
    want = simhash.Forest(len(v))
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    want.join(*np.nonzero(near))
    assert np.array_equal(got, want.label)


def test_split_subtrees_give_the_same_components(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    v = np.unique(np.array([centre ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(20) for b in range(20, 64, 5)]))
    df = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp bigint")
    whole = {r.node for r in simhash.components(simhash.links(df)).collect()}
    split = simhash.components(simhash.links(df, subtree=50))
    assert {r.node for r in split.collect()} == whole and split.select("root").distinct().count() == 1


def test_empty_and_dedup(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.deduplicate(empty).count() == 0
    docs = spark.createDataFrame([(2, "a b c d e"), (1, "A b c d e"), (3, "quite different words here today"), (None, "a b c d e")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in simhash.deduplicate(docs).collect()) == [1, 3]


def test_one_row_of_each_group_stays(spark):
    a, b = "one two three four five six", "quite different words stand in this other text here"
    rows = [(1, a, "x"), (1, a, "x"), (1, a + " " + a, "y"), (2, a, "z"), (None, a, "n"), (None, b, "m"), (None, b, "m"), (3, None, "e"), (4, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string").withColumns({"k1": F.lit(1), "k2": F.lit(2), "fp": F.lit("f"), "root": F.lit(0), "component_id": F.lit(9)})
    out = simhash.deduplicate(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.row, r.fp) for r in out.collect()), key=str)
    # Four groups: the text, it twice over, nothing, and the other text.
    assert len(got) == 4 and (3, None, "e", "f") in got and (None, b, "m", "f") in got and sum(g[0] == 1 for g in got) == 2
    assert sum(g[1] == a for g in got) <= 1 and sorted(map(tuple, simhash.deduplicate(docs.repartition(5)).select("doc_id", "text").collect()), key=str) == sorted(((g[0], g[1]) for g in got), key=str)
