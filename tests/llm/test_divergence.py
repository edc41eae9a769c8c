import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from skylattice.llm import divergence


def brute(rows, min_docs, top):
    """The audit by plain Python over (lang, source, text)."""
    rows = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        docs = Counter(t for r in mine for t in set(r[2]))
        kept = {t for t, n in docs.items() if n >= min_docs}
        count = defaultdict(Counter)
        for _, source, words in mine:
            count[source].update(w for w in words if w in kept)
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked[: None if part == "pair" else top], 1)]
    return sorted(out)


def test_audit_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "STRETCH", 64)
    rng = np.random.default_rng(3)
    vocabulary = ["The", "the", "ÉTÉ", "été", "x1y", "_a_", "日本語", "𐐀z", "ﬀ", "dog"]
    rows = [(["en", "fr", "", None][i % 4], f"s{rng.integers(0, 4)}", " ".join(rng.choice(vocabulary[: 3 + i % 8], rng.integers(0, 30)))) for i in range(200)]
    # Ties, repeats, a group without terms, a language without kept terms, a very long text, nulls.
    rows += [rows[0]] * 3 + [("en", "silent", "12 34"), ("en", None, None), ("xx", "a", "lone"), ("xx", "b", None), ("yy", "only", ""), ("fr", "s1", "dog, the " * 5000), ("en", "s2", "a" * 300)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS term", "2 AS n", "3 AS rank", "4 AS salt")
    for min_docs, top in ((1, 50), (20, 3)):
        got = sorted(tuple(r) for r in divergence.audit(docs.repartition(5), min_docs, top).select("lang", "source", "part", "item", "value", "rank").collect())
        assert got == brute(rows, min_docs, top)


def test_empty_table_and_long_counts(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
    n, total, size = 4 * 10**18, 8 * 10**18, 10**6
    row = spark.createDataFrame([(n, total, size)], "n bigint, total bigint, size bigint")
    assert row.select(divergence.share(row.n, row.total, row["size"])).first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * size)


def test_held_counts_are_given_out(spark, monkeypatch):
    rows = [("en", "a", f"w{chr(97 + i % 26)}{chr(97 + i // 26)} the") for i in range(300)]
    monkeypatch.setattr(divergence, "HELD", 10)
    import pyarrow as pa

    batch = pa.record_batch(list(map(pa.array, zip(*rows))), ["lang", "source", "text"])
    found = [r for b in divergence._counted(iter([batch])) for r in b.to_pylist()]
    assert max(Counter(r["term"] for r in found).values()) > 10 and sum(r["n"] for r in found if r["term"] == "the") == 300
    assert sum(r["docs"] for r in found if r["term"] == "the") == 300 and sum(r["n"] for r in found) == 600


@pytest.mark.parametrize("text", ["", "a b", "ab" * 100, "x " * 200])
def test_stretches_hold_every_term(monkeypatch, text):
    monkeypatch.setattr(divergence, "STRETCH", 7)
    assert [t for part in divergence._stretches(text.encode()) for t in part] == re.findall(divergence.TERM, text.encode())
