import hashlib
import re
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skylattice.llm import bpe, decontam

sys.path.insert(0, str(Path(__file__).parents[2]))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    win = {}
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        m = min(10, len(w))
        for k in range(len(w) - m + 1):
            win.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for m in {len(g) for g in win}:
            for k in range(len(w) - m + 1):
                if (g := tuple(w[k : k + m])) in win:
                    hit |= set(range(k, k + m))
                    ids |= win[g]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    v = ["The", "élan", "ÉLAN", "b2", "c", "dog", "x"]
    items = [(i, " ".join(rng.choice(v, n))) for i, n in enumerate([30, 12, 10, 9, 4, 40])] + [(7, None), (8, "..."), (None, "The c dog"), (5, "c c c c c b2 b2")]
    docs = [(i, ", ".join(rng.choice(v, 25)) + (" " + items[i % 3][1] if i % 3 else "") + " end") for i in range(60)]
    docs += [(100, None), (101, ""), (102, "dog " * 20000), (None, items[0][1]), docs[1], docs[1]]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("items", F.lit(1)).withColumn("at", F.lit("x"))
    b = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted((tuple(r) for r in decontam.report(d, b).collect()), key=str) == brute(docs, items)
    clean = {r[0] for r in brute(docs, items) if not r[5]}
    kept = decontam.remove(d, b)
    assert {r.doc_id for r in kept.collect()} == clean and kept.columns == d.columns
    assert decontam.report(d, b.limit(0)).where("contaminated").count() == 0 and decontam.report(d.limit(0), b).count() == 0
    cut = decontam.remove(d.where("doc_id = 1"), b, unit="spans").first().text
    assert not brute([(1, cut)], [items[1]])[0][5]


@pytest.mark.parametrize("texts", [["Hello world's end", "  a\n\n b\t", "é" * 50, "12345 <|endoftext|> x", "", "naïve 日本語 🙂", "aaaa" * 3000, "don't!!! ...", " x y "]])
def test_bpe_equals_the_library(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    df = spark.createDataFrame([(x,) for x in [*texts, None]], "text string").coalesce(1).withColumn("ids", F.lit("clash"))
    got = df.select("text", bpe.digests(F.col("text")).alias("d")).collect()
    for r in got:
        e = t.encode(r.text or "", add_special_tokens=False).ids
        assert r.d.n_tokens == len(e) and r.d.ids_sha256 == hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256(t.decode(e, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.encode_documents(df).select("text", bpe.decode(F.col("ids")).alias("b")).collect()
    assert all(r.b == (r.text or "") for r in back)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(1)
    en, fr = ["the", "river", "house", "thing", "there", "with"], ["le", "fleuve", "maison", "chose", "avec", "où"]
    rows = [(i, " ".join(rng.choice(en if i % 2 else fr, 60)), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(40)]
    item = " ".join(rng.choice(en, 12))
    rows += [(50, rows[1][1], "en", "s0"), (51, "with " + item + " house river", "en", "s1"), (52, "", "en", "s1"), (53, None, None, None), (54, "mail bob@example.com " + " ".join(rng.choice(en, 50)), "en", "s2")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert ids == {*range(40), 54}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = rows[-1][1].replace("bob@example.com", "<EMAIL>")
    assert next(r for r in out if r.doc_id == 54).n_tokens == len(t.encode(text, add_special_tokens=False).ids)
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, current, str(tmp_path)).columns == current.columns


def test_spans_keep_clashing_columns(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, f"Before, {item} after.", 1, 2, 3, "r"), (2, "clean", 4, 5, 6, "q")], "doc_id bigint, text string, _hash int, _id int, at int, row string")
    bench = spark.createDataFrame([(0, item)], "item_id bigint, text string")
    out = sorted(map(tuple, decontam.remove(docs, bench, unit="spans").collect()))
    assert out[1] == (2, "clean", 4, 5, 6, "q") and out[0][2:] == (1, 2, 3, "r") and "gamma" not in out[0][1] and out[0][1].startswith("Before,")
    assert [tuple(r) for r in decontam.remove(docs, bench).collect()] == [out[1]]


def test_every_stage_by_brute_force_with_nulls_repeats_ties_and_clashes(spark, tmp_path):
    """Each stage's rows against what its docstring says, on rows with nulls, empty and very long texts, repeated rows and columns of the operators' names."""
    import corpus_pipeline
    from skylattice.llm import langid, pii, simhash

    rng = np.random.default_rng(3)
    en = ["the", "river", "house", "thing", "there", "with", "mill", "stone"]
    item = " ".join(rng.choice(en, 12))
    text = lambda n: " ".join(rng.choice(en, n))
    rows = [(i, text(50), "en", f"s{i % 2}") for i in range(12)]
    rows += [rows[0], rows[0], (0, text(40), "en", "s0"), (None, text(45), "en", None), (None, None, None, None), (20, "", "en", "s1"), (21, text(12_000), "en", "s1"), (22, text(5) + " " + item + " end", "en", "s0"), (23, "write x@y.example " + text(40), None, "s1"), (24, rows[3][1], "en", "s0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    docs = docs.withColumns({c: F.lit(i) for i, c in enumerate(("row", "k1", "k2", "fp", "root", "_id", "_hash", "at", "language", "_language", "h"))})
    bench = spark.createDataFrame([(0, item), (None, text(12)), (1, None)], "item_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    stages = dict(corpus_pipeline.STAGES)
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")

    kept = stages["language"](spark, current, str(tmp_path))
    assert kept.columns == current.columns and key(kept) == sorted(((r[0], r[1]) for r in rows if r[1]), key=str)
    once = stages["near_duplicates"](spark, kept, str(tmp_path))
    prints = {r.text: r.fp for r in kept.select("text", simhash.fingerprint(F.col("text")).alias("fp")).collect()}
    all_rows = [(r.doc_id, r.text) for r in kept.collect()]
    group = list(range(len(all_rows)))
    for i, (_, a) in enumerate(all_rows):
        for j, (_, b) in enumerate(all_rows[:i]):
            if bin((prints[a] ^ prints[b]) & (1 << 64) - 1).count("1") <= 4:
                x, y = sorted((group[i], group[j]))
                group = [x if z == y else z for z in group]
    got = key(once)
    assert once.columns == current.columns and len(got) == len(set(group))
    for g in set(group):
        members = [r for r, z in zip(all_rows, group) if z == g]
        ids = [m[0] for m in members if m[0] is not None]
        own = [r for r in got if r in members]
        assert len(own) == 1 and own[0][0] == (min(ids) if ids else None)
    clean = stages["decontaminate"](spark, once, str(tmp_path))
    assert clean.columns == current.columns and key(clean) == [r for r in got if item not in r[1]]
    red = stages["redact"](spark, clean, str(tmp_path))
    assert red.columns == current.columns and dict(key(red))[23] == dict(key(clean))[23].replace("x@y.example", "<EMAIL>")
    assert all(r.n_chars == len(r.text) for r in red.collect()) and [r for r in key(red) if r[0] != 23] == [r for r in key(clean) if r[0] != 23]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(((r.doc_id, r.n_tokens) for r in out.collect()), key=str) == sorted(((i, len(t.encode(x, add_special_tokens=False).ids)) for i, x in key(red)), key=str)
    none = current.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
    assert langid and pii
