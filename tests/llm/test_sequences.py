import json
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from skylattice.llm import sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_chunks_encode_like_whole_texts(library):
    rng = random.Random(1)
    encode = sequences.Encoder(PATH)
    letters = ["a", "Word", " ", "  ", "\n", "\t ", *map(chr, (0x1C, 0x85, 0xA0, 0x200B, 0x2028, 0x3000)), "!", ".", ",", "'s", "'sword", "don't", "(", "-", "_", "²", "ß", "Ω", "×", "12", "é", "日本", "<|endoftext|>", "🙂", "x" * 70]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    assert [np.frombuffer(encode(t), "<u2").tolist() for t in texts] == [ids_of(library, t)[:-1] for t in texts]


def brute(library, docs):
    """Documents (id, text) in order with their place and digest, as (id, start, n, crc)."""
    out, at = [], 0
    for doc_id, text in docs:
        ids = ids_of(library, text)
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_report_matches_the_library(spark, library):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "a,", "Dog's", "\n", "Ünï", "!", "9"]) for _ in range(rng.randint(0, 60))) for _ in range(150)] + ["!", "!!", "", None, "long word " * 30000, "z" * 5000]
    docs = [(i * 7 - 300, t) for i, t in enumerate(texts)]
    rng.shuffle(docs)
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"id": F.lit(1), "h": F.lit(2), "start": F.lit("x")})
    found = sequences.report(rows.repartition(6))
    assert [tuple(r) for r in found.orderBy("doc_id").select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == brute(library, sorted(docs))


def test_repeated_null_and_text_ids(spark, library):
    docs = [(None, "b"), (None, None), ("10", "x y"), ("10", "x y"), ("10", "other"), ("9", "")]
    found = sequences.report(spark.createDataFrame(docs, "doc_id string, text string")).collect()
    assert sorted((r.doc_id or "", r.n_tokens) for r in found) == sorted((d or "", len(ids_of(library, t))) for d, t in docs)
    starts = sorted((r.start, r.n_tokens, r.doc_id or "") for r in found)
    assert [s[2] for s in starts] == ["", "", "10", "10", "10", "9"] and all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:])) and starts[0][0] == 0


def test_empty_table(spark):
    assert sequences.report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_sequences_are_views_of_equal_length(spark, library, tmp_path):
    docs = [(i, f"document {i} has some words " * (i % 9)) for i in range(400)]
    path = str(tmp_path / "ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sequences.write(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), path, length=64)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found, listed = sequences.Sequences(path), sequences.manifest(path)
    assert len(listed["files"]) > 1 and len(found) == listed["sequences"] == sum(f["sequences"] for f in listed["files"])
    flat = []
    for i in range(len(found)):
        ids, mask = found[i]
        assert len(ids) == len(mask) == 64 and not ids.flags.owndata
        flat += ids[np.array(mask.to_pylist())].tolist()
    assert flat == [t for _, text in docs for t in ids_of(library, text)]
    name = listed["files"][0]["name"]
    before = pa.total_allocated_bytes()
    mapped = pa.memory_map(f"{path}/{name}")
    reader = pa.ipc.open_file(mapped)
    batch = reader.get_batch(reader.num_record_batches - 1)
    whole = mapped.read_buffer(mapped.size())
    ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
    assert whole.address <= ids.ctypes.data < whole.address + whole.size and pa.total_allocated_bytes() == before
    assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 64) and batch.schema.field("mask").type == pa.list_(pa.bool_(), 64)
    with pytest.raises(IndexError):
        found[len(found)]


def test_an_aborted_write_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "ids")
    rows = spark.range(20).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 13, F.raise_error(F.lit("lost")).cast("string")).otherwise("some text").alias("text"))
    with pytest.raises(Exception, match="lost"):
        sequences.write(rows, path)
    assert not [f for f in os.listdir(path) if not f.startswith(".")]
    sequences.write(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string"), path)
    listed = json.loads((tmp_path / "ids" / "manifest.json").read_text())
    assert listed["tokens"] == 4 and sum(f["documents"] for f in listed["files"]) == 2
    with pytest.raises(ValueError):
        sequences.write(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), path, length=100)
