"""Jump consistent hashing against the published loop, and its law."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from feldspar.llm.sharding import assign, jump_shards, write_shards


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 7, 24, 100])
def test_equals_published_loop(spark, n):
    rng = random.Random(n)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *[rng.randrange(-(2**63), 2**63) for _ in range(300)], *range(200)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_shards(F.col("k"), n).alias("s")).collect()
    for r in got:
        assert (r.s.shard, r.s.grown) == (jump(r.k, n), jump(r.k, n + 1))


def test_rows_of_documents(spark):
    docs = spark.createDataFrame(
        [(1, "aé", "x", 9), (1, "aé", "x", 9), (1, "other", None, 9), (None, None, None, 1), (2, None, "y", 1), (3, "", "y", 2), *[(10, "same", "z", 0)] * 40],
        "doc_id long, text string, slot string, shard int",
    )
    got = assign(docs, 24).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.shard == jump(r.doc_id or 0, 24) and r.grown_shard in (r.shard, 24) and r.law == "key"
    text = {r.size: r.text_crc32 for r in got}
    assert text[8 + 3] == zlib.crc32("aé".encode()) and text[8] == 0
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert assign(docs.limit(0), 24).count() == 0


def test_slots_over_many_buckets(spark, monkeypatch):
    from feldspar.llm import graph

    monkeypatch.setattr(graph, "NUMBERED_ROWS", 7)
    docs = spark.range(500).select((F.col("id") % 300).alias("doc_id"), F.lit("t").alias("text"))
    got = assign(docs, 5).collect()
    for s in range(5):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_query_moves_only_into_the_new_shard(spark):
    from feldspar.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op6_jump_consistent_hashing"](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    moved = [r for r in got if r.grown_shard != r.shard]
    assert all(r.grown_shard == 24 for r in moved) and 0.015 < len(moved) / len(got) < 0.08


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    write_shards(docs, 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.doc_id, r.text, r.shard) for r in back} == {(i, f"t{i}", jump(i, 4)) for i in range(50)}
