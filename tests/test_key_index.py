"""Appending through a key index: same rows as the plain append, few files read, safe replays."""

import random

import pytest
from pyspark.sql import functions as F

from carbonledger.session import checkpoints_written, reliable_checkpoint, table_scope
from carbonledger.sources.key_index import KeyIndex
from carbonledger.sources.sinks import append_new_rows, path_exists

ROW = "id long, v string"


def rows_of(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select("id", "v").collect()), key=str)


def test_indexed_append_equals_the_plain_one(spark, tmp_path):
    rnd = random.Random(4)
    a, b = str(tmp_path / "indexed"), str(tmp_path / "plain")
    for k in range(4):
        ids = rnd.sample(range(200), 50) + ([None] if k % 2 else [])
        df = spark.createDataFrame([(i, rnd.choice(["a", "b", None])) for i in ids], ROW)
        n = KeyIndex(spark, a, {"id": ["id"]}, parts=8, blocks=64).append(df)
        append_new_rows(df, b, key_specs=[["id"]])
        assert rows_of(spark, a) == rows_of(spark, b) and n <= 51
        assert KeyIndex(spark, a, {"id": ["id"]}).append(df) == 0  # the same batch again


def test_several_specs_columns_and_copies_in_a_batch(spark, tmp_path):
    p = str(tmp_path / "t")
    index = KeyIndex(spark, p, {"id": ["id"], "v": ["v"]}, parts=4)
    assert index.append(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], ROW)) == 2
    assert index.append(spark.createDataFrame([("c", 9), ("z", 3), ("z", 4)], "v string, id int")) == 1
    extra = spark.createDataFrame([(5, 0.5)], "id int, other double")  # v is missing: null
    assert index.append(extra) == 1 and index.append(extra) == 0
    assert rows_of(spark, p)[-3:] == [(3, "c"), (4, "z"), (5, None)]
    assert index.append(extra.limit(0)) == 0


def test_a_small_batch_opens_few_files(spark, tmp_path):
    p = str(tmp_path / "t")
    index = KeyIndex(spark, p, {"id": ["id"]}, parts=32, blocks=256)
    index.append(spark.range(20_000).select("id", F.lit("x").alias("v")))
    new = spark.createDataFrame([(10**9 + k, "n") for k in range(3)], ROW)
    assert index.append(new) == 3
    # Three new keys: filters of at most three parts, and hardly ever any digests.
    assert 1 <= len(index.last["filters"]) <= 3 and len(index.last["digests"]) <= 1
    assert index.append(spark.createDataFrame([(7, "again"), (10**9, "again")], ROW)) == 0
    parts = {f.rpartition("part=")[2].split("/")[0] for f in index.last["digests"]}
    assert 1 <= len(parts) <= 2
    files = len(spark.read.parquet(p + ".keys/digests/id").inputFiles())
    index.compact(blocks=512)
    assert len(spark.read.parquet(p + ".keys/digests/id").inputFiles()) == 32 < files
    fresh = KeyIndex(spark, p, {"id": ["id"]})  # takes the sizes the index was built with
    assert (fresh.parts, fresh.blocks) == (32, 512)
    assert fresh.append(spark.range(20_003).select("id", F.lit("x").alias("v"))) == 3


@pytest.mark.parametrize("broken", ["_add", "_register"])
def test_replay_after_a_failure_between_data_and_index(spark, tmp_path, monkeypatch, broken):
    p = str(tmp_path / "t")
    KeyIndex(spark, p, {"id": ["id"]}, parts=4).append(spark.createDataFrame([(1, "a")], ROW))
    batch = spark.createDataFrame([(1, "z"), (2, "b"), (3, "c")], ROW)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyIndex, broken, fail)
        with pytest.raises(OSError):
            KeyIndex(spark, p, {"id": ["id"]}).append(batch)
    assert len(rows_of(spark, p)) == 3  # written, but not indexed
    index = KeyIndex(spark, p, {"id": ["id"]})
    assert index.append(batch) == 0 and index.last["caught_up_files"] > 0
    assert rows_of(spark, p) == [(1, "a"), (2, "b"), (3, "c")]


def test_interrupted_compaction_and_foreign_appends(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], ROW).write.parquet(p)  # a table without an index
    index = KeyIndex(spark, p, {"id": ["id"]}, parts=4)
    assert index.append(spark.createDataFrame([(2, "z"), (3, "c")], ROW)) == 1
    spark.createDataFrame([(4, "d")], ROW).write.mode("append").parquet(p)  # beside the index
    assert index.append(spark.createDataFrame([(4, "z")], ROW)) == 0

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyIndex, "_write", fail)
        with pytest.raises(OSError):
            index.compact(blocks=16)
    assert KeyIndex(spark, p, {"id": ["id"]}).append(spark.createDataFrame([(k, "z") for k in range(1, 6)], ROW)) == 1
    assert [r[0] for r in rows_of(spark, p)] == [1, 2, 3, 4, 5]


def test_builds_do_not_release_each_others_tables(spark, tmp_path):
    before = checkpoints_written()
    own = reliable_checkpoint(spark.range(5))
    with table_scope(spark) as keep:
        inner = reliable_checkpoint(spark.range(3))
        kept = keep(reliable_checkpoint(spark.range(4)))
        append_new_rows(spark.createDataFrame([(1, "a")], ROW), str(tmp_path / "p"), key_specs=[["id"]])
        append_new_rows(spark.createDataFrame([(1, "a"), (2, "b")], ROW), str(tmp_path / "p"), key_specs=[["id"]])
        assert inner.count() == 3 and own.count() == 5
    assert own.count() == 5 and kept.count() == 4 and checkpoints_written() == before + 2
    assert not path_exists(spark, inner.inputFiles()[0].rpartition("/")[0])


def test_threads_have_tables_of_their_own(spark):
    from concurrent.futures import ThreadPoolExecutor

    def build(n):
        with table_scope(spark):
            a = reliable_checkpoint(spark.range(n))
            b = reliable_checkpoint(a.select(F.col("id") + 1))
            return a.count() + b.count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(build, range(1, 9))) == [2 * n for n in range(1, 9)]
