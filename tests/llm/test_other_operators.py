"""Chat pairs, embeddings, WARC archive, components, SQL twins and the pipeline."""

import base64
import collections
import hashlib
import itertools
import json
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carbonledger.llm import chat_pairs, components, cover_tree, queries, warc

from ..oracle_diff import compare
from .test_text_operators import brute_components, docs_of, prose

SF = "/root/testdata/sf0.001"


def test_queries_match_their_sql(spark):
    got = compare(spark, SF, sorted(queries.ORACLE), verbose=False)
    assert {k for k, v in got.items() if v[0] is not True} == set()


# --- chat pairs -------------------------------------------------------------------------------------------------

def turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string").withColumn("k", F.lit(0))


def test_preference_format(spark):
    chosen = turns(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "more"),
                           (1, 3, "assistant", "yes"), (2, 0, "user", "same"), (3, 0, None, None),
                           (4, 0, "user", "<|end|>"), (None, 0, "user", "lost"), (5, 1, "user", "b"),
                           (5, 0, "user", "a"), (5, 0, "user", "a")])
    rejected = turns(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (2, 0, "user", "same"),
                             (4, 0, "assistant", "<|end|>"), (5, 0, "user", "a")])
    got = {r.pair_id: r for r in chat_pairs.format_preferences(chosen, rejected).collect()}
    one = got[1]
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.n_prompt_turns == 1
    spans = [tuple(map(int, s.split("-"))) for s in one.chosen_mask.split(",")]
    assert [one.chosen[a:b] for a, b in spans] == ["good<|end|>", "yes<|end|>"]
    a, b = map(int, one.rejected_mask.split("-"))
    assert one.rejected[a:b] == "bad<|end|>"
    assert (got[2].chosen, got[2].rejected, got[2].chosen_mask) == ("", "", "")
    assert got[3].chosen == "<|unknown|>\n<|end|>\n" and got[3].rejected == "" and got[3].prompt == ""
    assert "< |end|>" in got[4].chosen and got[4].n_prompt_turns == 0
    assert got[5].n_prompt_turns == 1 and got[5].chosen.count("<|end|>") == 2
    assert set(got) == {1, 2, 3, 4, 5}
    assert chat_pairs.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0


def test_preference_plan_has_no_python(spark):
    plan = queries.op2_preference_pairs(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- embeddings -------------------------------------------------------------------------------------------------

def clustered(seed, n, dim, spread):
    rnd = np.random.RandomState(seed)
    centres = rnd.randn(n // 10, dim)
    return (centres[rnd.randint(0, len(centres), n)] + spread * rnd.randn(n, dim)).astype(np.float32)


@pytest.mark.parametrize("spread,block", [(0.25, 2048), (0.25, 37), (0.02, 64), (3.0, 50)])
def test_cover_tree_matches_brute_force(spark, spread, block):
    x = clustered(4, 400, 8, spread)
    x[7] = x[3]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in cover_tree.near_duplicates(df, block=block).collect()}
    u = x.astype(float)
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    want = brute_components(range(len(x)), zip(*np.nonzero(hit)))
    assert [got[k].n_links for k in range(len(x))] == hit.sum(axis=1).tolist()
    assert {k: r.component_id for k, r in got.items()} == want
    assert all(r.kept == (r.component_id == k) for k, r in got.items())


def test_cover_tree_radii_cover_and_halve():
    x = cover_tree._unit(clustered(1, 600, 5, 0.4))
    order, nodes, reach = cover_tree.cover_tree(x)
    assert sorted(order) == list(range(600))
    y = x[order]
    for (lo, hi, a, b), r in zip(nodes, reach):
        assert np.linalg.norm(y[lo:hi] - y[lo], axis=1).max() <= r + 1e-6
        if a < b:
            assert [nodes[a][0], nodes[b - 1][1]] == [lo, hi]
            assert max(reach[a:b]) <= max(r, 1.0)


def test_cover_tree_edges(spark):
    rows = [(0, None), (1, [0.0, 0.0]), (2, [1.0, float("nan")]), (3, [1.0, None]), (4, [1.0, 0.0]), (5, [2.0, 0.0]),
            (6, [1.0, 0.0]), (7, [1e30, 0.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (10, []), (None, [1e-30, 0.0]),
            (4, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cid", F.lit("clash"))
    got = [(r.vec_id, r.n_links, r.component_id) for r in cover_tree.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([
        (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 4, 4), (5, 4, 4), (6, 4, 4), (7, 4, 4), (8, 0, 8), (9, 0, 9),
        (10, 0, 10), (None, 4, 4), (4, 0, 4)], key=str)
    assert cover_tree.near_duplicates(df.limit(0)).count() == 0


COVER_TREE_RUN = """
import numpy as np
from carbonledger.llm import cover_tree
from carbonledger.session import local_session

spark = local_session(2, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": LOG,
                                "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
x = np.random.RandomState(3).randn(3000, 64).astype(np.float32)
x[10] = x[2000] + 0.01
df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
got = cover_tree.near_duplicates(df, block=64).filter("n_links > 0")
print(sorted((r.vec_id, r.component_id) for r in got.collect()), x.nbytes)
spark.stop()
"""


def test_cover_tree_pairs_of_blocks_are_not_shuffled(tmp_path):
    """In a session of its own, for its event log: about 50 blocks, each compared with all others."""
    code = COVER_TREE_RUN.replace("LOG", repr(tmp_path.as_uri()))
    here = Path(cover_tree.__file__).parents[2]
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=here,
                         env={**os.environ, "PYTHONPATH": str(here)})
    assert run.returncode == 0, run.stderr[-2000:]
    assert "[(10, 10), (2000, 10)] 768000" in run.stdout
    events = [json.loads(line) for log in tmp_path.iterdir() for line in log.open()]
    written = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events
                  if e["Event"] == "SparkListenerTaskEnd")
    assert 0 < written < 4 * 768000


@pytest.mark.parametrize("dim,spread,strip_bytes", [(64, 0.3, 60_000), (64, 0.08, 100_000), (3, 0.3, 4_000)])
def test_cover_tree_strips_match_brute_force(spark, dim, spread, strip_bytes):
    """Several strips, several lengths (some without a pivot), copies, and enough dimensions for the screen."""
    x = clustered(6, 700, dim, spread)
    x[500:520] = x[3]
    vectors = [*x, *clustered(7, 90, 5, 0.3), *clustered(8, 20, 7, 0.3)]
    vectors += [np.ones(k, np.float32) for k in range(9, 19)]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in cover_tree.near_duplicates(df, block=30, pivots=20, strip_bytes=strip_bytes).collect()}
    hit = np.zeros((len(vectors), len(vectors)), bool)
    for d in {len(v) for v in vectors}:
        at = [k for k, v in enumerate(vectors) if len(v) == d]
        u = cover_tree._unit(np.array([vectors[k] for k in at]))
        hit[np.ix_(at, at)] = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    assert [got[k].n_links for k in range(len(vectors))] == hit.sum(axis=1).tolist()
    assert {k: r.component_id for k, r in got.items()} == brute_components(range(len(vectors)), zip(*np.nonzero(hit)))


@pytest.mark.parametrize("spread,screen", [(3.0, True), (0.05, True), (0.3, True), (0.3, False)])
def test_dual_walk_finds_all_pairs(spread, screen):
    x = cover_tree._unit(clustered(9, 1500, 64, spread))
    basis = np.linalg.qr(np.random.RandomState(1).randn(64, 23))[0] if screen else None
    blocks = []
    for part in (x[:900], x[900:]):
        order, nodes, reach = cover_tree.cover_tree(part)
        blocks.append({"x": part[order], "x32": part[order].astype(np.float32), "nodes": nodes, "reach": reach,
                       "short": cover_tree._short(part[order], basis) if screen else None})
    for one, two in (blocks, blocks[::-1], (blocks[0], blocks[0])):
        found = np.zeros((len(one["x"]), len(two["x"])), int)
        for i, j in cover_tree.dual_walk(one, two, 0.9):
            np.add.at(found, (i, j), 1)
        assert (found == (one["x"] @ two["x"].T >= 0.9)).all()


def test_components_of_random_links(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    links += [(500, k) for k in range(501, 700)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df, "a", "b").collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == brute_components({x for e in real for x in e}, real)
    assert components.connected_components(df.limit(0), "a", "b").count() == 0


# --- WARC -------------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, "http://c/\r\nX: y", "other é"), (4, None, None),
            (5, "http://d/", ""), (1, "http://b/", "same"), (None, "http://n/", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    warc.write_archive(pages, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w/blobs")).count() == 4  # each payload once
    got = warc.read_archive(spark, str(tmp_path / "w")).withColumn("raw", warc.record_bytes()).collect()
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([("1", "response", None), ("1", "revisit", 1), ("3", "revisit", 1), ("2", "response", None),
                            ("4", "response", None), ("5", "revisit", 4), ("None", "response", None)])
    for r in got:
        digest = base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
        head, _, rest = bytes(r.raw).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert r.payload_digest == digest and fields["WARC-Payload-Digest"] == f"sha1:{digest}"
        body = bytes(r.payload) if r.record_type == "response" else b""
        assert rest == body + b"\r\n\r\n" and int(fields["Content-Length"]) == len(body) and "X" not in fields
    assert len({f for f in (bytes(r.raw).split(b"WARC-Record-ID: ")[1][:60] for r in got)}) == len(rows)


def test_warc_small_payloads_and_damage(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")],
                                  "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.archive_pages(pages, min_revisit_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    path = str(tmp_path / "bad")
    warc.write_archive(pages, path)
    blobs = spark.read.parquet(f"{path}/blobs")
    blobs.withColumn("payload", F.lit(b"forged")).write.parquet(f"{path}/forged")
    spark.read.parquet(f"{path}/forged").write.mode("overwrite").parquet(f"{path}/blobs")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, path).collect()
    assert warc.archive_pages(pages.limit(0)).count() == 0


# --- pipeline ---------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    assert all(d.columns == cols for d in seen[:-1])
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in seen]
    assert set(ids[1]) <= set(ids[0]) and set(ids[2]) <= set(ids[1]) and set(ids[3]) <= set(ids[2])
    assert set(ids[4]) <= set(ids[3]) and collections.Counter(ids[5]) == collections.Counter(ids[4])
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(quality[k] == 1 for k in ids[1] if k in quality)
    fps = [r.fingerprint for r in __import__("carbonledger.llm.simhash", fromlist=["x"])
           .near_duplicates(seen[3]).collect()]
    assert all((int(a, 16) ^ int(b, 16)).bit_count() > 2 for a, b in itertools.combinations(fps, 2))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup",
                                                      "source_mix", "byte_bpe"]


def test_pipeline_catches_planted_copies(spark):
    clean = [prose(k, 120) + "." for k in range(30)]
    near = clean[3].replace("an", "an", 1).split(" ")
    near[60] = "changed"
    docs = docs_of(spark, clean + [clean[5], " ".join(near)])
    after = corpus_pipeline.lines(spark, docs, SF)
    assert {r.doc_id for r in after.collect()} == set(range(30)) | {31}
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert set(range(30)) <= left and 30 not in left


CLASH = ["score", "predicted", "label", "fp", "t1", "n", "size", "bucket", "target", "copies", "lines", "gone", "i",
         "component", "node", "k", "ids", "n_lines", "kept_text", "cell", "row"]


def test_pipeline_stages_with_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, empty and long texts, names that clash with working columns."""
    long = prose(77, 30_000)
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, prose(1, 80), "en", None, 1),
            (None, prose(2, 80), None, "a", None), (3, prose(1, 80), "en", "a", 1), (4, long, "fr", "b", 9),
            (5, long, "fr", "b", 9), (6, prose(3, 80), "en", "c", 2), (6, prose(4, 80), "en", "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in CLASH})
    for which, df in (("odd", docs), ("empty", docs.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            out.write.parquet(str(tmp_path / which / name))
            out = spark.read.parquet(str(tmp_path / which / name))
            if name != "byte_bpe":
                assert out.columns == docs.columns
                assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASH), name
            n = {"quality_classifier": None, "line_dedup": 8, "simhash_near_dedup": 6, "source_mix": None,
                 "byte_bpe": 10}[name]
            if which == "empty":
                assert out.count() == 0
            elif n is not None:
                assert out.count() == n, name


def test_folds_are_the_contract(spark):
    rows = queries.op4_quality_classifier(spark, SF).select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
