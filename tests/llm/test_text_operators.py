"""Corpus operators over texts against brute force: BPE, classifier, line dedup, SimHash, rules, mix, LM scores."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carbonledger.llm import (bpe, clean_rules, hashing, line_dedup, lm_mixing, mixing, quality_model, queries,
                              simhash)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, sources=None):
    rows = [(k, t, "en", (sources or ["s"] * len(texts))[k], len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(["an", "to", "re", "li", "su", "é"]) for _ in range(rnd.randint(1, 4)))
                    + rnd.choice(["", "", "", "."]) for _ in range(n))


# Two different words of 1,024 bytes that every polynomial modulo 2**64 takes for equal.
THUE = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
MORSE = THUE.translate({97: 98, 98: 97})
EDGE = [None, "", " \n\t", "x", "a b", prose(1, 30), prose(1, 30), "é🙂 中文 " * 20, "A" * 50_000, prose(2, 20_000),
        f"{THUE} a b c d e f g {MORSE} a b c d e f g"]


# --- byte-level BPE ---------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocab(spark):
    import public_tokenizers
    return bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def tiktoken_encoding():
    import public_tokenizers as p
    import tiktoken
    with open(p.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_the_rank_encoding(spark, vocab):
    import public_tokenizers
    got = {r.doc_id: r for r in bpe.round_trip(docs_of(spark, EDGE), vocab, public_tokenizers.PATTERN).collect()}
    enc = tiktoken_encoding()
    for k, t in enumerate(EDGE):
        ids = enc.encode_ordinary(t or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (got[k].n_tokens, got[k].ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert got[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() and got[k].decoded_ok
        assert got[k].offsets_ok
        pieces = [enc.decode_single_token_bytes(i) for i in ids]
        at, ends = 0, []
        for x in pieces:
            at += len(x)
            ends.append(at)
        whole = {len((t or "")[:j].encode()) for j in range(len(t or "") + 1)} if len(ids) < 5000 else set(ends) | {0}
        assert len(ids) >= 5000 or got[k].n_split == sum(
            e not in whole or e - len(x) not in whole for x, e in zip(pieces, ends))
    some = bpe.round_trip(docs_of(spark, EDGE), vocab, public_tokenizers.PATTERN, keep_ids=True).filter(
        "doc_id = 7").first()
    assert list(some.ids) == enc.encode_ordinary(EDGE[7]) and some.n_split > 0


def test_bpe_query_on_the_table(spark):
    got = {r.doc_id: r for r in queries.op3_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    enc, table = tiktoken_encoding(), spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(table)
    for r in table:
        assert got[r.doc_id].n_tokens == len(enc.encode_ordinary(r.text))


def test_bpe_random_strings_match():
    import public_tokenizers as p
    with open(p.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.Codec(f.read(), p.PATTERN)
    enc, rnd = tiktoken_encoding(), random.Random(5)
    some = ["a", "th", "he", " ", "  ", "\n", "\t", "'s", "'", "é", "中", "1", "23", " ", "\u0085", "\x1c", "🙂", "=="]
    for _ in range(3000):
        t = "".join(rnd.choice(some) if rnd.random() < 0.8 else chr(rnd.randint(0, 0xD7FF))
                    for _ in range(rnd.randint(0, 40)))
        assert codec.encode(t).tolist() == enc.encode_ordinary(t), repr(t)


def test_bpe_offsets_and_split_characters(spark, vocab):
    import public_tokenizers
    t = "é🙂a 中文"
    row = bpe.encode(docs_of(spark, [t]), vocab, public_tokenizers.PATTERN, with_offsets=True).first()
    codec = bpe.Codec.of(vocab, public_tokenizers.PATTERN)
    pieces = codec.decode_pieces(row.ids)
    assert "".join(pieces) == t and "" in pieces  # some character is split over tokens
    for i, a, b in zip(row.ids, row.char_start, row.char_end):
        assert codec.decode([i]) in t[a:b].encode()
    with pytest.raises(ValueError):
        codec.decode([999_999])
    assert codec.decode_pieces(row.ids[:2])[-1].endswith("�")


def test_bpe_rows_leave_in_runs(spark, vocab):
    """A worker works through a batch in runs of bounded size, whole rows each, in order, nulls included."""
    import public_tokenizers
    texts = pa.array(["é" * 400_000, None, "", "b" * 300_000, "c" * 3_000_000, "d", "e" * 1_000_000, None])
    size = [len((t or "").encode()) for t in texts.to_pylist()]
    runs = list(bpe.row_runs(texts))
    assert [k for at, stop in runs for k in range(at, stop)] == list(range(len(size)))
    assert all(stop - at == 1 or sum(size[at:stop]) <= bpe.RUN_CHARS for at, stop in runs)
    assert list(bpe.row_runs(texts[:0])) == []
    few = [None, "", *[f"{'word ' * 9_000}{k} é" for k in range(60)]]  # several runs in one batch
    docs = spark.createDataFrame([(None if k == 5 else (1 << 60) + k, t) for k, t in enumerate(few)],
                                 "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in bpe.round_trip(docs, vocab, public_tokenizers.PATTERN, keep_ids=True).collect()}
    enc = tiktoken_encoding()
    assert set(got) == {None if k == 5 else (1 << 60) + k for k in range(len(few))}
    for k, t in enumerate(few):
        r = got[None if k == 5 else (1 << 60) + k]
        assert r.ids == enc.encode_ordinary(t or "") and r.n_tokens == len(r.ids) and r.decoded_ok and r.offsets_ok


def test_bpe_table_of_pieces_may_overflow(vocab, monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(bpe, "PIECES_KEPT", 10)
    monkeypatch.setattr(bpe, "RUN_CHARS", 100)
    codec, enc = bpe.Codec(vocab.value, public_tokenizers.PATTERN), tiktoken_encoding()
    texts = [prose(k, 60) for k in range(5)] + [None, ""]
    assert [x.tolist() for x in codec.encode_many(texts)] == [enc.encode_ordinary(t or "") for t in texts]


# --- quality classifier -----------------------------------------------------------------------------------------

def test_hashing_of_words():
    texts = [t or "" for t in EDGE]
    h, n = hashing.words(hashing.as_bytes(texts))
    words = [w for t in texts for w in WORD.findall(t)]
    assert n.tolist() == [len(WORD.findall(t)) for t in texts] and len(h) == len(words)
    assert len(set(zip(h.tolist(), words))) == len(set(words)) == len(set(h.tolist()))


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op4_quality_classifier(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(r.quality, got[r.doc_id]) for r in labels if got[r.doc_id].held_out]
    assert len(got) == 1000 and len(held) > 50
    assert all(g.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, g in got.items())
    assert all(g.predicted == int(g.score >= 0.7) and 0 <= g.score <= 1 for g in got.values())
    assert sum(q == g.predicted for q, g in held) / len(held) > 0.9


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(0, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_model.score(docs_of(spark, EDGE).withColumn("score", F.lit("clash")), labels, F.lit(True)).collect()
    assert {r.score for r in rows} == {0.5} and len(rows) == len(EDGE)
    some = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.score for r in quality_model.score(docs_of(spark, EDGE), some, F.lit(True)).collect()}
    assert rows[5] == rows[6] > rows[7] and rows[0] == rows[1]
    assert quality_model.score(docs_of(spark, EDGE).limit(0), some, F.lit(True)).count() == 0


def test_ftrl_separates():
    m = quality_model.FTRL(bits=10)
    good, bad = quality_model.sparse_vectors(["fine words here", "junk junk$$ %%"], bits=10)
    for _ in range(50):
        m.update(*good, 1.0)
        m.update(*bad, 0.0)
    assert m.weights(good[0]) @ good[1] > 0.5 > m.weights(bad[0]) @ bad[1]


# --- line dedup -------------------------------------------------------------------------------------------------

def brute_lines(texts, least):
    """Lines to delete: those inside any stretch of lines with at least ``least`` words seen earlier."""
    windows = []
    for d, t in enumerate(texts):
        own = [(i, x, len(WORD.findall(x))) for i, x in enumerate((t or "").split("\n")) if WORD.search(x)]
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += own[b][2]
                if total >= least:
                    windows.append((d, own[a][0], own[b][0], tuple(x for _, x, _ in own[a:b + 1])))
    first, gone = {}, collections.defaultdict(set)
    for d, a, b, content in sorted(windows, key=lambda w: w[:3]):
        if first.setdefault(content, (d, a)) != (d, a):
            gone[d] |= set(range(a, b + 1))
    return gone


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(7)
    lines = [prose(k, rnd.choice([1, 2, 3, 5, 9])) for k in range(12)] + ["", " "]
    texts = ["\n".join(rnd.choice(lines) for _ in range(rnd.randint(1, 14))) for _ in range(60)]
    got = {r.doc_id: r for r in line_dedup.mark_runs(docs_of(spark, texts), min_words=8).collect()}
    want = brute_lines(texts, 8)
    assert any(want.values())
    for d, t in enumerate(texts):
        kept = [x for i, x in enumerate(t.split("\n")) if i not in want[d] and x.strip()]
        assert [x for x in got[d].kept_text.split("\n") if x.strip()] == kept, d
        assert got[d].n_removed + got[d].kept_text.count("\n") + bool(got[d].kept_text) <= got[d].n_lines + 1


def test_line_dedup_edges(spark):
    passage = prose(3, 60)
    docs = docs_of(spark, EDGE + [f"one.\n{passage}\ntwo.", f"three.\n\n{passage}\nfour.", passage])
    docs = docs.withColumn("n_lines", F.lit("clash")).unionAll(docs.withColumn("n_lines", F.lit("clash")).limit(2))
    marked = line_dedup.mark_runs(docs.drop("n_lines"))
    got = {r.doc_id: r for r in marked.collect()}
    assert marked.count() == len(EDGE) + 5
    n = len(EDGE)
    assert got[n].n_removed == 0 and got[n + 1].kept_text == "three.\n\nfour." and got[n + 2].kept_text == ""
    assert got[0].kept_text is None and got[0].n_lines == 0 and got[1].kept_text == ""
    left = line_dedup.drop_repeated_runs(docs)
    assert left.columns == docs.columns and n + 2 not in {r.doc_id for r in left.collect()}
    assert line_dedup.mark_runs(docs.limit(0)).count() == 0


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.mark_runs(docs_of(spark, EDGE))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- SimHash ----------------------------------------------------------------------------------------------------

def brute_fingerprint(text):
    from xxhash import xxh64_intdigest
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, linked):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {i: root(i) for i in ids}


def test_simhash_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op6_simhash(spark, sf).collect()}
    fps = {r.doc_id: brute_fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    near = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    want = brute_components(fps, near)
    assert {k: (int(r.fingerprint, 16), r.component_id) for k, r in got.items()} == {k: (fps[k], want[k]) for k in fps}


@pytest.mark.parametrize("bucket", [256, 8])
def test_simhash_links_are_exact(spark, monkeypatch, bucket):
    """Dense groups of fingerprints; a small bucket drives the refinement of keys."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd = random.Random(3)
    fps = set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(60):
            x = base
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.choice([rnd.randrange(64), rnd.randrange(8)])
            fps.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    near = {tuple(sorted((signed(a), signed(b)))) for a, b in itertools.combinations(fps, 2)
            if (a ^ b).bit_count() <= 2}
    if bucket == 256:
        assert {tuple(r) for r in simhash.links(df, all_pairs=True).collect()} == near
    spanning = {tuple(r) for r in simhash.links(df).collect()}
    ids = [signed(x) for x in fps]
    assert brute_components(ids, spanning) == brute_components(ids, near)


def test_simhash_edges(spark):
    docs = docs_of(spark, EDGE).unionAll(docs_of(spark, [None, "x"]))
    rows = simhash.near_duplicates(docs.withColumn("fp", F.lit(1))).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGE) + 2 and got[2].fingerprint == "0" * 16 and got[2].component_id == 0
    assert got[6].component_id == 5
    left = simhash.drop_near_duplicates(docs.withColumn("fp", F.lit(1)))
    ids = sorted(r.doc_id for r in left.collect())
    assert left.columns == docs.columns + ["fp"] and len(ids) == len(set(ids)) and 6 not in ids and 0 in ids
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# --- quality rules ----------------------------------------------------------------------------------------------

def test_rules_counts_match_brute_force(spark):
    texts = EDGE + ["a b\na b\n\nc", "The " * 40, "Home | News | Shop | About\n" + prose(4, 40) + ".",
                    prose(5, 12) + " " + prose(5, 12) + " " + prose(6, 30), "x#y $5 <b>|</b>", "a b c"]
    rows = clean_rules.clean(docs_of(spark, texts).withColumn("kept", F.lit("clash"))).collect()
    for r in rows:
        words = WORD.findall(r.text or "")
        at = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        cover = {j for i in range(len(words) - 7) if at[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum((r.text or "").count(c) for c in "#*$%&|<>"),
                len(lines) - len(set(lines)), len(cover))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.text[:50]
        assert r.base_failed == (len(words) < 20 or 100 * len(cover) > 30 * len(words))
        assert not (r.base_failed and r.kept)
    menu = next(r for r in rows if (r.text or "").startswith("Home |"))
    assert menu.kept and "Home" not in menu.clean_text
    assert clean_rules.clean(docs_of(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("line", [
    "Copyright 2020, All Rights Reserved.", "© Tous droits réservés.", "Alle Rechte vorbehalten.",
    "Lea nuestra Política de Privacidad.", "Bitte Javascript aktivieren.", "Voir les conditions générales d’utilisation."])
def test_boilerplate_lines_fail_in_four_languages(line):
    assert clean_rules.line_fails(line) == "boilerplate"
    assert clean_rules.line_fails("Le droit est à tous, und die Rechte bleiben.") is None


def test_rules_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.kept for r in queries.op8_quality_rules(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.9 and sum(bad) / len(bad) < 0.1


# --- source mix -------------------------------------------------------------------------------------------------

def brute_targets(sizes, weights, epochs):
    level, capped, total = {}, set(), sum(sizes)
    while True:
        rest = [k for k in range(len(sizes)) if k not in capped]
        free = total - sum(epochs * sizes[k] for k in capped)
        level = {k: free * weights[k] / sum(weights[j] for j in rest) for k in rest}
        over = {k for k in rest if level[k] > epochs * sizes[k]}
        if not over:
            return [epochs * sizes[k] if k in capped else level[k] for k in range(len(sizes))]
        capped |= over


def test_mix_targets_and_taken(spark):
    rnd = random.Random(2)
    sources = [rnd.choice(["a", "b", "c", "d", "é", None]) if k % 3 else "b" for k in range(900)]
    texts = [prose(k, rnd.randint(1, 40)) for k in range(900)]
    rows = mixing.mix(docs_of(spark, texts, sources)).collect()
    names = ["a", "b", "c", "d", "é", None]
    sizes = [sum(len(WORD.findall(t)) for t, s in zip(texts, sources) if s == n) for n in names]
    want = dict(zip(names, brute_targets(sizes, [5, 2, 1, 5, 2, 1], 3)))
    taken = collections.Counter()
    for r in rows:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9) and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for n, size in zip(names, sizes):
        assert want[n] - 40 <= taken[n] <= want[n] + 1e-6 or not size  # short of it by less than a document
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs_of(spark, texts, sources).repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}
    mixed = mixing.apply_mix(docs_of(spark, texts, sources).withColumn("copies", F.lit(1)))
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    assert all(counts[r.doc_id] == r.copies for r in rows) and mixed.columns[-1] == "copies"


def test_mix_fills_on_past_what_does_not_fit(spark):
    """A huge document in an early bucket does not end the filling, and buckets of many documents are split."""
    texts = ["w " * 10] * 999 + ["w " * 10_000] + ["v " * 7_000]
    docs = docs_of(spark, texts, ["a"] * 1000 + ["b"])
    for weights in ((1, 1), (1, 5), (5, 2), (7, 1)):
        rows = mixing.mix(docs, weights).collect()
        target, taken = rows[0].target, sum(r.taken for r in rows if r.source == "a")
        assert target - 10 < taken <= target
    same = spark.createDataFrame([(k % 3, "w " * 10, "a") for k in range(3000)] + [(9, "v " * 45_000, "b")],
                                 "doc_id long, text string, source string")  # a thousand rows an id
    rows = mixing.mix(same, (1, 2)).collect()
    assert {r.copies for r in rows if r.source == "a"} <= {0, 1, 2}
    assert len({(r.doc_id, r.copies) for r in rows}) == 4


def test_long_words_are_told_apart(spark):
    got = {r.doc_id: r for r in lm_mixing.score(docs_of(spark, [THUE, MORSE, THUE]), F.col("doc_id") == 0,
                                                F.lit(True)).collect()}
    assert [got[k].n_known for k in range(3)] == [2, 1, 2]


def test_mix_edges(spark):
    rows = mixing.mix(docs_of(spark, EDGE)).collect()
    assert len(rows) == len(EDGE) and all(r.taken == r.size for r in rows)  # one source: everything once
    assert mixing.mix(docs_of(spark, EDGE).limit(0)).count() == 0
    nothing = mixing.mix(docs_of(spark, [None, ""], ["a", None])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


# --- language-model scores --------------------------------------------------------------------------------------

def test_lm_base_model_and_compression(spark, monkeypatch):
    monkeypatch.setattr(lm_mixing, "HEAVY", 500)  # most tokens go through the join
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op1_context_mixing(spark, sf)
    got = {r.doc_id: r for r in out.collect()}
    tokens = {k: [w for w in WORD.findall(t.translate(simhash._LOWER))] + [None] for k, t in docs.items()}
    train = [k for k in docs if zlib.crc32(str(k).encode()) % 5 != 1]
    c = collections.Counter(w for k in train for w in tokens[k])
    n, v = sum(c.values()), len(c)
    for k, r in got.items():
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[k])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[k]), sum(c[w] > 0 for w in tokens[k]), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (k not in set(train)) and r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.bits_per_byte * r.n_bytes for r in held) / sum(r.n_bytes for r in held) < 3


def test_lm_probabilities_sum_to_one():
    """Over all continuations of a prefix by one byte, the probabilities of a trained model add up to one."""
    code = lm_mixing.Code(__import__("numpy").bincount(list(b"some words and some more words"), minlength=256))
    import numpy as np
    cells = [np.zeros(1 << b, np.int32) for b in lm_mixing.BITS]
    lm_mixing.count_cells(code, [b"some words and some more words"] * 3, cells)
    model = lm_mixing.Model(code, [lm_mixing.stretched(c) for c in cells], lm_mixing.first_weights(),
                            lm_mixing.plain_refinement())
    total = 0.0
    for b in range(256):
        buffer, _, sizes = next(lm_mixing._runs([b"some wor" + bytes([b])]))
        byte, hs = lm_mixing.contexts(buffer, sizes)
        total += math.exp(-lm_mixing.score_bytes(model, byte, hs)[8])
    assert abs(total - 1) < 1e-3


def test_lm_long_and_split_texts_score_alike():
    import numpy as np
    long = prose(9, 60_000).encode()
    code = lm_mixing.Code(np.bincount(np.frombuffer(long, np.uint8), minlength=256))
    cells = [np.zeros(1 << b, np.int32) for b in lm_mixing.BITS]
    lm_mixing.count_cells(code, [long[:5000]], cells)
    model = lm_mixing.Model(code, [lm_mixing.stretched(c) for c in cells], lm_mixing.first_weights(),
                            lm_mixing.plain_refinement())
    together = lm_mixing.score_texts(model, [b"", long, b"x", long, b""])
    alone = np.array([lm_mixing.score_texts(model, [t])[0] for t in (b"", long, b"x")])
    assert np.allclose(together, alone[[0, 1, 2, 1, 0]], rtol=1e-5)


def test_lm_edges(spark):
    docs = docs_of(spark, EDGE).select("doc_id", "text")
    rows = {r.doc_id: r for r in lm_mixing.score(docs, F.lit(False), F.lit(False)).collect()}
    assert rows[0].train_tokens == 0 and rows[0].n_tokens == 1 and rows[0].n_known == 0
    rows = {r.doc_id: r for r in lm_mixing.score(docs.unionAll(docs), F.lit(True), F.lit(True)).collect()}
    assert len(rows) == len(EDGE) and rows[0].score == rows[1].score and rows[5].score == rows[6].score
    assert lm_mixing.score(docs.limit(0), F.lit(True), F.lit(False)).count() == 0


def test_lm_all_training_documents_update_the_weights(spark, monkeypatch):
    """Every byte of every training document updates weights and map, whichever fold it is in."""
    texts = [prose(k, 200) for k in range(40)]
    seen = []
    learnt = lm_mixing.refinement
    monkeypatch.setattr(lm_mixing, "refinement", lambda n, one: seen.append(n.sum()) or learnt(n, one))
    docs = docs_of(spark, texts).select("doc_id", "text")
    train = docs.filter("doc_id < 30")
    counts = lm_mixing.token_counts(train)
    model = lm_mixing.train_model(train, F.col("doc_id") % 2 == 0, counts)
    raw = b"".join(lm_mixing._lower(t + "\0" for t in texts[:30])).replace(b"\0", bytes([lm_mixing.PAD]))
    assert seen == [sum(int(model.code.length[b]) for b in raw)]


def test_lm_contexts_by_pieces_are_those_of_the_run():
    """Cache-sized pieces of a run give every byte the context that the whole run gives it."""
    texts = [t.lower() for t in hashing.as_bytes([*EDGE, "a" * 700, *(prose(k, 40) for k in range(30))])]
    for buffer, _, sizes in lm_mixing._runs(texts, 20_000):
        pieces = list(lm_mixing._pieces(buffer, sizes, 1_000))
        assert [n for _, own in pieces for n in own] == sizes
        assert all(len(own) == 1 or sum(own) <= 1_000 for _, own in pieces)
        byte, hashes = lm_mixing.contexts(buffer, sizes)
        found = [lm_mixing.contexts(*piece) for piece in pieces]
        assert (byte == [b for own, _ in found for b in own]).all()
        for k, h in enumerate(hashes):
            assert (h == [x for _, own in found for x in own[k]]).all()


def test_lm_bytes_that_meet_in_a_node_lie_side_by_side():
    """A chunk in code order needs no look-up per byte and bit: nodes are spans; costs are those of a plain loop."""
    import numpy as np
    text = (prose(3, 300) + " é 漢 \x00").encode() + bytes([lm_mixing.PAD])
    code = lm_mixing.Code(np.bincount(np.frombuffer(text, np.uint8), minlength=256))
    cells = [np.zeros(1 << b, np.int32) for b in lm_mixing.BITS]
    lm_mixing.count_cells(code, [text[:900]], cells)
    model = lm_mixing.Model(code, [lm_mixing.stretched(c) for c in cells], lm_mixing.first_weights(),
                            lm_mixing.plain_refinement())
    buffer, _, sizes = next(lm_mixing._runs([text[:-1]]))
    byte, hs = lm_mixing.contexts(buffer, sizes)
    chunk = lm_mixing.Sorted(code, byte, hs)
    groups = lm_mixing.Groups(code, model.tables)
    word = {b: "".join(f"{code.nibble[q][b]:04b}" for q in range(4))[:code.length[b]] for b in range(256)}
    placed = [word[b] for b in chunk.byte]
    cost = np.zeros(len(placed))
    for t, n in enumerate(chunk.live):
        assert [len(w) > t for w in placed] == [True] * n + [False] * (len(placed) - n)
        assert [len({w[:t] for w in placed[i:j]}) for i, j, _ in chunk.spans[t]] == [1] * len(chunk.spans[t])
        assert sum(j - i for i, j, _ in chunk.spans[t]) == n
        middle, bit, many = chunk.by_bit[t]
        bits = np.repeat(bit, many)
        assert [int(w[t]) for w in placed[:n]] == bits.tolist()
        if n and t % 4 == 0:
            groups.fetch(chunk, t)
        x = 0.3 / 16 * groups.inputs(chunk, t).sum(axis=0) if n else np.zeros(0)
        step = np.rint(np.clip(2 * x, -16, 16))
        x = (x + step / 2) / 2
        cost[:n] += np.log1p(np.exp(np.where(bits == 1, -x, x)))
    assert np.allclose(lm_mixing.score_bytes(model, byte, hs)[chunk.order], cost, rtol=1e-3)
    seen = cells[0].reshape(-1, 16).any(axis=1)
    assert not lm_mixing.stretched(cells[0]).reshape(-1, 16)[~seen].any()
