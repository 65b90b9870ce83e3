"""Impact search, host reputation and conversation repair against brute force, and their defined cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from carbonledger.llm import host_reputation, impact_search, turn_repair
from tests.llm.test_text_operators import EDGE, docs_of, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# --- search -----------------------------------------------------------------------------------------------------

def brute_search(docs, items, k=50):
    terms = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in docs if t and TERM.search(t)]
    n_docs, length = len(terms), sum(sum(c.values()) for _, c in terms)
    out = []
    for item, text in items:
        scored = []
        for doc, c in terms:
            m = 50 + 50 * sum(c.values()) * n_docs // length
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & c.keys():
                df = sum(t in d for _, d in terms)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (
                    10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_search_is_the_brute_force_ranking(spark):
    texts = EDGE + [prose(s, 40) for s in range(60)] + ["AN to", "an TO", "an-to", "ÀN àn", "x" * 3]
    items = [(k, prose(100 + k, 12)) for k in range(8)] + [(90, "x À"), (91, None), (92, "?!"), (93, "nowhere"),
                                                         (94, "an to"), (94, "an to"), (None, "an")]
    got = impact_search.search(docs_of(spark, texts), items_of(spark, items)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_search(list(enumerate(texts)), items)


def test_search_in_blocks_tiles_and_ties(spark, monkeypatch):
    for name, value in (("ITEMS", 2), ("TERM_TILE", 3), ("DOC_TILE", 4), ("SALTS", 2)):
        monkeypatch.setattr(impact_search, name, value)
    texts = ["an to re"] * 30 + [prose(s, 25) for s in range(30)] + ["an to re"] * 30
    rows = list(zip([*range(89, -1, -1)], texts)) + [(None, "an to re"), (5, "an to re")]  # null and repeated ids
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = [(k, prose(50 + k, 9)) for k in range(6)] + [(7, "an to re")]
    got = impact_search.search(docs, items_of(spark, items), k=7).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_search(rows, items, k=7)


def test_search_of_empty_tables(spark):
    docs, items = docs_of(spark, ["an"]), items_of(spark, [(1, "an")])
    assert impact_search.search(docs.limit(0), items).count() == 0
    assert impact_search.search(docs, items.limit(0)).count() == 0
    assert impact_search.search(docs.withColumn("item", F.lit(1)).withColumn("score", F.lit("s")),
                                items.withColumn("rank", F.lit("x"))).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_of_long_texts_are_whole(monkeypatch):
    text = prose(3, 500) + "Z" * 300 + prose(4, 50)
    whole = impact_search.term_counts(text)
    monkeypatch.setattr(impact_search, "PIECE", 16)
    assert impact_search.term_counts(text) == whole == Counter(
        t.translate(LOWER).encode() for t in TERM.findall(text))


# --- host reputation --------------------------------------------------------------------------------------------

def brute_verdicts(pages, labels, z=1.645, threshold=0.5):
    bad = {}
    for doc, quality, toxic in labels:
        marks = [m for m in (None if quality is None else int(quality == 0), None if toxic is None else int(toxic == 1))
                 if m is not None]
        if doc is not None and marks:
            bad[doc] = max(bad.get(doc, 0), *marks)
    rows, n, good = [], Counter(), Counter()
    for page, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path, host = re.split("[?#]", rest[len(host):], maxsplit=1)[0], host.translate(LOWER)
        rows.append((page, host, path))
        n[host] += page in bad
        good[host] += page in bad and not bad[page]
    where = {}
    for host in {r[1] for r in rows}:
        bare = re.sub(r"\.?(:[0-9]*)?$", "", host.rpartition("@")[2], count=1)
        parts = bare.split(".")
        size = 2 if ".".join(parts[-2:]) in host_reputation.TWO_LABELS else 1
        ip = re.match(r"[0-9.]+$|\[", bare)
        where[host] = ("", bare) if ip else (".".join(parts[-size:]), ".".join(parts[-size - 1:]))

    def add(groups, key):
        out = defaultdict(lambda: [0, 0])
        for g, (a, b) in groups.items():
            out[key(g)][0] += a
            out[key(g)][1] += b
        return out

    hosts = {h: (n[h], good[h]) for h in where}
    domains = add(hosts, where.get)
    suffixes = add(domains, lambda d: d[0])

    def strength(groups, key):
        a = b = 0
        for above in {key(g) for g in groups}:
            own = [(t, k) for g, (t, k) in groups.items() if key(g) == above and t]
            t, k = sum(x[0] for x in own), sum(x[1] for x in own)
            if 0 < k < t:
                p = k / t
                a += sum(x * (y / x - p) ** 2 for x, y in own) / (p * (1 - p)) - (len(own) - 1)
                b += t - sum(x * x for x, _ in own) / t - (len(own) - 1)
        return 10 if b <= 1e-9 else 1 / min(max(a / b, 1 / 1001), 1 / 3) - 1

    t, k = (sum(x[i] for x in hosts.values()) for i in (0, 1))
    s3, s2, s1 = strength(hosts, where.get), strength(domains, lambda d: d[0]), strength(suffixes, lambda _: 0)
    blocked = set()
    for host, (suffix, domain) in where.items():
        m = (suffixes[suffix][1] + s1 * (k + 1) / (t + 2)) / (suffixes[suffix][0] + s1)
        m = (domains[suffix, domain][1] + s2 * m) / (domains[suffix, domain][0] + s2)
        a, b = good[host] + s3 * m, n[host] - good[host] + s3 * (1 - m)
        if a / (a + b) + z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) < threshold:
            blocked.add(host)
    out = []
    for page, host, path in rows:
        fit = [(len(r), r, v) for v, r in host_reputation.RULES
               if ("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1])]
        rule, verdict = max(fit)[1:] if fit else (None, "block" if host in blocked else "allow")
        out.append((page, host, path, rule, verdict))
    return sorted(out, key=str), blocked


URLS = [None, "", "no scheme", "http://", "https://A.B.Example.NET", "https://example.net/en/x?q=1#t", "ftp://net/",
        "http://anet/", "https://x.example.com/de/", "https://x.example.com/DE/", "https://u:p@w.org:80/fr/1",
        "https://sub.org/fr/1", "https://org./fr/", "http://10.1.2.3:8080/a", "http://[::1]/x", "http://a.co.uk/b",
        "http://b.a.co.uk?x=://y.net/", "http://x.org/a\nb?c", "a://b://c.net/d", "https://example.net/en?/en/"]


def test_verdicts_are_the_brute_force_ones(spark):
    rnd = random.Random(5)
    pages = list(enumerate(URLS)) + [(3, "http://x.org/again"), (None, "http://x.org/none")]
    labels = [(3, 0, None), (3, 1, 0), (5, None, None), (None, 0, 1), (6, None, 1)]
    for k in range(20, 700):
        host = rnd.choice(["bad.spam.info", "w.spam.info", "new.spam.info", "fine.org", "a.fine.org", "x.example.org"])
        pages.append((k, f"https://{host}/p/{k}"))
        if "new" not in host and rnd.random() < .7:
            labels.append((k, int(rnd.random() < (.05 if "spam" in host else .95)), 0))
    p = spark.createDataFrame(pages, "page_id long, url string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want, blocked = brute_verdicts(pages, labels)
    got = host_reputation.judge(p, lab).drop("by_rule").collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    # The unlabelled host of a bad domain falls with it; the good ones stay.
    assert {"bad.spam.info", "w.spam.info"} <= blocked and not {"fine.org", "a.fine.org"} & blocked


def test_verdicts_without_labels_or_pages(spark):
    p = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash"))
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = host_reputation.judge(p, lab)
    assert got.filter("NOT by_rule AND verdict = 'block'").count() == 0 and got.count() == len(URLS)
    assert host_reputation.judge(p.limit(0), lab).count() == 0


def test_equal_rules_block_and_longer_rules_win(spark):
    rules = [("allow", "a.b/"), ("block", "a.b/"), ("allow", "b/"), ("allow", "a.b/x/")]
    urls = spark.createDataFrame([("a.b", "/"), ("c.b", "/"), ("z.a.b", "/x/1"), ("ab", "/")], "host string, path string")
    rule, verdict = host_reputation.first_rule(F.col("host"), F.col("path"), rules)
    assert [tuple(r) for r in urls.select(rule, verdict).collect()] == [
        ("a.b/", "block"), ("b/", "allow"), ("a.b/x/", "allow"), (None, None)]


# --- conversation repair ----------------------------------------------------------------------------------------

SHAPE = re.compile(r"(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def brute_repair(rows):
    """All edits in order of cost, with at most two inserted turns in each gap."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        ws = text.strip(" \t\n\v\f\r")
        faults.append(1 if not ws else 2 if (role, text) in seen else 3 if ws[-1] not in ".!?" else 0)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    gaps = [("", 0), ("u", 2), ("a", 2), ("ua", 4), ("au", 4)]
    best = None

    def options(k):
        _, role, text = rows[k]
        yield "D", 3, None
        if faults[k] in (0, 3):
            extra = faults[k] == 3
            if role:
                yield "K", extra, (role, text)
            yield "R", 2 + extra, ("user", text)
            yield "R", 2 + extra, ("assistant", text)

    names = {"u": "user", "a": "assistant"}
    found = {("", ()): (0, "")}  # shape so far and turns -> cheapest (cost, audit)
    for k in range(len(rows) + 1):
        after = {}
        for (shape, turns_), (cost, audit) in found.items():
            for ins, c in gaps:
                base = (cost + c, audit + "I" * len(ins), shape + ins, turns_ + tuple((names[x], "") for x in ins))
                if k == len(rows):
                    if SHAPE.fullmatch(base[2]) and (best is None or base[:2] < best[:2]):
                        best = (base[0], base[1], base[3])
                    continue
                for e, c2, turn in options(k):
                    s = base[2] + (turn[0][:1] if turn else "")
                    if not re.fullmatch(r"s?(ua)*u?", s):
                        continue
                    key, value = (s, base[3] + ((turn,) if turn else ())), (base[0] + c2, base[1] + e)
                    if key not in after or value < after[key]:
                        after[key] = value
        if k < len(rows):
            found = after
    text = "\n".join(f"{r}:{t}" for r, t in best[2])
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2),
            faults.count(3), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), best[0],
            best[1], hashlib.sha256(text.encode()).hexdigest())


def conversations(seed, n):
    rnd = random.Random(seed)
    texts = ["Hi.", "hi", "", " \t", "Yes!", "no", "Why? ", "é…", None, "a\nb."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    rows = []
    for conv in range(n):
        size = rnd.randint(1, 6)
        for t in range(size):
            turn = rnd.choice([t, t, t, t + 1, None])
            rows.append((conv, turn, rnd.choice(roles[:5] if rnd.random() < .8 else roles), rnd.choice(texts)))
    return rows + [(None, 0, "user", "x."), (None, 1, "assistant", "y")]


CONV = "conv_id long, turn long, role string, text string"


def wanted(rows):
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(tuple(r))
    return {c: brute_repair(r) for c, r in by.items()}


@pytest.mark.parametrize("size", [4096, 1, 2])
def test_repair_is_the_cheapest_edit(spark, size):
    rows = brute_damage(conversations(size, 60))
    got = turn_repair.repair(spark.createDataFrame(rows, CONV).repartition(3), size).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == wanted(rows)


def test_damage_and_dropped_conversations(spark):
    rows = conversations(9, 80) + [(c, None, "user", "only.") for c in range(100, 160)]
    given = spark.createDataFrame(rows, CONV).withColumn("fault", F.lit("clash")).withColumn("id", F.lit(1))
    damaged = turn_repair.damage(given)
    assert sorted((tuple(r) for r in damaged.collect()), key=str) == sorted(brute_damage(rows), key=str)
    got = {r[0]: tuple(r)[1:] for r in turn_repair.repair_all(given, damaged).collect()}
    want = wanted(brute_damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, none) for c in {r[0] for r in rows}} and none in got.values()
    assert turn_repair.repair_all(given.limit(0), damaged.limit(0)).count() == 0


def test_long_conversation_in_segments_is_the_whole_one(spark):
    rnd = random.Random(3)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", f"{t}!", ""])) for t in range(900)]
    rows += [(1, 5, "user", "same.")] * 300 + [(2, 0, "user", "q?"), (2, 1, "assistant", "a.")]
    df = spark.createDataFrame(rows, CONV).repartition(4)
    whole, parts = (sorted(map(tuple, turn_repair.repair(x, size).collect()))
                    for x, size in ((df.coalesce(1), 10_000), (df, 17)))
    assert whole == parts
    assert sum(x != "I" for x in whole[0][7]) == 1200


def test_colliding_hashes_do_not_decide(monkeypatch):
    rnd = random.Random(1)
    for mod in ((1 << 61) - 1, 3, 1):
        monkeypatch.setattr(turn_repair, "_MOD", mod)
        nodes = [turn_repair.root()]
        for _ in range(400):
            nodes.append(turn_repair.Node(rnd.choice(nodes[-30:]), rnd.choice([68, 73])))
        for a, b in itertools.islice(itertools.combinations(rnd.sample(nodes, 60), 2), 1500):
            assert turn_repair.less(a, b) == (a.letters() < b.letters())
