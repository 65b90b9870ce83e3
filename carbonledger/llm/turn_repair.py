"""Conversation structure repair: the cheapest edits that give roles the shape ``(s?(ua)+)?``.

Edits of a conversation's rows, in order: Keep (cost 0), Rerole to user or
assistant (2), Delete (3), Insert an empty user or assistant turn (2); a row
without text (blank) or with the role and text of an earlier row (duplicate)
must go, a row that stays without an end mark (truncated) costs 1 more.  The
audit is the string of the edits' initials; of the cheapest edits the one with
the smallest audit (ASCII) is taken.

Method: a dynamic program over (rows, state of the pattern) whose audits are
persistent: every step is a node that points to the node before it, so the
states share their common beginnings.  A node holds the rolling hash of its
string and its ancestors 1, 2, 4, ... steps back.  Two audits of equal cost are
compared by a search for their longest common prefix over these ancestors, and
the prefix found is verified letter by letter down to the shared node, so a hash
collision cannot decide (then the strings are compared plainly).  An audit
determines its state and cost, so of equally cheap audits for the same rows and
state none is a beginning of another, and the first different letter decides for
every continuation.

Long conversations are worked through in segments of at most ``SEGMENT`` rows:
a range partitioning deals a conversation of any length over many tasks, each
segment yields the cheapest audit from every state to every state, with its rank
among them, and the same program runs over the segments with ranks for letters
(every audit of a segment ends with the edit of its last row, so here too none is
a beginning of another).  Only its audit, which is one value of the result, and
its digest, which SHA-256 makes a sequential stream, pass through one task.

Rows of a conversation are ordered by turn (nulls first), then role and text, so
that rows of equal turns have a defined order and copies are adjacent.

Defined cases: a null role, text, turn or conv_id counts as one space where it is
read as text; rows with a null conv_id are one conversation; an empty role has no
initial and is never kept; a conversation without rows (all dropped) has zeros, an
empty audit and the digest of the empty string; repeated rows are duplicates; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SEGMENT, CHARS = 4096, 8 << 20  # rows, and characters after which a segment ends early
# States: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn.
STATES, FINAL = range(4), (0, 3)
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}  # what an inserted or reroled turn must be
NAMES = {"u": "user", "a": "assistant"}
_MOD, _BASE = (1 << 61) - 1, 1_000_003
_PIECES = 16


# --- persistent audits ------------------------------------------------------------------------------------------

class Node:
    """Last letter of an audit; ``up[j]`` is the node 2**j steps back."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None, letter: int):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth, self.hash = parent.depth + 1, (parent.hash * _BASE + letter + 1) % _MOD
        up, j, at = [parent], 0, parent
        while j < len(at.up):
            at = at.up[j]
            up.append(at)
            j += 1
        self.up = tuple(up)

    def letters(self) -> list[int]:
        out, at = [], self
        while at.depth:
            out.append(at.letter)
            at = at.up[0]
        return out[::-1]


def root() -> Node:
    return Node(None, 0)


def ancestor(node: Node, depth: int) -> Node:
    j = 0
    rest = node.depth - depth
    while rest:
        if rest & 1:
            node = node.up[j]
        rest >>= 1
        j += 1
    return node


def less(a: Node, b: Node) -> bool:
    """Whether audit ``a`` is smaller than ``b``: the first letter after their longest common prefix decides."""
    if a is b:
        return False
    depth = min(a.depth, b.depth)
    x, y = ancestor(a, depth), ancestor(b, depth)
    if x.hash == y.hash:
        if not same(x, y):
            return a.letters() < b.letters()
        return a.depth < b.depth
    for j in range(len(x.up) - 1, -1, -1):
        if j < len(x.up) and x.up[j].hash != y.up[j].hash:
            x, y = x.up[j], y.up[j]
    # x and y are the first nodes whose prefixes differ, if no hash lied.
    if x.letter == y.letter or not same(x.up[0], y.up[0]):
        return a.letters() < b.letters()
    return x.letter < y.letter


def same(x: Node, y: Node) -> bool:
    """Letter by letter: equal strings (down to the node that both share)."""
    if x.depth != y.depth:
        return False
    while x is not y and x.depth:
        if x.letter != y.letter:
            return False
        x, y = x.up[0], y.up[0]
    return True


def put(found: dict, state: int, cost: int, parent: Node, letter: int) -> None:
    """Offer an audit for a state: kept if cheaper, or as cheap and smaller."""
    old = found.get(state)
    if old is None or cost < old[0]:
        found[state] = (cost, Node(parent, letter))
    elif cost == old[0] and less(node := Node(parent, letter), old[1]):
        found[state] = (cost, node)


_D, _I, _K, _R = map(ord, "DIKR")


def with_inserts(found: dict) -> dict:
    """The same states, and those that inserted turns lead to."""
    out = dict(found)
    for _ in range(2):  # 0 or 1 -> user -> assistant; further turns only come back to a state
        for state, (cost, node) in list(out.items()):
            put(out, AFTER[state, WANTED[state]], cost + INSERT, node, _I)
    return out


def consume(found: dict, initial: str, must_go: bool, truncated: bool) -> dict:
    """States after one more row."""
    out: dict = {}
    extra = TRUNCATED if truncated else 0
    for state, (cost, node) in with_inserts(found).items():
        put(out, state, cost + DELETE, node, _D)
        if must_go:
            continue
        if (kept := AFTER.get((state, initial))) is not None:
            put(out, kept, cost + extra, node, _K)
        put(out, AFTER[state, WANTED[state]], cost + REROLE + extra, node, _R)
    return out


def finish(found: dict) -> tuple[int, Node]:
    """Cheapest end, with turns inserted after the last row."""
    best = None
    for state, (cost, node) in with_inserts(found).items():
        if state in FINAL and (best is None or cost < best[0] or cost == best[0] and less(node, best[1])):
            best = (cost, node)
    return best


def repaired(audit: str, rows: Iterable[tuple[str, str]], state: int = 0) -> Iterator[tuple[str, str]]:
    """(role, text) turns of the edited rows."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES[WANTED[state]]
        state = AFTER[state, role[:1]]
        yield role, text


class Digest:
    """SHA-256 of newline-joined ``role:text`` turns, as a stream."""

    def __init__(self):
        self.sha, self.first = hashlib.sha256(), True

    def add(self, turns: Iterable[tuple[str, str]]) -> Digest:
        for role, text in turns:
            self.sha.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.first = False
        return self


# --- damaged rows -----------------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the faults dealt by crc32(conv_id:turn) modulo 20; nulls read as one space."""
    def as_text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"),
                                fault.alias("fault")).filter("fault <> 0")
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with id and fault: 0 none, 1 blank, 2 duplicate, 3 truncated; ``rows`` as ``damage`` returns them."""
    base = cut(rows.withColumn("id", F.monotonically_increasing_id()))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    digest = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
    keyed = base.select("*", blank.alias("blank"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("c"),
                        digest.alias("d"))
    # Role and text are equal, so turn (nulls first) and id give the order; a group of copies is one row per task.
    first = (keyed.filter("NOT blank").groupBy("c", "d")
             .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "id")).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("c", "d", F.col("first.id").alias("first")))
    open_end = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (F.when(F.col("blank"), 1).when(F.col("first") != F.col("id"), 2).when(open_end, 3).otherwise(0))
    return (keyed.join(cut(first), ["c", "d"], "left")
            .select("conv_id", "turn", "role", "text", "id", fault.alias("fault")))


# --- segments ---------------------------------------------------------------------------------------------------

_SEGMENT = ("conv_id long, no_id boolean, part int, seq long, n long, turns long, low long, high long, "
            "blank long, duplicate long, truncated long, illegal long, head string, tail string, "
            "costs array<int>, ranks array<int>, pieces array<string>, solo_cost long, solo_audit string, "
            "solo_sha string")


def segment(rows: list[tuple], whole: bool, first: bool) -> dict:
    """Counts of a run of rows (turn, role, text, fault), its cheapest audits between states, and its own repair.

    ``whole``: the run is known to be a conversation; ``first``: it is known to begin one.
    """
    turns = [r[0] for r in rows if r[0] is not None]  # sorted
    initials = [r[1][:1] for r in rows]
    faults = [r[3] for r in rows]
    out = {"n": len(rows), "turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
           "head": initials[0], "tail": initials[-1],
           "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
           "illegal": sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))}
    ends: dict[tuple[int, int], tuple[int, Node]] = {}
    for begin in ((0,) if first else STATES):
        found = {begin: (0, root())}
        for (_, _, _, fault), initial in zip(rows, initials):
            found = consume(found, initial, fault in (1, 2), fault == 3)
        ends |= {(begin, state): x for state, x in found.items()}
        if begin == 0:
            cost, node = finish(found)
            audit = "".join(map(chr, node.letters()))
            sha = Digest().add(repaired(audit, ((r[1], r[2]) for r in rows))).sha.hexdigest()
            out |= {"solo_cost": cost, "solo_audit": audit, "solo_sha": sha}
    if whole:
        return out | {"costs": None, "ranks": None, "pieces": None}
    pieces = ["".join(map(chr, ends[k][1].letters())) if (k := divmod(i, 4)) in ends else None for i in range(_PIECES)]
    rank = {p: i for i, p in enumerate(sorted({p for p in pieces if p is not None}))}
    return out | {"costs": [ends[k][0] if (k := divmod(i, 4)) in ends else None for i in range(_PIECES)],
                  "ranks": [rank.get(p) for p in pieces], "pieces": pieces}


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row per segment, in order of (part, seq); a segment's rows are neighbours of one conversation."""
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, own, run, made, chars = TaskContext.get().partitionId(), 0, None, [], [], 0
        begins = False  # the run is known to begin its conversation

        def emit(ends: bool):
            nonlocal seq, chars
            made.append({"conv_id": own[0], "no_id": own[1], "part": part, "seq": seq,
                         **segment(run, begins and ends, begins)})
            seq, chars = seq + 1, 0
            run.clear()

        for pdf in batches:
            for conv, none, turn, unplaced, role, text, fault in zip(
                    pdf["conv_id"].tolist(), pdf["no_id"].tolist(), pdf["turn"].tolist(), pdf["no_turn"].tolist(),
                    pdf["role"], pdf["text"], pdf["fault"].tolist()):
                if own != (conv, none):
                    if run:
                        emit(True)
                    begins, own = own is not None, (conv, none)
                elif len(run) == size or chars > CHARS:
                    emit(False)
                    begins = False
                run.append((None if unplaced else turn, role, text, fault))
                chars += len(text)
            if made:
                yield pd.DataFrame(made, dtype=object)
                made.clear()
        if run:
            emit(False)
            yield pd.DataFrame(made, dtype=object)

    spark = rows.sparkSession
    keys = [F.col("no_id"), F.col("conv_id"), F.col("no_turn").desc(), F.col("turn"), F.col("role"), F.col("text"),
            F.col("id")]
    # Nulls travel beside their columns, which would become floats.
    dealt = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
                        F.col("conv_id").isNull().alias("no_id"),
                        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                        F.col("turn").isNull().alias("no_turn"), "role", "text", "fault", "id")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = dealt.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return ranged.select("conv_id", "no_id", "turn", "no_turn", "role", "text", "fault").mapInPandas(stream, _SEGMENT)


# --- whole conversations ----------------------------------------------------------------------------------------

_JOINED = ("conv_id long, no_id boolean, part int, seq long, k long, pick int, tail string, gaps long, blank long, "
           "duplicate long, truncated long, illegal long, cost long")


def join_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of conversations in order -> the audit chosen for each segment, and the conversation's counts."""
    own, run = None, []
    for pdf in batches:
        made = []
        for row in pdf.to_dict("records"):
            if own != (row["conv_id"], row["no_id"]):
                if run:
                    made += chosen(run)
                own, run = (row["conv_id"], row["no_id"]), []
            run.append(row)
        if made:
            yield pd.DataFrame(made)
    if run:
        yield pd.DataFrame(chosen(run))


def chosen(run: list[dict]) -> list[dict]:
    found = {0: (0, root())}
    for row in run:
        after: dict = {}
        for i, (cost, rank) in enumerate(zip(row["costs"], row["ranks"])):
            if (before := found.get(i // 4)) is not None and rank is not None and rank == rank:
                put(after, i % 4, before[0] + int(cost), before[1], int(rank) * _PIECES + i)
        found = after
    cost, node = finish_ranked(found)
    tail = {0: "", 3: "", 2: "I", 1: "II"}[node.letter % _PIECES % 4]
    picks = [x % _PIECES for x in node.letters()]
    given = [r for r in run if r["low"] is not None]  # in order of turns
    gaps = 0
    if given:
        distinct = sum(r["turns"] for r in given) - sum(a["high"] == b["low"] for a, b in zip(given, given[1:]))
        gaps = int(given[-1]["high"]) - int(given[0]["low"]) + 1 - distinct
    illegal = sum(r["illegal"] for r in run) + sum(
        a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(run, run[1:]))
    sums = {c: sum(r[c] for r in run) for c in ("blank", "duplicate", "truncated")}
    return [{"conv_id": r["conv_id"], "no_id": r["no_id"], "part": r["part"], "seq": r["seq"], "k": k, "pick": p,
             "tail": tail, "gaps": gaps, "illegal": illegal, "cost": cost, **sums}
            for k, (r, p) in enumerate(zip(run, picks))]


def finish_ranked(found: dict) -> tuple[int, Node]:
    """Cheapest end over all states: the missing turns are inserted after the last segment."""
    best = None
    for state, (cost, node) in found.items():
        cost += {0: 0, 3: 0, 2: INSERT, 1: 2 * INSERT}[state]
        if best is None or cost < best[0] or cost == best[0] and less(node, best[1]):
            best = (cost, node)
    return best


def repair(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.  Conversations without rows do not appear."""
    faulty = with_faults(rows)
    cuts = cut(segments(faulty, size))
    key = ["conv_id", "no_id"]
    long_ones = cut(cuts.groupBy(*key).agg(F.count(F.lit(1)).alias("segments")).filter("segments > 1").select(*key))
    counts = ["blank", "duplicate", "truncated", "illegal"]
    solo = cuts.join(long_ones, key, "left_anti").select(
        *key, F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), *counts,
        F.col("solo_cost").alias("cost"), F.col("solo_audit").alias("audit"),
        F.col("solo_sha").alias("repaired_sha256"))

    many = cuts.join(long_ones, key, "left_semi")
    light = many.select(*key, "part", "seq", "turns",
                        *[F.col(c).cast("string").alias(c) for c in ("low", "high")], *counts, "head", "tail", "costs", "ranks")
    picked = cut(light.repartition(*key).sortWithinPartitions(*key, "part", "seq")
                 .mapInPandas(join_segments, _JOINED))
    pieces = many.select("part", "seq", "pieces").join(picked, ["part", "seq"])
    # The audit is one value of the result: as many letters as the conversation has rows.
    audits = cut(pieces.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("k", F.col("pieces")[F.col("pick")].alias("piece")))).alias("p"),
        F.first("tail").alias("end"), *[F.first(c).alias(c) for c in ("gaps", *counts, "cost")])
        .select(*key, "gaps", *counts, "cost", F.concat(F.array_join("p.piece", ""), "end").alias("audit")))
    digests = long_digests(faulty, audits.select(*key, "audit"))
    both = solo.unionByName(audits.join(digests, key).select(*solo.columns))
    return both.select(F.when(~F.col("no_id"), F.col("conv_id")).alias("conv_id"), "gaps", *counts, "cost", "audit",
                       "repaired_sha256")


def long_digests(faulty: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, no_id, repaired_sha256): rows of each conversation streamed in order through its audit."""
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, at, state, digest, audit, made = None, 0, 0, None, "", []

        def step(rows: list[tuple[str, str]], end: bool):
            """Feed rows and the edits up to them; at the end also the turns inserted after the last row."""
            nonlocal at, state
            stop, left = at, len(rows)
            while stop < len(audit) and (left or end and audit[stop] == "I"):
                left -= audit[stop] != "I"
                stop += 1
            turns = list(repaired(audit[at:stop], rows, state))
            digest.add(turns)
            at, state = stop, AFTER_ROLE[turns[-1][0][:1]] if turns else state

        def close():
            step([], True)
            made.append({"conv_id": own[0], "no_id": own[1], "repaired_sha256": digest.sha.hexdigest()})

        for pdf in batches:
            for conv, none, given, role, text in zip(pdf["conv_id"].tolist(), pdf["no_id"].tolist(), pdf["audit"],
                                                     pdf["role"], pdf["text"]):
                if given is not None:  # the audit comes before its conversation's rows
                    if own is not None:
                        close()
                    own, at, state, digest, audit = (conv, none), 0, 0, Digest(), given
                else:
                    step([(role, text)], False)
            if made:
                yield pd.DataFrame(made)
                made.clear()
        if own is not None:
            close()
            yield pd.DataFrame(made)

    null = F.lit(None)
    heads = audits.select("conv_id", "no_id", F.lit(0).alias("kind"), F.lit(False).alias("turn_given"),
                          null.cast("long").alias("turn"), null.cast("string").alias("role"),
                          null.cast("string").alias("text"), null.cast("long").alias("id"), "audit")
    rows = faulty.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
                         F.col("conv_id").isNull().alias("no_id"), F.lit(1).alias("kind"),
                         F.col("turn").isNotNull().alias("turn_given"), F.col("turn").cast("long").alias("turn"),
                         "role", "text", "id", null.cast("string").alias("audit"))
    rows = rows.join(audits.select("conv_id", "no_id"), ["conv_id", "no_id"], "left_semi")
    both = (heads.unionByName(rows).repartition("conv_id", "no_id")
            .sortWithinPartitions("no_id", "conv_id", "kind", "turn_given", "turn", "role", "text", "id"))
    return both.select("conv_id", "no_id", "audit", "role", "text").mapInPandas(
        stream, "conv_id long, no_id boolean, repaired_sha256 string")


AFTER_ROLE = {"s": 1, "u": 2, "a": 3}


def repair_all(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``repair`` of ``rows`` for every conv_id of ``conversations``, those without rows included."""
    none = F.sha2(F.lit("").cast("binary"), 256)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    got = cut(repair(rows))
    missing = ids.join(got.select(F.col("conv_id").alias("g"), F.lit(True).alias("there")),
                       F.col("conv_id").eqNullSafe(F.col("g")), "left_anti")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return got.unionByName(missing.select("conv_id", *zeros, F.lit("").alias("audit"), none.alias("repaired_sha256")))
