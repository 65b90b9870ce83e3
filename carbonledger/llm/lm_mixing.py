"""Language-model scoring by logistic context mixing (bits of bytes).

The text's UTF-8 bytes (A-Z lower-cased) and an end mark are predicted bit by
bit.  Predictors: the statistics of the bits seen before in three hashed contexts
(the last 3 and 5 bytes; the current word's beginning).  Each gives a
stretched probability; a weight vector chosen by a gate (bit position, how often
the 5-byte context and the word beginning were seen) adds them up in the logistic
domain; an adaptive map from (bits so far, mixed value) to the bit's observed
frequency refines the result; half of both is the prediction.

Learning, all over the training documents, on the executors:

1. token counts of the base model: map-side sums, one shuffle by token hash;
2. context statistics: each task counts its bytes' nibbles in hashed groups of 16
   cells; tasks emit only their non-zero cells, which are added per table slice in a tree;
3. weights and refinement map: the training documents fall into two folds, and
   each fold is predicted by the tables of the other one's counts, so that all of
   them update weights (online, in small batches) and map and none is predicted by
   its own counts; tasks' weights are averaged, their maps' counts added;
4. the tables for scoring hold the counts of all training documents.

The tables have a fixed size (hashed contexts, ``BITS`` cells each, one byte a
cell), so they are broadcast; the counts behind them cover all training text.
Scoring uses the finished model for every document alike: a score depends on
neither order nor partitioning, and a lost task can be run again.

Base model (unigram with additive smoothing): the ``HEAVY`` commonest tokens are
broadcast (bounded), all others are joined by token hash; tokens are 64-bit
hashes of lower-cased words.

Defined cases: null text is empty (one end token, an end mark); repeated rows
score alike; without training documents all counts are zero, the mixed
prediction is one half for every bit; an empty table gives an empty result;
extra columns are ignored; a null doc_id is a training document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import cut

ORDERS = (3, 5)  # bytes of context; the word's beginning comes after them
BITS = (22, 23, 24)  # cells of each predictor's table
GATES = 4 * 4
BUCKETS = 33
SLICE = 1 << 16
HEAVY = 1 << 18
RUN = 1 << 18
CHUNK = 1 << 15
TOKENS = 1 << 19  # different tokens that a worker holds before it emits their counts
FIT_CHUNK = 1 << 15
RATE = 1.0
END_TOKEN = 0x6E6420656E64
PAD = 0xFF  # in no UTF-8 text: stands before a text and is its end mark
LONGEST = 16  # bits of a byte's code
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)]


class Code:
    """A prefix code of the 256 byte values for given frequencies, at most LONGEST bits long.

    Common bytes get short codes, so that a byte is few binary decisions.  ``rank`` orders the bytes by falling
    code, longest codes first: among bytes in this order those that have a bit t are in front, and those that meet
    in a node of the code's tree lie side by side, the ones whose next bit is 1 before the ones whose bit is 0.
    ``nodes`` has a row for each node, by its bits t: its bounds as ranks (first, first with bit 0, end), its cell (1
    to 15) in the group of its four bits, the middle bucket of its map cells (of the bits so far, folded to 8), and t.
    """

    def __init__(self, frequency: np.ndarray):
        weight = np.asarray(frequency, np.float64) + 1
        length = self._lengths(weight)
        while length.max() > LONGEST:
            weight = weight ** 0.9 + 1  # flatter until the longest code fits
            length = self._lengths(weight)
        word, last = np.zeros(256, np.int64), 0
        code = -1
        for b in sorted(range(256), key=lambda b: (length[b], b)):  # canonical: in order of length
            code = (code + 1) << (length[b] - last)
            word[b], last = code, length[b]
        self.length = length
        full = word << (LONGEST - length)
        self.nibble = [((full >> (LONGEST - 4 * (q + 1))) & 15).astype(np.int64) for q in range(LONGEST // 4)]
        self.before = [(full >> (LONGEST - 4 * q)).astype(np.uint64) for q in range(LONGEST // 4)]
        self.mixed = [before * _K[2] for before in self.before]
        by_rank = np.lexsort((-full, -length))
        self.rank = np.empty(256, np.uint8)
        self.rank[by_rank] = np.arange(256)
        self.nodes = np.concatenate([self._nodes(full[by_rank], length[by_rank], t) for t in range(LONGEST)])

    @staticmethod
    def _nodes(full: np.ndarray, length: np.ndarray, t: int) -> np.ndarray:
        full = full[length > t]  # the bytes that have a bit t are in front
        done, bit = full >> (LONGEST - t), (full >> (LONGEST - 1 - t)) & 1
        first = np.flatnonzero(np.diff(done, prepend=-1))
        end = np.append(first[1:], len(full)) if len(first) else first
        zero = first + (np.add.reduceat(bit, first) if len(first) else 0)
        done = done[first]
        cell = (1 << t % 4) | (done & ((1 << t % 4) - 1))
        sofar = (1 << min(t, 8)) | (done & ((1 << min(t, 8)) - 1))
        return np.column_stack([first, zero, end, cell, sofar * BUCKETS + BUCKETS // 2,
                                np.full(len(first), t)])

    @staticmethod
    def _lengths(weight: np.ndarray) -> np.ndarray:
        import heapq
        heap = [(w, b, (b,)) for b, w in enumerate(weight)]
        heapq.heapify(heap)
        length = np.zeros(len(weight), np.int64)
        while len(heap) > 1:
            w1, b1, s1 = heapq.heappop(heap)
            w2, b2, s2 = heapq.heappop(heap)
            length[list(s1 + s2)] += 1
            heapq.heappush(heap, (w1 + w2, min(b1, b2), s1 + s2))
        return length


# --- contexts ---------------------------------------------------------------------------------------------------

def _runs(texts: list[bytes], size: int = RUN) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """(buffer, text of each part, coded bytes of each part): a part is 8 bytes of context, then its bytes."""
    parts, who, sizes, total = [], [], [], 0
    for k, t in enumerate(texts):
        body, at, lead = t + bytes([PAD]), 0, bytes([PAD]) * 8
        while at < len(body):
            stop = min(len(body), at + size)
            while stop < len(body) and body[stop - 1] not in b" \t\n\v\f\r" and stop < at + 2 * size:
                stop += 1
            if parts and total + stop - at > size:
                yield np.frombuffer(b"".join(parts), np.uint8), who, sizes
                parts, who, sizes, total = [], [], [], 0
            parts += [lead, body[at:stop]]
            who.append(k)
            sizes.append(stop - at)
            total += stop - at
            lead, at = (lead + body[max(0, stop - 8):stop])[-8:], stop
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), who, sizes


def contexts(buffer: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(coded bytes, per predictor a 64-bit hash of each byte's context)."""
    n = len(buffer)
    stops = list(accumulate(8 + size for size in sizes))

    def coded(of: np.ndarray, back: int = 0) -> np.ndarray:
        return np.concatenate([of[stop - size - back:stop - back] for size, stop in zip(sizes, stops)])

    before = coded(np.ndarray((n - 7,), "<u8", buffer, strides=(1,)), 8)  # the eight bytes before each coded one
    begin = np.flatnonzero(hashing.is_space(buffer) | (buffer == PAD)) + 1  # of the words; a part begins with PAD
    begin = np.concatenate([[0], begin])
    power, inverse = hashing._tables(n + 1)
    worth = buffer.astype(np.uint64)
    worth += np.uint64(1)
    worth *= power[:n]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(worth, out=total[1:])
    # Words' values are looked up once a word and handed to its bytes.
    long = np.diff(np.append(begin, n + 1))
    word = total - np.repeat(total.take(begin), long)
    word *= np.repeat(inverse.take(begin), long)
    raw = [before >> np.uint64(64 - 8 * o) for o in ORDERS] + [coded(word)]
    for k, h in enumerate(raw):
        h += np.uint64(k + 1)
        h *= _K[0]
        h ^= h >> np.uint64(29)
    return coded(buffer), raw


def _pieces(buffer: np.ndarray, sizes: list[int], size: int = CHUNK) -> Iterator[tuple[np.ndarray, list[int]]]:
    """A run's buffer and sizes in slices of whole parts, with at most ``size`` coded bytes (or one part), whose
    arrays fit in a core's cache."""
    first, at, stop, held = 0, 0, 0, 0
    for k, s in enumerate(sizes):
        if held and held + s > size:
            yield buffer[at:stop], sizes[first:k]
            first, at, held = k, stop, 0
        held += s
        stop += 8 + s
    yield buffer[at:stop], sizes[first:]


def group(h: np.ndarray, mixed: np.ndarray | None, bits: int) -> np.ndarray:
    """Number of the group of 16 cells of a context and the code bits already known, given as ``Code.mixed`` (None:
    no bits yet)."""
    if mixed is not None:
        h = h + mixed
    g = h >> np.uint64(31)
    g ^= h
    g *= _K[1]
    g >>= np.uint64(64 - (bits - 4))
    return g.view(np.int64)


class Sorted:
    """A chunk's bytes and context hashes in the order of ``Code.rank``.

    ``live[t]`` bytes, all in front, have a bit t.  Of the nodes of t bits that are met, ``spans[t]`` has (start, stop,
    cell); ``by_bit[t]`` has for each node and bit of it, 1 first, the middle bucket of the map, the bit and how many
    bytes have it.
    """

    BIT = np.tile(np.array([1, 0], np.float32), 256)

    def __init__(self, code: Code, byte: np.ndarray, hs: list[np.ndarray]):
        rank = code.rank.take(byte)
        self.order = rank.argsort(kind="stable")
        self.hs = [h.take(self.order) for h in hs]
        self.byte = byte.take(self.order).astype(np.intp)
        edge = np.zeros(257, np.int64)
        np.cumsum(np.bincount(rank, minlength=256), out=edge[1:])
        first, zero, stop = edge[code.nodes[:, :3].T]
        met = np.flatnonzero(first < stop)
        first, zero, stop = first[met], zero[met], stop[met]
        _, _, _, cell, middle, depth = code.nodes[met].T
        spans = list(zip(first.tolist(), stop.tolist(), cell.tolist()))
        middle = np.repeat(middle.astype(np.float32), 2)
        many = np.column_stack([zero - first, stop - zero]).ravel()
        at = np.searchsorted(depth, np.arange(LONGEST + 1)).tolist()
        self.spans = [spans[i:j] for i, j in zip(at, at[1:])]
        self.live = [own[-1][1] if own else 0 for own in self.spans]
        self.by_bit = [(middle[2 * i:2 * j], self.BIT[:2 * (j - i)], many[2 * i:2 * j]) for i, j in zip(at, at[1:])]


class Groups:
    """The groups of 16 cells that a chunk's bytes meet, fetched once for a nibble's four bits."""

    def __init__(self, code: Code, tables: list[np.ndarray]):
        self.code, self.tables = code, [t.reshape(-1, 16) for t in tables]
        self.room = np.empty((len(tables), max(CHUNK, FIT_CHUNK), 16), np.int8)

    def fetch(self, chunk: Sorted, t: int) -> None:
        n = chunk.live[t]
        self.rows = self.room[:, :n]
        mixed = self.code.mixed[t // 4].take(chunk.byte[:n]) if t else None
        for table, h, bits, rows in zip(self.tables, chunk.hs, BITS, self.rows):
            table.take(group(h[:n], mixed, bits), axis=0, out=rows, mode="clip")  # every group is in the table
        self.gate = (self.rows[-2, :, 0] << 2) + self.rows[-1, :, 0].astype(np.intp)

    def inputs(self, chunk: Sorted, t: int) -> np.ndarray:
        """(predictor, byte): stretched probabilities of bit t."""
        if t % 4 == 0:  # all in the same cell
            return self.rows[:, :, 1].astype(np.float32, order="C")
        st = np.empty((len(self.tables), chunk.live[t]), np.float32)
        for i, j, cell in chunk.spans[t]:
            st[:, i:j] = self.rows[:, i:j, cell]
        return st


# --- tables -----------------------------------------------------------------------------------------------------

def no_counts() -> list[np.ndarray]:
    """Zeros for every predictor's cells, written rather than left to the system: numpy asks for huge pages then, and
    counting hits a cell at random."""
    tables = [np.empty(1 << b, np.int32) for b in BITS]
    for table in tables:
        table.fill(0)
    return tables


def count_cells(code: Code, texts: list[bytes], counts: list[np.ndarray]) -> None:
    """Add the texts' code nibbles to each predictor's counts (a cell per group and nibble value)."""
    one = np.int32(1)
    for buffer, _, sizes in _runs(texts):
        for piece in _pieces(buffer, sizes):
            byte, hs = contexts(*piece)
            for q in range(LONGEST // 4):
                if q:
                    more = np.flatnonzero(code.length.take(byte) > 4 * q)
                    byte, hs = byte.take(more), [h.take(more) for h in hs]
                at = byte.astype(np.intp)
                value, mixed = code.nibble[q].take(at), code.mixed[q].take(at) if q else None
                for c, h, bits in zip(counts, hs, BITS):
                    cell = group(h, mixed, bits)
                    cell <<= 4
                    cell += value
                    np.add.at(c, cell, one)


def stretched(cells: np.ndarray) -> np.ndarray:
    """Of counts per nibble value (a multiple of 16 cells): the stretched probability of each node's bit in
    sixteenths (cells 1 to 15 of a group) and how often the group was seen (cell 0: 0, 1, 2 or 3)."""
    cells = cells.reshape(-1, 16)
    made = np.zeros(cells.shape, np.int8)
    met = np.flatnonzero(cells.any(axis=1))  # a group never seen is all zeros
    leaf = cells[met].astype(np.float64)
    out = np.zeros(leaf.shape, np.int8)
    total = leaf.sum(axis=1)
    out[:, 0] = (total > 0).astype(np.int8) + (total > 2) + (total > 15)
    for depth in range(3, -1, -1):
        zero, one = leaf[:, ::2], leaf[:, 1::2]
        st = np.log((one + 0.4) / (zero + 0.4))
        out[:, 1 << depth:2 << depth] = np.clip(np.rint(16 * st), -127, 127)
        leaf = zero + one
    made[met] = out
    return made.reshape(-1)


@dataclass
class Model:
    code: Code
    tables: list[np.ndarray]  # int8 per predictor
    weights: np.ndarray  # (bit, predictor, gate), float32
    refine: np.ndarray  # stretched frequencies per (bits so far, bucket of the mixed value), float32


def first_weights() -> np.ndarray:
    return np.full((LONGEST, len(BITS), GATES), 0.3 / 16, np.float32)


def plain_refinement() -> np.ndarray:
    return np.tile((np.arange(BUCKETS) - BUCKETS // 2).astype(np.float32) / 2, 512)


def _steps(x: np.ndarray) -> np.ndarray:
    """Buckets above the middle one."""
    y = _bounded(x * np.float32(2), BUCKETS // 2)
    return np.rint(y, out=y)


def _bounded(x: np.ndarray, most: int) -> np.ndarray:
    np.minimum(x, np.float32(most), out=x)
    return np.maximum(x, np.float32(-most), out=x)


def _mixed(st: np.ndarray, w: np.ndarray) -> np.ndarray:
    w *= st
    x = w[0]
    for more in w[1:]:
        x += more
    return x


def score_bytes(model: Model, byte: np.ndarray, hs: list[np.ndarray]) -> np.ndarray:
    """Cost in nats of every byte."""
    out, groups = np.empty(len(byte), np.float32), Groups(model.code, model.tables)
    for at in range(0, len(byte), CHUNK):
        chunk = Sorted(model.code, byte[at:at + CHUNK], [h[at:at + CHUNK] for h in hs])
        cost, odds = np.zeros(len(chunk.byte), np.float32), np.ones(len(chunk.byte), np.float32)
        for t, n in enumerate(chunk.live):
            if not n:
                break
            if t % 4 == 0:
                groups.fetch(chunk, t)
            x = _mixed(groups.inputs(chunk, t), model.weights[t].take(groups.gate[:n], axis=1))
            middle, bit, many = chunk.by_bit[t]
            at_map = _steps(x)
            at_map += middle.repeat(many)
            x += model.refine.take(at_map.astype(np.intp))
            x *= (np.float32(0.5) - bit).repeat(many)
            np.exp(_bounded(x, 12), out=x)
            x += np.float32(1)
            odds[:n] *= x
            if t % 4 == 3:  # the logarithm of a nibble's four bits at once
                cost[:n] += np.log(odds[:n])
                odds[:n] = 1
        out[at:at + CHUNK][chunk.order] = cost + np.log(odds)
    return out


def score_texts(model: Model, texts: list[bytes]) -> np.ndarray:
    """log10 probability of each text and its end mark."""
    out = np.zeros(len(texts))
    for buffer, who, sizes in _runs(texts):
        nats = [score_bytes(model, *contexts(*piece)) for piece in _pieces(buffer, sizes)]
        cost = np.add.reduceat(np.concatenate(nats).astype(np.float64), np.cumsum([0] + sizes[:-1]))
        np.add.at(out, who, cost)
    return -out / np.log(10)


class Fit:
    """Online learning of the gated weights and the refinement map from texts in order."""

    def __init__(self, code: Code, tables: list[np.ndarray], weights: np.ndarray | None = None):
        self.code, self.groups = code, Groups(code, tables)
        self.weights = first_weights() if weights is None else weights.copy()
        self.seen = np.zeros((LONGEST, GATES))
        self.map_n, self.map_one = np.zeros(512 * BUCKETS), np.zeros(512 * BUCKETS)

    def learn(self, texts: list[bytes]) -> None:
        for buffer, _, sizes in _runs(texts):
            found = [contexts(*piece) for piece in _pieces(buffer, sizes)]
            byte = np.concatenate([b for b, _ in found])
            hs = [np.concatenate(h) for h in zip(*[h for _, h in found])]
            n = np.zeros(2 * len(self.map_n), np.int64)
            for at in range(0, len(byte), FIT_CHUNK):
                cells: list[np.ndarray] = []
                self._step(byte[at:at + FIT_CHUNK], [h[at:at + FIT_CHUNK] for h in hs], cells)
                n += np.bincount(np.concatenate(cells), minlength=len(n))
            self.map_n += n[::2] + n[1::2]
            self.map_one += n[1::2]

    def _step(self, b: np.ndarray, hs: list[np.ndarray], cells: list[np.ndarray]) -> None:
        """Update the weights; the map cells met (twice the cell, plus the bit) are appended to ``cells``."""
        chunk, groups = Sorted(self.code, b, hs), self.groups
        sums = np.zeros((LONGEST, 1 + len(BITS), 8 * GATES))  # of each bit's gates: ones, then each predictor's slopes
        for t, n in enumerate(chunk.live):
            if not n:
                break
            if t % 4 == 0:
                groups.fetch(chunk, t)
                lane = groups.gate + LANE[:n]
            st = groups.inputs(chunk, t)
            x = _bounded(_mixed(st, self.weights[t].take(groups.gate[:n], axis=1)), 12)
            middle, bit, many = chunk.by_bit[t]
            at_map = _steps(x)
            at_map *= np.float32(2)
            at_map += (np.float32(2) * middle + bit).repeat(many)
            cells.append(at_map.astype(np.intp))
            np.exp(np.negative(x, out=x), out=x)
            x += np.float32(1)
            error = np.divide(np.float32(-1), x, out=x)
            error += bit.repeat(many)
            st *= error
            sums[t, 0] = np.bincount(lane[:n], minlength=8 * GATES)
            for k, own in enumerate(st, 1):
                sums[t, k] = np.bincount(lane[:n], own, 8 * GATES)
        sums = sums.reshape(LONGEST, -1, 8, GATES).sum(axis=2)
        count, slope = sums[:, 0], sums[:, 1:]
        self.seen += count
        rate = RATE / 256 * np.minimum(1, count / 64) / np.maximum(count, 1) / np.sqrt(1 + self.seen / 2e5)
        self.weights += (rate[:, None] * slope).astype(np.float32)


# Sums over a few gates wait for one another when neighbours share a gate, so each of eight neighbours has its own.
LANE = np.arange(FIT_CHUNK) % 8 * GATES



def refinement(n: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Stretched frequency of every map cell; cells hardly seen fall back to the mixed value itself."""
    plain = 1 / (1 + np.exp(-plain_refinement().astype(np.float64)))
    p = (one + 4 * plain) / (n + 4)
    return np.log(p / (1 - p)).astype(np.float32)


# --- distribution -----------------------------------------------------------------------------------------------

def _lower(texts) -> list[bytes]:
    return [t.lower() for t in hashing.as_bytes(list(texts))]


def token_counts(train: DataFrame) -> DataFrame:
    """(kind, key, n): kind 0 is a token's hash, kind 1 a byte value (end marks included); ``train`` has text."""

    def added(held: list) -> pd.DataFrame:
        key, which = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        n = np.bincount(which, np.concatenate([n for _, n in held])).astype(np.int64)
        return pd.DataFrame({"kind": 0, "key": key, "n": n})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, held = np.zeros(256, np.int64), []
        for pdf in batches:
            for run in hashing.runs(list(pdf["text"]), 1 << 20):
                texts = _lower(run)
                for t in texts:
                    seen += np.bincount(np.frombuffer(t, np.uint8), minlength=256)
                seen[PAD] += len(texts)
                key, n = np.unique(hashing.words(texts)[0], return_counts=True)
                held.append((np.append(key.view(np.int64), END_TOKEN), np.append(n, len(run))))
                if sum(len(k) for k, _ in held) > TOKENS:
                    yield added(held)
                    held.clear()
        if held:
            yield added(held)
        yield pd.DataFrame({"kind": 1, "key": np.arange(256), "n": seen})

    got = train.select("text").mapInPandas(count, "kind int, key long, n long")
    return got.groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("n > 0")


def context_cells(train: DataFrame, code: Code, part: str) -> DataFrame:
    """(part, k, slice, src, cells, counts): each task's non-zero counts of predictor k, by slice of its table;
    ``src`` is the task's partition."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = no_counts()
        for pdf in batches:
            for run in hashing.runs(list(pdf["text"])):
                count_cells(code, _lower(run), tables)
        src = TaskContext.get().partitionId()
        for k, table in enumerate(tables):
            rows = []
            for at in range(0, len(table), SLICE):
                cells = np.flatnonzero(table[at:at + SLICE])
                if len(cells):
                    rows.append((part, k, at // SLICE, src, cells.astype(np.uint16).tobytes(),
                                 table[at + cells].astype(np.uint32).tobytes()))
                if len(rows) == 32 or at + SLICE >= len(table):
                    yield pd.DataFrame(rows, columns=["part", "k", "slice", "src", "cells", "counts"])
                    rows = []

    return train.select("text").mapInPandas(count, CELLS)


CELLS = "part string, k int, slice int, src long, cells binary, counts binary"
FAN_IN = 64  # tasks whose counts of a slice meet in one group


def _added(pdf: pd.DataFrame) -> np.ndarray:
    """Sum of the counts of one slice."""
    total = np.zeros(SLICE, np.int64)
    for cells, n in zip(pdf["cells"], pdf["counts"]):
        cells = np.frombuffer(cells, np.uint16)
        total[cells] += np.frombuffer(n, np.uint32 if len(n) == 4 * len(cells) else np.int64)
    return total


def context_tables(rest: DataFrame, fit: DataFrame, code: Code) -> tuple[list[np.ndarray], ...]:
    """(tables of ``rest`` alone, of ``fit`` alone, of both): int8 cells, of fixed size whatever the input.

    The counts are added in a tree: at most FAN_IN rows (of at most one slice each) meet in a group, whatever
    the number of tasks.
    """
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = _added(pdf)
        cells = np.flatnonzero(total)
        first = pdf.iloc[:1][["part", "k", "slice", "src"]]
        return first.assign(src=first["src"] // FAN_IN, cells=[cells.astype(np.uint16).tobytes()],
                            counts=[total[cells].tobytes()])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        only = _added(pdf[pdf["part"] == "rest"])
        other = _added(pdf[pdf["part"] == "fit"])
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "slice": pdf["slice"].iloc[:1],
                             "rest": [stretched(only).tobytes()], "fit": [stretched(other).tobytes()],
                             "both": [stretched(only + other).tobytes()]})

    found = context_cells(rest, code, "rest").unionAll(context_cells(fit, code, "fit"))
    tasks = max(rest.rdd.getNumPartitions(), fit.rdd.getNumPartitions())
    while tasks > FAN_IN:
        found = found.groupBy("part", "k", "slice", F.floor(F.col("src") / FAN_IN)).applyInPandas(add, CELLS)
        tasks = -(-tasks // FAN_IN)
    made = found.groupBy("k", "slice").applyInPandas(
        finish, "k int, slice int, rest binary, fit binary, both binary").toArrow()
    out = {name: [np.zeros(1 << b, np.int8) for b in BITS] for name in ("rest", "fit", "both")}
    for r in made.to_pylist():  # a row per slice of the fixed tables
        at = r["slice"] * SLICE
        for name, tables in out.items():
            cells = np.frombuffer(r[name], np.int8)
            tables[r["k"]][at:at + len(cells)] = cells
    return out["rest"], out["fit"], out["both"]


def fit_weights(folds: list[tuple[DataFrame, Broadcast]], code: Code) -> tuple[np.ndarray, np.ndarray]:
    """(weights averaged over the tasks by what each has seen, refinement map of the tasks' added counts); ``folds``:
    documents with the tables of the other documents' counts."""

    def learnt(docs: DataFrame, tables: Broadcast) -> DataFrame:
        def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = Fit(code, tables.value)
            for pdf in batches:
                for run in hashing.runs(list(pdf["text"])):
                    own.learn(_lower(run))
            seen = np.broadcast_to(own.seen[:, None, :], own.weights.shape).ravel()
            yield pd.DataFrame({"kind": 0, "cell": np.arange(seen.size), "n": seen, "v": own.weights.ravel() * seen})
            yield pd.DataFrame({"kind": 1, "cell": np.arange(own.map_n.size), "n": own.map_n, "v": own.map_one})

        return docs.select("text").mapInPandas(learn, "kind int, cell int, n double, v double").filter("n > 0")

    sums = (reduce(DataFrame.unionAll, [learnt(*fold) for fold in folds])
            .groupBy("kind", "cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow())
    kind, cell, n, v = (sums.column(c).to_numpy() for c in ("kind", "cell", "n", "v"))
    weights, of_map = first_weights(), kind == 1
    weights.reshape(-1)[cell[~of_map]] = v[~of_map] / n[~of_map]
    map_n, map_one = np.zeros(512 * BUCKETS), np.zeros(512 * BUCKETS)
    map_n[cell[of_map]], map_one[cell[of_map]] = n[of_map], v[of_map]
    return weights, refinement(map_n, map_one)


def train_model(train: DataFrame, in_fit: Column, counts: DataFrame) -> Model:
    """Model from the training documents; ``counts``: their token_counts; ``in_fit`` divides them into two folds."""
    sc = train.sparkSession.sparkContext
    frequency = np.zeros(256)
    for r in counts.filter("kind = 1").collect():  # 256 byte values
        frequency[r["key"]] = r["n"]
    code = Code(frequency)
    rest, fit = train.filter(~in_fit), train.filter(in_fit)
    of_rest, of_fit, both = context_tables(rest, fit, code)
    shared = [sc.broadcast(of_rest), sc.broadcast(of_fit)]
    weights, refine = fit_weights([(fit, shared[0]), (rest, shared[1])], code)
    for tables in shared:
        tables.unpersist()
    return Model(code, both, weights, refine)


@dataclass
class Heavy:
    """The commonest tokens in a table of one slot per hash prefix; a token that finds its slot taken is left out."""
    slots: np.ndarray
    n: np.ndarray

    SHIFT = np.uint64(64 - 21)

    @classmethod
    def of(cls, counts: DataFrame, most: int = HEAVY) -> Heavy:
        level = F.floor(8 * F.log2("n")).cast("int")
        sizes = counts.filter("kind = 0").groupBy(level.alias("level")).count().collect()  # some hundred levels
        least, total = None, 0
        for r in sorted(sizes, key=lambda r: -r["level"]):
            total += r["count"]
            if total > most:
                break
            least = r["level"]
        table = cls(np.zeros(1 << 21, np.int64), np.zeros(1 << 21, np.int64))
        if least is not None:
            got = counts.filter((F.col("kind") == 0) & (level >= least)).select("key", "n").toArrow()  # <= most
            key, n = got.column("key").to_numpy(), got.column("n").to_numpy()
            at = (key.view(np.uint64) >> cls.SHIFT).astype(np.int64)
            order = np.lexsort((key, n))  # the commonest of a slot is written last
            table.slots[at[order]], table.n[at[order]] = key[order], n[order]
        return table

    def find(self, key: np.ndarray) -> np.ndarray:
        """Counts of token hashes; 0 if not in the table."""
        at = (key >> self.SHIFT).astype(np.int64)
        return np.where(self.slots.take(at) == key.view(np.int64), self.n.take(at), 0)


def score(docs: DataFrame, is_train: Column, in_fit: Column) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    sc = docs.sparkSession.sparkContext
    train = docs.filter(is_train)
    counts = cut(token_counts(train))
    sums = counts.filter("kind = 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
        F.coalesce(F.max(F.when(F.col("key") == END_TOKEN, F.col("n"))), F.lit(0)).alias("ends")).first()
    all_tokens, distinct, ends = sums["n"], sums["v"], sums["ends"]
    model = sc.broadcast(train_model(train, in_fit, counts))
    heavy = sc.broadcast(Heavy.of(counts))

    @F.pandas_udf("n_tokens long, n_known long, known_log double, score double, n_bytes long, rest array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for texts in hashing.runs(list(batch)):
                raw = _lower(texts)
                key, n = hashing.words(raw)
                c = heavy.value.find(key)
                edge = np.concatenate([[0], np.cumsum(n)])
                log = np.concatenate([[0.0], np.cumsum(np.where(c > 0, np.log10(c + 0.5), 0))])
                known = np.concatenate([[0], np.cumsum(c > 0)])
                rest = np.split(key[c == 0].view(np.int64), (edge - known[edge])[1:-1])
                parts.append(pd.DataFrame({
                    "n_tokens": n + 1, "n_known": known[edge[1:]] - known[edge[:-1]] + (ends > 0),
                    "known_log": log[edge[1:]] - log[edge[:-1]] + np.log10(ends + 0.5),
                    "score": score_texts(model.value, raw), "n_bytes": [len(t) for t in raw], "rest": rest}))
            if parts:
                yield pd.concat(parts, ignore_index=True)

    # The written copy fixes the row ids that the rare tokens go by.
    scored = cut(docs.select("doc_id", run("text").alias("x")).select("doc_id", "x.*")
                 .withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rest").alias("key"))
    kept = counts.filter("kind = 0").select("key", "n")
    rare = (rare.join(kept, "key", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"), F.count("n").alias("rare_known")))
    weight = float(np.log10(all_tokens + 0.5 * (distinct + 1)))
    out = scored.drop("rest").join(rare, "row", "left")
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * weight).alias("base_score"),
        "score", "n_bytes",
        (F.col("score") * -float(np.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))
