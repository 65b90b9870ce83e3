"""SimHash near-duplicate detection with bit-sliced distance counting.

Fingerprint: the text with A-Z lower-cased, words, 3-word shingles (repeats
included, joined by one space; a text of fewer words is one shingle, one
without words has fingerprint zero); each shingle's XXH64 (UTF-8, seed 42); a
fingerprint bit is set if it is set in over half of the shingle hashes.

Candidates (exact for a radius of 2 bits): two fingerprints that differ in at
most 2 bits agree in at least two of four 16-bit blocks, so each distinct
fingerprint is dealt under six 32-bit keys.  Keys with more than 256
fingerprints are refined by the same rule on the 32 bits not yet fixed (six
keys of 48 bits), then on the last 16 (56 bits): at most 2**8 = 256 distinct
fingerprints share 56 bits, so no bucket is larger and nothing is capped.
Every refinement keeps every pair within the radius.

Comparison: a task holds its buckets sorted by key and stores the fingerprints
as 64 vertical bit planes.  All fingerprints are compared with their s-th
successor at once, s = 1, 2, ...: the planes, 64 fingerprints to a word, are
moved by s lanes, and their differences are added into three carry-save counters
(ones, twos, overflow), one bit per pair; a block of pairs is abandoned as soon as
all its counters exceed the radius.

Links of a bucket are reported as (fingerprint, linked fingerprint) between
distinct fingerprints only, and components are contracted by
``components.connected_components``.  Copies share one fingerprint, so a hot
group of copies is one row after the first partial aggregation.

Defined cases: null text has fingerprint zero (as any text without words);
fingerprint zero links like any other; doc_id null is never the smallest of its
component unless alone; repeated rows each give a row; an empty table gives an
empty result; extra columns are ignored (``near_duplicates``) or kept
(``drop_near_duplicates``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .components import connected_components, spanning_links

SHINGLE, RADIUS, SEED = 3, 2, 42
BUCKET = 256
SETTLE = 1 << 18  # pairs of a batch that a task holds at a time
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_VOTES = 1 << 16  # shingle hashes unpacked at a time


# --- fingerprints -----------------------------------------------------------------------------------------------

def shingle_hashes(text: str | None, n: int = SHINGLE, seed: int = SEED) -> list[int]:
    from xxhash import xxh64_intdigest
    words = _WORD.findall(text.translate(_LOWER)) if text else []
    if not words:
        return []
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    if len(raw) <= n:
        return [xxh64_intdigest(b" ".join(raw), seed)]
    joined = b" ".join(raw)
    ends = np.cumsum([len(w) + 1 for w in raw])
    starts = (ends - [len(w) + 1 for w in raw]).tolist()
    return [xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, (ends[n - 1:] - 1).tolist())]


def fingerprint(text: str | None, n: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    hashes = shingle_hashes(text, n, seed)
    if not hashes:
        return 0
    votes = np.zeros(64, np.int64)
    arr = np.array(hashes, dtype=">u8")
    for i in range(0, len(arr), _VOTES):
        votes += np.unpackbits(arr[i:i + _VOTES].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(arr)).tobytes(), "big")


def fingerprint_udf(n: int = SHINGLE, seed: int = SEED):
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        own = np.array([fingerprint(t, n, seed) for t in texts], dtype=np.uint64)
        return pd.Series(own.view(np.int64))
    return fp


# --- bit-sliced comparison --------------------------------------------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows; row b holds bit b of every fingerprint, 64 fingerprints to a word (with a spare word at the end)."""
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    words = -(-len(fps) // 64) + 1
    rows = np.zeros((64, words * 8), np.uint8)
    rows[:, :-(-len(fps) // 8)] = np.packbits(bits.T, axis=1, bitorder="little")
    return rows.view("<u8")


def _ahead(planes: np.ndarray, shift: int, words: int) -> np.ndarray:
    """The planes moved by ``shift`` lanes: lane i holds what lane i + shift held; ``words`` words of each."""
    by, bits = divmod(shift, 64)
    low = planes[:, by:by + words]
    if not bits:
        return low
    return (low >> np.uint64(bits)) | (planes[:, by + 1:by + 1 + words] << np.uint64(64 - bits))


def links_within(fps: np.ndarray, key: np.ndarray, radius: int = RADIUS, settle: int | None = None
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with equal key and at most ``radius`` (0 to 2) differing bits; ``key`` is sorted.

    With ``settle`` the pairs found so far are replaced by (member, smallest of
    its linked set) whenever there are more than that many, so that a batch of
    dense buckets holds few pairs at a time; components stay the same.
    """
    planes, n = bit_planes(fps), len(fps)
    after = np.searchsorted(key, key, side="right") - np.arange(n) if n else np.zeros(0, int)  # to the bucket's end
    found, held = [np.zeros((2, 0), np.int64)], 0
    for shift in range(1, int(after.max(initial=0))):
        inside = after > shift
        last = int(np.flatnonzero(inside)[-1]) + 1
        hit = _within(planes, shift, inside[:last], radius)
        if len(hit):
            found.append(np.stack([hit, hit + shift]))
            held += len(hit)
            if settle and held > settle:
                found = [np.stack(spanning_links(n, *np.concatenate(found, axis=1)))]
                held = 0
    return tuple(np.concatenate(found, axis=1))


def _within(planes: np.ndarray, shift: int, inside: np.ndarray, radius: int) -> np.ndarray:
    """Lanes i among ``inside`` whose fingerprint is within ``radius`` of lane i + shift's, by carry-save counters
    over the vertical planes."""
    words = -(-len(inside) // 64)
    planes = np.pad(planes, ((0, 0), (0, max(0, shift // 64 + 1 + words - planes.shape[1]))))
    lanes = np.zeros(words * 8, np.uint8)
    lanes[:-(-len(inside) // 8)] = np.packbits(inside, bitorder="little")
    lanes = lanes.view("<u8")
    ones, twos, over = (np.zeros(words, np.uint64) for _ in range(3))
    for at in range(0, 64, 8):
        for d in planes[at:at + 8, :words] ^ _ahead(planes[at:at + 8], shift, words):
            carry = ones & d
            ones ^= d
            over |= twos & carry
            twos |= carry
        near = lanes & ~(over | {0: ones | twos, 1: twos, 2: ones & twos}[radius])
        if not near.any():
            return np.zeros(0, np.int64)  # the whole block is beyond the radius
    return np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))


# --- candidates -------------------------------------------------------------------------------------------------

def _block_masks(bits: list[int]) -> list[int]:
    """Masks that keep two of four equal blocks of the given bit positions (six masks)."""
    size = len(bits) // 4
    blocks = [sum(1 << b for b in bits[k * size:(k + 1) * size]) for k in range(4)]
    return [blocks[a] | blocks[b] for a in range(4) for b in range(a + 1, 4)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _refine(rows: DataFrame, level: int) -> DataFrame:
    """One row (fp, mask, key) for each of the six masks that extend a row's mask.

    ``rows``: fp and mask (the bits already fixed).  Which bits are free follows from the mask, so the six
    extensions of every possible mask are a constant table (6**level entries).
    """
    masks = [0]
    for _ in range(level):
        masks = list(dict.fromkeys(m | x for m in masks for x in
                                   _block_masks([b for b in range(64) if not m >> b & 1])))
    options = F.create_map(*[x for m in masks for x in (
        F.lit(_signed(m)), F.array(*[F.lit(_signed(m | e)) for e in
                                     _block_masks([b for b in range(64) if not m >> b & 1])]))])
    return (rows.select("fp", F.explode(options[F.col("mask")]).alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct())


def candidate_buckets(fps: DataFrame) -> DataFrame:
    """(fp, mask, key) of every bucket with 2 to 256 fingerprints; ``fps``: distinct values of column fp."""
    rows = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    found = None
    for level in range(3):
        rows = _refine(rows, level)
        counts = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = cut(rows.join(counts, ["mask", "key"]))
        # 56 fixed bits leave at most 256 distinct fingerprints, so the last level needs no further cut.
        small = (rows.filter(F.col("n") <= BUCKET) if level < 2 else rows).select("fp", "mask", "key")
        found = small if found is None else found.unionAll(small)
        rows = rows.filter(F.col("n") > BUCKET).select("fp", "mask").distinct()
        if level == 2 or rows.isEmpty():
            break
    return found


def links(fps: DataFrame, radius: int = RADIUS, all_pairs: bool = False) -> DataFrame:
    """(a, b) of distinct fingerprints whose links have the same components as all links within ``radius`` <= 2.

    A bucket of copies with small changes links nearly all its pairs; of the
    pairs found in a bucket, a spanning set is reported (every linked fingerprint
    with the smallest of its linked set), so output stays linear.  ``all_pairs``
    reports every pair within the radius.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the block keys are exact for a radius of 0, 1 or 2 bits")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if rest is not None:
                pdf = pd.concat([rest, pdf], ignore_index=True)
            # The last bucket may go on in the next batch: a bucket has at most 256 rows.
            last = (pdf["mask"] == pdf["mask"].iloc[-1]) & (pdf["key"] == pdf["key"].iloc[-1]) if len(pdf) else None
            if last is not None and not last.all():
                yield _found(pdf[~last], radius, all_pairs)
                rest = pdf[last]
            else:
                rest = pdf
        if rest is not None and len(rest):
            yield _found(rest, radius, all_pairs)

    dealt = candidate_buckets(fps).repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return dealt.mapInPandas(compare, "a long, b long").distinct()


def _found(pdf: pd.DataFrame, radius: int, all_pairs: bool) -> pd.DataFrame:
    fps = pdf["fp"].to_numpy(np.int64)
    pair = pdf[["mask", "key"]].to_numpy(np.int64)
    key = np.concatenate([[0], np.cumsum(np.any(pair[1:] != pair[:-1], axis=1))])
    i, j = links_within(fps.view(np.uint64), key, radius, None if all_pairs else SETTLE)
    if not all_pairs:
        i, j = spanning_links(len(fps), i, j)
    return pd.DataFrame({"a": np.minimum(fps[i], fps[j]), "b": np.maximum(fps[i], fps[j])})


# --- operator ---------------------------------------------------------------------------------------------------

def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprint_groups(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS, seed: int = SEED
                       ) -> tuple[DataFrame, DataFrame]:
    """(per document: doc_id, fp, two text hashes t1 and t2; per fingerprint: fp, component, component_id =
    smallest doc_id reachable)."""
    own = cut(docs.select("doc_id", fingerprint_udf(n, seed)("text").alias("fp"), F.xxhash64("text").alias("t1"),
                          F.xxhash64(F.lit(1), "text").alias("t2")))
    per = cut(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = cut(connected_components(links(per.select("fp"), radius), "a", "b"))
    linked = per.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    linked = linked.withColumn("component", F.coalesce("component", "fp"))
    # Materialised, so that a component with a large share of all rows can be split in the join.
    least = cut(linked.groupBy("component").agg(F.min("least").alias("component_id")))
    return own, linked.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links)."""
    own, groups = fingerprint_groups(docs, n, radius, seed)
    return own.join(groups, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id (null last).

    Of rows with that same doc_id, the one with the smallest text hash stays, once.
    """
    cols = docs.columns
    own, groups = fingerprint_groups(docs, n, radius, seed)
    best = F.struct("t1", "t2")
    keep = (own.join(groups, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component", "doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("component").agg(F.first("doc_id").alias("__sh_id"), F.min(best).alias("t"),
                                      F.min_by("n", best).alias("__sh_n"))
            .select("component", "__sh_id", F.col("t.t1").alias("__sh_t1"), F.col("t.t2").alias("__sh_t2"), "__sh_n"))
    keep = keep.withColumnRenamed("component", "__sh_component")
    kept = docs.join(keep, F.col("doc_id").eqNullSafe(F.col("__sh_id"))
                     & (F.xxhash64("text") == F.col("__sh_t1"))
                     & (F.xxhash64(F.lit(1), "text") == F.col("__sh_t2")))
    once = kept.filter("__sh_n = 1").select(*cols)
    # Equal ids and texts: any one of these rows.
    w = Window.partitionBy("__sh_component").orderBy(F.lit(1))
    again = (kept.filter("__sh_n > 1").withColumn("__sh_row", F.row_number().over(w)).filter("__sh_row = 1")
             .select(*cols))
    return once.unionByName(again)
