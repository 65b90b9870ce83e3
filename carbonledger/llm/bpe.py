"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary is a rank file (base64 token bytes and rank per line) whose path
is a parameter; the driver reads it, checks its size and broadcasts its bytes.
Each Python worker builds one ``tokenizers`` BPE model from it: bytes are mapped
to printable characters, every split of a token into two lower-ranked tokens is
a merge with the token's rank, and a piece that is a token itself is taken whole.

Encoding: a batch's texts are split into pieces by the pattern; each piece not
seen before goes through the library's BPE model, and the batch's ids are
gathered from the pieces' ids with numpy.  Texts are encoded whole; the table
of pieces is emptied when it is full, which changes no result.

Offsets: a token covers bytes; byte offsets are mapped to character offsets by
counting lead bytes.  A token that starts or ends inside a character covers that
whole character (such neighbours overlap in it).

Decoding reverses the byte table: a token's characters back to its bytes, the
document's bytes joined.  ``decode_pieces`` gives the text of each token: a
character split over several tokens comes with the token that completes it, and
bytes that never complete a character become U+FFFD.

Defined cases: null text is encoded like the empty text (no ids, decoded to no
bytes); unknown ids raise; an empty table gives an empty result; repeated rows
are encoded alike; extra columns are kept by ``encode`` and ``decode`` (an
existing column of the output's name is replaced).  ``round_trip`` hands its rows
on in runs of bounded size, so a worker never holds the ids of a whole batch.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_VOCABULARY_BYTES = 64 << 20
PIECES_KEPT = 250_000  # pieces whose ids a worker keeps
RUN_CHARS = 1 << 20  # characters worked through at a time


def byte_characters() -> list[str]:
    """The printable character of every byte: visible Latin-1 bytes stand for themselves, the others follow
    from U+0100 in byte order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary inside a Python worker."""

    _kept: dict[str, Codec] = {}

    def __init__(self, rank_file: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
        import regex
        from tokenizers import models

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        chars = byte_characters()
        seen_as = {t: "".join(chars[b] for b in t) for t in ranks}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            halves = ((token[:k], token[k:]) for k in range(1, len(token)))
            pairs = [(ranks[a], ranks[b], a, b) for a, b in halves if ranks.get(a, rank) < rank > ranks.get(b, rank)]
            merges += [(seen_as[a], seen_as[b]) for _, _, a, b in sorted(pairs)]
        self.model = models.BPE(vocab={seen_as[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        self.characters = dict(enumerate(chars))
        self.pattern = regex.compile(pattern)
        self.split = self.pattern.findall
        byte_of = {c: b for b, c in enumerate(chars)}
        table = {r: bytes(byte_of[c] for c in s) for s, r in ((seen_as[t], r) for t, r in ranks.items())}
        size = max(table, default=-1) + 1
        self.known = np.zeros(size + 1, bool)
        self.known[list(table)] = True
        self.lengths = np.array([len(table.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(table.get(i, b"") for i in range(size)), np.uint8)
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}  # piece -> its place in ``first``
        self.flat, self.first = array("i"), array("q", [0])

    @classmethod
    def of(cls, rank_file: Broadcast, pattern: str) -> Codec:
        """The worker's codec; built once per vocabulary."""
        name = hashlib.sha256(rank_file.value + pattern.encode()).hexdigest()
        if name not in cls._kept:
            cls._kept = {name: cls(rank_file.value, pattern)}
        return cls._kept[name]

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of one whole text."""
        text = text or ""
        if len(text) <= RUN_CHARS:
            return self._ids(self.split(text))
        found = (m.group() for m in self.pattern.finditer(text))
        return np.concatenate([self._ids(part) for part in iter(lambda: list(islice(found, PIECES_KEPT // 2)), [])])

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text of a batch, worked through in runs of bounded size."""
        out, run, chars = [], [], 0
        for t in texts:
            if run and chars + len(t or "") > RUN_CHARS:
                out += self._run(run)
                run, chars = [], 0
            run.append(t)
            chars += len(t or "")
        return out + (self._run(run) if run else [])

    def _run(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(texts) == 1:
            return [self.encode(texts[0])]
        pieces, ends = [], []
        for t in texts:
            if t:
                pieces += self.split(t)
            ends.append(len(pieces))
        ids, per_piece = self._ids(pieces, True)
        token_end = np.concatenate([[0], np.cumsum(per_piece)])[ends]
        return np.split(ids, token_end[:-1])

    def _ids(self, pieces: list[str], lengths: bool = False):
        """Ids of pieces in order (and how many each has); new pieces go through the library's model once."""
        number = self.number
        new = [p for p in dict.fromkeys(pieces) if p not in number]
        if len(number) + len(new) > PIECES_KEPT:
            self._empty()
            number, new = self.number, list(dict.fromkeys(pieces))
        tokenize, table = self.model.tokenize, self.characters
        for p in new:
            number[p] = len(number)
            self.flat.extend([t.id for t in tokenize(p.encode("utf-8", "surrogatepass").decode("latin-1")
                                                     .translate(table))])
            self.first.append(len(self.flat))
        at = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        first = np.array(self.first)
        size = (first[1:] - first[:-1])[at]
        ids = ragged(np.array(self.flat), first[at], size)
        return (ids, size) if lengths else ids

    def offsets(self, text: str | None, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character offsets (first, past the last) of every token in its text."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
        end = np.cumsum(self.lengths[ids])
        start = end - self.lengths[ids]
        return (lead[start + 1] - 1 if len(ids) else start), lead[end]

    def decode(self, ids) -> bytes:
        """Bytes of a list of ids; an id outside the vocabulary raises ValueError."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return ragged(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()

    def decode_pieces(self, ids) -> list[str]:
        """Text of each token; joined, they are the text of all ids."""
        import codecs
        reader, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for i in np.asarray(ids, np.int64):
            out.append(reader.decode(self.decode([i])))
        rest = reader.decode(b"", True)
        if rest:
            out[-1] += rest
        return out


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of values[starts[k] : starts[k] + lengths[k]]."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def row_runs(texts: pa.Array, limit: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """(first, past the last) row of runs whose texts have at most ``limit`` bytes together; a longer text is one."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, done = 0, 0
    while at < len(total):
        stop = max(at + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield at, stop
        at, done = stop, int(total[stop - 1])


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """Broadcast the bytes of a rank file after checking their size."""
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: {size} bytes is no vocabulary to broadcast")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, vocab: Broadcast, pattern: str, text: str = "text", out: str = "ids",
           with_offsets: bool = False) -> DataFrame:
    """Add ``out`` (array<int>) and, if asked, ``char_start`` and ``char_end`` (array<int>) to ``df``."""
    kind = "ids array<int>" + (", char_start array<int>, char_end array<int>" if with_offsets else "")

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec.of(vocab, pattern)
        for texts in batches:
            ids = codec.encode_many(list(texts))
            made = {"ids": ids}
            if with_offsets:
                both = [codec.offsets(t, i) for t, i in zip(texts, ids)]
                made |= {"char_start": [a for a, _ in both], "char_end": [b for _, b in both]}
            yield pd.DataFrame(made)

    df = df.withColumn("__bpe", run(text)).withColumn(out, F.col("__bpe.ids"))
    if with_offsets:
        df = df.withColumn("char_start", F.col("__bpe.char_start")).withColumn("char_end", F.col("__bpe.char_end"))
    return df.drop("__bpe")


def decode(df: DataFrame, vocab: Broadcast, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary): the bytes that the ids stand for; null ids give null."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec.of(vocab, pattern)
        for part in batches:
            yield pd.Series([None if x is None else codec.decode(x) for x in part], dtype=object)

    return df.withColumn(out, run(ids))


def round_trip(df: DataFrame, vocab: Broadcast, pattern: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode, then decode every text, with digests: n_tokens, ids_sha256 (little-endian unsigned 32-bit ids),
    decoded_sha256, decoded_ok (the decoded bytes are the text's bytes), n_split (tokens that begin or end inside a
    character) and offsets_ok (the tokens' character offsets go through the whole text without a gap).  All other
    columns are dropped but doc_id, and ``ids`` if asked.  Nothing is shuffled."""
    kind = ("n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_ok boolean, n_split long, "
            "offsets_ok boolean" + (", ids array<int>" if keep_ids else ""))
    names = ["doc_id", *[x.split()[0] for x in kind.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(vocab, pattern)
        for batch in batches:
            for at, stop in row_runs(batch.column(1)):
                part = batch.slice(at, stop - at)
                texts = part.column(1).to_pylist()
                found, rows = codec.encode_many(texts), []
                for t, ids in zip(texts, found):
                    back, (first, end) = codec.decode(ids), codec.offsets(t, ids)
                    # A character that several tokens share lies in the offsets of each: they overlap by it.
                    split = first[1:] < end[:-1]
                    whole = bool(len(ids) == 0 or first[0] == 0 and end[-1] == len(t)
                                 and (first[1:] + split == end[:-1]).all())
                    n_split = int((np.append(split, False) | np.append(False, split)).sum()) if len(ids) else 0
                    rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                                 hashlib.sha256(back).hexdigest(), back == (t or "").encode("utf-8", "surrogatepass"),
                                 n_split, whole))
                made = [part.column(0), *[pa.array(c) for c in zip(*rows)]]
                if keep_ids:
                    ends = np.cumsum([0, *map(len, found)])
                    made.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                        np.concatenate(found).astype(np.int32, copy=False))))
                yield pa.RecordBatch.from_arrays(made, names)

    id_type = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", text).mapInArrow(run, f"doc_id {id_type}, {kind}")
