"""Packing along a space-filling curve.

A document's token counts, hashed to random signs, are projected to ``DIMENSIONS`` numbers; scaled by the counts' norm these
are near standard normal, so their normal quantiles spread evenly over a grid, whose Hilbert index is the document's key.
Documents are range-sorted by key and their token streams laid end to end: sequence s holds the tokens from
s * length on, and documents are cut where a sequence is full. Only the last, partial sequence could need padding; its
tokens fill sequences of falling powers of two, which need none.
"""
from __future__ import annotations

import zlib
from functools import cache
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NOT_PLAIN, Recent, map_batches, materialize, plain_pattern, text_or_empty

LENGTH = 4096
END_ID = 2
#: Documents of a range of the curve, at most about; a session with more shuffle partitions makes smaller ones.
RANGE_ROWS = 4_000_000
DIMENSIONS, BITS = 4, 15
VOCABULARY = "word_bpe_49k.json"
#: Distinct words of a generation whose ids a worker remembers: a worker stays, and so do they, while other stages run.
CACHE_WORDS = 200_000
#: Texts that are split at once; their words stand in memory together.
SPLIT_TEXTS = 100

# Fixed value: the pieces between which the vocabulary's file splits texts.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids as the library gives them, remembered by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence as Steps
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        self.split = plain_pattern(PIECES).findall
        self.known = Recent(CACHE_WORDS)
        if self.library.get_vocab_size() > 65536:
            raise ValueError("ids must fit 16 bits")
        self.ends_word = np.zeros(65536, bool)
        # words are split and in lower case already: only their bytes and merges are left to do
        self.of_words = Tokenizer.from_file(path)
        self.of_words.normalizer = Steps([])
        self.of_words.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.library.model.end_of_word_suffix
        if suffix:
            self.ends_word[[i for token, i in self.library.get_vocab().items() if token.endswith(suffix)]] = True

    def _learn(self, words: list[str]) -> list[tuple[str, bytes]]:
        """Ids of words: the library reads them as one text, and a word's last id alone is of a token with the suffix."""
        ids = np.array(self.of_words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return [(w, np.array(x.ids, "<u2").tobytes()) for w, x in zip(words, self.library.encode_batch(words, add_special_tokens=False))]
        raw, ends = ids.tobytes(), (2 * ends).tolist()
        return [(w, raw[a:b]) for w, a, b in zip(words, [0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 16-bit numbers, the end id last."""
        return [x for at in range(0, len(texts), SPLIT_TEXTS) for x in self._encode(texts[at : at + SPLIT_TEXTS])]

    def _encode(self, texts: list[str]) -> list[bytes]:
        odd = ["<|" in t or NOT_PLAIN.search(t) is not None for t in texts]
        split = [[] if o else self.split(t.lower()) for t, o in zip(texts, odd)]
        known, end = self.known.ready(set().union(*split), self._learn), np.array([END_ID], "<u2").tobytes()
        whole = lambda t: np.array(self.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
        return [(whole(t) if o else b"".join(map(known.__getitem__, w))) + end for t, w, o in zip(texts, split, odd)]


@cache
def worker_encoder(path: str) -> WordEncoder:
    """One a worker process, for all of its tasks."""
    return WordEncoder(path)


def _signs() -> np.ndarray:
    """(65536, DIMENSIONS) random signs by token id, from a 64-bit mixer."""
    x = np.arange(65536, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.stack([((x >> np.uint64(16 * d)) & np.uint64(1)).astype(np.float64) * 2 - 1 for d in range(DIMENSIONS)], axis=1)


def hilbert_indices(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions of grid points (a row each) on the Hilbert curve (Skilling 2004): undo the rotations, then Gray-decode."""
    x, n = list(np.array(points, np.int64).T), points.shape[1]
    mask = 1 << (bits - 1)
    while mask > 1:
        low = mask - 1
        for i in range(n):
            swap = np.where(x[i] & mask, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(x[i] & mask, low, swap)
            if i:
                x[i] = x[i] ^ swap
        mask >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    fix, mask = np.zeros_like(x[0]), 1 << (bits - 1)
    while mask > 1:
        fix ^= np.where(x[n - 1] & mask, mask - 1, 0)
        mask >>= 1
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ fix) >> bit & 1)
    return out


def hilbert_index(point: list[int], bits: int = BITS) -> int:
    return int(hilbert_indices(np.array([point]), bits)[0])


def curve_keys(ids: list[bytes], signs: np.ndarray) -> list[int]:
    """Hilbert key of each document's token ids, the last of which (the end id) counts for nothing; 0 without another."""
    n = np.array([len(x) // 2 - 1 for x in ids], np.int64)
    each = np.sort(np.repeat(np.arange(len(ids)) << 16, n) | np.frombuffer(b"".join(x[:-2] for x in ids), "<u2"))
    first = np.flatnonzero(np.diff(each, prepend=-1))
    counts, of, signs = np.diff(first, append=len(each)), each[first] >> 16, signs[each[first] & 65535]
    total = lambda v: np.bincount(of, v, len(ids))
    norm = np.sqrt(total(np.square(counts.astype(np.float64))))
    z = np.stack([total(counts * signs[:, d]) for d in range(DIMENSIONS)], axis=1) / np.where(n > 0, norm, 1.0)[:, None]
    grid = 1 << BITS
    points = [[min(grid - 1, int(grid * (1 + erf(v / sqrt(2))) / 2)) for v in row] for row in z.tolist()]
    return np.where(n > 0, hilbert_indices(np.array(points, np.int64)), 0).tolist() if points else []


def _encode_kernel(path: str):
    def make():
        encoder, signs = worker_encoder(path), _signs()

        def step(batch: pa.RecordBatch) -> dict:
            ids = encoder.encode(batch.column("text").to_pylist())
            keys = curve_keys(ids, signs)
            n = [len(x) // 2 for x in ids]
            return {"rid": batch.column("rid"), "doc_id": batch.column("doc_id"), "key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.binary())}

        return step

    return make


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(rid, doc_id, key, n, ids): written, so that every later step sees the same rows and ids."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return materialize(map_batches(rows, _encode_kernel(path), "rid long, doc_id long, key long, n long, ids binary"), "packing-ids")


def placed(table: DataFrame) -> tuple[DataFrame, int]:
    """(rid, at): tokens before each document in curve order, and the count of all tokens.

    Only (key, doc_id, rid, n) is range-sorted; each range's total, one number a range, meets on the driver.
    """
    parts = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // RANGE_ROWS))
    order = ["key", "doc_id", "rid"]
    ranged = materialize(table.select("rid", "doc_id", "key", "n").repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "packing-order")
    totals = {r["range"]: r["total"] for r in ranged.groupBy("range").agg(F.sum("n").alias("total")).collect()}
    before, at = {}, 0
    for k in sorted(totals):
        before[k], at = at, at + totals[k]
    if not before:
        return ranged.select("rid", F.lit(0).cast("long").alias("at")), 0
    starts = ranged.sparkSession.createDataFrame([(k, v) for k, v in before.items()], "range int, base long")
    own = F.sum("n").over(Window.partitionBy("range").orderBy(*order)) - F.col("n")
    return ranged.withColumn("own", own).join(F.broadcast(starts), "range").select("rid", (F.col("own") + F.col("base")).alias("at")), at


def sequence_bounds(total: int, length: int = LENGTH) -> tuple[int, list[tuple[int, int]]]:
    """Tokens in full sequences, and (start, length) of the powers of two that hold the rest."""
    full = total // length * length
    tail, at = [], full
    for bit in range(length.bit_length() - 1, -1, -1):
        if (total - full) >> bit & 1:
            tail.append((at, 1 << bit))
            at += 1 << bit
    return full, tail


def cut(at: int, n: int, full: int, tail: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """Pieces (start in document, length, sequence, offset) of a document of n tokens that starts at token ``at``."""
    out, start = [], 0
    while start < n:
        here = at + start
        if here < full:
            seq, offset = divmod(here, length)
            room = length - offset
        else:
            k = max(i for i, (begin, _) in enumerate(tail) if begin <= here)
            seq, offset = full // length + k, here - tail[k][0]
            room = tail[k][1] - offset
        take = min(room, n - start)
        out.append((start, take, seq, offset))
        start += take
    return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def _cut_kernel(total: int, length: int, with_ids: bool):
    full, tail = sequence_bounds(total, length)

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            rows = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc_id, at, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "n", "ids"))):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                for start, take, seq, offset in cut(at, n, full, tail, length):
                    part = ids[start : start + take]
                    for k, v in zip(rows, (doc_id, start, take, zlib.crc32(part.tobytes()), n, seq, offset, part.tolist() if with_ids else None)):
                        rows[k].append(v)
            return {k: pa.array(v, pa.list_(pa.int32()) if k == "ids" else pa.int64()) for k, v in rows.items()}

        return step

    return make


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and the piece's ids.

    Every token of every document, its end id included, lies in exactly one piece; sequences have no gaps and no
    padding. Null or empty text is its end id alone; repeated rows are documents of their own; documents equal in key
    are ordered by doc_id, then row; an empty table gives an empty table.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    table = encoded(docs, path or vocabulary_path(VOCABULARY))
    spots, total = placed(table)
    return map_batches(table.select("rid", "doc_id", "n", "ids").join(spots, "rid").select("doc_id", "at", "n", "ids"), _cut_kernel(total, length, with_ids), _PIECES)


def report(docs: DataFrame) -> DataFrame:
    """Columns of op3: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(docs, with_ids=False).drop("ids")
