"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The binary (23,12,7) Golay code is perfect with
radius 3, so every 23-bit word has one codeword within distance 3 and, if that one is at exactly 3, five more at 4.
Two words that differ in at most 2 bits have a midpoint within 1 of both; the midpoint's codeword is within 4 of both,
so the two words share one of these at most 6 codeword indices. Two errors leave one of the three segments untouched
(pigeonhole): a fingerprint's keys are (i, segment i as it is, one codeword index of the next segment), at most 18.
Fingerprints that meet in a key are joined and verified by the number of differing bits.

Buckets of more than ``bucket_pairs`` distinct fingerprints are not paired. Their members are linked exactly by
midpoints: each emits itself and its 64 one-bit neighbours, and all members that emit one value lie within 2 bits of
each other, so links to the least member of the value join all of them. No link is lost and no group is squared.

``near_duplicates`` is the operator by fingerprints. ``drop_near_duplicates``, for a pipeline, holds texts to a Jaccard
similarity of 0.8 of their five-word shingles, which is far beyond two bits (9.7 of 64 are expected to differ): the Golay
keys give its candidates among the closest texts, and nearcopies gives those of the rest.
"""
from __future__ import annotations

from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, join_hot, map_batches, materialize, rows_of, same_columns, text_or_empty
from .components import connected_components

SEED = 42
SHINGLE = 3
GENERATOR = 0b101011100011  # fixed value: x^11+x^9+x^7+x^6+x^5+x+1 generates the binary Golay code
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # (first bit, width)


def shingle_fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """Fingerprint of one UTF-8 text, unsigned; texts without a word give 0."""
    words = raw.lower().split()  # bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    if len(words) < size:
        words = [b" ".join(words)]
        size = 1
    total = len(words) - size + 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)))) if size > 1 else iter(words)
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, total))


def majority(hashes: np.ndarray, chunk: int = 1 << 16) -> int:
    """The bits that are set in over half of the hashes."""
    total, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, total, chunk):
        part = hashes[at : at + chunk]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprint_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        raw = batch.column("text").cast(pa.binary()).to_pylist()
        fps = np.fromiter((shingle_fingerprint(x) for x in raw), np.uint64, len(raw))
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(fps.view(np.int64))}

    return step


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long): one row per row of docs; null text counts as empty."""
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), _fingerprint_kernel, "doc_id long, fp long")


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    out = words.astype(np.int64)
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


@cache
def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome: up to 6 error patterns of weight 4 or less to nearby codewords, and how many there are."""
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        words = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for word, s in zip(words.tolist(), _syndrome(words).tolist()):
            if weight < 4 or (found[s] and bin(found[s][0]).count("1") == 3):
                found[s].append(word)
    count = np.array([len(x) for x in found])
    table = np.array([x + [x[0]] * (6 - len(x)) for x in found], np.int64)
    return table, count


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices (12 data bits) of codewords near each 23-bit word, and how many of the six hold."""
    table, count = error_patterns()
    s = _syndrome(words)
    return (words[:, None] ^ table[s]) >> 11, count[s]


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys) for unsigned fingerprints: pairs within 2 bits share a key."""
    parts = [(fps >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        near, count = golay_indices(parts[(i + 1) % 3])
        row, k = np.nonzero(np.arange(6)[None, :] < count[:, None])
        rows.append(row)
        keys.append((np.int64(i) << 35) | (parts[i][row] << 12) | near[row, k])
    return np.concatenate(rows), np.concatenate(keys)


def _key_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        rows, keys = golay_keys(fps.view(np.uint64))
        return {"fp": pa.array(fps[rows]), "key": pa.array(keys)}

    return step


def _midpoint_links(members: DataFrame) -> DataFrame:
    """Links of the members' 2-bit graph, each to the least member of a shared midpoint; (a, b)."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64)])
    mids = members.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    least = mids.groupBy("mid").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1").select("mid", "low")
    return mids.join(least, "mid").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = 2, bucket_pairs: int = 32, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Links (a, b) whose closure is that of all pairs of distinct fingerprints at max_bits (at most 2) or fewer bits.

    Small buckets give every link; of a large bucket, links to the least member of each midpoint.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the Golay keys hold for at most 2 differing bits")
    keys = materialize(map_batches(distinct_fps.select("fp"), _key_kernel, "fp long, key long"), "golay-keys")
    sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "golay-sizes")
    met = materialize(join_hot(keys, sizes, "key", sizes.withColumnRenamed("n", "size"), hot_rows), "golay-met")
    few = met.where(F.col("n") <= bucket_pairs)
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    links = pairs.where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    crowded = met.where(F.col("n") > bucket_pairs)
    if max_bits == 2:
        return links.unionByName(_midpoint_links(crowded.select("fp").distinct()))
    low = crowded.select("fp").distinct()  # one bit or none: neighbours by single flips
    flips = F.array(*[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64 if max_bits else 0)])
    other = low.select(F.col("fp").alias("a"), F.explode(flips.cast("array<bigint>")).alias("x")).select("a", F.col("a").bitwiseXOR(F.col("x")).alias("b"))
    return links.unionByName(other.where("a < b").join(low.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b"))


def near_duplicates(docs: DataFrame, max_bits: int = 2, bucket_pairs: int = 32, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs.

    component_id is the least doc_id reachable over links of max_bits or fewer bits. Null or empty text has fingerprint
    zero and is linked like any other; rows that repeat a doc_id each get a row; a null doc_id never names a component
    unless all its members have none; an empty table gives an empty table; other columns of docs are ignored. A
    fingerprint of more than hot_rows rows stays where its rows are.
    """
    marked = materialize(fingerprints(docs), "fingerprints")
    groups = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")), "fingerprint-groups")
    roots = connected_components(fingerprint_links(groups, max_bits, bucket_pairs, hot_rows), hot_rows)
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "fingerprint-roots")
    least = materialize(rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("size")), "fingerprint-least")
    named = join_hot(rooted, least.select("root", "component_id"), "root", least, hot_rows).select("fp", "component_id")
    return join_hot(marked, named, "fp", groups, hot_rows).select("doc_id", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """Columns of op8: doc_id, fingerprint (16 hex digits), component_id."""
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near duplicates, all columns as they were, whatever their names.

    Texts are near duplicates at a Jaccard similarity of 0.8 or more of their five-word shingles, and groups are what such
    links connect; texts without a word are one group. The row of least doc_id stays (the first such row, if it repeats);
    rows without doc_id stay only if no member has one; an empty table gives an empty table.
    """
    from . import nearcopies  # it takes its fingerprints and their links from here

    marked = rows_of(docs)
    kept = nearcopies.near_copies(marked.select("rid", "doc_id", "text")).where("rid = keep_rid").select("rid")
    return same_columns(marked.join(kept, "rid", "left_semi").select("row.*"), docs)
