"""Exact duplicates through a log-structured merge index of digests.

A memtable is what a task has read: up to ``MEMTABLE_ROWS`` digests, sorted, each with its smallest identifier and its
number of rows. It is flushed as pieces of a run, one for each bucket (range of digests) that it touches. Compaction
merges the pieces of a bucket into one sorted piece, keeping the smallest identifier and adding the counts; when a level
holds ``FANOUT`` runs they are merged into one run of the next. Every compacted piece has its least and greatest digest
and a Bloom filter. A new batch is probed against these alone, and only pieces that may hold one of its digests are read.

Each hit (a row of a digest with several rows) is then compared byte by byte with the text of its keeper; rows that fail
are grouped by their whole text.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, materialize, rows_of, same_columns, scratch_path, ship_package, text_or_empty

SPACES = r"[\x20\x09-\x0D]+"
MEMTABLE_ROWS = 1 << 18
#: Digests that a bucket is made for, and runs of a level that are merged into one of the next.
BUCKET_ROWS = 1 << 19
FANOUT = 4
FILTER_BITS = 10  # a digest in a filter
#: Digests with several rows up to which they are broadcast to filter the text scan (8 bytes each, 4 MB).
FILTER_LIMIT = 500_000
#: Rows of one digest from which they are dealt over salts, and that then share a copy of the keeper's text; and hot
#: digests up to which their list is broadcast (beyond it, which takes 4e8 copies, the bound is doubled until it fits).
HOT_ROWS = 2048
HOT_LIMIT = 200_000

_ENTRY = [("digests", pa.binary()), ("none", pa.binary()), ("ids", pa.binary()), ("rids", pa.binary()), ("counts", pa.binary())]
PIECE = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("least", pa.binary()), ("greatest", pa.binary()), ("filter", pa.binary()), *_ENTRY])
PIECE_SQL = "bucket int, n long, least binary, greatest binary, filter binary, digests binary, none binary, ids binary, rids binary, counts binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def smallest() -> Column:
    """Order of identifiers: doc_id, those without one last, then the row."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("rid").alias("rid"))


Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # digests (n, 32), none, ids, rids, counts


def _words(digests: np.ndarray) -> np.ndarray:
    """(n, 4) big-endian words of digests of 32 bytes, in whose order they sort."""
    return np.ascontiguousarray(digests).view(">u8").astype(np.uint64)


def merged(entries: Entries) -> Entries:
    """Sorted by digest, one entry each: the smallest identifier and the sum of counts."""
    digests, none, ids, rids, counts = entries
    words = _words(digests)
    order = np.lexsort((rids, ids, none, *words.T[::-1]))
    words = words[order]
    first = np.nonzero(np.append(True, (words[1:] != words[:-1]).any(axis=1)))[0] if len(words) else np.zeros(0, np.int64)
    pick = order[first]
    return digests[pick], none[pick], ids[pick], rids[pick], np.add.reduceat(counts[order], first) if len(first) else counts


def buckets_of(digests: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of each digest."""
    return (_words(digests)[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(digests), np.int64)


def _spots(digests: np.ndarray, size: int) -> Iterator[np.ndarray]:
    words = _words(digests)
    for k in range(1, 4):  # three hashes: words of the digest that the bucket doesn't use
        yield (words[:, k] % np.uint64(size)).astype(np.int64)


def bloom(digests: np.ndarray) -> bytes:
    size = max(64, len(digests) * FILTER_BITS + 7 & ~7)
    bits = np.zeros(size, bool)
    for at in _spots(digests, size):
        bits[at] = True
    return np.packbits(bits).tobytes()


def may_hold(filter_: bytes, digests: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(filter_, np.uint8)).astype(bool)
    out = np.ones(len(digests), bool)
    for at in _spots(digests, len(bits)):
        out &= bits[at]
    return out


def _packed(entries: Entries, at: slice, filtered: bool) -> dict:
    digests, none, ids, rids, counts = (x[at] for x in entries)
    ends = (digests[0].tobytes(), digests[-1].tobytes())
    values = (digests.astype(np.uint8), none.astype(np.uint8), ids.astype("<i8"), rids.astype("<i8"), counts.astype("<i8"))
    return {"n": len(digests), "least": ends[0], "greatest": ends[1], "filter": bloom(digests) if filtered else None} | {k: v.tobytes() for (k, _), v in zip(_ENTRY, values)}


def _unpacked(pieces: pa.Table | pa.RecordBatch) -> Entries:
    whole = [b"".join(pieces.column(k).to_pylist()) for k, _ in _ENTRY]
    return np.frombuffer(whole[0], np.uint8).reshape(-1, 32), np.frombuffer(whole[1], np.uint8), *(np.frombuffer(x, "<i8") for x in whole[2:])


def _memtables(bits: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            table = merged(tuple(np.concatenate(x) for x in zip(*held)))
            bucket = buckets_of(table[0], bits)
            cuts = [0, *(np.nonzero(np.diff(bucket))[0] + 1).tolist(), len(bucket)]
            return pa.RecordBatch.from_pylist([{"bucket": int(bucket[a])} | _packed(table, slice(a, b), False) for a, b in zip(cuts, cuts[1:])], PIECE)

        held: list[Entries] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8).reshape(-1, 32)
            ids = batch.column("doc_id")
            none = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            held.append((digests, none, ids.fill_null(0).to_numpy(), batch.column("rid").to_numpy(), np.ones(len(none), np.int64)))
            rows += batch.num_rows
            if rows >= size:
                yield flush()
                held, rows = [], 0
        if rows:
            yield flush()

    return run


def _merge_pieces(pieces: pa.Table) -> pa.Table:
    table = merged(_unpacked(pieces))
    return pa.Table.from_pylist([{"bucket": pieces.column("bucket")[0].as_py()} | _packed(table, slice(None), True)], PIECE)


def _probe_kernel():
    """Of the batch's digests, those that a piece's range and filter let pass."""

    def step(batch: pa.RecordBatch) -> dict:
        out = {"bucket": [], "run": [], "asked": [], "pass": []}
        for bucket, run, least, greatest, filter_, own in zip(*(batch.column(k).to_pylist() for k in ("bucket", "run", "least", "greatest", "filter", "own"))):
            digests = np.frombuffer(own, np.uint8).reshape(-1, 32)
            within = np.array([least <= d.tobytes() <= greatest for d in (digests[0], digests[-1])])
            some = digests[may_hold(filter_, digests)] if within.any() or digests[0].tobytes() < least < digests[-1].tobytes() else digests[:0]
            for k, v in zip(out, (bucket, run, len(digests), some.tobytes())):
                out[k].append(v)
        return {k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.int32(), pa.string(), pa.int64(), pa.binary()))}

    return step


def _find_kernel():
    """Entries of a piece for the digests that passed its filter and are in it."""

    def step(batch: pa.RecordBatch) -> dict:
        out: list[dict] = []
        for k in range(batch.num_rows):
            entries = _unpacked(batch.slice(k, 1))
            asked = np.frombuffer(batch.column("pass")[k].as_py(), np.uint8).reshape(-1, 32)
            view = entries[0].reshape(-1).view("S32") if len(entries[0]) else np.zeros(0, "S32")
            hit = np.nonzero(np.isin(view, asked.reshape(-1).view("S32")))[0]
            for i in hit:
                digest, none, doc_id, rid, n = (x[i] for x in entries)
                out.append({"digest": digest.tobytes(), "none": bool(none), "doc_id": None if none else int(doc_id), "rid": int(rid), "n": int(n)})
        schema = pa.schema([("digest", pa.binary()), ("none", pa.bool_()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("n", pa.int64())])
        table = pa.Table.from_pylist(out, schema)
        return {f.name: table.column(f.name).combine_chunks() for f in schema}

    return step


def _repeated_kernel():
    """(digest, none, doc_id, rid, n) of entries with several rows."""

    def step(batch: pa.RecordBatch) -> dict:
        digests, none, ids, rids, counts = _unpacked(batch)
        some = np.nonzero(counts > 1)[0]
        return {
            "digest": pa.array([digests[i].tobytes() for i in some], pa.binary()), "none": pa.array(none[some].astype(bool)), "doc_id": pa.array(ids[some], pa.int64(), mask=none[some].astype(bool)),
            "rid": pa.array(rids[some], pa.int64()), "n": pa.array(counts[some], pa.int64()),
        }

    return step


_ENTRY_SQL = "digest binary, none boolean, doc_id long, rid long, n long"


class DigestIndex:
    """Levels of runs under one shared folder; buckets are fixed by the rows that the index is made for."""

    def __init__(self, spark: SparkSession, rows: int, path: str | None = None, memtable_rows: int = MEMTABLE_ROWS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.memtable_rows = spark, path or scratch_path(spark, "digest-index"), memtable_rows
        self.bits = min(24, max(0, (max(rows, 1) - 1) // bucket_rows).bit_length())
        self.levels: list[list[str]] = []  # paths of the runs of each level, from level 1 on
        self.made = 0

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(PIECE_SQL).parquet(*paths).select(*PIECE.names)

    def _place(self, runs: list[str], level: int) -> str:
        """Merge runs (or flushed memtables) into one run of a level, and make it that level's newest."""
        where = f"{self.path}/level{level}/run{self.made}"
        self.made += 1
        ship_package(self.spark)
        self._read(runs).groupBy("bucket").applyInArrow(_merge_pieces, PIECE_SQL).write.option("compression", "zstd").parquet(where)
        while len(self.levels) < level:
            self.levels.append([])
        self.levels[level - 1].append(where)
        return where

    def add(self, rows: DataFrame) -> str:
        """Add a batch (doc_id, rid, digest of 32 bytes); levels that are full move down. Returns the batch's own run."""
        flushed = f"{self.path}/level0/batch{self.made}"
        ship_package(self.spark)
        rows.select("doc_id", "rid", "digest").mapInArrow(_memtables(self.bits, self.memtable_rows), PIECE_SQL).write.option("compression", "zstd").parquet(flushed)
        run, level = self._place([flushed], 1), 1
        while len(self.levels[level - 1]) >= FANOUT:
            full, self.levels[level - 1] = self.levels[level - 1], []
            self._place(full, level + 1)
            level += 1
        return run

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def compact(self) -> DataFrame:
        """All runs as one, which stays the index's only one: its pieces."""
        runs = self.runs()
        if len(runs) > 1:
            self.levels = [[] for _ in self.levels]
            self._place(runs, len(self.levels) + 1)
        return self._read(self.runs())

    def repeated(self) -> DataFrame:
        """(digest, none, doc_id, rid, n): digests of several rows with their smallest identifier."""
        return map_batches(self.compact().select(*(k for k, _ in _ENTRY)), _repeated_kernel, _ENTRY_SQL)

    def probe(self, batch: str) -> tuple[DataFrame, DataFrame]:
        """What other runs hold of a batch's run: entries (digest, none, doc_id, rid, n); and (bucket, run, asked, pass).

        The second is the filters' answer, for which only ranges and filters are read; pieces that let nothing pass are
        not read at all.
        """
        others = [r for r in self.runs() if r != batch]
        if not others:
            empty = self.spark.createDataFrame([], "bucket int, run string, asked long, pass binary")
            return self.spark.createDataFrame([], _ENTRY_SQL), empty
        every = [self._read([r]).withColumn("run", F.lit(r)) for r in others]
        pieces = every[0]
        for more in every[1:]:
            pieces = pieces.unionByName(more)
        own = self._read([batch]).select("bucket", F.col("digests").alias("own"))
        asked = pieces.select("bucket", "run", "least", "greatest", "filter").join(own, "bucket")
        answer = materialize(map_batches(asked, _probe_kernel, "bucket int, run string, asked long, pass binary"), "probe")
        wanted = answer.where(F.length("pass") > 0).select("bucket", "run", "pass")
        entries = map_batches(pieces.join(wanted, ["bucket", "run"]).select("pass", *(k for k, _ in _ENTRY)), _find_kernel, _ENTRY_SQL)
        return entries, answer


def _verified(log: DataFrame, shared: DataFrame, hot_rows: int) -> DataFrame:
    """(rid, doc_id, digest, keeper, n, same, text) for rows of shared digests; same: the keeper's bytes; text if not."""
    texts = log.select("rid", "doc_id", "digest", "text")
    heads = shared.select(F.xxhash64("digest").alias("head")).distinct()
    if heads.count() <= FILTER_LIMIT:  # spares other rows the shuffle
        texts = texts.join(F.broadcast(heads), F.xxhash64("digest") == F.col("head"), "left_semi")
    while shared.where(F.col("n") > hot_rows).count() > HOT_LIMIT:
        hot_rows *= 2
    hot = shared.where(F.col("n") > hot_rows).withColumn("salts", F.ceil(F.col("n") / hot_rows).cast("int"))
    keeper = F.struct("none", F.col("first_id").alias("doc_id"), F.col("first_rid").alias("rid")).alias("keeper")
    named = lambda df: df.withColumnsRenamed({"doc_id": "first_id", "rid": "first_rid"})
    marked = texts.join(F.broadcast(named(hot)), "digest", "left")
    dealt = marked.where("salts IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("salts")).cast("int"))
    heads_of_hot = marked.where(F.col("rid") == F.col("first_rid")).select("digest", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("text").alias("first"))
    warm = dealt.join(heads_of_hot, ["digest", "salt"]).select("rid", "doc_id", "digest", keeper, "n", (F.col("text") == F.col("first")).alias("same"), "text")
    cold = marked.where("salts IS NULL").select("rid", "doc_id", "digest", "text").join(named(shared), "digest")
    first = F.first("text").over(Window.partitionBy("digest").orderBy(smallest()))  # at most hot_rows rows
    cold = cold.select("rid", "doc_id", "digest", keeper, "n", (F.col("text") == first).alias("same"), "text")
    return cold.unionByName(warm).withColumn("text", F.when(~F.col("same"), F.col("text")))


def exact_groups(rows: DataFrame, digest_bits: int = 256, hot_rows: int = HOT_ROWS) -> DataFrame:
    """rows (rid, doc_id, text; rid unique) -> (rid, doc_id, keep_id, keep_rid, group_size, digest).

    Null text counts as empty and equals it. Of rows that repeat a doc_id with equal text, one stays. Rows without
    doc_id stay only if no equal row has one. An empty table gives an empty table. digest_bits shortens the digest
    (tests of collisions); results do not depend on it.
    """
    spark = rows.sparkSession
    whole = normalised(text_or_empty())
    digest = F.unhex(F.rpad(F.substring(F.sha2(F.col("text"), 256), 1, digest_bits // 4), 64, "0"))
    log = materialize(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "rid", whole.alias("text")).withColumn("digest", digest), "digest-log")
    index = DigestIndex(spark, log.count())
    index.add(log)
    shared = materialize(index.repeated(), "digest-hits")
    checked = materialize(_verified(log, shared, hot_rows), "verified")
    ids = log.select("rid", "doc_id", "digest")
    few = shared.count() <= FILTER_LIMIT
    if few:
        single = ids.join(F.broadcast(shared.select("digest")), "digest", "left_anti")
    else:
        single = ids.join(checked.select("rid"), "rid", "left_anti")  # by row: no digest is hot there
    alone = single.select("rid", "doc_id", F.col("doc_id").alias("keep_id"), F.col("rid").alias("keep_rid"), F.lit(1).cast("long").alias("group_size"), "digest")
    failed = checked.where(~F.col("same"))
    if failed.isEmpty():
        return alone.unionByName(checked.select("rid", "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.rid").alias("keep_rid"), F.col("n").alias("group_size"), "digest"))
    gone = failed.groupBy("digest").agg(F.count("*").alias("gone"))
    same = checked.where("same").join(F.broadcast(gone) if few else gone, "digest", "left")
    same = same.select("rid", "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.rid").alias("keep_rid"), (F.col("n") - F.coalesce("gone", F.lit(0))).alias("group_size"), "digest")
    own = failed.groupBy("digest", "text").agg(F.min(smallest()).alias("own"), F.count("*").alias("group_size"))
    other = failed.join(own, ["digest", "text"]).select("rid", "doc_id", F.col("own.doc_id").alias("keep_id"), F.col("own.rid").alias("keep_rid"), "group_size", "digest")
    return alone.unionByName(same).unionByName(other)


def report(docs: DataFrame) -> DataFrame:
    """Columns of op2: doc_id, keep_id, group_size, kept, text_sha256."""
    out = exact_groups(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid")))
    return out.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts, all columns as they were, whatever their names."""
    marked = rows_of(docs)
    kept = exact_groups(marked.select("rid", "doc_id", "text")).where("rid = keep_rid").select("rid")
    return same_columns(marked.join(kept, "rid", "left_semi").select("row.*"), docs)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
