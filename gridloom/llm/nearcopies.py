"""Near duplicates by exact Jaccard similarity of word shingles: the wide pass of the SimHash operator.

A text is the set of its runs of ``SHINGLE`` words. Candidates are pairs whose fingerprints are linked by Golay keys, and
pairs that meet in one of ``BANDS`` bands of ``ROWS`` MinHash values each. The keys alone can't do it: at 0.8, a bit differs
with a probability of 0.15, a 23-bit segment keeps a codeword index in common in fewer than half of such pairs, and one
index is 12 bits; three segments in one key, as selective as a band, hold together for 6 % of the pairs at 150 keys a text.
The bands miss a pair at 0.8 with a probability of 5e-8, one at 0.9 with 1e-15, at 32 keys a text.

Every candidate is verified on the whole sets, so no pair below the threshold is linked by itself; components of links
are groups. Texts of one set are one node. In a band's bucket of more than ``bucket_pairs`` nodes, each is first held
against one, the least by one of ``PIVOTS`` hashes, so a group of any size costs so many comparisons a member. Buckets that are still of several components
are crowds: texts that share a passage, say, without being near copies. Their pairs are found exactly, and without being
formed one by one (``_across``):

A shingle in more than ``FREQUENT`` nodes of the crowds is frequent. With the others sorted first, a similar pair shares one
of the first n - ceil(0.8 n) + 1 shingles of both (prefix filtering; Chaudhuri et al. 2006). If that one is not frequent, at
most FREQUENT nodes meet in it. If it is, both nodes have all their infrequent shingles before it, so no more than a fifth,
and none in common: what they share is frequent. Then each is at least as similar to the other's double of the least
infrequent part, among nodes of the very same frequent part (class): so each such node is held against one node a class,
where their frequent parts are long enough.
"""
from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, join_hot, map_batches, materialize
from .components import connected_components
from .simhash import fingerprint_links, majority

SEED = 42
SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 32, 4
#: Different nodes that a group's buckets may take as the one against which all are held first.
PIVOTS = 8
#: Nodes of crowds that may share an infrequent shingle; frequent ones up to which their list goes to every task (8 MB).
FREQUENT = 32
BROADCAST_FREQUENT = 1_000_000
#: Ways in which a crowd's nodes are dealt when they are held against its classes.
SALTS = 16


def every_shingle(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a UTF-8 text's shingles; fewer words than size are one shingle, none give none."""
    words = raw.lower().split()  # as simhash does: A-Z only, ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        runs, total = iter([b" ".join(words)]), 1
    else:
        runs, total = map(b" ".join, zip(*(words[k:] for k in range(size)))), len(words) - size + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, total)


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes."""
    return np.unique(every_shingle(raw, size))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(SEED)
    a = rnd.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    return rnd.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64), a[:, None]


def band_keys(hashes: np.ndarray, flips: np.ndarray, odd: np.ndarray, chunk: int = 512) -> np.ndarray:
    """One signed 64-bit key a band."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), chunk):
        mixed = (hashes[None, at : at + chunk] ^ flips) * odd
        mixed ^= mixed >> np.uint64(32)
        low = np.minimum(low, (mixed * odd).min(axis=1))
    rows = low.reshape(BANDS, ROWS)
    return np.fromiter((xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)), np.uint64, BANDS).view(np.int64)


def _mark_kernel():
    flips, odd = _multipliers()

    def step(batch: pa.RecordBatch) -> dict:
        ids, sizes, bands, fps = [], [], [], []
        for raw in batch.column("text").cast(pa.binary()).to_pylist():
            every = every_shingle(raw)
            h = np.unique(every)
            ids.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63))
            sizes.append(len(h))
            bands.append(band_keys(h, flips, odd) if len(h) else np.zeros(0, np.int64))
            fps.append(majority(every) if len(h) else 0)
        out = {k: batch.column(k) for k in ("rid", "doc_id", "text")} | {"node": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int32())}
        return out | {"fp": pa.array(np.array(fps, np.uint64).view(np.int64)), "bands": pa.array(bands, pa.list_(pa.int64()))}

    return step


def _set_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        sets = [shingles(raw).view(np.int64) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
        return {"node": batch.column("node"), "hashes": pa.array(sets, pa.list_(pa.int64()))}

    return step


def similar(a: np.ndarray, b: np.ndarray, at_least: float = SIMILAR) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= at_least * (len(a) + len(b) - both) - 1e-9


def _verify_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        left, right = batch.column("ha"), batch.column("hb")
        ok = [similar(left[k].values.to_numpy(), right[k].values.to_numpy()) for k in range(batch.num_rows)]
        keep = pa.array(ok, pa.bool_())
        return {"a": batch.column("a").filter(keep), "b": batch.column("b").filter(keep)}

    return step


def _verified(pairs: DataFrame, marked: DataFrame, groups: DataFrame, label: str) -> DataFrame:
    """Pairs (a, b) of nodes at SIMILAR or more; the sets are made again from one text a node, for nodes in pairs only."""
    pairs = materialize(pairs.select("a", "b").distinct(), f"{label}-pairs")
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = marked.select("rid", "text").join(groups.join(asked, "node", "left_semi").select("node", "rid"), "rid").select("node", "text")
    sets = materialize(map_batches(texts, _set_kernel, "node long, hashes array<long>"), f"{label}-sets")
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
    both = one.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
    return materialize(map_batches(both.select("a", "b", "ha", "hb"), _verify_kernel, "a long, b long"), f"{label}-links")


def _close_by_keys(groups: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb) of nodes from Golay keys: of a fingerprint, each node and the least; of linked ones, the least two."""
    least = groups.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("least")).select("fp", F.col("least.node").alias("a"), F.col("least.n").alias("na"))
    least = materialize(least, "near-fingerprints")
    within = groups.select("fp", F.col("node").alias("b"), F.col("n").alias("nb")).join(least, "fp").where("a <> b")
    other = least.select(F.col("fp").alias("to"), F.col("a").alias("b"), F.col("na").alias("nb"))
    links = fingerprint_links(least.select("fp")).select(F.col("a").alias("fp"), F.col("b").alias("to"))
    across = links.join(least, "fp").join(other, "to")
    return within.select("a", "b", "na", "nb").unionByName(across.select("a", "b", "na", "nb"))


def _alike_in_size(x: str, y: str):
    return F.least(x, y) >= SIMILAR * F.greatest(x, y) - 1e-9


def _count_kernel():
    """Nodes that hold each shingle, added up over a part."""

    def step(batch: pa.RecordBatch) -> dict:
        hashes, counts = np.unique(batch.column("hashes").flatten().to_numpy(), return_counts=True)
        return {"hash": pa.array(hashes, pa.int64()), "df": pa.array(counts, pa.int64())}

    return step


def prefix_of(rare: np.ndarray, n: int) -> np.ndarray:
    """The infrequent ones among a set's first shingles: those of which a similar set must share one, unless it is frequent."""
    return np.sort(rare)[: n - int(np.ceil(SIMILAR * n - 1e-9)) + 1]


def _feature_kernel(frequent: Broadcast | None):
    """Per node: shingles, infrequent ones, its prefix of those, whether it reaches frequent ones, and its frequent part's hash."""

    def make():
        listed = None if frequent is None else frequent.value

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"n": [], "rare": [], "prefix": [], "mostly": [], "class": []}
            for k in range(batch.num_rows):
                if listed is None:
                    rare, common = (batch.column(c)[k].values.to_numpy() for c in ("rare", "common"))
                else:
                    every = batch.column("hashes")[k].values.to_numpy()
                    at = np.minimum(np.searchsorted(listed, every), max(len(listed) - 1, 0))
                    found = listed[at] == every if len(listed) else np.zeros(len(every), bool)
                    rare, common = every[~found], every[found]
                n = len(rare) + len(common)
                prefix = prefix_of(rare, n)
                values = (n, len(rare), prefix, len(rare) < n - int(np.ceil(SIMILAR * n - 1e-9)) + 1, xxhash.xxh3_64_intdigest(np.sort(common).tobytes()) - (1 << 63))
                for name, v in zip(out, values):
                    out[name].append(v)
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.bool_(), pa.int64())
            return {"node": batch.column("node")} | {name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds)}

        return step

    return make


def _features(sets: DataFrame, broadcast_frequent: int) -> DataFrame:
    """(node, n, rare, prefix, mostly, class) of the crowds' nodes."""
    counted = map_batches(sets.select("hashes"), _count_kernel, "hash long, df long").groupBy("hash").agg(F.sum("df").alias("size"))
    frequent = materialize(counted.where(F.col("size") > FREQUENT), "near-frequent")
    schema = "node long, n int, rare int, prefix array<long>, mostly boolean, class long"
    if frequent.count() <= broadcast_frequent:
        listed = np.sort(np.array([r["hash"] for r in frequent.select("hash").collect()], np.int64))  # bounded by broadcast_frequent
        return map_batches(sets, _feature_kernel(sets.sparkSession.sparkContext.broadcast(listed)), schema)
    every = sets.select("node", F.explode("hashes").alias("hash")).join(frequent.select("hash", F.lit(True).alias("often")), "hash", "left")
    of = lambda which, name: F.collect_list(F.when(which, F.col("hash"))).alias(name)  # noqa: E731  one text's shingles
    parted = every.groupBy("node").agg(of(F.col("often").isNull(), "rare"), of(F.col("often"), "common"))
    return map_batches(parted, _feature_kernel(None), schema)


def _across(crowded: DataFrame, roots: DataFrame, marked: DataFrame, groups: DataFrame, hot_rows: int, broadcast_frequent: int) -> DataFrame:
    """Pairs (a, b) by which crowds' nodes of different components may be linked. crowded: key, node, n."""
    members = materialize(crowded.join(roots.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left").select("key", "node", F.coalesce("root", "node").alias("root")), "near-members")
    counted = members.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "root")).alias("main"), F.count("*").alias("roots"), F.sum("c").alias("size"))
    counted = materialize(counted.where("roots > 1").select("key", F.col("main.root").alias("main"), "size"), "near-counted")
    mixed = materialize(join_hot(members, counted.select("key", "main"), "key", counted, hot_rows), "near-mixed")
    asked = mixed.groupBy("node", "root").agg(F.collect_list("key").alias("keys"))  # a key a band at most
    texts = marked.select("rid", "text").join(groups.join(asked, "node", "left_semi").select("node", "rid"), "rid").select("node", "text")
    sets = materialize(map_batches(texts, _set_kernel, "node long, hashes array<long>"), "near-crowd-sets")
    features = materialize(_features(sets, broadcast_frequent).join(asked, "node"), "near-features")

    tokens = features.select("node", "n", "root", F.explode("prefix").alias("token"))
    shared = tokens.join(tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"), "token")
    other = shared.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
    rare = shared.join(other, "token").where((F.col("node") < F.col("b")) & (F.col("root") != F.col("rb")) & _alike_in_size("n", "nb")).select(F.col("node").alias("a"), "b")

    common = mixed.select("key", "node", "main").join(features.where("mostly").select("node", "n", "rare", "class", "root", "keys"), "node")
    aside = F.col("root") != F.col("main")
    classes = common.groupBy("key", "class").agg(F.min(F.struct("rare", "node", "n", "root", "keys")).alias("one"), F.bool_or(aside).alias("some"))
    own = [F.col(f"one.{x}").alias(y) for x, y in (("node", "y"), ("n", "ny"), ("root", "ry"), ("keys", "ky"))]
    classes = classes.select("key", "some", *own, (F.col("one.n") - F.col("one.rare")).alias("cy"))
    dealt = common.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    against = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    most = F.least(F.col("n") - F.col("rare"), F.col("cy"))  # what the two can have in common at most
    can = most >= SIMILAR * (F.col("n") + F.col("ny") - most) - 1e-9
    once = F.array_min(F.array_intersect("keys", "ky")) == F.col("key")  # a pair is formed in the first bucket that it shares
    met = dealt.join(against, ["key", "salt"]).where((aside | F.col("some")) & (F.col("root") != F.col("ry")) & can & once)
    return rare.unionByName(met.select(F.least("node", "y").alias("a"), F.greatest("node", "y").alias("b")))


def near_copies(rows: DataFrame, bucket_pairs: int = 32, hot_rows: int = HOT_ROWS, broadcast_frequent: int = BROADCAST_FREQUENT) -> DataFrame:
    """rows (rid, doc_id, text; rid unique) -> (rid, doc_id, component_id, keep_rid): least doc_id of the group, and its row.

    Texts without a word are copies of each other. Rows that repeat a doc_id each get a row; a null doc_id never names a
    component unless all its members have none; an empty table gives an empty table.
    """
    marked = materialize(map_batches(rows.select("rid", "doc_id", "text"), _mark_kernel, "rid long, doc_id long, text string, node long, n int, fp long, bands array<long>"), "near-marked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    groups = marked.groupBy("node").agg(first, F.min("n").alias("n"), F.min("fp").alias("fp"), F.count("*").alias("size"))
    groups = materialize(groups.select("node", "n", "fp", "size", F.col("first.rid").alias("rid"), "first"), "near-groups")
    bands = marked.select("rid", "bands").join(groups.select("rid", "node", "n"), "rid")  # of one row a node
    keys = materialize(bands.select("node", "n", F.explode("bands").alias("key")).distinct(), "near-keys")
    pivot = F.xxhash64(F.pmod("key", F.lit(PIVOTS)), "node").alias("order")
    sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct(pivot, "node", "n")).alias("least")).where("c > 1"), "near-sizes")
    met = materialize(join_hot(keys, sizes, "key", sizes.withColumnRenamed("c", "size"), hot_rows), "near-met")
    few = met.where(F.col("c") <= bucket_pairs)
    pairs = few.select("key", F.col("node").alias("a"), F.col("n").alias("na")).join(few.select("key", F.col("node").alias("b"), F.col("n").alias("nb")), "key").where("a < b")
    crowded = met.where(F.col("c") > bucket_pairs)
    stars = crowded.select(F.col("least.node").alias("a"), F.col("node").alias("b"), F.col("least.n").alias("na"), F.col("n").alias("nb")).where("a <> b")
    every = pairs.drop("key").unionByName(stars).unionByName(_close_by_keys(groups)).where(_alike_in_size("na", "nb"))
    links = _verified(every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), marked, groups, "near-first")
    roots = connected_components(links, hot_rows)
    if not crowded.isEmpty():
        roots = materialize(roots, "near-roots")
        links = links.unionByName(_verified(_across(crowded.select("key", "node", "n"), roots, marked, groups, hot_rows, broadcast_frequent), marked, groups, "near-across"))
        roots = connected_components(links, hot_rows)
    rooted = materialize(groups.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "near-rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("first").alias("keep"), F.count("*").alias("size")), "near-least")
    named = join_hot(rooted.select("node", "root"), least.select("root", "keep"), "root", least, hot_rows).select("node", "keep")
    out = join_hot(marked.select("rid", "doc_id", "node"), named, "node", groups, hot_rows)
    return out.select("rid", "doc_id", F.col("keep.doc_id").alias("component_id"), F.col("keep.rid").alias("keep_rid"))
