"""Information-theoretic sanitisation of personal data.

Base spans (email, ip, card, phone) are found in every whole text. Protected entities are the distinct values and, with
the contexts of their values pooled, the domains of e-mail addresses. From the words around an entity's mentions, corpus
co-occurrence estimates how much a term t tells of an entity c:

    disclosure(c, t) = PMI(c; t) / IC(c) = log(N n_ct / (n_c n_t)) / log(N / n_c)

with N distinct texts, and n_c, n_ct and n_t those with a mention of c, with t near a mention of c, and with t anywhere:
all four in one unit, in which copies of a text count once. 1 means that t occurs only with c. As a share n_ct / n_t of
few passages is weak evidence, its lower confidence bound (Wilson, one-sided 90 %) stands in for it, where the pair's
distinct contexts are the sample: one context is enough, and copies add nothing. Terms above the removal threshold are
removed, those above the lower one are generalised, where they stand near a mention of that entity.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, join_hot, map_batches, materialize, rows_of, same_columns, text_or_empty

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("term_removed", "term_generalised")
WINDOW = 8
#: Normal quantile of the confidence bound.
QUANTILE = 1.2816
REMOVE_AT = 0.90
GENERALISE_AT = 0.75
#: Candidate terms up to which their set is sent to every task (about 16 MB); above it, all terms are counted and joined.
BROADCAST_TERMS = 200_000
#: Texts with copies up to which their list is broadcast (16 bytes each, 8 MB); above it, texts are made distinct by a shuffle.
BROADCAST_COPIES = 500_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match that starts inside a run of digits fails where one at its start does
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DIGITS = re.compile(r"[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """A match's local part is all of the run before its '@' that no earlier match has taken."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(digits: str) -> bool:
    odd, even = map(int, digits[::-1][::2]), (2 * int(x) for x in digits[::-1][1::2])
    return (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in KINDS, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entities_of(kind: str, value: str) -> list[str]:
    """Digests of the entities that a value belongs to, so that scratch tables hold no personal data."""
    plain = value.lower() if kind == "email" else value if kind == "ip" else "".join(_DIGITS.findall(value))
    names = [f"{kind}:{plain}"]
    if kind == "email":
        names.append(f"domain:{plain.rsplit('@', 1)[1]}")
    return [xxhash.xxh3_128_hexdigest(n) for n in names]


def mentions(text: str, spans: list[tuple[str, int, int]], window: int = WINDOW) -> list[tuple[str, int, str, int, int]]:
    """(entity, context, term, start, end) for the window words before and after each span, words in spans left out."""
    if not spans:
        return []
    edges = sorted({(a, b) for _, a, b in spans})
    words, k, reach = [], 0, -1
    for m in _TERM.finditer(text):
        while k < len(edges) and edges[k][0] < m.end():
            reach = max(reach, edges[k][1])
            k += 1
        if m.start() >= reach:
            words.append(m)
    starts = [m.start() for m in words]
    out = []
    for kind, a, b in spans:
        near = words[max(0, bisect_left(starts, a) - window) : bisect_left(starts, b) + window]
        terms = [m.group().lower() for m in near]
        context = xxhash.xxh64_intdigest(" ".join(terms)) - (1 << 63)
        out += [(entity, context, t, *m.span()) for entity in entities_of(kind, text[a:b]) for t, m in zip(terms, near)]
    return out


_FOUND = "rid long, doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
_FOUND += "near array<struct<entity:string,context:long,term:string,start:int,end:int>>"
_NEAR = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.int64()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _find_kernel(window: int):
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            cols = {k: [] for k in ("base_sha256", "base", "near", *KINDS)}
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                base = joined(spans)
                cols["base"].append(base)
                cols["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                cols["near"].append([dict(zip(("entity", "context", "term", "start", "end"), x)) for x in mentions(text, spans, window)])
                for kind in KINDS:
                    cols[kind].append(sum(k == kind for k, _, _ in spans))
            out = {k: batch.column(k) for k in ("rid", "doc_id", "text_key")} | {f"n_{k}": pa.array(cols[k], pa.int64()) for k in KINDS}
            return out | {"base_sha256": pa.array(cols["base_sha256"], pa.string()), "base": pa.array(cols["base"], pa.string()), "near": pa.array(cols["near"], _NEAR)}

        return step

    return make


def _counted_terms(texts: DataFrame, terms: set[str] | None) -> DataFrame:
    """(term, n_t): distinct texts with each of the terms (all terms if None); a partial sum leaves each batch.

    texts: text, copies. A text that stands in several rows counts one over their number in each.
    """
    sent = None if terms is None else texts.sparkSession.sparkContext.broadcast(frozenset(terms))

    def make():
        wanted = None if sent is None else sent.value

        def step(batch: pa.RecordBatch) -> dict:
            count: dict[str, float] = {}
            for text, copies in zip(batch.column("text").to_pylist(), batch.column("copies").to_pylist()):
                found = set(_TERM.findall(text.lower()))
                for t in found & wanted if wanted is not None else found:
                    count[t] = count.get(t, 0.0) + 1 / copies
            return {"term": pa.array(list(count), pa.string()), "n": pa.array(list(count.values()), pa.float64())}

        return step

    return map_batches(texts, make, "term string, n double").groupBy("term").agg(F.round(F.sum("n")).cast("long").alias("n_t"))


def disclosures(near: DataFrame, texts: DataFrame, n_texts: int, quantile: float = QUANTILE, at_least: float = GENERALISE_AT, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(pair struct<entity, term>, size, disclosure) of at_least or more; size: rows of near with the pair.

    near: text_key, pair, context; texts: text and in how many rows it stands (copies).
    """
    pairs = near.groupBy("pair").agg(F.countDistinct("text_key").alias("n_ct"), F.countDistinct("context").alias("contexts"), F.count("*").alias("size"))
    pairs = materialize(pairs.withColumn("entity", F.col("pair.entity")).withColumn("term", F.col("pair.term")), "term-pairs")
    entities = near.select(F.col("pair.entity").alias("entity"), "text_key").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    wanted = pairs.select("term").distinct()
    n_terms = wanted.count()
    if n_terms == 0:
        return pairs.select("pair", "size", F.lit(0.0).alias("disclosure")).where(F.lit(False))
    terms = {r.term for r in wanted.collect()} if n_terms <= broadcast_terms else None  # bounded by broadcast_terms
    both = pairs.join(entities, "entity").join(materialize(_counted_terms(texts, terms), "term-counts"), "term")
    total = F.greatest(F.lit(float(n_texts)), F.col("n_c"), F.col("n_t"))
    n_t = F.greatest("n_t", "n_ct")
    own = F.log2(total / F.col("n_c"))
    share, z2 = F.col("n_ct") / n_t, quantile * quantile
    m = F.col("contexts") / share  # passages with t, if those near c are its contexts
    bound = (share + z2 / (2 * m) - quantile * F.sqrt(share * (1 - share) / m + z2 / (4 * m * m))) / (1 + z2 / m)
    ratio = F.when(own > 0, F.log2(total * bound / F.col("n_c")) / own).otherwise(F.lit(0.0))
    return both.select("pair", "size", ratio.alias("disclosure")).where(F.col("disclosure") >= at_least)


def _with_copies(rows: DataFrame, found: DataFrame, broadcast_copies: int) -> DataFrame:
    """(text, copies) of rows, so that one over copies adds up to 1 a distinct text."""
    repeated = materialize(found.groupBy("text_key").agg(F.count("*").alias("copies")).where("copies > 1"), "pii-copies")
    if repeated.count() > broadcast_copies:
        return rows.select("text").distinct().withColumn("copies", F.lit(1).cast("long"))
    both = rows.join(F.broadcast(repeated), "text_key", "left")
    return both.select("text", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))


def find(
    rows: DataFrame, window: int = WINDOW, quantile: float = QUANTILE, remove_at: float = REMOVE_AT, generalise_at: float = GENERALISE_AT,
    broadcast_terms: int = BROADCAST_TERMS, broadcast_copies: int = BROADCAST_COPIES, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """rows (rid, doc_id, text) -> rid, doc_id, base counts, base_sha256, base spans, method (array of o, start, end, kind).

    Null text counts as empty; repeated rows each get a row; where every text has the entity, no term tells of it; an
    empty table gives an empty table. A pair of entity and term in more than hot_rows places stays where they are.
    """
    text = text_or_empty()
    rows = rows.select("rid", "doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = materialize(map_batches(rows, _find_kernel(window), _FOUND), "pii-found")
    near = found.where(F.size("near") > 0).select("rid", "text_key", F.explode("near").alias("x"))
    near = near.select("rid", "text_key", F.struct("x.entity", "x.term").alias("pair"), "x.context", "x.start", "x.end")
    n_texts = found.select("text_key").distinct().count()
    told = disclosures(near, _with_copies(rows, found, broadcast_copies), n_texts, quantile, generalise_at, broadcast_terms)
    told = materialize(told, "pii-told")
    kind = F.when(F.col("disclosure") >= remove_at, F.lit(TERM_KINDS[0])).otherwise(F.lit(TERM_KINDS[1]))
    spots = join_hot(near, told.select("pair", "disclosure"), "pair", told, hot_rows).groupBy("rid", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    order = F.when(kind == TERM_KINDS[0], 0).otherwise(1)
    listed = F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col("start"), F.col("end"), kind.alias("kind"))))
    method = spots.groupBy("rid").agg(listed.alias("method"))
    return found.drop("near", "text_key").join(method, "rid", "left")


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def _spans(found: DataFrame) -> DataFrame:
    """found with spans, all of them joined, base first, and n_term."""
    none = F.array().cast("array<struct<o:int,start:int,end:int,kind:string>>")
    added = F.array_join(F.transform(F.coalesce("method", none), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(added, F.lit("")))
    return found.withColumn("spans", spans).withColumn("n_term", F.coalesce(F.size("method"), F.lit(0)).cast("long"))


def report(docs: DataFrame) -> DataFrame:
    """Columns of op1: doc_id, four counts, base_sha256, spans; then n_term, the spans that the method adds."""
    return _spans(find(_numbered(docs))).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_term")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Spans become their kind in brackets; removed terms vanish; where spans meet, they form one of the first's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], "" if kind == TERM_KINDS[0] else "[TERM]" if kind == TERM_KINDS[1] else f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _mask_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            texts.append(masked(text, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(","))]))
        return {"rid": batch.column("rid"), "clean": pa.array(texts, pa.string())}

    return step


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with every base span masked and revealing terms removed or generalised; n_chars counted anew, in its type.

    Null texts stay null; texts without spans stay as they are, and so do other columns, whatever their names.
    """
    marked = rows_of(docs)
    spans = _spans(find(marked.select("rid", "doc_id", "text"))).where("spans <> ''").select("rid", "spans")
    touched = marked.select("rid", "text").join(materialize(spans, "pii-spans"), "rid")
    both = marked.select("rid", "row").join(map_batches(touched, _mask_kernel, "rid long, clean string"), "rid", "left")
    new = {"text": F.col("clean"), "n_chars": F.length("clean")}
    types = dict(docs.dtypes)
    fields = [F.when(F.col("clean").isNotNull(), new[c].cast(types[c])).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`") for c in docs.columns]
    return same_columns(both.select(*[f.alias(c) for f, c in zip(fields, docs.columns)]), docs)
