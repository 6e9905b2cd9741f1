"""Byte-level BPE encoding and decoding by recursive queries, one DuckDB connection a worker.

A vocabulary's merge table has a row for each way to split a token into two tokens; its rank is the token's id. A task
splits its texts into words and holds the distinct new ones as rows (word, pos, token), one a byte. A recursive query
joins neighbouring tokens with the merge table, contracts each word's leftmost pair of least rank, and ends with the
words that have no pair left; an ordered aggregation gives ids and, from them, the decoded bytes. Words are remembered
with both, so each is encoded once a worker, and a text is the concatenation of its words.

Rows are keyed by (word, pos), so a query holds one row a byte, however many rounds it takes. Words of more than
``SHORT`` bytes contract, in one round, all the pairs of least rank that would be taken one after the other from the left:
up to the first whose contraction makes a pair of lower rank. Only tokens that are part of one of lower rank can do that.
"""
from __future__ import annotations

import base64
import hashlib
import tempfile
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_PLAIN, Recent, map_batches, plain_pattern, text_or_empty

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Distinct words of a generation that a worker remembers, and bytes of one recursive query.
CACHE_WORDS = 400_000
QUERY_BYTES = 400_000
#: Bytes up to which a word takes a round a pair; the window query, of fewer rounds, is for longer ones.
SHORT = 64


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merge_rows(ranks: dict[bytes, int]) -> np.ndarray:
    """(n, 3) left id, right id, merged id: every split of every token into two tokens."""
    return np.array([(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks], np.int32).reshape(-1, 3)


_IDS = """
SELECT word, string_agg(token::VARCHAR, ',' ORDER BY pos) AS ids, string_agg(hex, '' ORDER BY pos) AS bytes
FROM turn JOIN tokens USING (token) GROUP BY word ORDER BY word
"""
# next is the place of the token after; later is that token. A contracted place stays as token -1, which is no token.
ENCODE = f"""
WITH RECURSIVE turn(word, pos, token, later, next) USING KEY (word, pos) AS (
    SELECT word, pos, token, later, next FROM start
  UNION ALL (
    WITH best AS (
        SELECT t.word, min((m.merged::BIGINT << 32) | t.pos) AS pick, arg_min(t.next, (m.merged::BIGINT << 32) | t.pos) AS gone
        FROM turn t JOIN merges m ON m.a = t.token AND m.b = t.later GROUP BY t.word),
    pair AS (SELECT word, (pick >> 32)::INT AS merged, (pick & 4294967295)::INT AS spot, gone FROM best),
    after AS (SELECT p.word, t.later, t.next FROM pair p JOIN turn t ON t.word = p.word AND t.pos = p.gone)
    SELECT t.word, t.pos, CASE t.pos WHEN p.spot THEN p.merged WHEN p.gone THEN -1 ELSE t.token END,
           CASE WHEN t.pos = p.spot THEN a.later WHEN t.next = p.spot THEN p.merged ELSE t.later END,
           CASE WHEN t.pos = p.spot THEN a.next ELSE t.next END
    FROM turn t JOIN pair p ON t.word = p.word JOIN after a ON a.word = p.word WHERE t.token >= 0)){_IDS}"""
# place is a pair's number among pairs of least rank that overlap in a row: every second one goes. parts is true for
# tokens that are part of one of lower rank.
ENCODE_LONG = f"""
WITH RECURSIVE turn(word, pos, token) USING KEY (word, pos) AS (
    SELECT word, pos, token FROM start
  UNION (
    WITH state AS (
        SELECT word, pos, token, lag(token) OVER w AS before, lead(pos) OVER w AS gone, lead(token) OVER w AS later, lead(token, 2) OVER w AS beyond
        FROM recurring.turn SEMI JOIN (SELECT DISTINCT word FROM turn) USING (word) WHERE token >= 0 WINDOW w AS (PARTITION BY word ORDER BY pos)),
    pair AS (SELECT s.*, m.merged, m.parts, min(m.merged) OVER (PARTITION BY word) AS least FROM state s JOIN merges m ON m.a = s.token AND m.b = s.later),
    best AS (SELECT *, coalesce(lag(gone) OVER w <> pos, true) AS opens, row_number() OVER w AS k FROM pair WHERE merged = least WINDOW w AS (PARTITION BY word ORDER BY pos)),
    placed AS (SELECT *, k - max(CASE WHEN opens THEN k END) OVER (PARTITION BY word ORDER BY k) AS place FROM best),
    apart AS (SELECT *, CASE WHEN place > 0 THEN merged ELSE before END AS beside FROM placed WHERE place % 2 = 0),
    lower AS (
        SELECT c.word, c.pos FROM apart c LEFT JOIN merges l ON l.a = c.beside AND l.b = c.merged LEFT JOIN merges r ON r.a = c.merged AND r.b = c.beyond
        WHERE c.parts AND (l.merged < c.merged OR r.merged < c.merged)),
    stop AS (SELECT word, min(pos) AS last FROM lower GROUP BY word),
    chosen AS (SELECT c.word, c.pos, c.gone, c.merged FROM apart c LEFT JOIN stop USING (word) WHERE c.pos <= stop.last OR stop.last IS NULL)
    SELECT word, pos, merged FROM chosen UNION ALL SELECT word, gone, -1 FROM chosen)){_IDS}"""


class WordTable:
    """(ids as text, decoded bytes) of words."""

    def __init__(self, path: str):
        import public_tokenizers

        self.ranks = read_ranks(path)
        self.bytes = {r: t for t, r in self.ranks.items()}
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.split_any, self.split_plain = regex.compile(public_tokenizers.PATTERN).findall, plain_pattern(public_tokenizers.PATTERN).findall
        self.known = Recent(CACHE_WORDS)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": tempfile.gettempdir()})
        rows = merge_rows(self.ranks)
        parts = np.zeros(max(self.bytes) + 1, bool)
        for k in (0, 1):
            parts[rows[rows[:, 2] < rows[:, k], k]] = True
        merges = pa.table({n: rows[:, k] for k, n in enumerate(("a", "b", "merged"))} | {"parts": parts[rows[:, 2]]})
        tokens = pa.table({"token": pa.array(self.bytes, pa.int32()), "hex": pa.array([t.hex() for t in self.bytes.values()])})
        for name, table in (("merges", merges), ("tokens", tokens)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _query(self, words: list[bytes]) -> list[tuple[str, bytes]]:
        """Words in order of length, of one query."""
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        token, pos = self.first[np.frombuffer(b"".join(words), np.uint8)], (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        later = np.append(token[1:], -1).astype(np.int32)
        later[ends - 1] = -1  # a word's last token has no neighbour
        start = pa.table({"word": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": pos, "token": token, "later": later, "next": pos + 1})
        self.db.register("start", start)
        found = self.db.execute(ENCODE if sizes[-1] <= SHORT else ENCODE_LONG).fetchall()
        self.db.unregister("start")
        return [(ids, bytes.fromhex(h)) for _, ids, h in found]

    def learn(self, words: list[str]) -> list[tuple[str, tuple[str, bytes]]]:
        ask, out = [], []
        for word in words:
            raw = word.encode()
            if raw in self.ranks:
                out.append((word, (str(self.ranks[raw]), self.bytes[self.ranks[raw]])))
            else:
                ask.append((len(raw), word, raw))
        ask.sort()
        part, size = [], 0
        for k, (n, word, raw) in enumerate(ask):
            part.append((word, raw))
            size += n
            if size >= QUERY_BYTES or k + 1 == len(ask) or n <= SHORT < ask[k + 1][0]:
                out += zip([w for w, _ in part], self._query([r for _, r in part]), strict=True)
                part, size = [], 0
        return out

    def encode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Ids (decimal, joined by commas) and the bytes they decode to, for each text."""
        split = [(self.split_any if NOT_PLAIN.search(t) else self.split_plain)(t) for t in texts]
        known = self.known.ready(set().union(*split), self.learn)
        out = []
        for words in split:
            pairs = [known[w] for w in words]
            out.append((",".join([p[0] for p in pairs]), b"".join([p[1] for p in pairs])))
        return out


@cache
def worker_table(path: str) -> WordTable:
    """One a worker process, for all of its tasks."""
    return WordTable(path)


def _encode_kernel(path: str, whole: bool):
    def make():
        table = worker_table(path)

        def step(batch: pa.RecordBatch) -> dict:
            found = table.encode(batch.column("text").to_pylist())
            out = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in found], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(ids.encode()).hexdigest() for ids, _ in found], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(raw).hexdigest() for _, raw in found], pa.string()),
            }
            if whole:
                out |= {"ids": pa.array([[int(x) for x in ids.split(",")] if ids else [] for ids, _ in found], pa.list_(pa.int32())), "decoded": pa.array([raw for _, raw in found], pa.binary())}
            return out

        return step

    return make


def encode_decode(docs: DataFrame, path: str | None = None, whole: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if whole, ids and decoded, for each row of docs.

    Null text counts as empty and has no ids; repeated rows each get a row; an empty table gives an empty table; other
    columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * whole
    return map_batches(rows, _encode_kernel(path or vocabulary_path(VOCABULARY), whole), schema)


def report(docs: DataFrame) -> DataFrame:
    """Columns of op6: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(docs, whole=False)
