"""Exact token counts at every prefix, by dynamic programming over the last token.

The encoding of a prefix ends in exactly one token t, and what is before t is encoded as it would be alone; t fits there
if it and the last token before it are what their own concatenation encodes to. So count[p] = count[p - len(t)] + 1 for
the one vocabulary token t that ends at p and fits. One pass over a word gives the count at each of its prefixes, and
with the counts of the words before it that at each prefix of the text: truncation and budget questions need no
re-encoding. Words are remembered with their counts by each worker.
"""
from __future__ import annotations

import json
from functools import cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_PLAIN, Recent, map_batches, plain_pattern, text_or_empty

LIMIT = 1024
VOCABULARY = "byte_bpe_50k.json"
#: Words of a generation whose prefix counts a worker remembers, and fitting pairs (at that bound, they start anew).
CACHE_WORDS = 600_000
CACHE_PAIRS = 1_000_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as is, the rest from U+0100 on."""
    as_is = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(as_is)]
    return {b: chr(b) for b in as_is} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class PrefixCounter:
    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {c: b for b, c in byte_alphabet().items()}
        raw = lambda token: bytes(letters[c] for c in token)
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        special = set(self.special)
        self.whole = frozenset(t for t in (raw(x) for x in spec["model"]["vocab"] if x not in special) if self.merge([t[k : k + 1] for k in range(len(t))]) == [t])
        self.longest = max(map(len, self.whole))
        self.library = Tokenizer.from_file(path)
        self.split = plain_pattern(public_tokenizers.PATTERN).findall
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))).split if special else lambda text: [text]
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known = Recent(CACHE_WORDS)

    def merge(self, parts: list[bytes]) -> list[bytes]:
        """Plain merging by least rank, for pairs of tokens only."""
        while len(parts) > 1:
            best = min(((self.rank.get(pair, 1 << 30), k) for k, pair in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 30:
                break
            k = best[1]
            parts = [*parts[:k], parts[k] + parts[k + 1], *parts[k + 2 :]]
        return parts

    def fit(self, a: bytes, b: bytes) -> bool:
        pair = (a, b)
        found = self.fits.get(pair)
        if found is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            both = a + b
            found = self.fits[pair] = self.merge([both[k : k + 1] for k in range(len(both))]) == [a, b]
        return found

    def byte_counts(self, word: bytes) -> list[int]:
        """Count at each byte prefix of a word, 0 first."""
        count, last, whole, fit, longest = [0], [b""], self.whole, self.fit, self.longest
        for p in range(1, len(word) + 1):
            for start in range(max(0, p - longest), p):
                token = word[start:p]
                if token in whole and (not start or fit(last[start], token)):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")
        return count

    def _counts(self, word: str) -> bytes | tuple[int, ...]:
        found = self.byte_counts(word.encode())
        if not word.isascii():
            found = [found[at] for at in accumulate((len(c.encode()) for c in word), initial=0)]
        return bytes(found) if max(found) < 256 else tuple(found)

    def _learn(self, words: list[str]) -> list[tuple[str, bytes | tuple[int, ...]]]:
        return [(w, b"\0\1" if w in self.special else self._counts(w)) for w in words]

    def word_counts(self, word: str) -> bytes | tuple[int, ...]:
        """Count at each letter prefix of a word (one pre-token), 0 first."""
        found = self.known.now.get(word)
        return self._counts(word) if found is None else found

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if not NOT_PLAIN.search(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens and special strings of a text, in order."""
        if not any(s in text for s in self.special):
            return self.words(text)
        out: list[str] = []
        for k, part in enumerate(self.at_special(text)):
            out += [self.special[0]] * (k > 0) + (self.words(part) if part else [])
        return out

    def count(self, piece: str) -> int:
        return 1 if piece in self.special else self.word_counts(piece)[-1]

    def totals(self, texts: list[str]) -> list[tuple[int, list[str]]]:
        """Tokens and pieces of each text."""
        split = [self.pieces(t) for t in texts]
        known = self.known.ready(set().union(*split), self._learn)
        return [(sum([known[w][-1] for w in p]), p) for p in split]

    def prefix_count(self, text: str, letters: int) -> int:
        """Tokens of text[:letters]: the stored counts, but for the split of the piece that the cut breaks."""
        pieces = self.pieces(text)
        ends = [*accumulate(map(len, pieces))]
        k = next((i for i, end in enumerate(ends) if end >= letters), len(pieces)) if letters else 0
        if k >= len(pieces):
            return sum(map(self.count, pieces))
        return sum(map(self.count, pieces[:k])) + self._partial(pieces, k, letters - (ends[k] - len(pieces[k])))

    def _partial(self, pieces: list[str], k: int, letters: int) -> int:
        """Tokens that the first letters of piece k add to the pieces before it."""
        part = pieces[k][:letters]
        if not part:
            return 0
        if letters == len(pieces[k]) and not part.isspace():
            return self.count(part)
        joins = (part.isspace() and pieces[k - 1].isspace()) or (pieces[k] in self.special and pieces[k - 1] not in self.special)
        before = pieces[k - 1] if k and joins else ""
        own = sum(map(self.count, self.words(before + part)))
        return own - (self.count(before) if before else 0)

    def longest_prefix(self, text: str, budget: int, pieces: list[str] | None = None) -> int:
        """Most letters of text whose tokens are at most budget."""
        pieces = self.pieces(text) if pieces is None else pieces
        used = at = 0
        for k, piece in enumerate(pieces):
            n = self.count(piece)
            if used + n > budget:
                broken = piece in self.special or piece[0] == "'" or not self.words(piece) == [piece]
                counts = () if broken else self.word_counts(piece)  # from the second letter on, a prefix is one piece too
                return at + max(j for j in range(len(piece)) if used + (self._partial(pieces, k, j) if j < 2 or broken else counts[j]) <= budget)
            used, at = used + n, at + len(piece)
        return at


@cache
def worker_counter(path: str) -> PrefixCounter:
    """One a worker process, for all of its tasks."""
    return PrefixCounter(path)


def _count_kernel(path: str, limit: int):
    def make():
        counter = worker_counter(path)

        def step(batch: pa.RecordBatch) -> dict:
            totals, fit = [], []
            whole = batch.column("text").to_pylist()
            for text, (n, pieces) in zip(whole, counter.totals(whole)):
                totals.append(n)
                fit.append(len(text) if n <= limit else counter.longest_prefix(text, limit, pieces))
            return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(totals, pa.int64()), "fit_chars": pa.array(fit, pa.int64())}

        return step

    return make


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) for each row of docs.

    fit_chars is the length of the longest prefix of at most limit tokens. Null text counts as empty: 0 bytes, 0
    tokens. Repeated rows each get a row; an empty table gives an empty table; other columns are ignored.
    """
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = map_batches(rows, _count_kernel(path or vocabulary_path(VOCABULARY), limit), "doc_id long, n_bytes long, n_tokens long, fit_chars long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")
