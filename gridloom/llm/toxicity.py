"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel with Nyström landmarks.

The kernel counts letter subsequences of length 3 that two strings share (their ends count as letters), each weighted by
DECAY to the power of the stretch it spans (at most SPAN letters), and is normalised (Lodhi et al. 2002). Signs inside a
word are passed over, and gaps are allowed, so insults with inserted, dropped or changed characters stay near their plain
form. Landmarks are strings of the labelled texts; a string's features are its kernel with each landmark, whitened by the
inverse root of the landmarks' kernel, and a linear machine is trained on them. As kernels are sums over subsequences, the
trained machine is one weight a subsequence: every string's decision is computed in full, whatever the landmarks' number.

Labels are per text. A text is scored by its most toxic string (word, or run of single letters). In training, strings
with strong evidence of toxic texts are positive, strings of clean texts negative (multiple-instance training), the
negatives nearest to positives weighing as much as all others. Each positive string of sure evidence also stands there
with one letter inserted or dropped at each inner place (virtual examples). Copies among the labelled texts count once.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, text_or_empty

ORDER, SPAN, DECAY = 3, 7, 0.75
WIDTH, STRIDE = 24, 12
OTHERS, EDGE = 14, 41  # codes 27 to 40 are for letters outside a-z, by code point; EDGE is a string's end
SIZE = EDGE**ORDER
#: Bounds of what is fitted on the driver: labelled texts of each class (chosen by hash of doc_id), landmarks, negatives.
TEXTS_PER_CLASS = 1500
LANDMARKS = 320
NEGATIVES = 20_000
HARD = 400
MIN_SUPPORT = 3
MIN_EVIDENCE = 12.0
#: Evidence from which a positive string stands in training with its variants too.
SURE = 60.0
THRESHOLD = 0.7
CACHE_STRINGS = 500_000
SIGNS = ".,;:!?\"'()[]{}<>*#$%&|-_+=/~`^@"  # passed over by the kernel: words that differ in them alone are one
LETTER_RUN = re.compile(r"(?<!\S)\w(?:\s+\w){2,}(?!\S)")

_STEPS = [(a, b) for a in range(1, SPAN) for b in range(a + 1, SPAN)]  # second and third letter, after the first


def _letter_table() -> np.ndarray:
    """0 for what is no letter, 1 to 26 for a-z, 27 to 40 for other letters."""
    out = np.zeros(0x3000, np.int16)
    for code in range(len(out)):
        c = chr(code).lower()[:1]
        if c.isalpha():
            out[code] = ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % OTHERS
    return out


_LETTERS = _letter_table()


def strings_of(text: str) -> set[str]:
    """Distinct words of a text, and its runs of three or more single letters as one string."""
    low = text.lower()
    out = {w.strip(SIGNS) for w in set(low.split())}
    out.discard("")
    if LETTER_RUN.search(low):
        out |= {"".join(m.group().split()) for m in LETTER_RUN.finditer(low)}
    return out


def windows_of(string: str) -> list[str]:
    """The string, or if it is longer than WIDTH, overlapping windows that cover all of it."""
    if len(string) <= WIDTH:
        return [string]
    return [string[at : at + WIDTH] for at in range(0, len(string) - WIDTH + STRIDE, STRIDE)]


def letter_codes(strings: list[str]) -> np.ndarray:
    """(n, WIDTH + 2) letter codes of strings of at most WIDTH letters, letters alone, between two EDGEs."""
    flat = np.frombuffer("".join(s.ljust(WIDTH) for s in strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WIDTH)
    codes = np.where(flat < len(_LETTERS), _LETTERS[np.minimum(flat, len(_LETTERS) - 1)], 27 + flat % OTHERS)
    codes = np.take_along_axis(codes, np.argsort(codes == 0, axis=1, kind="stable"), axis=1)  # signs inside a word go
    out = np.zeros((len(strings), WIDTH + 2), np.int32)
    out[:, 1:-1] = codes
    count = (codes > 0).sum(axis=1)
    some = np.nonzero(count)[0]
    out[some, 0] = out[some, count[some] + 1] = EDGE
    return out


def subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, weight) of each subsequence of each string, rows in order; equal ones of a row are added up."""
    rows, numbers, weights = [], [], []
    padded = np.concatenate([codes, np.zeros((len(codes), SPAN), np.int32)], axis=1)
    width = codes.shape[1]
    for a, b in _STEPS:
        x, y, z = codes, padded[:, a : a + width], padded[:, b : b + width]
        row, at = np.nonzero((x > 0) & (y > 0) & (z > 0))
        rows.append(row)
        numbers.append(((x[row, at] - 1) * EDGE + (y[row, at] - 1)) * EDGE + (z[row, at] - 1))
        weights.append(np.full(len(row), DECAY ** (b + 1)))
    key = np.concatenate(rows).astype(np.int64) * SIZE + np.concatenate(numbers)
    key, where = np.unique(key, return_inverse=True)
    return key // SIZE, key % SIZE, np.bincount(where, np.concatenate(weights), len(key))


@dataclass
class Landmarks:
    """Unit vectors of strings: place gives each subsequence's row in matrix, row 0 being that of all others."""

    place: np.ndarray  # (SIZE,) int32
    matrix: np.ndarray  # (1 + subsequences, strings) float32


def landmarks_of(strings: list[str]) -> Landmarks:
    """strings: of at most WIDTH letters."""
    row, number, weight = subsequences(letter_codes(strings))
    norm = np.sqrt(np.bincount(row, np.square(weight), len(strings)))
    found, where = np.unique(number, return_inverse=True)
    place = np.zeros(SIZE, np.int32)
    place[found] = np.arange(1, len(found) + 1)
    matrix = np.zeros((len(found) + 1, len(strings)), np.float32)
    matrix[where + 1, row] = weight / norm[row]
    return Landmarks(place, matrix)


def summed(strings: list[str], place: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per string of at most WIDTH letters: the sum of its unit vector's weights times the values (rows) of its subsequences."""
    out = np.zeros((len(strings), *values.shape[1:]), np.float32)
    for at in range(0, len(strings), 2048):
        part = strings[at : at + 2048]
        row, number, weight = subsequences(letter_codes(part))
        norm = np.sqrt(np.bincount(row, np.square(weight), len(part)))
        where = place[number]
        some = np.nonzero(where)[0]
        if len(some):
            row, unit = row[some], (weight[some] / norm[row[some]]).astype(np.float32)
            if values.ndim == 1:
                out[at : at + len(part)] = np.bincount(row, unit * values[where[some]], len(part))
                continue
            first = np.nonzero(np.diff(row, prepend=-1))[0]
            out[at + row[first]] = np.add.reduceat(values[where[some]] * unit[:, None], first, axis=0)
    return out


def kernels(strings: list[str], landmarks: Landmarks) -> np.ndarray:
    """(n, m) kernels of strings of at most WIDTH letters with landmarks."""
    return summed(strings, landmarks.place, landmarks.matrix)


@dataclass
class Model:
    place: np.ndarray  # (SIZE,) int32: each subsequence's row in weights, 0 for those of no landmark
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def decisions(self, strings: list[str]) -> np.ndarray:
        """Decision of each string; of a long one, its highest window's."""
        if not strings:
            return np.zeros(0)
        parts = [windows_of(s) for s in strings]
        out = summed([w for p in parts for w in p], self.place, self.weights) + self.bias
        return np.maximum.reduceat(out, np.cumsum([0, *map(len, parts[:-1])]))

    def score(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss: Newton steps on the active rows, costs summing to 1."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    reg = np.full(z.shape[1], ridge)
    reg[-1] = 1e-9
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        active = y * (z @ w) < 1
        za, ca = z[active], cost[active]
        new = np.linalg.solve(za.T @ (za * ca[:, None]) + np.diag(reg), za.T @ (ca * y[active]))
        if np.allclose(new, w, atol=1e-10):
            break
        w = new
    return w[:-1], float(w[-1])


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def _calibrated(toxic: np.ndarray, clean: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift by which THRESHOLD is the decision of best F1 at this share of toxic texts, and 1 scores 0.98.

    Labels of texts say little of single strings, so a logistic fit to them would be flat; the operating point is not.
    """
    cuts = np.unique(np.round(np.concatenate([toxic, clean]), 3))
    cuts = cuts[(cuts > -1) & (cuts < 0.95)]
    if not len(cuts):
        cuts = np.array([0.0])
    right = share * (toxic[None, :] >= cuts[:, None]).mean(axis=1)
    wrong = (1 - share) * (clean[None, :] >= cuts[:, None]).mean(axis=1)
    f1 = 2 * right / (right + wrong + share)
    best = cuts[f1 >= f1.max() - 0.002]
    cut = float(best[len(best) // 2])  # the middle of those as good
    slope = (_logit(0.98) - _logit(THRESHOLD)) / (1 - cut)
    return slope, _logit(THRESHOLD) - slope * cut


def _one_of_each(texts: list[set[str]], hashes: int = 16) -> list[set[str]]:
    """Texts without those that share half of their minimum hashes with an earlier one: copies are one piece of evidence."""
    seen: dict[tuple[int, int], set[int]] = {}
    kept: list[set[str]] = []
    factors = [2 * k * 0x9E3779B1 + 1 for k in range(1, hashes + 1)]
    for text in texts:
        base = np.array([zlib.crc32(s.encode()) for s in text], np.uint64)
        marks = [(k, int(((base * np.uint64(f)) & np.uint64(0xFFFFFFFF)).min())) for k, f in enumerate(factors)]
        meets = Counter(j for m in marks for j in seen.get(m, ()))
        if not meets or max(meets.values()) < hashes // 2:
            for m in marks:
                seen.setdefault(m, set()).add(len(kept))
            kept.append(text)
    return kept


def _evidence(n: int, of: int, m: int, other: int) -> float:
    """Log-likelihood ratio that a string's share of toxic texts is above that of clean ones; 0 if it is not."""
    if n * other <= m * of:
        return 0.0
    share = (n + m) / (of + other)
    return 2 * (n * np.log(n / of / share) + (m * np.log(m / other / share) if m else 0.0))


def variants(string: str) -> list[str]:
    """The string with a letter inserted, and one dropped, at each inner place; short ones lose none."""
    letter = lambda k: chr(97 + zlib.crc32(f"{string}{k}".encode()) % 26)
    out = [string[:k] + letter(k) + string[k:] for k in range(1, len(string))]
    return out + [string[:k] + string[k + 1 :] for k in range(1, len(string) - 1) if len(string) > 4]


def _letters(string: str) -> int:
    return sum(map(str.isalpha, string))


def fit(toxic: list[set[str]], clean: list[set[str]], share: float = 0.5) -> Model:
    """Train on sets of strings, one set a text; share: part of toxic texts where the scores will be used.

    Of a positive string of more than WIDTH letters, the window nearest to other positives is trained; of a negative one,
    every window. Without texts of either class every text scores the share of toxic ones.
    """
    blank = Model(np.zeros(SIZE, np.int32), np.zeros(1, np.float32), 0.0, 1.0, _logit(min(max(share, 1e-6), 1 - 1e-6)))
    toxic, clean = [t for t in toxic if t], [t for t in clean if t]
    if not toxic or not clean:
        return blank
    toxic, clean = _one_of_each(toxic), _one_of_each(clean)
    bad, good = Counter(s for t in toxic for s in t), Counter(w for t in clean for w in {w for s in t for w in windows_of(s)})
    whole = Counter(s for t in clean for s in t)
    gain = {s: _evidence(n, len(toxic), whole[s], len(clean)) for s, n in bad.items() if n >= MIN_SUPPORT and _letters(s) >= ORDER}
    ranked = [s for s in sorted(gain, key=lambda s: (-gain[s], s)) if gain[s] >= MIN_EVIDENCE]
    if not ranked:
        return blank
    short = landmarks_of([s for s in ranked if len(s) <= WIDTH] or [ranked[0][:WIDTH]])
    best_window = lambda s: max(windows_of(s), key=lambda w: float(kernels([w], short).max())) if len(s) > WIDTH else s
    positives: dict[str, int] = {}
    sure: dict[str, bool] = {}
    for s in ranked:
        positives.setdefault(best_window(s), bad[s])
        sure.setdefault(best_window(s), gain[s] >= SURE)
    plain = [s for s, _ in sorted(good.items(), key=lambda x: (-x[1], x[0])) if _letters(s) >= ORDER and s not in positives]
    strong = [*positives][: LANDMARKS * 2 // 5]
    near = kernels(plain, landmarks_of(strong)).max(axis=1) if plain else np.zeros(0)  # the clean strings nearest to strong ones
    hard = [plain[k] for k in np.argsort(-near, kind="stable")[:HARD].tolist()]
    half = NEGATIVES // 2
    rest = sorted((s for s in good if s not in positives), key=lambda s: (-good[s], zlib.crc32(s.encode()), s))
    rest = [*rest[:half], *sorted(rest[half:], key=lambda s: (zlib.crc32(s.encode()), s))[:half]]
    negatives = list(dict.fromkeys([*hard, *rest]))
    landmarks = list(dict.fromkeys([*strong, *hard[: LANDMARKS * 2 // 5], *plain]))[:LANDMARKS]
    unit = landmarks_of(landmarks)
    own = kernels(landmarks, unit).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    cn = np.array([float(good[s]) for s in negatives])
    close = np.arange(len(negatives)) < len(hard)  # near misses weigh as much as all the rest together
    for part in (close, ~close):
        cn[part] /= max(cn[part].sum(), 1e-12)
    made = {v: n / len(more) for s, n in sorted(positives.items()) if sure[s] for more in [variants(s)] for v in more if v not in good and v not in positives and len(v) <= WIDTH}
    words = [*sorted(positives), *made]
    cp = np.array([positives.get(s) or made[s] for s in words], float)
    x = kernels([*words, *negatives, ""], unit) @ root  # the empty string is a negative too: what is like no landmark is clean
    y = np.array([1.0] * len(words) + [-1.0] * (len(negatives) + 1))
    w, bias = _svm(x, y, np.concatenate([cp / cp.sum(), cn / max(cn.sum(), 1e-12), [0.5]]))
    model = Model(unit.place, (unit.matrix @ (root @ w)).astype(np.float32), bias, 1.0, 0.0)
    disguised = [[variants(s)[zlib.crc32(s.encode()) % max(1, len(s) - 1)] if sure.get(s) else s for s in sorted(t)] for t in toxic]
    best = [np.array([model.decisions(sorted(t)).max() for t in texts]) for texts in (toxic, disguised, clean)]
    model.slope, model.shift = _calibrated(np.concatenate(best[:2]), best[2], share)
    return model


def remainder() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))


def _strings_kernel():
    def step(batch: pa.RecordBatch) -> dict:
        return {"toxic": batch.column("toxic"), "strings": pa.array([sorted(strings_of(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))}

    return step


def train(docs: DataFrame, labels: DataFrame, texts_per_class: int = TEXTS_PER_CLASS) -> Model:
    """Fit on at most texts_per_class labelled texts of each class, the first by a hash of doc_id, none held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(remainder() != 1)
    totals = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picks = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts_per_class) for k in (0, 1)]
    chosen = materialize(picks[0].unionByName(picks[1]), "toxicity-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = map_batches(texts.select("toxic", "text"), _strings_kernel_maker, "toxic int, strings array<string>").collect()  # 2 * texts_per_class at most
    by = [[set(r["strings"]) for r in rows if r["toxic"] == k] for k in (0, 1)]
    total = sum(totals.values())
    return fit(by[1], by[0], totals.get(1, 0) / total if total else 0.5)


def _strings_kernel_maker():
    return _strings_kernel()


_remembered: dict[str, dict[str, float]] = {}


def _worker_known(model: Model) -> dict[str, float]:
    """Decisions that this worker process has made with this very model."""
    stamp = hashlib.sha256(model.place.tobytes() + model.weights.tobytes() + repr(model.bias).encode()).hexdigest()
    if stamp not in _remembered:
        _remembered.clear()
        _remembered[stamp] = {}
    return _remembered[stamp]


def _score_kernel(model: Model, threshold: float):
    def make():
        known = _worker_known(model)

        def step(batch: pa.RecordBatch) -> dict:
            sets = [strings_of(t) for t in batch.column("text").to_pylist()]
            new = list(set().union(*sets).difference(known))
            if len(known) + len(new) > CACHE_STRINGS:
                known.clear()
                new = list(set().union(*sets))
            for at in range(0, len(new), 1 << 16):
                part = new[at : at + (1 << 16)]
                known.update(zip(part, model.decisions(part).tolist()))
            best = np.array([max(map(known.__getitem__, s)) if s else model.bias for s in sets])
            score = model.score(best)
            return {"doc_id": batch.column("doc_id"), "score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))}

        return step

    return make


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    Null text counts as empty; an empty text scores as a string without subsequences does; a null doc_id is held out of
    nothing; repeated rows each get a row; an empty table gives an empty table; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = map_batches(rows, _score_kernel(model, threshold), "doc_id long, score double, predicted int")
    return out.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns of op9: doc_id, held_out, score, predicted."""
    return score(docs, train(docs, labels))
