"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features (``NAMES``): hits and densities of a lexicon by strength, hits near a second-person pronoun,
capitals, punctuation, and obfuscation (symbols and digits inside words, runs of symbols behind
them, stretched letters, and lexicon hits that only show when these are undone, which count as hits too). The lexicon is learned:
its entries are whole words and word beginnings (``PREFIXES`` bytes), each with the lower end of a
confidence interval of its log-odds between toxic and other documents; a word counts with its best
entry. So inflected words are found by their stem, in any language of the labels.

Learning takes a bounded sample of labelled rows, about ``SAMPLE`` toxic and twice as many others, drawn
by a hash of the id and weighted back to their shares. Its texts are written once; entry counts are added up in Spark. Every
fold of the sample (by text, so equal texts are in one) gets features from a lexicon of the other
folds; trees are fitted on the driver on those features (``SAMPLE`` x 3 rows), and the calibration on
margins of trees fitted without the row's fold. Scoring is one pass over every whole text, without a shuffle.

Null texts count as empty and score as texts without words. Rows with a null label are not learned
from; of conflicting labels of one id, toxic counts. Without labels of both kinds the score is the share of
toxic labels (0 without any). Equal texts have equal scores. Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import text as T
from seedrank.llm.tables import Staged, ship

SAMPLE = 2000
FOLDS = 4
#: at most so many lexicon entries, the strongest
LEXICON = 4096
PREFIXES = (4, 5, 6, 7, 8, 10)
MIN_TOXIC = 3
#: lower ends of the three strengths of an entry
STRENGTHS = (1.0, 2.0, 3.5)
Z = 1.64
#: words between a lexicon hit and a second-person pronoun
NEAR = 5
#: fixed values: second-person pronouns
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "tu", "te", "toi", "ton", "vous", "votre", "du", "dich", "dir", "dein", "deine", "sie", "usted", "ti", "tus")
#: fixed values: digits and symbols that stand for letters
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}
THRESHOLD = 0.3

NAMES = ["log_words", "hits_1", "hits_2", "hits_3", "density_1", "density_2", "density_3", "strength_per_word", "strongest", "distinct_hits",
         "second_person", "hits_near_second_person", "share_near_second_person", "capitals", "capital_words", "capital_hits", "exclamations", "questions",
         "punctuation_runs", "punctuation", "obfuscated", "symbol_runs", "undone_hits", "digits", "stretched"]

LETTERS = T.class_table(b for b in range(128) if not chr(b).isalpha())
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$&%@!"]] = True
_LETTER_OF = np.zeros(256, np.uint8)
_LETTER_OF[LETTERS] = np.arange(256, dtype=np.uint8)[LETTERS]
for _c, _l in STAND_INS.items():
    _LETTER_OF[ord(_c)] = ord(_l)
_WHOLE = np.uint64(0xA24BAED4963EE407)


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the two-byte Latin-1 letters."""
    low = T.lower_ascii(data)
    if len(low) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        low[second] += 32
    return low


def keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(words, hashes) of each kind of entry: the words long enough for a beginning, then whole words."""
    prefix = T.byte_hash(low)
    for k in PREFIXES:
        at = np.flatnonzero(ends - starts >= k)
        yield at, T.span_hash(prefix, starts[at], starts[at] + k)
    yield np.arange(len(starts)), T.mix64(T.span_hash(prefix, starts, ends) ^ _WHOLE)


class Lexicon:
    """Entry hashes ascending and their strengths."""

    def __init__(self, hashes: np.ndarray, strength: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.strength = hashes[order], strength[order]

    def of(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's best strength (0: none), and its whole-word hash."""
        best = np.zeros(len(starts))
        whole = np.zeros(0, np.uint64)
        for at, whole in keys(low, starts, ends):
            if len(self.hashes) and len(at):
                i = np.minimum(np.searchsorted(self.hashes, whole), len(self.hashes) - 1)
                hit = self.hashes[i] == whole
                best[at[hit]] = np.maximum(best[at[hit]], self.strength[i[hit]])
        return best, whole


def _hash_words(words) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    *_, (_, whole) = keys(data, ends - [len(w) for w in raw], ends)
    return np.sort(whole)


def features(data: np.ndarray, offs: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """(documents, len(NAMES)) features of a chunk."""
    n = len(offs) - 1
    per = lambda values, first: T.segment_sum(values, first).astype(float)
    low = lower(data)
    starts, ends, first = T.words(low, offs, LETTERS)
    strength, whole = lexicon.of(low, starts, ends)
    words = np.maximum(1, np.diff(first)).astype(float)
    hits = [strength >= s for s in STRENGTHS]
    doc = np.repeat(np.arange(n), np.diff(first))
    pairs = np.unique(np.stack([doc[hits[0]].astype(np.uint64), whole[hits[0]]]), axis=1)[0].astype(np.int64) if hits[0].any() else np.zeros(0, np.int64)
    strongest = np.zeros(n)
    np.maximum.at(strongest, doc, strength)
    # words within NEAR of a pronoun of the same text
    pronouns = _hash_words(SECOND_PERSON)
    you = np.flatnonzero(pronouns[np.minimum(np.searchsorted(pronouns, whole), len(pronouns) - 1)] == whole) if len(whole) else np.zeros(0, np.int64)
    around = np.zeros(len(starts) + 1, np.int64)
    np.add.at(around, np.maximum(you - NEAR, first[doc[you]]), 1)
    np.add.at(around, np.minimum(you + NEAR + 1, first[doc[you] + 1]), -1)
    near = (np.cumsum(around)[:-1] > 0) & hits[0]
    # capitals and symbols
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    letters = np.concatenate(([0], np.cumsum(LETTERS[data])))
    capital = (upper[ends] - upper[starts] == ends - starts) & (ends - starts >= 3)
    total_letters = np.maximum(1, per(LETTERS[data], offs))
    size = np.maximum(1, np.diff(offs)).astype(float)
    inside = np.ones(len(data), bool)  # the byte before is of the same text
    inside[offs[:-1][offs[:-1] < len(data)]] = False
    before = np.concatenate(([0], data[:-1])).astype(np.uint8) if len(data) else data
    punctuation, symbol = _PUNCTUATION[data], _SYMBOL[data]
    run = punctuation & (data == before) & inside
    symbols = symbol & _SYMBOL[before] & inside
    twice = np.concatenate((np.zeros(2, np.uint8), data[:-2])).astype(np.uint8) if len(data) > 2 else np.zeros(len(data), np.uint8)
    stretched = LETTERS[data] & (data < 128) & (data == before) & (data == twice) & inside & np.concatenate(([False], inside[:-1]))[: len(data)]
    # words with something else inside, undone: stand-ins become letters, the rest goes
    a, b, t_first = T.words(data, offs, T.SPACE_SEPARATED)
    token = np.repeat(np.arange(n), np.diff(t_first))
    lead = np.searchsorted(starts, a)  # the token's first and last runs of letters
    last = np.searchsorted(starts, b) - 1
    odd = np.flatnonzero((last > lead) | ((last == lead) & (letters[b] - letters[a] >= 2) & (_LETTER_OF[data[a]] > 0) & ~LETTERS[data[a]]))
    o_len = (b - a)[odd]
    at = T.ragged(a[odd], o_len)
    plain = _LETTER_OF[low[at]] if len(at) else np.zeros(0, np.uint8)
    kept = plain > 0
    bounds = np.concatenate(([0], np.cumsum(o_len)))
    cut = np.concatenate(([0], np.cumsum(kept)))[bounds]
    undone, _ = lexicon.of(plain[kept], cut[:-1], cut[1:])
    shown = np.zeros(len(odd), bool)
    if len(odd):
        piece = T.ragged(lead[odd], last[odd] - lead[odd] + 1)
        owner = np.repeat(np.arange(len(odd)), last[odd] - lead[odd] + 1)
        best = np.zeros(len(odd))  # strongest plain piece of each odd token
        np.maximum.at(best, owner, strength[piece])
        shown = (undone >= STRENGTHS[0]) & (best < STRENGTHS[0])
    odd_doc = token[odd]
    count = lambda where: np.bincount(where, minlength=n).astype(float)
    undone = np.where(shown, undone, 0.0)  # a word that only shows undone is a hit like any other
    np.maximum.at(strongest, odd_doc, undone)
    n_hit = [per(h, first) + count(odd_doc[undone >= s]) for h, s in zip(hits, STRENGTHS)]
    n_near = per(near, first)
    in_all = per(strength, first) + np.bincount(odd_doc, undone, n)
    tokens = np.maximum(1, np.diff(t_first)).astype(float)
    columns = [np.log1p(np.diff(first)), *n_hit, *[1000 * h / words for h in n_hit], in_all / words, strongest, count(pairs),
               count(doc[you]) / words, 1000 * n_near / words, n_near / np.maximum(1, n_hit[0]), per(_UPPER[data], offs) / total_letters,
               per(capital, first) / words, per(capital & hits[0], first), 1000 * per(data == 33, offs) / size, 1000 * per(data == 63, offs) / size,
               1000 * per(run, offs) / size, 1000 * per(punctuation, offs) / size, count(odd_doc) / tokens, 1000 * per(symbols, offs) / size,
               count(odd_doc[shown]), per(_DIGIT[data], offs) / size, 1000 * per(stretched, offs) / size]
    return np.stack(columns, axis=1)


# ---------------------------------------------------------------- trees and calibration

class Trees:
    """Gradient-boosted trees of fixed depth for weighted 0/1 labels, on binned features."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least: float = 2.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least
        self.base, self.model = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> "Trees":
        n, p = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(p)]
        binned = np.stack([np.searchsorted(self.edges[j], x[:, j], side="left") for j in range(p)], axis=1)
        w = w / w.mean()
        share = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(n, self.base)
        offset = np.arange(p) * self.bins
        for _ in range(self.trees):
            prob = 1 / (1 + np.exp(-margin))
            g, h = w * (y - prob), w * prob * (1 - prob)
            node = np.zeros(n, np.int64)
            splits = []
            for level in range(self.depth):
                k = 1 << level
                cell = (node[:, None] * (p * self.bins) + offset + binned).ravel()
                shape = (k, p, self.bins)
                gs = np.bincount(cell, np.repeat(g, p), k * p * self.bins).reshape(shape).cumsum(axis=2)
                hs = np.bincount(cell, np.repeat(h, p), k * p * self.bins).reshape(shape).cumsum(axis=2)
                gt, ht = gs[:, :1, -1:], hs[:, :1, -1:]
                ok = (hs >= self.least) & (ht - hs >= self.least)
                gain = np.where(ok, gs ** 2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt ** 2 / (ht + self.ridge), 0.0).reshape(k, -1)
                best = gain.argmax(axis=1)
                feature, cut = best // self.bins, best % self.bins
                cut = np.where(gain[np.arange(k), best] > 1e-9, cut, self.bins)  # no gain: all go left
                splits.append((feature, cut))
                node = 2 * node + (binned[np.arange(n), feature[node]] > cut[node])
            leaves = 1 << self.depth
            value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge)
            margin += value[node]
            self.model.append((splits, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not self.model or not len(x):
            return out
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)
        rows = np.arange(len(x))
        for splits, value in self.model:
            node = np.zeros(len(x), np.int64)
            for feature, cut in splits:
                node = 2 * node + (binned[rows, feature[node]] > cut[node])
            out += value[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least-squares increasing fit by pooling adjacent violators: the blocks' mean x and value."""
    order = np.lexsort((-y, x))
    blocks: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order]):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Model:
    """Lexicon, trees and calibration; without trees a constant."""

    def __init__(self, lexicon: Lexicon, trees: Trees | None, at: np.ndarray, value: np.ndarray):
        self.lexicon, self.trees, self.at, self.value = lexicon, trees, at, value

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(offs) - 1, self.value[0])
        return np.clip(np.interp(self.trees.margin(features(data, offs, self.lexicon)), self.at, self.value), 0.0, 1.0)


# ---------------------------------------------------------------- learning

def sampled(stage: Staged, docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, toxic, fold, text) of the sample, written, and the weight of a sampled row by label. The ids
    drawn are bounded by the sample, so they are broadcast."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
             .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    span = 1 << 62
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(span))
    share = {y: min(1.0, (sample if y else 2 * sample) / n) for y, n in counts.items()}
    chosen = F.lit(False)
    for y, p in share.items():
        chosen = chosen | ((F.col("toxic") == y) & (draw < min(span, int(span * p))))
    rows = docs.join(F.broadcast(known.filter(chosen)), "doc_id").select(
        "doc_id", "toxic", F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold"), "text")
    return stage.write(rows, "sample"), {y: 1 / p for y, p in share.items()}


def entry_counts(rows: DataFrame) -> DataFrame:
    """(entry, toxic0, other0, ...): documents of each fold and label that hold an entry, at least
    ``MIN_TOXIC`` of them toxic. Every document counts an entry once; tasks add up before the shuffle."""
    def run(batches):
        for part, data, offs in T.chunks(batches, "text"):
            low = lower(data)
            starts, ends, first = T.words(low, offs, LETTERS)
            doc = np.repeat(np.arange(part.num_rows), np.diff(first)).astype(np.uint64)
            kind = np.array([2 * f + (1 - t) for f, t in zip(part.column(1).to_pylist(), part.column(0).to_pylist())], np.int64)
            found = [np.unique(np.stack([h, doc[at]]), axis=1) for at, h in keys(low, starts, ends)]
            pair = np.concatenate(found, axis=1)
            entry, inverse = np.unique(pair[0], return_inverse=True)
            count = np.bincount(inverse * (2 * FOLDS) + kind[pair[1].astype(np.int64)], minlength=len(entry) * 2 * FOLDS).reshape(-1, 2 * FOLDS)
            yield pa.RecordBatch.from_arrays([pa.array(entry.view(np.int64)), *[pa.array(count[:, k]) for k in range(2 * FOLDS)]], names=["entry", *COUNTS])

    counted = rows.select("toxic", "fold", "text").mapInArrow(run, "entry long, " + ", ".join(f"{c} long" for c in COUNTS))
    return counted.groupBy("entry").agg(*[F.sum(c).alias(c) for c in COUNTS]).filter(" + ".join(c for c in COUNTS if c[0] == "t") + f" >= {MIN_TOXIC}")


COUNTS = [f"{name}{f}" for f in range(FOLDS) for name in ("toxic", "other")]


def lexicon_without(entries: np.ndarray, counts: np.ndarray, size: np.ndarray, fold: int | None) -> Lexicon:
    """Entries whose lower end of log-odds reaches the least strength, from all folds but ``fold``."""
    use = [f for f in range(FOLDS) if f != fold]
    a, b = (sum(counts[:, 2 * f + k] for f in use) for k in (0, 1))
    n_a, n_b = (sum(size[2 * f + k] for f in use) for k in (0, 1))
    a, b = a + 0.5, b + 0.5
    low = np.log(a / (n_a + 1)) - np.log(b / (n_b + 1)) - Z * np.sqrt(1 / a + 1 / b)
    keep = np.flatnonzero((low >= STRENGTHS[0]) & (a > MIN_TOXIC))
    keep = keep[np.lexsort((entries[keep], -low[keep]))][:LEXICON]
    return Lexicon(entries[keep], low[keep])


def sample_features(rows: DataFrame, lexicons: list[Lexicon]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and folds of the sample, in an order that does not depend on the tasks."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)

    def run(batches):
        for part, data, offs in T.chunks(batches, "text"):
            fold = np.array(part.column(1).to_pylist(), np.int64)
            x = np.zeros((part.num_rows, len(NAMES)))
            for f in np.unique(fold):
                own = np.flatnonzero(fold == f)
                sizes = np.diff(offs)[own]
                x[own] = features(data[T.ragged(offs[own], sizes)], np.concatenate(([0], np.cumsum(sizes))), shared.value[f])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["toxic", "fold", "x"])

    got = rows.select("toxic", "fold", "text").mapInArrow(run, "toxic int, fold int, x binary").collect()
    got.sort(key=lambda r: (r["x"], r["fold"], r["toxic"]))
    return (np.array([np.frombuffer(r["x"]) for r in got]).reshape(len(got), len(NAMES)), np.array([r["toxic"] for r in got], float),
            np.array([r["fold"] for r in got], np.int64))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic)."""
    stage = Staged(docs.sparkSession, "toxicity")
    rows, weight = sampled(stage, docs, labels, sample)
    empty = Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    size = np.zeros(2 * FOLDS)
    for r in rows.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect():
        size[2 * r["fold"] + 1 - r["toxic"]] = r["n"]
    n_toxic, n_other = size[::2].sum(), size[1::2].sum()
    if not n_toxic or not n_other:
        return Model(empty, None, np.zeros(1), np.array([1.0 if n_toxic else 0.0]))
    found = entry_counts(rows).toLocalIterator()
    table = np.array([[r[c] for c in ("entry", *COUNTS)] for r in found], np.int64).reshape(-1, 2 * FOLDS + 1)
    entries, counts = table[:, 0].copy().view(np.uint64), table[:, 1:].astype(float)
    x, y, fold = sample_features(rows, [lexicon_without(entries, counts, size, f) for f in range(FOLDS)])
    w = np.where(y == 1, weight.get(1, 1.0), weight.get(0, 1.0))
    margin = np.zeros(len(y))
    for f in range(FOLDS):
        rest, own = fold != f, fold == f
        if own.any():
            known = rest if len(np.unique(y[rest])) == 2 else np.ones(len(y), bool)
            margin[own] = Trees().fit(x[known], y[known], w[known]).margin(x[own])
    at, value = isotonic(margin, y, w)
    stage.drop("sample")
    return Model(lexicon_without(entries, counts, size, None), Trees().fit(x, y, w), at, value)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for rows, data, offs in T.chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(data, offs))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``held_out`` ids are never learned from."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(rows, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), sample)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return score(rows, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
