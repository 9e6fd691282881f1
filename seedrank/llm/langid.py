"""Language identification with a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over a fixed-length
window and classified by a softmax layer; the network is trained with numpy on the driver from a
bounded sample of labelled rows (about ``SAMPLE`` documents of every language and ``WINDOWS`` windows
of each). Every text is then cut into consecutive
windows of ``LENGTH`` bytes (the last one padded with zero bytes), whole, and the windows' class
probabilities are averaged by the bytes they hold. A convolution over bytes is a sum of table rows,
so prediction adds rows of precomputed byte-pair tables, window batches at a time.

Learning uses text and non-null language of the rows that ``learn`` selects; the language, source
and id are no inputs of a prediction. Null texts and texts without a letter give ``und`` with score
0, as does a table without anything to learn from. Repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from seedrank.functions.params import bounded_broadcast
from seedrank.llm import text as T
from seedrank.llm.tables import free_name, ship

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBED = 8
SAMPLE = 300
WINDOWS = 3
EPOCHS = 10


def window_matrix(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """(n, length) bytes of windows that begin at ``starts`` and hold ``sizes`` bytes; zero beyond."""
    step = np.arange(length)
    out = data[np.minimum(starts[:, None] + step, max(0, len(data) - 1))] if len(data) else np.zeros((len(starts), length), np.uint8)
    return np.where(step < sizes[:, None], out, np.uint8(0))


class ByteCNN:
    def __init__(self, labels: list[str], seed: int = 0):
        r = np.random.default_rng(seed)
        self.labels = labels
        self.p = {"E": r.normal(0, 0.5, (256, EMBED)), "b": np.zeros((len(WIDTHS), FILTERS)),
                  "D": r.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(labels))), "c": np.zeros(len(labels))}
        for w in WIDTHS:
            self.p[f"W{w}"] = r.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01, seed: int = 1) -> "ByteCNN":
        """Adam on the cross-entropy; the gradient of a maximum goes to the position that attains it."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), batch):
                i = order[lo:lo + batch]
                g = self.gradient(x[i], y[i])
                t += 1
                for k in self.p:
                    m[k] += 0.1 * (g[k] - m[k])
                    v2[k] += 0.001 * (g[k] ** 2 - v2[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v2[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        at, top = [], []
        for w in WIDTHS:
            tables = [p["E"] @ p[f"W{w}"][j] for j in range(w)]
            z = sum(tables[j][x[:, j:x.shape[1] - w + 1 + j]] for j in range(w))
            at.append(z.argmax(axis=1))
            top.append(z.max(axis=1))
        pre = np.stack(top, axis=1) + p["b"]
        h = np.maximum(pre, 0)
        flat = h.reshape(n, -1)
        s = flat @ p["D"] + p["c"]
        s = np.exp(s - s.max(axis=1, keepdims=True))
        s /= s.sum(axis=1, keepdims=True)
        s[np.arange(n), y] -= 1
        s /= n
        g = {"D": flat.T @ s + 1e-4 * p["D"], "c": s.sum(axis=0), "E": np.zeros_like(p["E"])}
        back = (s @ p["D"].T).reshape(pre.shape) * (pre > 0)
        g["b"] = back.sum(axis=0)
        rows = np.arange(n)[:, None]
        for k, w in enumerate(WIDTHS):
            g[f"W{w}"] = np.zeros_like(p[f"W{w}"])
            for j in range(w):
                chars = x[rows, at[k] + j]
                g[f"W{w}"][j] = np.einsum("nf,nfe->ef", back[:, k], p["E"][chars])
                np.add.at(g["E"], chars, back[:, k][:, :, None] * p[f"W{w}"][j].T[None])
        return g

    def tables(self) -> list[list[np.ndarray]]:
        """Per width, float32 tables over byte pairs (and a last single byte for odd widths)."""
        out = []
        for w in WIDTHS:
            one = [(self.p["E"] @ self.p[f"W{w}"][j]).astype(np.float32) for j in range(w)]
            out.append([(one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS) if j + 1 < w else one[j] for j in range(0, w, 2)])
        return out

    def predict(self, x: np.ndarray, tables: list | None = None, batch: int = 64) -> np.ndarray:
        """Class probabilities of windows."""
        tables = tables or self.tables()
        out = np.empty((len(x), len(self.labels)))
        for lo in range(0, len(x), batch):
            xt = np.ascontiguousarray(x[lo:lo + batch].T)
            pair = (xt[:-1].astype(np.intp) << 8) | xt[1:]
            top = []
            for w, tabs in zip(WIDTHS, tables):
                n = xt.shape[0] - w + 1
                z = tabs[0].take(pair[:n], axis=0)
                for k, tab in enumerate(tabs[1:], 1):
                    z += tab.take((pair if len(tab) > 256 else xt)[2 * k:2 * k + n], axis=0)
                top.append(z.max(axis=0))
            h = np.maximum(np.stack(top, axis=1) + self.p["b"], 0).reshape(xt.shape[1], -1)
            s = h @ self.p["D"] + self.p["c"]
            s = np.exp(s - s.max(axis=1, keepdims=True))
            out[lo:lo + batch] = s / s.sum(axis=1, keepdims=True)
        return out


def training_windows(docs: DataFrame, learn: Column, sample: int, windows: int) -> tuple[np.ndarray, list[str]]:
    """Windows and their languages from about ``sample`` documents of every language, chosen by a hash."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # a row per language; broadcast as long as that many are small, or the texts would be shuffled by language
    share = bounded_broadcast(rows.groupBy("lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("share")))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 52)).cast("double") / float(1 << 52)

    def cut(batches):
        for part, data, offs in T.chunks(batches, "text"):
            size = np.diff(offs)
            doc = np.repeat(np.arange(len(size)), windows)
            free = np.maximum(0, size[doc] - LENGTH)
            starts = offs[doc] + (free * np.tile(np.arange(windows), len(size)) // max(1, windows - 1))
            full = (size[doc] > 0) & ((free > 0) | (np.tile(np.arange(windows), len(size)) == 0))
            x = window_matrix(data, starts[full], np.minimum(size[doc], LENGTH)[full], LENGTH)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc[full])), pa.array([w.tobytes() for w in x], pa.binary())], names=["lang", "x"])

    got = rows.join(share, "lang").filter(draw < F.col("share")).select("lang", "text").mapInArrow(cut, "lang string, x binary").collect()
    got.sort()
    return np.array([np.frombuffer(r["x"], np.uint8) for r in got], np.uint8).reshape(-1, LENGTH), [r["lang"] for r in got]


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE, windows: int = WINDOWS, epochs: int = EPOCHS) -> ByteCNN | None:
    x, lang = training_windows(docs, learn, sample, windows)
    if not lang:
        return None
    labels = sorted(set(lang))
    return ByteCNN(labels).fit(x, np.array([labels.index(v) for v in lang]), epochs)


def predict(docs: DataFrame, model: ByteCNN | None, keep_text: bool = False, letters: str = "letters",
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` (text, the boolean ``letters``, and more) with the two ``out`` columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    passed = [c for c in names if c != letters and (keep_text or c != "text")]

    def run(batches):
        model = shared.value
        tables = model.tables() if model else None
        for rows, data, offs in T.chunks(batches, "text"):
            n = rows.num_rows
            known = np.array(rows.column(names.index(letters)).to_pylist(), bool) if n else np.zeros(0, bool)
            pred, score = np.full(n, "und", object), np.zeros(n)
            if model:
                size = np.diff(offs) * known
                count = -(-size // LENGTH)
                doc = np.repeat(np.arange(n), count)
                starts = T.ragged(np.zeros(n, np.int64), count) * LENGTH
                held = np.minimum(size[doc] - starts, LENGTH)
                total = np.zeros((n, len(model.labels)))
                for lo in range(0, len(doc), 1024):
                    s = slice(lo, lo + 1024)
                    prob = model.predict(window_matrix(data, offs[doc[s]] + starts[s], held[s], LENGTH), tables)
                    np.add.at(total, doc[s], prob * held[s][:, None])
                some = size > 0
                total[some] /= size[some][:, None]
                best = total.argmax(axis=1)
                pred[some] = np.array(model.labels, object)[best[some]]
                score[some] = np.clip(total[some, best[some]], 0, 1)
            kept = [rows.column(names.index(c)) for c in passed]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred.tolist(), pa.string()), pa.array(score, pa.float64())], names=[*passed, *out])

    schema = ty.StructType([docs.schema[c] for c in passed]).add(out[0], "string").add(out[1], "double")
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row. Rows whose crc32 of the id as text leaves
    remainder 2 modulo 4 are held out of learning (as are rows with a null id, of no remainder)."""
    ship(docs.sparkSession)
    rest = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train(rows, ~F.col("held_out") & F.col("doc_id").isNotNull(), **how)
    return predict(rows.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")), model)


def keep_identified(docs: DataFrame, min_score: float = 0.0, **how) -> DataFrame:
    """Rows of ``docs`` whose text has a language: prediction not ``und`` (and, if asked, a score of at least ``min_score``). Columns
    of any name pass through."""
    ship(docs.sparkSession)
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    model = train(docs.select("doc_id", "text", "lang"), rest != 2, **how)
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    own = free_name(docs.columns, "_li_")
    judged = predict(docs.withColumn(f"{own}letters", known), model, True, f"{own}letters", (f"{own}lang", f"{own}score"))
    return judged.filter((F.col(f"{own}lang") != "und") & (F.col(f"{own}score") >= min_score)).select(*docs.columns)
