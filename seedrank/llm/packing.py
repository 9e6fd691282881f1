"""Sum-of-squares online packing of tokenised documents into windows of ``capacity`` ids.

Every task packs the documents of its partition online. A document's ids end with id 0; full
windows are cut off its front, and the rest is placed into the fill level (an open window, or a new
one) that minimises the sum of squared counts of partially filled windows, which a level array
tracks: going from level h to h + s changes the sum by 2 (N[h + s] - N[h]) + 2, opening a window by 2 N[s] + 1. When
the partition ends (or ``MAX_OPEN`` windows are open, a bound on memory) the open windows are closed: windows of levels h
and ``capacity`` - h complete each other as they are; what no level completes is run together and cut into full windows, and
the last one into sequences whose lengths are powers of two, which need no padding. Memory is the open windows. Sequence ids carry the partition number,
so packing needs no shuffle, and a task that is run again gives the same pieces.

Ids come from a byte-level BPE vocabulary (a tokenizers JSON file): texts are split into
pre-tokens with array operations, each distinct pre-token of a chunk is encoded once, and ids are
gathered. A text that holds an added special token is encoded by the tokenizers library as a whole.

Null text counts as empty: such a document is the single id 0. A null doc_id stays null. Repeated
rows are packed one by one. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import text as T

CAPACITY = 1024
MAX_OPEN = 50_000
END = 0

#: fixed values: code points with the White_Space property
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def python_classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, by code point, as this Python's Unicode tables have them; 4: unassigned."""
    kind = {"L": 1, "N": 2}
    t = np.fromiter((4 if unicodedata.category(chr(c)) == "Cn" else kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)
    t[WHITE] = 3
    return t


@functools.cache
def classes(path: str) -> np.ndarray:
    """Classes of code points as the vocabulary's own splitter sees them. Its Unicode tables may be newer than Python's, so the
    code points of the first four planes that Python does not know (no other plane holds letters) are put to it, each behind a
    letter and behind a digit: it does not split a letter from a letter."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    t = python_classes()
    unknown = np.flatnonzero(t[:0x40000] == 4)
    t[t == 4] = 0
    for lead, kind in (("a", 1), ("1", 2)):
        starts = np.fromiter((span[0] for _, span in split("".join(f"{lead}{chr(c)} " for c in unknown.tolist()))), np.int64)
        joined = ~np.isin(np.arange(len(unknown)) * 3 + 1, starts)
        t[unknown[joined]] = kind
    return t


def byte_letters() -> dict[str, int]:
    """Inverse of the printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts under a byte-level BPE file, by pre-token, with a bounded cache."""

    CACHE = 1 << 20

    def __init__(self, path: str, kinds: np.ndarray | None = None):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model  # merges in the order of the file's list, as for a whole text
        self.letters = {b: c for c, b in byte_letters().items()}
        self.classes = classes(path) if kinds is None else kinds
        self.values = None
        self.clear()

    def clear(self) -> None:
        self.hashes, self.first, self.sizes, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def pieces(self, cp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Start of every pre-token; the pre-tokens tile the text and none crosses a document."""
        n = len(cp)
        kind = self.classes[cp]
        cut = np.zeros(n + 1, bool)
        cut[1:n] = kind[1:] != kind[:-1]
        cut[bounds] = True
        cut[n] = True
        run = np.flatnonzero(cut)
        a, b = run[:-1], run[1:]
        is_bound = np.zeros(n + 1, bool)
        is_bound[bounds] = True
        is_bound[n] = True
        # white space before a word: all but its last character is a piece; a last blank joins the word
        space = (kind[a] == 3) & ~is_bound[b]
        sb = b[space]
        cut[sb - 1] = True
        joins = cp[sb - 1] == 32
        cut[sb[joins]] = False
        # contractions: a lone apostrophe that does not follow a blank, then one of the endings
        quote = np.flatnonzero((kind[a] == 0) & (b - a == 1) & (cp[a] == 39) & cut[a] & ~is_bound[b])
        quote = quote[kind[b[quote]] == 1]
        if len(quote):
            p, end = a[quote], b[quote + 1]
            l0 = cp[p + 1]
            l1 = np.where(end - p > 2, cp[np.minimum(p + 2, n - 1)], 0)
            two = ((l0 == 114) & (l1 == 101)) | ((l0 == 118) & (l1 == 101)) | ((l0 == 108) & (l1 == 108))
            k = np.where(np.isin(l0, [115, 116, 109, 100]), 1, np.where(two, 2, 0))
            p, k = p[k > 0], k[k > 0]
            cut[p + 1] = False
            cut[p + 1 + k] = True
        return np.flatnonzero(cut[:n])

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk and the first id of each document (n + 1 bounds)."""
        raw = data.tobytes()
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        bounds = lead[offs]
        try:
            s = raw.decode("utf-8")
        except UnicodeDecodeError:
            docs = [raw[x:y].decode("utf-8", "replace") for x, y in zip(offs[:-1], offs[1:])]
            s, bounds = "".join(docs), np.concatenate(([0], np.cumsum([len(x) for x in docs])))
        cp = np.frombuffer(s.encode("utf-32-le"), np.uint32)
        start = self.pieces(cp, bounds[bounds < len(cp)])
        end = np.append(start[1:], len(cp))
        prefix = T.prefix_hash(T.mix64(cp.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        h = T.span_hash(prefix, start, end)
        u, one, inv = np.unique(h, return_index=True, return_inverse=True)
        first, sizes = self.look_up(u, s, start[one], end[one])
        n_ids = sizes[inv]
        ids = self.flat[T.ragged(first[inv], n_ids)]
        at = np.concatenate(([0], np.cumsum(n_ids)))
        out = at[np.searchsorted(start, bounds)]
        if any(x in s for x in self.special):
            parts = [ids[x:y] for x, y in zip(out[:-1], out[1:])]
            for i, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if any(t in s[x:y] for t in self.special):
                    parts[i] = np.array(self.whole.encode(s[x:y], add_special_tokens=False).ids, np.uint32)
            ids, out = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return ids, out

    def look_up(self, u: np.ndarray, s: str, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, u), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == u if len(self.hashes) else np.zeros(len(u), bool)
        if not known.all():
            if len(self.hashes) > self.CACHE:
                self.clear()
                known[:] = False
            new = np.flatnonzero(~known)
            tokenize, letters = self.model.tokenize, self.letters
            got = [[t.id for t in tokenize(s[x:y].encode().decode("latin-1").translate(letters))] for x, y in zip(start[new].tolist(), end[new].tolist())]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter((i for g in got for i in g), np.uint32, int(sizes.sum()))
            first = len(self.flat) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
            self.flat = np.concatenate((self.flat, flat))
            hashes = np.concatenate((self.hashes, u[new]))
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.first = np.concatenate((self.first, first))[order]
            self.sizes = np.concatenate((self.sizes, sizes))[order]
            at = np.searchsorted(self.hashes, u)
        return self.first[at], self.sizes[at]


class Packer:
    """Online sum-of-squares packing of id arrays; ``done`` gathers finished pieces."""

    def __init__(self, capacity: int = CAPACITY, max_open: int = MAX_OPEN, first_id: int = 0):
        self.capacity, self.max_open, self.next = capacity, max_open, first_id
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list] = [[] for _ in range(capacity + 1)]
        self.n_open = 0
        self.done: list[tuple] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n, full = len(ids), len(ids) // self.capacity * self.capacity
        for at in range(0, full, self.capacity):
            self.finish([(doc, at, ids[at:at + self.capacity], n)])
        if full < n:
            self.place((doc, full, ids[full:], n))

    def place(self, piece: tuple) -> None:
        s, c = len(piece[2]), self.capacity
        # change of the sum of squares from level h to h + s, h from 0 to c - s, less 2
        cost = 2 * (self.count[s:] - self.count[: c + 1 - s])
        cost = np.where(self.count[: c + 1 - s] > 0, cost, np.iinfo(np.int64).max)
        cost[-1] = min(cost[-1], cost[-1] - 1)  # a window that becomes full has no level any more
        cost[0] = 2 * self.count[s] - 1  # a new window had none
        h = c - s - int(np.argmin(cost[::-1]))  # of equal levels the fullest
        window = self.open[h].pop() if h else []
        if h:
            self.count[h] -= 1
            self.n_open -= 1
        window.append(piece)
        if h + s == c:
            self.finish(window)
            return
        self.open[h + s].append(window)
        self.count[h + s] += 1
        self.n_open += 1
        if self.n_open >= self.max_open:
            self.close()

    def finish(self, window: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, n in window:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, self.next, offset))
            offset += len(ids)
        self.next += 1

    def close(self) -> None:
        """Complete windows by windows of the level that they lack; run the others together: full windows, then powers of two."""
        for h in range(self.capacity, (self.capacity - 1) // 2, -1):
            high, low = self.open[h], self.open[self.capacity - h]
            while high and low and (high is not low or len(high) > 1):
                self.finish(high.pop() + low.pop())
        left = [p for level in reversed(self.open) for window in level for p in window]
        self.open = [[] for _ in range(self.capacity + 1)]
        self.count[:] = 0
        self.n_open = 0
        todo = sum(len(p[2]) for p in left)
        sizes = [self.capacity] * (todo // self.capacity) + [1 << b for b in range(self.capacity.bit_length(), -1, -1) if todo % self.capacity >> b & 1]
        left.reverse()
        for size in sizes:
            window = []
            while size:
                doc, start, ids, n = left.pop()
                window.append((doc, start, ids[:size], n))
                if len(ids) > size:
                    left.append((doc, start + size, ids[size:], n))
                size -= len(window[-1][2])
            self.finish(window)

    def take(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, max_open: int = MAX_OPEN,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kinds = docs.sparkSession.sparkContext.broadcast(classes(tokenizer_path))  # a byte per code point

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=COLUMNS)

    def run(batches):
        encoder = Encoder(tokenizer_path, kinds.value)
        packer = Packer(capacity, max_open, TaskContext.get().partitionId() << 33)
        for rows, data, offs in T.chunks(batches, "text", 1 << 20):
            ids, bounds = encoder.encode(data, offs)
            for doc, a, b in zip(rows.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                packer.add(doc, np.append(ids[a:b], np.uint32(END)))
            if packer.done:
                yield table(packer.take())
        packer.close()
        if packer.done:
            yield table(packer.take())

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS)))
