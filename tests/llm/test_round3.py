"""Toxicity, fill-in-middle and ranked search on small fixtures: held-out accuracy, round trips and brute
force; nulls, empty and long texts, ties, repeated rows, extra columns with clashing names, empty tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seedrank.llm import exact_stream, fim, packing, ranked_search, simhash, tables, toxicity

SCHEMA = "doc_id long, text string, rank int, score int, chunk string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(11)
    vocab = ["".join(r.choice(list("abcdeé"), 4)) for _ in range(300)]
    make = lambda n: " ".join(vocab[int(i)] for i in np.minimum(r.zipf(1.3, n), 300) - 1)
    texts = [make(int(n)) for n in r.integers(1, 80, 60)]
    texts += [texts[0], texts[0].upper(), None, "", " \n", "...", "日本語 テキスト 😀😀", "a\r\nb\u0085c d", make(4000), "a<P>b", "<S>", "x<M>", "😀" * 3000, "<P", "S>", "<"]
    out = [(i, t, 1, 2, "c") for i, t in enumerate(texts)]
    return out + [(None, texts[3], None, None, None), (5, texts[5], 1, 2, "c"), (None, None, 0, 0, ""), (-(1 << 63), texts[7], 1, 2, "c")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    tables.ship(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


# ---------------------------------------------------------------- fill-in-middle

def test_fill_in_middle_cuts_and_restores(docs, rows):
    want = []
    for doc, t, *_ in rows:
        t = t or ""
        h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        plain = not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90
        form = "plain" if plain else "spm" if h4 % 100 < 20 else "psm"
        p, m, s = t[:a], t[a:b], t[b:]
        out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        want.append((doc, len(t), form, None if plain else a, None if plain else b - a, out))
    got = [tuple(r) for r in fim.examples(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len({w[2] for w in want}) == 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    digests = [tuple(r) for r in fim.digests(docs).collect()]
    assert sorted(map(str, digests)) == sorted(str((*w[:5], sha(w[5]), sha(t or ""))) for w, (_, t, *_) in zip(want, rows))
    assert fim.digests(docs.limit(0)).count() == 0


def test_units_are_counted_over_blocks(spark):
    sizes = [0, 1, fim.BLOCK - 1, fim.BLOCK, fim.BLOCK + 1, 3 * fim.BLOCK, 200_000]
    df = spark.createDataFrame([(n, "😀" * (n // 2) + "\n" * (n - n // 2)) for n in sizes], "n long, text string")
    assert all(r.n == r.c for r in df.select("n", fim.count_units(F.col("text")).alias("c")).collect())


# ---------------------------------------------------------------- ranked search

def brute(rows, items, k):
    term = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    texts = [(doc, collections.Counter(term(t))) for doc, t, *_ in rows]
    texts = [(doc, c) for doc, c in texts if c]
    n, total = len(texts), sum(sum(c.values()) for _, c in texts)
    df = collections.Counter(w for _, c in texts for w in c)
    out = []
    for item, t in dict.fromkeys(items):
        scores = []
        for doc, c in texts:
            m = 75 + (25 * sum(c.values()) * n) // total
            x = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w in term(t) if w in c)
            if x > 0:
                scores.append((-x, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("how", [{}, {"bundle": 3, "block_words": 40, "k": 3}, {"bands": (), "k": 5}, {"bands": (0.01, 0.05, 0.1, 0.3, 0.6), "k": 1}])
def test_ranked_search(spark, docs, rows, how, monkeypatch):
    monkeypatch.setattr(ranked_search, "CHUNK_DOCS", 7)
    items = [(1, rows[3][1]), (2, rows[8][1] + " " + rows[9][1]), (3, None), (4, "..."), (None, rows[12][1]), (5, "zzz"), (2, rows[20][1]), (1, rows[3][1]), (6, rows[30][1].upper())]
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, row int")
    got = [tuple(r) for r in ranked_search.search(docs, asked, **how).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, items, how.get("k", 20))))


def test_ranked_search_of_empty_tables(spark, docs):
    asked = spark.createDataFrame([(1, "abc")], "item_id long, text string")
    assert ranked_search.search(docs.limit(0), asked).count() == 0
    none = ranked_search.search(docs, asked.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


# ---------------------------------------------------------------- toxicity

def labelled(r, n):
    vocab = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(200)]
    bad = ["fooling", "barbaric", "grumble"]
    texts, labels = [], []
    for i in range(n):
        w = list(r.choice(vocab, 40))
        if i % 6 == 0:
            for j in r.choice(40, 4, replace=False):
                w[j] = bad[int(r.integers(3))]
        texts.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 6 == 0)))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = labelled(np.random.default_rng(2), 900)
    extra = [(2000, None), (2001, ""), (None, texts[0][1]), (2002, "f00ling gr-um-ble b@rbaric " + texts[1][1]), (2003, texts[1][1]), (0, texts[0][1]), (2004, "!!! ### 😀")]
    docs = spark.createDataFrame([(*x, 9, "s") for x in texts + extra], "doc_id long, text string, score int, toxic string").repartition(4)
    known = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, known).collect()
    assert len(got) == len(texts) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[2002].score > by[2003].score and by[2000].score == by[2001].score and by[None].score == by[0].score and not by[None].held_out


def test_toxicity_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.classify(docs, labels).collect()] == [0.0, 0.0]
    assert toxicity.classify(docs, labels.limit(0)).count() == 2 and toxicity.classify(docs.limit(0), labels).count() == 0


def test_features_do_not_look_across_documents():
    lexicon = toxicity.Lexicon(toxicity._hash_words(["idiot"]), np.array([4.0]))
    texts = ["You IDIOT!!", "id10t###", "", "aaaa you", "idiot", "i.d.i.o.t é É"]
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    whole = toxicity.features(np.frombuffer(b"".join(raw), np.uint8), offs, lexicon)
    alone = [toxicity.features(np.frombuffer(x, np.uint8), np.array([0, len(x)]), lexicon)[0] for x in raw]
    assert np.allclose(whole, alone)
    f = {name: whole[:, i] for i, name in enumerate(toxicity.NAMES)}
    assert f["hits_3"].tolist() == [1, 1, 0, 0, 1, 1] and f["undone_hits"].tolist() == [0, 1, 0, 0, 0, 1]
    assert f["hits_near_second_person"][0] > 0 and f["hits_near_second_person"][4] == 0 and f["capital_hits"][0] == 1 and f["stretched"][3] > 0


def test_isotonic_is_increasing_and_trees_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = toxicity.Trees(trees=40).fit(x[:1000], y[:1000], np.ones(1000))
    m = trees.margin(x[1000:])
    assert np.mean((m > 0) == (y[1000:] == 1)) > 0.9
    at, value = toxicity.isotonic(m, y[1000:], np.ones(1000))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    assert np.isclose(np.interp(m, at, value).mean(), y[1000:].mean(), atol=0.05)


# ---------------------------------------------------------------- earlier operators

def test_packing_ids_of_random_code_points():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    r = np.random.default_rng(4)
    points = np.concatenate([np.arange(32, 0xD800), np.arange(0xE000, 0x11000), np.arange(0x1F300, 0x1F700)])
    texts = ["\U000143da\u9b73", "it's I'LL 'sx  \n\t x"] + ["".join(chr(c) for c in r.choice(points, int(n))) for n in r.integers(1, 12, 4000)]
    raw = [t.encode() for t in texts]
    ids, bounds = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
    for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == encoder.whole.encode(t, add_special_tokens=False).ids


def test_packing_places_by_least_squares_and_completes_levels():
    r = np.random.default_rng(5)
    p = packing.Packer(capacity=16, max_open=10_000)
    for doc in range(400):
        s, before, levels = int(r.integers(1, 16)), p.count.copy(), p.count.copy()
        p.add(doc, np.zeros(s, np.uint32))
        costs = {}
        for h in range(0, 17 - s):
            if h and not levels[h]:
                continue
            after = levels.copy()
            if h:
                after[h] -= 1
            if h + s < 16:
                after[h + s] += 1
            costs[h] = int((after ** 2).sum())
        assert (p.count ** 2).sum() == min(costs.values()), (s, before)
    q = packing.Packer(capacity=16)
    for doc, h in enumerate([10, 10, 10, 6, 6, 8, 8, 8]):
        q.open[h].append([(doc, 0, np.zeros(h, np.uint32), h)])
    q.close()
    windows = collections.defaultdict(list)
    for doc, start, n, *_, sequence, offset in q.take():
        windows[sequence].append((doc, start, n, offset))
    whole = [sorted(n for _, _, n, _ in w) for w in windows.values() if all(start == 0 and n == [10, 10, 10, 6, 6, 8, 8, 8][doc] for doc, start, n, _ in w)]
    assert sorted(w for w in whole if sum(w) == 16) == [[6, 10], [6, 10], [8, 8]]
    assert sorted(sum(n for _, _, n, _ in w) for w in windows.values()) == [2, 16, 16, 16, 16]


def test_exact_dedup_of_any_long_and_any_column_name(spark):
    low = -(1 << 63)
    docs = spark.createDataFrame([(low, "a", 1, "x", 7), (3, "a ", 2, "y", 8), (None, "b", 3, None, 9), (low, "b", 4, "z", 9)],
                                 "doc_id long, text string, _xd_row int, _XD_kept string, _cp_row long")
    got = {(r.doc_id, r.kept): r.keep_id for r in exact_stream.decisions(docs).collect()}
    assert got == {(low, False): 3, (3, True): 3, (None, False): low, (low, True): low}
    kept = exact_stream.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["_cp_row"] for r in kept.collect()) == [8, 9]
    near = corpus_pipeline.simhash_dedup(spark, docs, "")
    assert near.columns == docs.columns and {r["_cp_row"] for r in near.collect()} <= {7, 8, 9}


def test_staged_tables_are_removed(spark):
    from seedrank.functions.params import drop_written

    stage = tables.Staged(spark, "gone")
    df = stage.write(spark.range(3), "t")
    assert df.count() == 3 and drop_written(spark) >= 1
    fs = spark._jvm.org.apache.hadoop.fs.Path(stage.base)
    assert not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)


def test_simhash_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1000)] + [(5000, 7000), (6000, 7000)], "a long, b long")
    stage = tables.Staged(spark, "path")
    rounds = []
    write = stage.write
    stage.write = lambda df, name, *more: (rounds.append(name), write(df, name, *more))[1]
    got = {r.v: r.root for r in simhash.components(edges, stage).collect()}
    assert all(got[i] == 0 for i in range(1001)) and got[7000] == got[6000] == got[5000] == 5000
    assert sum("step" in name for name in rounds) <= 15


def test_simhash_groups_equal_in_one_half_are_dealt_by_the_other():
    r = np.random.default_rng(7)
    fp = (np.uint64(0x12345678) << np.uint64(32)) | r.integers(0, 1 << 32, 30_000, dtype=np.uint64)
    key, i = simhash.variant_keys(fp, 3)
    own = key[63 * len(fp):]  # one key of the upper half, the same for all
    assert len(np.unique(own)) == 1 and (i[63 * len(fp):] == np.arange(len(fp))).all()
    free = simhash.free_bits(own, fp, 3)
    assert (free == np.uint64((1 << 32) - 1)).all()
    second, rows, left = simhash.finer_keys(own, fp, free, 3)
    assert len(second) == 4 * len(fp) and np.unique(second, return_counts=True)[1].max() < 2000
    # pairs at three bits or fewer share a key at every level
    near = fp.copy()
    for row in range(len(near)):
        near[row] ^= np.uint64(sum(1 << int(b) for b in r.choice(32, 3, replace=False)))
    other, rows2, left2 = simhash.finer_keys(own, near, free, 3)
    shared = (second.reshape(4, -1) == other.reshape(4, -1))
    assert shared.any(axis=0).all()
    third, i3, _ = simhash.finer_keys(second, fp[rows], left, 3)
    fourth, i4, _ = simhash.finer_keys(other, near[rows2], left2, 3)
    assert len(np.intersect1d(third, fourth)) > 0
