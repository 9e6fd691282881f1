"""Each operator against a brute-force version on a small fixture with nulls, empty and long texts,
ties, repeated rows, extra columns, and empty tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seedrank.llm import decontam, exact_stream, langid, lm_score, packing, quality, simhash, substring, suffix_dedup, tables, url_filter

SCHEMA = "doc_id long, text string, lang string, spans string, score int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def word(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(3)
    vocab = ["".join(r.choice(list("abcdeé"), 5)) for _ in range(400)]
    make = lambda n: " ".join(r.choice(vocab, n))
    passage, line = make(60), make(9)
    texts = [make(int(n)) for n in r.integers(1, 120, 40)]
    texts += [texts[0], texts[0] + "  ", texts[1].replace(" ", "\n"), texts[2], make(3000)]
    texts += [f"{make(30)} {passage} {make(20)}" for _ in range(8)]
    texts += [f"{make(20)}\n{line}\n{make(25)}" for _ in range(8)]
    near = make(90).split()
    for i in range(6):
        w = list(near)
        w[i * 7] = "zz"
        texts.append(" ".join(w))
    texts += [None, "", " \n\t", "Hello, WORLD! don't 'll  x\n\ny", "ab " * 200, "z" * 700, "日本語 テキスト 😀", "<|endoftext|> a"]
    out = [(i, t, "en" if i % 2 else None, "x", 1) for i, t in enumerate(texts)]
    return out + [(None, texts[3], None, None, None), (5, texts[5], "en", "x", 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    tables.ship(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def suffix_want(rows, n=200):
    raw = [(t or "").encode() for _, t, *_ in rows]
    count = collections.Counter(b[i:i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for (doc, *_), b in zip(rows, raw):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if count[b[i:i + n]] > 1:
                gone[i:i + n] = True
        starts = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), len(b) - len(kept), starts, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2000, 2, 0])
def test_suffix(docs, rows, hot):
    same(suffix_dedup.digests(docs, hot=hot).collect(), suffix_want(rows))


def test_multikey_sort_is_exact():
    data = np.frombuffer(b"abcdefghijabcdefghixabcdefghij", np.uint8)
    token = suffix_dedup.tokens_at(data)
    g = suffix_dedup.multikey(np.zeros(3, np.int64), token, np.array([0, 10, 20]), np.array([10, 10, 10]))
    assert g[0] == g[2] != g[1]


def test_substring(docs, rows):
    words = [word(t) for _, t, *_ in rows]
    count = collections.Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for (doc, *_), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        want.append((doc, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    same(substring.digests(docs).collect(), want)


def fingerprint(t):
    w = word(lower(t))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("group", [20_000, 1])
def test_simhash(docs, rows, group):
    fp = [fingerprint(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (fp[i] ^ fp[j]).bit_count() <= 3) for i in range(len(rows))]
    least = {}
    for (doc, *_), g in zip(rows, label):
        least[g] = min(least.get(g, 10**9), doc if doc is not None else 10**9)
    same(simhash.near_duplicates(docs, group=group).collect(), [(r[0], f"{f:016x}", least[g]) for r, f, g in zip(rows, fp, label)])


@pytest.mark.parametrize("weak", [False, True])
def test_exact(docs, rows, weak):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for doc, t, *_ in rows:
        groups[norm(t)].append((-len(t or ""), doc is None, doc or 0))
    how = {"digest": lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1).substr(1, 1).cast("string")), "batch_bytes": 2000} if weak else {}
    if weak:
        how["digest"] = lambda c: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(c, 256), 1, 1)))
    got = exact_stream.decisions(docs, **how).collect()
    assert sum(r.kept for r in got) == len(groups)
    for r in got:
        assert r.group_size >= 1 and (not r.kept or r.doc_id == r.keep_id)
    want = [(d, min(groups[norm(t)])[2], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for d, t, *_ in rows]
    same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], want)


def test_decontamination(spark, docs, rows):
    alnum = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    items = [(1, rows[46][1]), (10, " ".join(alnum(rows[50][1])[:20])), (2, "hello world"), (3, None), (4, "..."), (None, rows[7][1]), (5, rows[9][1]), (5, rows[9][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = alnum(t)
        for a in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[a:a + 13])].update([] if i is None else [str(i)])
    want = []
    for doc, t, *_ in rows:
        w, hit, found = alnum(t), set(), set()
        for k, ids in windows.items():
            for a in range(len(w) - len(k) + 1):
                if tuple(w[a:a + len(k)]) == k:
                    hit.update(range(a, a + len(k)))
                    found |= ids
        want.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    same(decontam.contamination(docs, bench).collect(), want)
    same(decontam.contamination(docs, bench, block_words=40).collect(), want)
    assert not any(r.contaminated for r in decontam.contamination(docs, bench.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c"), (2, "a b c"), (3, "c b a q r s")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    got = {r.doc_id: (len(r.spans[0]), len(r.near[0])) for r in decontam.search(docs, bench, slack=1).collect()}
    assert got[1] == (0, 8) and got[2][0] == 8 and got[3][0] == 0


def test_packing(docs, rows):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, path, capacity=64).collect()
    ids = collections.defaultdict(list)
    for doc, t, *_ in rows:
        ids[doc].append(tok.encode(t or "", add_special_tokens=False).ids + [0])
    fill = collections.defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
        assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
    assert sum(r.length for r in got) == sum(len(x) for v in ids.values() for x in v)
    for v in fill.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 64 and (at == 64 or at & (at - 1) == 0)


def test_url_rules_and_propagation(spark):
    pages = spark.createDataFrame([
        (1, "https://A.org/x", '<a href="https://good.net/1">'), (2, "https://b.com/de/1", None), (3, "http://spam.net", '<a href="//b.com/fr/2">'),
        (4, "http://good.net?x#y", ""), (5, None, None), (6, "nothing", "x"), (7, "https://example.org/en/17?q", None), (8, "https://example.org/es", None), (9, "https://sub.b.com/fr/2", None)],
        "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == {1: ("a.org", "/x", "org/", "allow"), 2: ("b.com", "/de/1", "com/de/", "block"), 3: ("spam.net", "", None, "block"),
                   4: ("good.net", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
                   7: ("example.org", "/en/17", "example.org/en/1", "block"), 8: ("example.org", "/es", "org/", "allow"), 9: ("sub.b.com", "/fr/2", "com/fr/", "allow")}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_lm_score_counts(docs, rows):
    labels = docs.sparkSession.createDataFrame([(i, i % 3 and 1, 0) for i in range(40)] + [(None, 1, 0), (50, None, None)], "doc_id long, quality int, toxic int")
    good = {i for i in range(40) if i % 3}
    grams = []
    for doc, t, *_ in rows:
        w, g = word(lower(t)), collections.Counter()
        for p, x in zip(["\0", *w], w):
            g[(p,)] += 1
            g[(p, x)] += 1
        grams.append((doc, len(w), g))
    background, target = collections.Counter(), collections.Counter()
    for doc, _, g in grams:
        background.update(g)
        if doc in good:
            target.update(g)
    size = lambda keep: sum(len((t or "").encode()) for d, t, *_ in rows if keep(d))
    ratio = size(lambda d: d in good) / size(lambda d: True)
    want = []
    for doc, n, g in grams:
        s = 0.0
        for k, f in g.items():
            add = lm_score.ALPHA * (1 if len(k) == 2 else lm_score.VOCABULARY)
            r = np.log(target[k] - f * (doc in good) + add) - np.log((background[k] - f) * ratio + add)
            s += f * (-r if len(k) == 2 else r)
        want.append((doc is None, doc or 0, n, s / max(n, 1)))
    for heavy in (8, 0):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in lm_score.score(docs, labels, heavy=heavy).collect())
        assert [x[:3] for x in got] == [x[:3] for x in sorted(want)]
        assert np.allclose([x[3] for x in got], [x[3] for x in sorted(want)], atol=1e-5)


def test_language_id(spark):
    r = np.random.default_rng(0)
    words = {"aa": ["the", "thing", "ation", "when"], "bb": ["ñe", "ción", "que", "los"]}
    rows = [(i, " ".join(r.choice(words[lang], 60)), lang) for i, lang in enumerate(["aa", "bb"] * 60)] + [(500, None, "aa"), (501, "123 !!", "bb"), (None, "the thing", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.identify(docs).collect()}
    held = [i for i, _, lang in rows[:120] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i in held) and all(got[i].lang_pred == rows[i][2] for i in held)
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[500].score == 0 and all(0 <= x.score <= 1 for x in got.values())
    assert {x.lang_pred for x in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality(spark):
    r = np.random.default_rng(1)
    kind = [([], 1, 0), (["moron"], 1, 1), (["in%%%", "of$$$", "|"], 0, 0)]
    vocab = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join([*r.choice(vocab, 40), *kind[i % 3][0]])) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, None), (None, "w1")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, *kind[i % 3][1:]) for i in range(200)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality.classify(docs, labels).collect()}
    test = range(200, 300)
    assert np.mean([got[i].keep == (i % 3 == 0) for i in test]) > 0.95
    assert np.mean([got[i].expected_grade for i in test if i % 3 == 0]) > np.mean([got[i].expected_grade for i in test if i % 3 == 1]) > np.mean([got[i].expected_grade for i in test if i % 3 == 2])
    assert not any(x.keep for x in quality.classify(docs, labels.limit(0)).collect())


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (suffix_dedup.digests(empty), substring.digests(empty), simhash.near_duplicates(empty), exact_stream.decisions(empty),
                langid.identify(empty), lm_score.score(empty, labels), quality.classify(empty, labels)):
        assert out.count() == 0
