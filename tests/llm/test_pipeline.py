"""The pipeline on the smallest tables, stage by stage, against brute force."""

import collections
import re

import corpus_pipeline as C
from seedrank.llm.tables import read
from tests.llm.test_operators import fingerprint, lower

D = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = read(spark, D, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    bench = [r.text for r in read(spark, D, "benchmark").collect()]
    left = []
    for name, fn in C.STAGES:
        fn(spark, docs, D).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "pack":
            assert docs.columns == read(spark, D, "documents").columns
    assert left[0] == {i for i, t in rows.items() if re.search(r"[^\W\d_]", t or "")}
    groups = collections.defaultdict(list)
    for i in left[0]:
        groups[re.sub(r"[\x20\x09-\x0D]", "", rows[i] or "")].append((-len(rows[i] or ""), i))
    assert left[1] == {min(g)[1] for g in groups.values()}
    fp = {i: fingerprint(rows[i]) for i in sorted(left[1])}
    label = {i: i for i in fp}
    while True:
        new = {i: min(label[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 3) for i in fp}
        if new == label:
            break
        label = new
    assert left[2] == {i for i in fp if label[i] == i}
    alnum = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {tuple(w[a:a + 13]) for w in map(alnum, bench) if w for a in range(max(1, len(w) - 12))}
    clean = set()
    for i in left[2]:
        w = alnum(rows[i])
        hit = {p for n in {len(k) for k in windows} for a in range(len(w) - n + 1) if tuple(w[a:a + n]) in windows for p in range(a, a + n)}
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert left[3] == left[4] == clean


def test_near_and_contaminated_rows_go_by_row(spark, tmp_path):
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    near = words("near", 60)
    docs = spark.createDataFrame([
        (1, near), (None, near.upper()),  # a null id near an id: only that row goes
        (None, words("alone", 40)), (None, words("other", 40)),
        (7, words("twin", 60)), (7, words("twin", 60).upper()),  # near rows that share an id: one stays
        (7, words("seven", 40)), (1, words("one", 40)),  # unrelated rows with those ids stay
        (None, words("left", 5) + " " + words("leak", 20)), (9, words("nine", 30) + " " + words("leak", 20)), (9, words("clean", 40)),
    ], "doc_id long, text string").repartition(3)
    d = str(tmp_path)
    spark.createDataFrame([("q", words("leak", 20))], "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    kept = C.simhash_dedup(spark, docs, d)
    kept.write.parquet(f"{d}/kept")
    kept = spark.read.parquet(f"{d}/kept")
    got = collections.Counter((r.doc_id, r.text.split()[0][:-1].lower()) for r in kept.collect())
    want = [(1, "near"), (None, "alone"), (None, "other"), (7, "twin"), (7, "seven"), (1, "one"), (None, "left"), (9, "nine"), (9, "clean")]
    assert got == collections.Counter(want)
    clean = C.decontaminate(spark, kept, d)
    assert clean.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text.split()[0][:-1].lower()) for r in clean.collect()) == collections.Counter(
        [w for w in want if w not in ((None, "left"), (9, "nine"))])
