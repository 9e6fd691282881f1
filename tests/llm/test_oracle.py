"""The registered queries against their DuckDB SQL on small tables with edge cases; the pages here
carry links between hosts, so the propagation is compared too."""

import duckdb
import numpy as np
import pytest

from seedrank.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = np.random.default_rng(5)
    vocab = ["".join(r.choice(list("abcdeé"), 6)) for _ in range(300)]
    make = lambda n: " ".join(r.choice(vocab, n))
    passage, item = make(50), make(30)
    texts = [make(int(n)) for n in r.integers(1, 90, 20)]
    texts += [texts[0], f" {texts[0]}\n", texts[1].replace(" ", "\t"), make(2000)]
    texts += [f"{make(20)} {passage} {make(15)}" for _ in range(5)]
    texts += [f"{make(10)} {item.upper()} {make(5)}", f"{make(1500)} {item}", "x" * 900, "ab " * 300, "日本語 テキスト 😀" * 40]
    texts += [None, None, "", " \n", "only short", "Only SHORT words"]
    d = str(tmp_path_factory.mktemp("oracle"))
    docs = [(i, t, None, None, None) for i, t in enumerate(texts)]
    bench = [(1, item), (2, "only short"), (3, None), (4, ""), (None, make(20)), (2, "only short")]
    link = lambda *hosts: "".join(f"<a href='http://{h}/x'>" for h in hosts)
    pages = [(1, "http://A.example.org/es/1", link("n1.net", "n2.net", "n1.net")), (2, "https://www.example.org/x", link("n3.net")),
             (3, "http://n1.net/a?b", link("bad.com", "n2.net")), (4, "http://n2.net", link("spam.com", "bad.com")), (5, "http://spam.com/de/1", None),
             (6, "http://bad.com/de/", link("n3.net")), (7, "http://bad.com/other", ""), (8, None, None), (9, "no scheme", link("n1.net")),
             (10, "http://n3.net#f", link("n1.net")), (11, "http://example.org/en/10", link("n2.net")), (11, "http://x.com/fr/", link("n2.net"))]
    for name, rows, schema in (("documents", docs, DOCS), ("benchmark", bench, "item_id long, text string"), ("pages", pages, "page_id long, url string, html string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    got = QUERIES[name](spark, folder)
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert got.columns == columns
    plain = lambda rows: sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)
    assert plain(got.collect()) == plain(want.fetchall())
    if name == "op7_url_filter":
        assert got.filter("rule IS NULL AND trust > 0 AND distrust > 0").count() > 0
