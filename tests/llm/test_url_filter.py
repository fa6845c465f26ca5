import numpy as np
import pytest

from tramline.llm import lookup
from tramline.llm import url_filter as uf

PAGES = [
    (1, "http://www.adult-x.example.com/a?b#c"), (2, "https://ok.example.org/"), (3, None), (4, ""), (5, "HTTPS://USER:pw@Free-Bets.example.net:8080/x/"), (6, "https://not-free-bets.example.net/"),
    (7, "https://ok.example.org/bad/page/?q=1"), (None, "http://blog.casino-win.example.net"), (2, "https://ok.example.org/"), (8, "not a url"), (9, "https://free-bets.example.net.evil.org/"), (10, "http://a.b.c.d.e.f.g.spam-farm.example.org/" + "x" * 50_000),
]
LISTED = [*uf.LISTED, "ok.example.org/bad/page"]
WANT = {1: True, 2: False, 3: False, 4: False, 5: True, 6: False, 7: True, None: True, 8: False, 9: False, 10: True}


def keys(rng, n):
    return np.unique(rng.integers(0, 2**63, (n, 2), dtype=np.int64), axis=0).view(np.uint64)


@pytest.mark.parametrize("n, m", [(0, 10), (1, 0), (50, 5000), (3000, 100)])
def test_cascade_is_exact_over_its_universe(n, m):
    k = keys(np.random.default_rng(n), n + m)
    made = uf.Cascade.load(uf.Cascade.build(k[:n], k[n:]).dump())
    assert (made.listed(k) == (np.arange(n + m) < n)).all()


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_pages(spark, most, clash):
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    listed = spark.createDataFrame([(k,) for k in LISTED], "__key string")
    got = uf.url_filter(pages, listed, per_shard=7, most_broadcast=most).collect()
    assert len(got) == len(PAGES)
    assert {r["page_id"]: r["listed"] for r in got} == WANT
    assert sorted(map(repr, uf.url_filter(clash(pages), listed).collect())) == sorted(map(repr, got))


def test_a_hot_key_is_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(lookup.sharded, "__defaults__", (lookup.BROADCAST_BYTES, 40))
    pages = spark.createDataFrame([(i, f"http://{'hot' if i % 3 else f'h{i}'}.{'ads-track' if i % 2 else 'ok'}.example.com/{i % 7}") for i in range(600)], "page_id long, url string").repartition(5)
    got = {r["page_id"]: r["listed"] for r in uf.url_filter(pages, per_shard=100, most_broadcast=0).collect()}
    assert got == {i: bool(i % 2) for i in range(600)}


def test_nothing_listed_and_no_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    none = spark.createDataFrame([], "__key string")
    assert not any(r["listed"] for r in uf.url_filter(pages, none).collect())
    assert uf.url_filter(pages.filter("false")).count() == 0


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_hosts_of_any_depth(spark, most):
    hosts = {1: ".".join("abcdef") + ".spam-farm.example.org", 2: ".".join("abcdef") + ".bad.org", 3: "x." * 3_000 + "spam-farm.example.org", 4: "x." * 3_000 + "example.org", 5: "org", 6: "spam-farm.example.org"}
    pages = spark.createDataFrame([(k, f"http://{h}/p") for k, h in hosts.items()], "page_id long, url string")
    listed = spark.createDataFrame([(k,) for k in [*uf.LISTED, "bad.org", "org"]], "__key string")
    got = {r["page_id"]: r["listed"] for r in uf.url_filter(pages, listed, per_shard=1000, most_broadcast=most).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: True, 6: True}
