from __future__ import annotations

import zlib
from itertools import combinations

from helpers import SMALL
from pyspark.sql import functions as F

from tidemark.llm import urls
from tidemark.llm.queries import URL_RULES, op6_urls

ODD = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "https://example.com", "https://example.com?/en/",
    "x://a.net/es/1#/fr/", "ftp://net/fr/", "http://notexample.com/en/", "http://example.com/EN/", "a://b://c/d", "http://ü.com/ö",
    "http://a.example.com/en/\nx", "http://www.example.com/en/", "http://com/", "http://dot.com",
]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_given_rules(spark):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*ODD, ODD[4]])], "page_id bigint, url string, host string")
    labels = spark.createDataFrame([(None, 0)], "doc_id bigint, quality int")
    got = {r["page_id"]: r for r in urls.filter_urls(pages, labels, URL_RULES).collect()}
    assert len(got) == len(ODD) + 1
    for k, url in enumerate([*ODD, ODD[4]]):
        host, path, rule, verdict = plain(url)
        assert tuple(got[k])[1:4] == (host, path, rule)
        assert got[k]["verdict"] == (verdict or "allow") and got[k]["mined"] is None
    assert urls.filter_urls(pages.limit(0), labels, URL_RULES).collect() == []


def test_smallest_table(spark):
    got = op6_urls(spark, SMALL).collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = plain(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or rule is None


def made():
    for k in range(400):
        spam = k % 5 == 0
        yield k, f"http://{'pills' if spam else 'news'}.site{k % 7}.org/{'buy' if k % 2 else 'read'}/{k}", int(not (spam and k % 2))


def test_mined_rules_equal_counting(spark):
    rows = list(made())
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows] + [(3, 1), (None, 0), (9999, 0)], "doc_id bigint, quality int")
    got = {r["page_id"]: r for r in urls.filter_urls(pages, labels, [], confidence=0.8).collect()}
    bad = {k for k, _, q in rows if q == 0}
    assert {k for k, r in got.items() if r["verdict"] == "block"} == bad
    assert {got[k]["mined"] for k in bad} == {"host:pills & path:buy"}

    sets = [
        (frozenset(r["t"]), r["url"])
        for r in pages.select("url", urls.tokens(F.col("url")).alias("t")).collect()
    ]
    quality = {u: q for _, u, q in rows}
    found = {}
    for size in (1, 2, 3):
        for items in {c for s, _ in sets for c in combinations(sorted(s), size)}:
            held = [quality[u] for s, u in sets if s >= set(items)]
            blocked = held.count(0)
            if blocked >= 20 and blocked / len(held) >= 0.8:
                found[items] = blocked / len(held)
    labelled = pages.join(labels.withColumnRenamed("doc_id", "page_id"), "page_id").dropDuplicates(["page_id"]).select(
        urls.tokens(F.col("url")).alias("items"), (F.col("quality") == 0).alias("bad")
    )
    mined = [r for r in urls.mine(labelled, confidence=0.8)[0].collect() if r["verdict"] == "block"]
    assert {tuple(r["items"]) for r in mined} == {
        i for i in found if not any(set(j) < set(i) and found[j] >= found[i] - urls.MARGIN for j in found)
    }


def test_many_equal_query_names(spark):
    """Forty names that always occur together are one item, so there are no 2 ** 40 item sets."""
    names = "&".join(f"q{chr(97 + k // 26)}{chr(97 + k % 26)}=1" for k in range(40))
    rows = [(k, f"http://site.org/{k}" + (f"?{names}" if k % 6 == 0 else ""), int(k % 6 != 0)) for k in range(360)]
    rows.append((900, "http://else.org/x?qab=3", None))  # one of the tokens is enough
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows], "doc_id bigint, quality int")
    got = {r["page_id"]: r for r in urls.filter_urls(pages, labels, []).collect()}
    assert {k for k, r in got.items() if r["verdict"] == "block"} == {k for k, _, q in rows if q == 0} | {900}
    assert {r["mined"] for r in got.values() if r["verdict"] == "block"} == {"query:qaa"}


def test_rare_label_on_pages_kept_out(spark):
    """Bad pages are a seventh, and no host is bad for sure; labels of a fifth of the pages are not given."""
    rows = []
    for k in range(3000):
        draw = zlib.crc32(f"draw {k}".encode()) / 2**32
        spam = k % 9 == 0
        bad = draw < (0.55 if spam else 0.1)
        host = "pills" if spam else ("news", "blog", "shop")[k % 3]
        rows.append((k, f"https://{host}.site{k % 7}.org/{'ab'[k % 2]}/{k}", int(not bad)))
    kept_out = [r for r in rows if r[0] % 5 == 3]
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows if k % 5 != 3], "doc_id bigint, quality int")
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, labels, []).collect()}
    assert all((got[k] == "block") == ("pills" in u) for k, u, _ in kept_out)
    # labels that have nothing to do with the urls give no rule to block by
    noise = spark.createDataFrame([(k, int(zlib.crc32(f"n {k}".encode()) % 7 != 0)) for k, _, _ in rows], "doc_id bigint, quality int")
    assert {r["verdict"] for r in urls.filter_urls(pages, noise, []).collect()} == {"allow"}
