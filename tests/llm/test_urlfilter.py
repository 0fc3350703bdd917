import re

from millrace.llm import urlfilter
from millrace.llm.queries import QUERIES
from tests.llm.helpers import FOLDER

ODD_URLS = [None, "", "no scheme", "http://", "://", "HTTP://A.Org", "http://a.org/", "http://xorg/", "http://org/x", "a://b://c.org/", "http://Example.org?x#/en/1",
            "http://m.example.org/en/1?q", "http://example.org/en/2", "http://example.org:80/es/", "http://É.COM/de/x\n/y", "x" * 50_000 + "://a.com/fr/" + "y" * 50_000]


def brute(url):
    """(host, path, rule, verdict of the rule)."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in urlfilter.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def check(rows, urls):
    for r in rows:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] == ("block" if r["p_block"] >= 0.5 else "allow")
        assert (r["p_block"] is None) == (verdict is not None)


def test_query_on_all_pages(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op7_url_filter"](spark, FOLDER).collect()
    assert len(rows) == len(urls)
    check(rows, urls)


def test_the_classifier_learns_the_rules_on_urls_it_has_not_seen(spark):
    rows = QUERIES["op7_url_filter"](spark, "/root/testdata/sf0.1").where("rule is not null").collect()
    kept, new = rows[::2], rows[1::2]
    model = urlfilter.fitted([r["host"] for r in kept], [r["path"] for r in kept], __import__("numpy").array([r["verdict"] == "block" for r in kept]))
    p = model.block([r["host"] for r in new], [r["path"] for r in new])
    assert sum((x >= 0.5) == (r["verdict"] == "block") for x, r in zip(p, new, strict=True)) >= 0.95 * len(new)


def test_odd_urls_clashing_names_and_empty_tables(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(ODD_URLS)] * 2, "page_id long, url string").selectExpr("*", "'x' AS host", "'x' AS Verdict", "1 AS p_block", "'kept' AS more")
    rows = urlfilter.judge(pages).collect()
    assert len(rows) == 2 * len(ODD_URLS) and all(r["more"] == "kept" for r in rows)
    check(rows, dict(enumerate(ODD_URLS)))
    assert urlfilter.judge(pages.limit(0)).count() == 0
    plain = spark.createDataFrame([(1, "http://x.net/a")], "page_id long, url string")
    assert urlfilter.judge(plain).first()["verdict"] == "allow"
    given = spark.createDataFrame([("http://bad.net/x", "block"), ("http://bad.net/y", "block"), (None, "other")], "url string, verdict string")
    assert urlfilter.judge(plain, labelled=given).first()["verdict"] == "block"
