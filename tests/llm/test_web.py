"""URL filter and archives: SQL oracles, plain-Python rules, round trips."""

import random

import duckdb
import pytest
from conftest import SF_SMALL
from oracle_check import _canon, duck

from starmart.llm import queries, url_filter, warc


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    a = _canon(queries.QUERIES[name](spark, SF_SMALL).toPandas())
    b = _canon(duck(SF_SMALL).sql(queries.ORACLES[name]).df())
    assert list(a.columns) == list(b.columns) and a.astype(str).equals(b.astype(str))


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:] if rest[n : n + 1] == "/" else ""
        path = path.split("?")[0].split("#")[0]
    fits = [r for r in url_filter.SITE_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.action


def urls():
    rng = random.Random(8)
    hosts = ["example.com", "www.example.com", "a.www.example.com", "EXAMPLE.com", "notexample.com", "x.net", "net", "com", "x.net:80", "ü.net", "", "a\tb.com", "xcom", "com.org"]
    paths = ["", "/", "/en/", "/en", "/EN/", "/es/1", "/fr/x?y=/es/", "/en/..", "/\t/en/", "/x.com/\t/en/", "\n/en/"]
    ends = ["", "?q=1", "#f", "?a://b/en/"]
    out = [s + h + p + e for h in hosts for p in paths for e in ends for s in [rng.choice(["http://", "https://", "HTTP://", "://", "//", "http:/"])]]
    return out + [None, "", "://", "mailto:x@y.com", out[0], out[0]]


def test_rules(spark):
    rows = [(k if k % 50 else None, u, "r", 1.0) for k, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, tokens double")
    out = url_filter.judge(spark, pages).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, action = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        if rule:
            assert r.verdict == action
    assert {r.verdict for r in out} == {"allow", "block"}
    assert url_filter.judge(spark, pages.limit(0)).count() == 0


def test_pattern_rules(spark):
    rules = (url_filter.Rule("block", "shop.org", "/*/sale^"), url_filter.Rule("allow", "shop.org", "/eu/sale/ok"), url_filter.Rule("block", "", "/ads/"))
    cases = {"http://shop.org/us/sale": "block", "http://shop.org/us/sales": "allow", "http://a.shop.org/x/y/sale/1": "block", "http://shop.org/eu/sale/ok": "allow", "http://q.com/ads/1": "block", "http://q.com/badads/1": "allow"}
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    got = {r.url: r.verdict for r in url_filter.judge(spark, pages, rules=rules, own=()).collect()}
    assert got == cases


def test_wildcard_hosts_are_indexed_by_their_rarest_run(spark):
    own = url_filter.OWN_RULES
    hosts = [f"site{k}.org" for k in range(40)] + ["www.casinos.org", "x-casino.net", "cas.ino.org", "spam-farm.example", "cheapxpills.org", "bets", "a", "free-bets.io"]
    pages = spark.createDataFrame([(k, f"http://{h}/") for k, h in enumerate(hosts)], "page_id long, url string")
    want = {f"http://{h}/": any(x in h for x in ("casino", "spam-farm", "cheap-pills", "free-bets", "adult-x", "ads-track")) for h in hosts}
    got = {r.url: r.verdict == "block" for r in url_filter.judge(spark, pages, rules=(), own=own).collect()}
    assert got == want
    urls = pages.selectExpr("url", "substring(url, 8, length(url) - 8) AS host", "'/' AS path").withColumn("tokens", url_filter.tokens_of(grams=True))
    index = url_filter.index_rules(spark, own, urls)
    assert {r.token[:2] for r in index.collect()} == {"g:", "p:"}
    pairs = urls.selectExpr("url", "explode(tokens) AS token").join(index, "token").count()
    assert pairs <= 8  # of 48 URLs and 8 rules; all rules under the common token made 6 x 48


def test_records_refer_to_records_that_exist(spark, monkeypatch):
    """The pages come in another order at each reading."""
    monkeypatch.setattr(warc, "RECORDS", 2)
    from pyspark.sql import functions as F

    df = spark.range(60).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "concat('copy ', id % 7) AS html")
    path = warc.convert(spark, df.repartition(5).orderBy(F.rand()))
    text = spark.read.option("wholetext", True).text(path)
    ids = text.selectExpr("explode(regexp_extract_all(value, 'WARC-Record-ID: <([^>]*)>', 1)) AS id")
    refs = text.selectExpr("explode(regexp_extract_all(value, 'WARC-Refers-To: <([^>]*)>', 1)) AS id")
    assert ids.distinct().count() == 60 and refs.count() == 53
    assert refs.join(ids, "id", "left_anti").count() == 0


def test_native_plan(spark):
    plan = queries.op2_url_filter(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def pages(spark):
    same = "<p>same ü</p>\r\n\r\nWARC/1.0\r\n"
    rows = [(5, "http://a", same), (3, "http://b c\n", same), (9, None, same), (None, "u", same), (7, "http://e", None), (8, "http://e", ""), (1, "http://l", "x" * 300_000), (2, "", "own"), (2, "", "own"), (None, "n", "only null"), (4, "http://z", "own")]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string"), rows


def test_warc_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 2)
    df, rows = pages(spark)
    path = warc.convert(spark, df.repartition(3))
    got = warc.read_warc(spark, path).collect()
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"}))
    want = con.sql(warc.ORACLE).fetchall()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r[n] for n in names) for r in got), key=key) == sorted(want, key=key)
    assert {r.page_id: (r.record_type, r.refers_to) for r in got}[9] == ("revisit", 3)
    assert warc.report(spark, df.limit(0)).count() == 0


def test_smaller_payloads_are_all_responses(spark):
    df, _ = pages(spark)
    path = warc.convert(spark, df, least_bytes=10)
    assert {(r.page_id, r.record_type) for r in warc.read_warc(spark, path).collect() if r.payload_bytes < 10} == {(7, "response"), (8, "response"), (2, "response"), (4, "response"), (None, "response")}


def test_arc_versions():
    for version in (1, 2):
        name = "a.arc"
        head = warc.arc_version_block(version, name) + b"\n"
        one = warc.arc_record(version, name, len(head), "http://x/y z", warc.http_block(4, "é\n\n".encode()))
        two = warc.arc_record(version, name, 0, None, b"")
        got = list(warc.parse_arc(head + one + two))
        assert [g[0] for g in got] == [len(head), len(head + one)]
        assert got[0][1]["url"] == "http://x/y%20z" and got[0][1]["type"] == "text/html" and got[1][1]["url"] == "-"
        assert warc._http(got[0][2])[1] == "é\n\n".encode() and got[1][2] == b""
    with pytest.raises(ValueError):
        list(warc.parse_arc(head + one[:-5]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(head.replace(b"\n2 0", b"\n3 0") + one))
