"""Rules and features against plain Python, the trees on held-out urls."""

import math
import random
import re
from collections import Counter

from conftest import SF_MID
from pyspark.sql import functions as F

from scorecast.llm import urltrees

SCHEMA = "page_id long, url string"
LOWER = str.maketrans(urltrees.UPPER, urltrees.LOWER)


def plain(url):
    """Host, path, rule and verdict of the rule."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate(LOWER)
    fits = [r for r in urltrees.RULES
            if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://anet/", "http://x.example.net/en/", "http://example.net/en",
        "http://example.net/EN/", "http://myexample.net/en/1", "https://a.b.example.com/de/10?x=1#y", "http://example.com/de", "ftp://org/fr/", "http://x.org/fr/2",
        "http://x.org?/fr/", "http://x.org#/fr/", "a://b://c.net/", "://y.net/", "http://user@z.net:80/", "http://z.net:80/", "http://ÄÖ.net/ü", "http://x.org/fr/\nnet/",
        "http://.net/", "http://%.org/fr/", "http://x.org//fr/", "x" * 50_000, "http://h.org/" + "ab/" * 20_000 + "?" + "k=v&" * 5_000]


def pages(spark, urls, clashing=False):
    df = spark.createDataFrame(list(enumerate(urls)), SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in ("host", "path", "rule", "label", "score", "features", "weight", "tld", "fold")]) if clashing else df


def test_rules(spark):
    urls = URLS * 2
    got = {r["page_id"]: r for r in urltrees.judged(pages(spark, urls, clashing=True)).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule = plain(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == (urltrees.RULES[rule] if rule else got[i]["model_verdict"])


def test_longest_rule_wins(spark):
    rules = {"org/": "block", "a.org/": "allow", "a.org/x/": "block", "b.org/x": "allow"}
    df = spark.createDataFrame([("a.org", "/y"), ("z.a.org", "/x/1"), ("b.org", "/xyz"), ("c.org", ""), ("com", "/")], "host string, path string")
    assert [r[0] for r in df.select(urltrees.rule_of(F.col("host"), F.col("path"), rules)).collect()] == ["a.org/", "a.org/x/", "b.org/x", None, None]


def test_features(spark):
    urls = ["https://a-b1.example.com/x/yy/z.html?p=1&q=22#f", "http://é/9", ""]
    rows, names, _ = urltrees.features(pages(spark, urls))
    got = {r["page_id"]: r for r in rows.collect()}
    for i, url in enumerate(urls):
        host, path, _ = plain(url)
        n, query = max(len(url), 1), re.search(r"\?([^#]*)", url)
        assert got[i]["url_length"] == len(url) and got[i]["depth"] == len([p for p in path.split("/") if p]) and got[i]["hyphens"] == host.count("-")
        assert got[i]["digit_share"] == sum(c in "0123456789" for c in url) / n
        assert math.isclose(got[i]["entropy"], -sum(k / n * math.log2(k / n) for k in Counter(url).values()), abs_tol=1e-9)
        assert got[i]["parameters"] == (len([p for p in query.group(1).split("&") if p]) if query else 0)


def test_suffix_rates(spark):
    """Counts of the other folds for a labelled url and of all for the rest; no url sees its own label."""
    r = random.Random(3)
    urls = [f"http://h{r.randint(0, 40)}.{r.choice(['example.net', 'example.com', 'org', 'net'])}/{r.choice(['en', 'de', 'fr'])}/{i}{r.choice(['', '.html'])}"
            for i in range(600)]
    rows, _, (labelled, blocked) = urltrees.features(pages(spark, urls))
    got = rows.collect()
    known = [x for x in got if x["label"] is not None]
    assert (labelled, blocked) == (len(known), sum(x["label"] for x in known)) and 0 < blocked < labelled

    def fold(x):
        import zlib

        return zlib.crc32(x["url"].encode()) % urltrees.FOLDS

    for x in got:
        same = [y for y in known if y["host"].split(".")[-1] == x["host"].split(".")[-1] and (x["label"] is None or fold(y) != fold(x))]
        want = (sum(y["label"] for y in same) + urltrees.PRIOR * blocked / labelled) / (len(same) + urltrees.PRIOR)
        assert math.isclose(x["rate_tld"], want)


def test_rare_suffixes(spark, monkeypatch):
    """Suffixes below the broadcast bound are joined, with the same rates."""
    urls = [f"http://h{i % 50}.{'net' if i % 3 else 'org'}/fr/{i}" for i in range(300)]

    def rates():
        return sorted((r["page_id"], r["rate_tld"], r["rate_domain"], r["rate_directory"], r["rate_extension"]) for r in urltrees.features(pages(spark, urls))[0].collect())

    want = rates()
    monkeypatch.setattr(urltrees, "FREQUENT", 1)
    assert rates() == want


def test_held_out_urls(spark):
    """Labelled hosts that take no part in training are judged as their rule does."""
    df = spark.read.parquet(f"{SF_MID}/pages.parquet").select("page_id", "url")
    train = F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(4)) != 2
    out = urltrees.judged(df, training=train).where(F.col("rule").isNotNull()).where(~train).collect()
    right = [r["verdict"] == r["model_verdict"] for r in out]
    assert len(right) > 20 and sum(right) / len(right) > 0.8, (len(right), sum(right))


def test_one_kind_of_label_and_none(spark):
    assert {r["verdict"] for r in urltrees.judged(pages(spark, ["http://a.net/", "http://b.com/"])).collect()} == {"block"}
    assert {r["verdict"] for r in urltrees.judged(pages(spark, ["http://a.de/", None])).collect()} == {"allow"}


def test_empty_table(spark):
    assert urltrees.judged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_workers(spark):
    plan = urltrees.judged(pages(spark, URLS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
