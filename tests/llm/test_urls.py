import random

import numpy as np
import pytest

from msgmart.llm import urls
from msgmart.llm.scratch import Scratch

RULES = [("org", "/", "allow"), ("Example.ORG", "/es/", "block"), ("a.example.org", "/es/x", "allow"), ("com", "", "block"), ("b.com", "", "allow"), ("über.de", "/ä", "block"), ("twice.net", "/", "allow"), ("twice.net", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("null.net", None, "block")]


def plain(url, rules, otherwise="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, otherwise)))


def clean(rules):
    return [(h.lower(), p or "", v) for h, p, v in rules if h]


URLS = [None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://x.org/es/1", "http://example.org/es/1", "http://a.example.org/es/x?/y", "http://b.a.example.org/es/xyz#?", "http://norg/", "http://.com", "http://com", "http://B.COM?x", "http://a.b.com/z", "http://über.de/ä1", "http://ÜBER.de/ä1", "http://twice.net/1", "http://null.net", "a://b://c/d", "http://u:p@x.org:80/", "http://" + "a." * 50_000 + "com/" + "x/" * 50_000, "http://x.org/\n/y"]


@pytest.mark.parametrize("mapped", [urls.MAPPED, 0])
def test_odd_urls(spark, monkeypatch, mapped):
    """Mapped and joined forms give what a plain version gives; clashing columns are not read."""
    monkeypatch.setattr(urls, "MAPPED", mapped)
    scratch = Scratch(spark, "test")
    index = urls.build(spark.createDataFrame(RULES, "host string, path string, verdict string"), scratch)
    pages = spark.createDataFrame([*enumerate(URLS), (1, "")], "page_id long, url string").selectExpr("page_id", "url", "'x' AS host", "1 AS row", "2 AS verdict", "3 AS kept0")
    got = urls.judge(pages, index, scratch, ["page_id", "host"])
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted([(i, *plain(u, clean(RULES))) for i, u in enumerate(URLS)] + [(1, *plain("", clean(RULES)))], key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("mapped", [urls.MAPPED, 0])
def test_random_rules_in_many_shards(spark, monkeypatch, mapped):
    monkeypatch.setattr(urls, "MAPPED", mapped)
    monkeypatch.setattr(urls, "SHARD", 20)
    rng = random.Random(1)
    host = lambda: ".".join(rng.choices(["a", "b", "c", "ab"], k=rng.randint(1, 4)))
    path = lambda: "".join("/" + x for x in rng.choices(["a", "b", "ab"], k=rng.randint(0, 3)))
    rules = list({(h, p): (h, p, rng.choice(urls.VERDICTS)) for h, p in ((host(), path()) for _ in range(300))}.values())
    # a third of the URLs has one host
    links = [(i, f"http://{host() if i % 3 else 'hot.a.b'}{path()}?q") for i in range(900)]
    scratch = Scratch(spark, "test")
    index = urls.build(spark.createDataFrame(rules, "host string, path string, verdict string"), scratch)
    assert index.bits > 2 if mapped else index.files == ()
    got = urls.judge(spark.createDataFrame(links, "page_id long, url string").repartition(5), index, scratch, ["page_id"], otherwise="block")
    assert sorted(map(tuple, got.collect())) == sorted((i, *plain(u, rules, "block")) for i, u in links)


def test_equal_digests_are_told_apart(tmp_path):
    import pandas as pd

    keys = [b"hb", b"ha", b"hc"]
    rows = pd.DataFrame({"digest": np.array([7, 7, 9], np.int64), "key": keys, "value": [b"1", b"2", b"3"], "shard": 0})
    file = tmp_path / "part-0"
    file.write_bytes(urls._shard(rows)["blob"][0] + urls.GAP.encode())
    index = urls.Mapped((str(file),), 0)
    digests = {b"ha": 7, b"hb": 7, b"hc": 9, b"hd": 7, b"he": 8, b"hf": 10}
    find = urls.xxhash
    try:
        urls.xxhash = type("Fixed", (), {"xxh64_intdigest": staticmethod(lambda x, seed: digests[x])})
        assert index.find(list(digests)) == [b"2", b"1", b"3", None, None, None]
    finally:
        urls.xxhash = find


def test_digests_are_those_of_spark(spark):
    from pyspark.sql import functions as F

    texts = ["", "a", "hexample.org", "r" + "x" * 1000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64(F.col("t").cast("binary"))).collect()]
    assert [x % 2**64 for x in got] == [urls.xxhash.xxh64_intdigest(t.encode(), urls.SEED) for t in texts]


def test_no_rules_and_no_rows(spark):
    scratch = Scratch(spark, "test")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    index = urls.build(none, scratch)
    assert [tuple(r) for r in urls.judge(pages, index, scratch, ["page_id"]).collect()] == [(1, "a.b", "/c", None, "allow")]
    some = urls.build(spark.createDataFrame(RULES, none.schema), Scratch(spark, "test"))
    assert urls.judge(pages.limit(0), some, scratch, ["page_id"]).collect() == []


def test_unknown_verdicts_are_an_error(spark):
    with pytest.raises(Exception, match="unknown verdict: maybe"):
        urls.build(spark.createDataFrame([("a", "/", "maybe")], "host string, path string, verdict string"), Scratch(spark, "test"))
