from __future__ import annotations

import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyloom.llm.queries import URL_RULES
from tallyloom.llm.url_filter import host_of, judged_urls, mined_rules, path_of, tokens_of

URLS = [
    None, "", "no scheme.org/es/", "://", "http://", "https://Example.ORG/es/1?x=/de/", "http://a.example.org/en/12",
    "http://example.org/en/2", "http://example.org", "http://notexample.org/es/x", "http://shop.com/fr/", "http://shop.com/de/1",
    "http://com/de/", "http://xcom/de/", "http://a.net/de/#top", "http://a.com?x#y", "ftp://ÄB.com/fr/é", "http://u:p@b.org:80/",
    "http://b.org/a\n/c?d", "http://x://y.org/",
]


def plain(url):
    """Host, path and the longest rule, from the words of the contract."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    fitting = [
        r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fitting, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, url) for i, url in enumerate(URLS)] + [(None, URLS[5]), (5, URLS[5])]
    for i in range(300):
        top, language = ("org", "com", "net")[i % 3], ("en", "de", "fr", "es")[i // 3 % 4]
        rows.append((1000 + i, f"https://s{i % 5}.example.{top}/{language}/{i}" + (".html" if i % 7 == 0 else "")))
    return spark.createDataFrame(rows, "page_id bigint, url string").withColumns(
        {name: F.lit(1) for name in ("host", "path", "rule", "tokens")}
    )


def test_given_rules(pages):
    urls = {}
    for row in pages.collect():
        urls.setdefault(row["page_id"], row["url"])
    found = judged_urls(pages, URL_RULES).collect()
    assert len(found) == pages.count()
    for row in found:
        host, path, rule, verdict = plain(urls[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == verdict if rule else row["verdict"] in ("allow", "block")


def test_mined_rules_decide_the_rest_as_counted_by_hand(pages):
    support, confidence = 0.02, 0.8
    rows = pages.select(
        "page_id", "url", tokens_of(F.col("url"), F.lit("x"), F.lit("")).alias("ignored")
    ).drop("ignored")
    found = judged_urls(rows, URL_RULES, min_support=support, min_confidence=confidence).collect()
    parsed = spark_tokens(pages)
    labelled = [(parsed[u], plain(u)[3]) for u in (r["url"] for r in rows.collect()) if plain(u)[3] and parsed[u]]
    subsets = {}
    for tokens, verdict in labelled:
        for size in range(1, len(tokens) + 1):
            for subset in combinations(tokens, size):
                subsets.setdefault(subset, []).append(verdict)
    least = support * len(labelled)
    mined = [
        (-votes.count(v) / len(votes), -votes.count(v) / len(labelled), len(s), list(s), v)
        for s, votes in subsets.items()
        for v in ("allow", "block")
        if votes.count(v) >= least and votes.count(v) / len(votes) >= confidence
    ]
    urls = {r["page_id"]: r["url"] for r in rows.collect()}
    kinds = set()
    for row in found:
        if row["rule"] is None:
            own = set(parsed[urls[row["page_id"]]])
            best = min((m for m in mined if own.issuperset(m[3])), default=None)
            assert row["verdict"] == (best[4] if best else "allow")
            kinds.add(row["verdict"])
    assert kinds == {"allow", "block"}


def spark_tokens(pages):
    url = F.coalesce("url", F.lit(""))
    rows = pages.select("url", tokens_of(url, host_of(url), path_of(url)).alias("found")).collect()
    return {r["url"]: r["found"] for r in rows}


def test_tokens(pages):
    found = spark_tokens(pages)
    assert found["https://Example.ORG/es/1?x=/de/"] == [
        "arg=x", "dir=es", "domain=example.org", "scheme=https", "top=org",
    ]
    assert found[None] == [] and found["http://"] == []


def test_many_shared_arguments_cost_no_more_than_few(spark):
    """40 arguments that always come together are one item: same verdicts, no more rules."""

    def labels(arguments):
        query = "&".join(f"a{i}=x" for i in range(arguments))
        rows = [(f"http://s{i % 9}.net/{'ab'[i % 2]}/{i}?{query}", ("allow", "block")[i % 2]) for i in range(200)]
        rows += [(f"http://t.net/{i}", "allow") for i in range(50)]
        return spark.createDataFrame(rows, "url string, verdict string")

    pages = spark.createDataFrame(
        [(1, "http://x.com/b/1?a1=y"), (2, "http://x.com/a/1?a7=y&a3=x"), (3, "http://y.com/?a39=1"), (4, "http://t.net/q")],
        "page_id int, url string",
    )
    found, rules = [], []
    for arguments in (8, 40):
        frame = labels(arguments)
        judged = judged_urls(pages, [], labels=frame, min_support=0.05, min_confidence=0.7)
        found.append(sorted((row.page_id, row.verdict) for row in judged.collect()))
        parsed = frame.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        parsed = parsed.select(tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), "verdict")
        rules.append(mined_rules(parsed, 0.05, 0.7)[0].count())
    assert found[0] == found[1] and rules[0] == rules[1]
    assert dict(found[0])[1] == "block" and dict(found[0])[2] == "allow"


def test_labels_of_its_own_and_empty_tables(spark, pages):
    labels = spark.createDataFrame([("http://a.net/x/", "block"), ("http://b.net/y/", "allow")] * 5, "url string, verdict string")
    found = {r["page_id"]: r["verdict"] for r in judged_urls(pages, [], labels=labels, min_support=0.1).collect()}
    assert found[14] == "allow" or found[14] == "block"
    nothing = spark.createDataFrame([], "page_id bigint, url string")
    assert judged_urls(nothing, URL_RULES).collect() == []
    assert {r["verdict"] for r in judged_urls(pages.where("page_id < 5"), []).collect()} == {"allow"}
