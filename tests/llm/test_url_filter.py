import re

from stationflow.llm import url_filter
from stationflow.llm.queries import ORACLES, op1_url_filter

from .helpers import duck, rows


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    words = "|".join(url_filter.LISTED_WORDS)
    return host, path, None, "block" if re.search(rf"(^|\.)([^.]*-)?({words})(-[^.]*)?\.", host) else "allow"


def test_query_equals_sql(spark, sf_dir):
    assert rows(op1_url_filter(spark, sf_dir)) == sorted(duck(sf_dir, ORACLES["op1_url_filter"]), key=str)


URLS = [None, "", "no scheme", "://", "http://", "HTTP://Example.ORG/ES/x", "http://example.org/es/", "http://example.org/es",
        "http://a.example.org/en/1?q", "http://example.org/en/2", "http://notexample.org/es/1", "http://org/", "http://org",
        "http://x.com/fr/a#b", "http://x.com/de/a", "http://com/de/", "http://x.com?/de/", "http://x.com#://y.org/",
        "http://ads-x.net/", "http://w.free-bets.net", "http://bets.net/a", "http://alphabets.net/", "http://É.Ünet.ORG/Ä",
        "a://b://c.org/d", "http://" + "a." * 3000 + "adult-x.net/", "http://x.net/" + "p" * 100000, "http://spam/"]


def test_edge_urls_repeats_and_clashing_columns(spark):
    pages = spark.createDataFrame([(i, u, "k", "v", 1) for i, u in enumerate(URLS + URLS[:6])],
                                  "page_id long, url string, key string, verdict string, host int")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_pages(pages).collect()}
    assert got == {i: by_hand(u) for i, u in enumerate(URLS + URLS[:6])}
    assert url_filter.judge_pages(pages.limit(0)).count() == 0
    kept = url_filter.judge(pages, listed_hosts=url_filter.listed_domains(pages))
    assert kept.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20000).selectExpr("concat('k', id) AS key")
    listed = universe.filter("crc32(key) % 7 = 0")
    cascade = url_filter.build_cascade(universe, listed)
    assert len(cascade.levels) >= 3                              # false positives were encoded, alternately
    both = universe.selectExpr("key", "crc32(key) % 7 = 0 AS want")
    assert both.withColumn("got", cascade.contains(both["key"])).filter("want <> got").count() == 0
    assert url_filter.build_cascade(universe, listed.limit(0)).levels == []
    plan = universe.withColumn("in", cascade.contains(universe["key"]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_a_list_above_the_limit_is_judged_part_by_part(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.{'spam' if i % 3 else 'good'}.net/de/{i}") for i in range(300)]
                                  + [(1000 + i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    listed = url_filter.listed_domains(pages)
    whole, cut = [{tuple(r) for r in url_filter.judge(pages, listed_hosts=listed, max_bits=m).drop("url").collect()}
                  for m in (url_filter.MAX_FILTER_BITS, 1024)]
    assert whole == cut and {r[-1] for r in cut} == {"allow", "block"}


def test_bits_follow_the_list_and_the_corpus_by_its_logarithm():
    assert url_filter.bits_per_key(1000, 1000) == url_filter.bits_per_key(1000, 0) == 10
    assert url_filter.bits_per_key(1000, 10 ** 9) == 30
