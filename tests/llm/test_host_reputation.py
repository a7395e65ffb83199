from pyspark.sql import functions as F

from opinara.llm.host_reputation import (
    ReputationConfig, UrlRule, domain_of, host_of, judge_urls, page_outcomes, path_of, reputations, suffix_of,
)

PAGES = "page_id long, url string, host string, verdict string"
LONG = "http://a.net/" + "x" * 50_000


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "", "") for i, u in enumerate(urls)], PAGES)


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "host string, n long, good long")


def test_parts(spark):
    urls = {
        None: ("", ""), "": ("", ""), "nothing": ("", ""), "http://": ("", ""), "HTTP://ABC.Éx.org?q=/a": ("abc.Éx.org", ""),
        "x://h#/p": ("h", ""), "http://u@h.org:80/A/b?c#d": ("u@h.org:80", "/A/b"), "/p?u=http://h.com/x": ("h.com", "/x"), LONG: ("a.net", LONG[12:]),
    }
    got = pages(spark, urls).orderBy("page_id").select(host_of(), path_of()).collect()
    assert [tuple(r) for r in got] == list(urls.values())


def test_domains_and_suffixes(spark):
    hosts = {
        "a.b.example.com": ("example.com", "com"), "x.y.co.uk": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "localhost": ("localhost", "localhost"),
        "10.0.0.1": ("10.0.0.1", ""), "u@w.example.org:8080": ("example.org", "org"), "": ("", ""), "foo.xco.uk": ("xco.uk", "uk"),
    }
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = {r.h: (r.d, r.s) for r in df.select("h", domain_of(F.col("h")).alias("d"), suffix_of(F.col("h")).alias("s")).collect()}
    assert got == hosts


def test_longest_rule_wins(spark):
    urls = [
        "http://example.org/es/1", "http://a.example.org/en/1x", "http://a.example.org/en/2", "http://notexample.org/es/",
        "http://x.com/fr/", "http://x.com/de/3", "http://x.com/en/", "http://org/", "http://xorg/", "http://example.org", "http://EXAMPLE.org/ES/",
    ]
    out = judge_urls(pages(spark, urls), outcomes(spark, [])).orderBy("page_id").collect()
    rules = ["example.org/es/", "example.org/en/1", "org/", "org/", "com/fr/", "com/de/", None, "org/", None, None, "org/"]
    assert [r.rule for r in out] == rules
    assert [r.verdict for r in out] == ["block", "block", "allow", "allow", "allow", "block"] + ["allow"] * 5


def test_hosts_shrink_to_their_domain_and_suffix(spark):
    rows = [("a.good.net", 500, 480), ("b.good.net", 400, 390), ("a.bad.net", 500, 50), ("b.bad.net", 400, 30), ("c.bad.net", 0, 0), ("c.good.net", 1, 0), ("z.new.net", 0, 0)]
    got = {r.host: r for r in reputations(outcomes(spark, rows), ReputationConfig()).collect()}
    assert got["c.bad.net"].posterior < 0.2 < 0.8 < got["c.good.net"].posterior < 480 / 500
    assert 0.3 < got["z.new.net"].posterior < 0.8
    assert all(r.bound < r.posterior for r in got.values())
    urls = ["http://a.good.net/", "http://c.bad.net/", "http://unseen.bad.net/x", "http://unseen.good.net/x"]
    config = ReputationConfig(rules=(UrlRule("allow", "org", "/"),))
    assert [r.verdict for r in judge_urls(pages(spark, urls), outcomes(spark, rows), config).orderBy("page_id").collect()] == ["allow", "block", "block", "allow"]


def test_outcomes_of_pages(spark):
    urls = ["http://h.net/en/7", "http://h.net/en/7.html?x", "http://h.net/de/8/", "http://h.net/en/x9", "http://g.net/fr/9#a", None, "http://g.net/1/"]
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (9, 1, 1), (9, 1, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in page_outcomes(pages(spark, urls), labels).select("host", "n", "good").collect())
    assert got == [("g.net", 2, 1), ("h.net", 3, 2)]


def test_repeated_rows_and_empty_table(spark):
    df = pages(spark, ["http://h.net/", None]).union(pages(spark, ["http://h.net/"]))
    assert judge_urls(df, outcomes(spark, [])).count() == 3
    assert judge_urls(df.limit(0), outcomes(spark, [("h.net", 3, 1)])).count() == 0
