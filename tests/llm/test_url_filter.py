from endpointlens.llm.queries import URL_RULES, page_outcomes
from endpointlens.llm.url_filter import filter_urls, host_reputation, url_host, url_path, with_levels
from pyspark.sql import functions as F


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
    path = rest[cut:]
    end = min([k for k in (path.find(c) for c in "?#") if k >= 0], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), path[:end]


def rule(host, path):
    best = None
    for verdict, text in URL_RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best or (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "https://www.example.com/en/", "https://Www.Example.Com/en/1?q=/x#y", "http://a.net/es/", "http://net/es/1", "http://a.net?x=/es/",
    "http://xcom/", "http://com", "http://com/", "x://y://z/../", "http://bexample.com/en/1", "http://m.b.net/fr/1#t", "http://a.org/en/\n1", "ftp://ÄB.com/", "http://u@h.com:80/en/?", "http://bad.org/1", "http://good.org/1", "http://new.org/",
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = df.select("page_id", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p")).collect()
    assert [(r["h"], r["p"]) for r in sorted(got)] == [parts(u) for u in URLS]
    none = spark.createDataFrame([], "host string, bad int")
    rows = filter_urls(df, none, URL_RULES).orderBy("page_id").collect()
    assert len(rows) == len(URLS)
    for r, u in zip(rows, URLS):
        text, verdict = rule(*parts(u))
        assert (r["rule"], r["verdict"]) == (text, verdict or "allow"), u
    assert filter_urls(df.limit(0), none, URL_RULES).count() == 0


def test_reputation_needs_evidence(spark):
    rows = [("bad.org", 1)] * 40 + [("good.org", 0)] * 40 + [("once.org", 1)] + [("m.bad.org", None)] + [("x.fine.com", 0)] * 200
    outcomes = spark.createDataFrame(rows, "host string, bad int")
    suffixes, domains, hosts = host_reputation(outcomes)
    found = {r["_host"]: r for r in hosts.collect()}
    assert found["bad.org"]["lower"] > 0.5 > found["good.org"]["mean"]
    assert found["once.org"]["lower"] < 0.5  # one bad page is no proof
    df = spark.createDataFrame([(0, "http://bad.org/1"), (1, "http://once.org/"), (2, "http://m.bad.org/9"), (3, "http://good.org"), (4, "http://nowhere.xyz/"), (0, "http://bad.org/1")], "page_id long, url string")
    verdicts = sorted((r["page_id"], r["verdict"]) for r in filter_urls(df, outcomes).collect())
    assert verdicts == [(0, "block"), (0, "block"), (1, "allow"), (2, "block"), (3, "allow"), (4, "allow")]


def test_names_and_levels_of_hosts(spark):
    df = spark.createDataFrame([(1, "http://bad.org/1", "mine", 2, 3, "p", "r")], "page_id long, url string, _host string, _fit int, _n int, page string, rule string")
    outcomes = spark.createDataFrame([("bad.org", 1)] * 40, "host string, bad int")
    row = filter_urls(df, outcomes).first()
    assert (row["_host"], row["_fit"], row["_n"], row["page"], row["rule"], row["verdict"]) == ("mine", 2, 3, "p", None, "block")
    hosts = {"10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "u@h.com:80": ("h.com", "com"), "a.h.com.": ("h.com", "com"), "x.a.co.uk": ("a.co.uk", "co.uk"), "": ("", ""), "one": ("one", "one"), "a@b@c.d.net.:1": ("d.net", "net")}
    got = {r["_host"]: (r["_domain"], r["_suffix"]) for r in with_levels(spark.createDataFrame([(h,) for h in hosts], "_host string")).collect()}
    assert got == hosts


def test_outcomes_take_the_id_at_the_end_of_the_path(spark):
    urls = ["http://a.org/en/7", "http://a.org/en/7/", "http://a.org/7/about", "http://a.org/en/x7", "http://a.org/3/7?x=1", "http://a.org/1234567890123456789", None]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    labels = spark.createDataFrame([(7, 0), (3, 1)], "doc_id long, quality int")
    assert [(r["host"], r["bad"]) for r in page_outcomes(pages, labels).collect()] == [("a.org", 1)] * 3
