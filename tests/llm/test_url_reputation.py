import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattloom.llm import url_reputation as u

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = {
    None: ("", ""),
    "": ("", ""),
    "example.com/x": ("", ""),
    "http://": ("", ""),
    "HTTP://A.Example.COM/De/?q#f": ("a.example.com", "/De/"),
    "http://É.com?x=/y": ("É.com", ""),
    "http://a.net#/": ("a.net", ""),
    "x://a/b://c/d": ("a", "/b://c/d"),
    "http://a\nb.org/fr/\nz": ("a\nb.org", "/fr/\nz"),
}


def test_parsing(spark):
    frame = spark.createDataFrame([(url,) for url in URLS], "url string")
    found = {r[0]: (r[1], r[2]) for r in frame.select("url", u.host_of(F.col("url")), u.path_of(F.col("url"))).collect()}
    assert found == URLS


def test_longest_rule_wins_on_hosts_and_subdomains(spark):
    cases = {
        ("net", "/"): "net/",
        ("a.net", "/en/x"): "net/",
        ("example.net", "/en/x"): "example.net/en/",
        ("b.a.example.net", "/en/"): "example.net/en/",
        ("example.net", "/en"): "net/",
        ("notexample.net", "/en/"): "net/",
        ("a.net", ""): None,
        ("internet", "/"): None,
        ("w.example.com", "/de/"): "example.com/de/",
        ("example.com", "/en/"): None,
        ("x.org", "/fr/"): "org/fr/",
        ("", ""): None,
    }
    frame = spark.createDataFrame(list(cases), "host string, path string")
    found = frame.select("host", "path", u.matching_rule(F.col("host"), F.col("path"), RULES)["rule"]).collect()
    assert {(r[0], r[1]): r[2] for r in found} == cases


def test_domains_and_suffixes(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "w.x.co.uk": ("x.co.uk", "co.uk"), "com": ("com", "com"), "": ("", "")}
    frame = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert {r[0]: (r[1], r[2]) for r in frame.select("h", u.domain_of(F.col("h")), u.suffix_of(F.col("h"))).collect()} == hosts


def pages(spark, counts):
    """host -> (pages, labelled bad, labelled good)"""
    data, outcomes, number = [], [], 0
    for host, (total, bad, good) in counts.items():
        for i in range(total):
            data.append((number, f"http://{host}/p{i}"))
            if i < bad + good:
                outcomes.append((number, i < bad))
            number += 1
    return spark.createDataFrame(data, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad boolean")


def test_hosts_are_shrunk_towards_their_domain(spark):
    counts = {f"h{i}.good.com": (30, 0, 25) for i in range(6)} | {f"h{i}.bad.org": (30, 25, 0) for i in range(6)}
    counts |= {"new.good.com": (5, 0, 0), "new.bad.org": (5, 0, 0), "once.good.com": (5, 1, 0)}
    frame, outcomes = pages(spark, counts)
    verdicts = {r["host"]: r["verdict"] for r in u.judge_urls(frame, outcomes).collect()}
    assert verdicts["h0.bad.org"] == verdicts["new.bad.org"] == "block"
    # one bad page does not make a host of a good domain bad
    assert verdicts["h0.good.com"] == verdicts["new.good.com"] == verdicts["once.good.com"] == "allow"
    known = {r["host"]: r for r in u.reputations(frame.select("page_id", u.host_of(F.col("url")).alias("host")), outcomes).collect()}
    assert known["new.good.com"]["mean"] < known["once.good.com"]["mean"] < 0.5
    assert all(0 <= r["lower"] <= r["mean"] <= 1 for r in known.values())


def test_edges(spark):
    frame, outcomes = pages(spark, {"a.com": (3, 1, 1)})
    odd = frame.union(frame).union(spark.createDataFrame([(None, "http://a.com/"), (77, None), (77, None)], frame.schema))
    odd = odd.withColumns({"host": F.lit("x"), "verdict": F.lit(1), "bad": F.lit("y")})
    judged = u.judge_urls(odd, outcomes.union(spark.createDataFrame([(None, True), (0, None), (0, False)], outcomes.schema)), RULES)
    assert judged.count() == 9 and {r["verdict"] for r in judged.collect()} <= {"allow", "block"}
    for labels in (outcomes.limit(0), outcomes):
        assert u.judge_urls(frame.limit(0), labels, RULES).collect() == []
    assert {r["verdict"] for r in u.judge_urls(frame, outcomes.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("native", ["judge_urls"])
def test_nothing_runs_python(spark, native):
    frame, outcomes = pages(spark, {"a.com": (3, 1, 1)})
    plan = getattr(u, native)(frame, outcomes, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert rows(frame.limit(1)) == rows(frame.limit(1))
