"""URL filter: parsing, rules, shrinkage and edges."""
from pyspark.sql import functions as F

from fillbook.llm import urls as U


def test_parts_and_rules(spark):
    cases = [
        ("HTTP://WWW.Example.COM/de/x?q#f", "www.example.com", "/de/x", "example.com/de/", "block"),
        ("https://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://a.example.net/fr/1", "a.example.net", "/fr/1", "net/", "block"),
        ("http://x.org/fr/?a", "x.org", "/fr/", "org/fr/", "allow"),
        ("http://internet/x", "internet", "/x", None, "allow"),
        ("http://foo.net", "foo.net", "", None, "allow"),
        ("http://ÄB.com#/de/", "Äb.com", "", None, "allow"),
        ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(cases)], "page_id long, url string, host string, rule string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in U.judge_urls(df, none).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert U.judge_urls(df.limit(0), none).count() == 0


def test_domains(spark):
    rows = [("a.b.co.uk", "b.co.uk", "co.uk"), ("b.com", "b.com", "com"), ("x.y.b.com:80", "b.com", "com"),
            ("10.0.0.1", "10.0.0.1", "ip"), ("", "", ""), ("u@h.de", "h.de", "de")]
    df = spark.createDataFrame(rows, "host string, d string, s string")
    d = U.registered_domain(F.col("host"))
    assert df.where((d != F.col("d")) | (U.public_suffix(d) != F.col("s"))).count() == 0


def test_few_labels_do_not_block(spark):
    """Many bad pages block a host; one bad page does not; a new host takes its domain's rate."""
    pages, bad, n = [], [], 0
    for host, total, marked in (("bad.com", 80, 76), ("once.org", 1, 1), ("new.bad.com", 1, 0), *((f"h{i}.org", 40, 2) for i in range(12))):
        for j in range(total):
            pages.append((n, f"http://{host}/{j}"))
            if host != "new.bad.com":
                bad.append((n, int(j < marked)))
            n += 1
    got = U.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(bad + bad[:3], "page_id long, bad int"))
    said = {x.host: x for x in got.dropDuplicates(["host"]).collect()}
    assert said["bad.com"].verdict == "block" and said["once.org"].verdict == "allow" and said["h3.org"].verdict == "allow"
    assert said["new.bad.com"].bad_rate > said["once.org"].bad_rate and got.count() == len(pages)


def test_limit_follows_from_the_outcomes(spark):
    """The same counts block where bad pages are rare and not where they are common; a named limit holds instead."""
    def verdicts(common, **kw):
        pages, bad, n = [], [], 0
        for host, total, marked in (("x.com", 60, 30), *((f"h{i}.org", 60, common) for i in range(10))):
            for j in range(total):
                pages.append((n, f"http://{host}/{j}"))
                bad.append((n, int(j < marked)))
                n += 1
        got = U.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int"), **kw)
        return {x.host for x in got.where("verdict = 'block'").select("host").distinct().collect()}
    assert verdicts(3) == {"x.com"} and "x.com" not in verdicts(30) and verdicts(3, limit=0.9) == set() and verdicts(3, lift=9.0) == set()
