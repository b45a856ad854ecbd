"""Operator 7, URL filter: fixed rules first, then empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted by host. Three beta-binomial
levels shrink them: the rate of a suffix towards the overall rate, that of a
registered domain towards its suffix, that of a host towards its domain, each
without the labels of the unit that it is the prior of. How
hard each level shrinks is estimated from the spread of its units (method of
moments). A host is blocked when the lower posterior bound of its bad rate is
above ``LIFT`` times the overall rate: its pages are surely worse than a page
drawn at random. The limit so follows from the outcomes, and few labels, whose
bound stays low, do not block a host; a caller may name a fixed limit instead.

All of it is DataFrame code: the counts are aggregates combined before the
shuffle (a host with a third of all pages is one row per task), and the host
table joins back by AQE's choice (broadcast under its size threshold, else a
sort-merge join whose hot host AQE splits). Two one-row aggregates reach the driver.

Defined results: a null url or one without ``://`` has an empty host and path
and shares the reputation of the empty host; a page without an outcome counts
for nothing but is judged; several outcomes of one page count as bad if one is;
without any outcome nothing is blocked but by rule; repeated rows get equal
verdicts; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import register, table, write_read

#: (rule, verdict): a host, then the beginning of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: How far above the overall bad rate a host must surely be; more than 1 spares large hosts a little above it.
LIFT = 1.0
Z = 1.645
MAX_STRENGTH = 1000.0
#: Second-level labels that belong to the suffix below a two-letter country.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bare(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def registered_domain(host: Column) -> Column:
    """The last two labels, three below a country's second level; an IP address stays whole."""
    bare = _bare(host)
    country = r"([^.]+\.)?(%s)\.[a-z]{2}$" % "|".join(SECOND_LEVEL)
    return (F.when(bare.rlike(r"^[0-9.]+$"), bare)
            .when(bare.rlike(r"(^|\.)" + country), F.regexp_extract(bare, country, 0))
            .otherwise(F.regexp_extract(bare, r"[^.]*(\.[^.]*)?$", 0)))


def public_suffix(domain: Column) -> Column:
    return F.when(domain.rlike(r"^[0-9.]+$"), F.lit("ip")).otherwise(F.regexp_extract(domain, r"([^.]*\.)?(.*)$", 2))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null: a CASE from the longest on."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        h, p = rule.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per host of ``pages``: labelled and bad pages, posterior mean and lower bound of the bad rate, overall rate.

    ``pages``: page_id, host; ``outcomes``: page_id, bad (0 or 1).
    """
    marked = outcomes.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = pages.join(marked, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
    hosts = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", public_suffix(F.col("domain")))
    hosts = write_read(hosts, "hosts")  # one row per host, read four times below
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    mean = (total.k + 0.5) / (total.n + 1)
    units = {c: hosts.groupBy(c).agg(F.sum("n").alias("n"), F.sum("k").alias("k")) for c in LEVELS}
    strength = _strengths(units, mean)
    named = {c: units[c].select(c, F.col("n").alias(f"n_{c}"), F.col("k").alias(f"k_{c}")) for c in ("suffix", "domain")}
    rows = hosts.join(named["domain"], "domain").join(named["suffix"], "suffix")
    prior, inner = F.lit(mean), {"suffix": ("k_domain", "n_domain"), "domain": ("k", "n")}
    for c, (k, n) in inner.items():  # what the level below counts itself is no part of its prior
        prior = (F.col(f"k_{c}") - F.col(k) + strength[c] * prior) / (F.col(f"n_{c}") - F.col(n) + strength[c])
    s = strength["host"]
    rows = rows.withColumn("a", F.col("k") + s * prior).withColumn("b", F.col("n") + s - F.col("a"))
    both = F.col("a") + F.col("b")
    sd = F.sqrt(F.col("a") * F.col("b") / (both * both * (both + 1)))
    return rows.select("host", "n", "k", (F.col("a") / both).alias("bad_rate"), (F.col("a") / both - Z * sd).alias("bad_bound"),
                       F.lit(mean).alias("overall"))


def _strengths(units: dict[str, DataFrame], mean: float) -> dict[str, float]:
    """Prior strength of each level: from the excess of its units' spread over chance."""
    one = None
    for c, u in units.items():
        n, k = F.col("n").cast("double"), F.col("k").cast("double")
        row = u.where("n > 0").agg(F.count(F.lit(1)).alias("u"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"),
                                   F.sum(n * F.pow(k / n - mean, 2)).alias("s")).select(F.lit(c).alias("level"), "*")
        one = row if one is None else one.unionByName(row)
    out = {}
    for x in one.collect():
        chance = mean * (1 - mean)
        room = (x.n - x.nn / x.n - (x.u - 1)) * chance if x.u and x.u > 1 else 0.0
        share = (x.s - (x.u - 1) * chance) / room if room > 0 else 0.0
        share = min(max(share, 1 / (1 + MAX_STRENGTH)), 0.5)
        out[x.level] = round((1 - share) / share, 6)
    return out


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float | None = None, lift: float = LIFT) -> DataFrame:
    """Every page with host, path, rule and verdict.

    Hosts without a rule are blocked above ``limit``, or where that is None above ``lift`` times the overall rate.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rep = host_reputation(rows, outcomes)
    rows = rows.join(rep, "host").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    bound = F.col("overall") * lift if limit is None else F.lit(limit)
    verdict = F.when(F.col("bad_bound") > bound, F.lit("block")).otherwise(F.lit("allow"))
    for rule, said in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(said)).otherwise(verdict)
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                       F.col("n").alias("host_labels"), F.col("k").alias("host_bad"), F.round("bad_rate", 6).alias("bad_rate"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome of each page that shows a labelled document.

    A page's path ends in the number of the document it shows; the page is bad
    if that document is marked as low quality or as toxic.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(\.[A-Za-z]+)?/?$", 1)
    shown = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    bad = F.greatest(F.when(F.col("quality") == 0, 1).otherwise(0), F.coalesce(F.col("toxic"), F.lit(0))).alias("bad")
    return shown.join(labels.select("doc_id", bad), "doc_id").select("page_id", "bad")


def _sql() -> str:
    country = r"([^.]+\.)?(%s)\.[a-z]{2}$" % "|".join(SECOND_LEVEL)
    rule = "CASE " + " ".join(
        f"WHEN (host = '{r.split('/', 1)[0]}' OR host LIKE '%.{r.split('/', 1)[0]}') AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{r}'"
        for r, _ in sorted(RULES, key=lambda r: -len(r[0]))) + " END"
    said = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    level = lambda c: f"""s_{c} AS (SELECT round((1 - r) / r, 6) AS s FROM (SELECT least(greatest(coalesce(CASE WHEN u > 1
        AND (n - nn / n - (u - 1)) > 0 THEN (s - (u - 1) * c) / ((n - nn / n - (u - 1)) * c) END, 0), {1 / (1 + MAX_STRENGTH)!r}), 0.5) AS r
        FROM (SELECT count(*) AS u, sum(n)::DOUBLE AS n, sum(n::DOUBLE * n) AS nn, sum(n * power(k / n - m, 2)) AS s, any_value(m * (1 - m)) AS c
        FROM u_{c}, g WHERE n > 0)))"""  # noqa: E731
    return f"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (SELECT page_id, max(greatest(CASE WHEN quality = 0 THEN 1 ELSE 0 END, coalesce(toxic, 0))) AS bad FROM
        (SELECT page_id, try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(\\.[A-Za-z]+)?/?$', 1), '') AS BIGINT) AS doc_id FROM p)
        JOIN labels USING (doc_id) GROUP BY 1),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare
        FROM p LEFT JOIN o USING (page_id) GROUP BY 1),
h1 AS (SELECT host, n, k, CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare
        WHEN regexp_matches(bare, '(^|\\.){country}') THEN regexp_extract(bare, '{country}', 0)
        ELSE regexp_extract(bare, '[^.]*(\\.[^.]*)?$', 0) END AS domain FROM h0),
h AS (SELECT *, CASE WHEN regexp_matches(domain, '^[0-9.]+$') THEN 'ip' ELSE regexp_extract(domain, '([^.]*\\.)?(.*)$', 2) END AS suffix FROM h1),
g AS (SELECT (coalesce(sum(k), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS m FROM h),
u_suffix AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h GROUP BY 1),
u_domain AS (SELECT domain, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h GROUP BY 1),
u_host AS (SELECT host, n, k FROM h),
{level('suffix')}, {level('domain')}, {level('host')},
f AS (SELECT h.host, h.n, h.k, h.k + s_host.s * ((d.k - h.k + s_domain.s * ((x.k - d.k + s_suffix.s * m) / (x.n - d.n + s_suffix.s))) / (d.n - h.n + s_domain.s)) AS a,
        s_host.s AS s FROM h JOIN u_domain d USING (domain) JOIN u_suffix x USING (suffix), g, s_host, s_domain, s_suffix),
q AS (SELECT host, n, k, a / (n + s) AS bad_rate, a / (n + s) - {Z} * sqrt(a * (n + s - a) / ((n + s) * (n + s) * (n + s + 1))) AS bad_bound FROM f),
r AS (SELECT *, {rule} AS rule FROM p JOIN q USING (host))
SELECT page_id, host, path, rule, CASE rule {said} ELSE CASE WHEN bad_bound > (SELECT m FROM g) * {LIFT} THEN 'block' ELSE 'allow' END END AS verdict,
    n AS host_labels, k AS host_bad, round(bad_rate, 6) AS bad_rate FROM r"""


@register("op7_url_filter", _sql())
def op7_url_filter(spark, sf_dir) -> DataFrame:
    """Host, path, rule and verdict of every url of ``pages``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")))
