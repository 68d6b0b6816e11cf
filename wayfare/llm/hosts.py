"""URL filters: rules by host and path, then trust and distrust spread over the link graph of hosts.

Rules judge the pages they fit. Hosts of allowed pages are trusted seeds, hosts of blocked pages
distrusted ones. Trust follows links by personalised PageRank; distrust follows them backwards, to
those who link to blocked hosts. A page that no rule fits is blocked where its host's distrust
outweighs its trust and passes a threshold. DataFrame operations only.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import lower_ascii, stage, table

#: verdict, host, path prefix. Fixed values.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING = 0.85
SQL_TERMS = 200  # of the limit's series that the SQL adds up; the next are below 1e-14 of the weight
STAGED_EVERY = 4  # rounds between written tables
THRESHOLD = 0.1  # distrust of a host, in units of the mean seed, from which it can be blocked
REMAINDER = 1e-4 * THRESHOLD  # bound of all mass, of all hosts together, that a settled walk has yet to add
#: A link that leaves its page's host: a scheme, or two slashes. One without may still hold an address in its query.
AWAY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(pages: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """Add host, path, rule and ruling: the longest rule whose host or parent domain and path prefix fit the url."""
    found = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, host, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(prefix))
        rule = F.when(fits, F.lit(host + prefix)).otherwise(rule)
        ruling = F.when(fits, F.lit(verdict)).otherwise(ruling)
    return found.withColumns({"rule": rule, "ruling": ruling})


def host_edges(pages: DataFrame) -> DataFrame:
    """from, to and the number of links between different hosts. Links without a scheme or leading slashes stay on their page's host."""
    links = pages.select(F.col("host").alias("from"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
    away = links.filter(F.col("link").rlike(AWAY))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    edges = away.select("from", host_of(full).alias("to")).filter("`from` != '' and `to` != '' and `from` != `to`")
    return edges.groupBy("from", "to").agg(F.count(F.lit(1)).alias("links"))


def _shares(edges: DataFrame) -> DataFrame:
    """from, to and the share of a host's links that lead there."""
    out = edges.groupBy("from").agg(F.sum("links").alias("all"))
    return stage(edges.join(out, "from").select("from", "to", (F.col("links") / F.col("all")).alias("share")), "shares")


def _step(mass: DataFrame, shares: DataFrame, back: DataFrame) -> DataFrame:
    """One round: mass moves along the links by DAMPING, and ``back`` is added."""
    moved = mass.join(shares, mass["host"] == shares["from"]).select(F.col("to").alias("host"), (F.col("mass") * F.col("share") * DAMPING).alias("mass"))
    return moved.unionAll(back).groupBy("host").agg(F.sum("mass").alias("mass"))


def settle(edges: DataFrame, seeds: DataFrame, remainder: float = REMAINDER) -> DataFrame:
    """Personalised PageRank: host and mass, from below, all hosts together short of the limit by at most ``remainder``.

    ``edges``: from, to, links; ``seeds``: host and weight. Mass moves on in proportion to a host's links with probability DAMPING;
    what reaches a host without links to others stays counted there and goes no further, so masses add up to
    the seeds' weight at most. They are in units of the mean seed and do not shrink as the graph grows. A host with very many
    links is a skewed join key that adaptive execution splits; masses of one host are summed before the shuffle.
    Only what a seed keeps, 1 - DAMPING of its weight, sets out: every round then adds the next term of the limit's series,
    and no mass under way is ever counted. A round adds at most DAMPING times what the round before added, so what the last
    rounds added bounds the rest, as do all terms by their number: rounds grow with the logarithm of the number of
    seeds, and end at once where the walks do.
    """
    shares = _shares(edges)
    back = stage(seeds.select("host", (F.col("weight") * (1 - DAMPING)).alias("mass")), "mass")
    total = lambda df: df.agg(F.sum("mass")).first()[0] or 0.0
    mass, kept, fading = back, total(back), DAMPING**STAGED_EVERY
    weight, reached = kept / (1 - DAMPING), kept
    left = weight * DAMPING
    while left > remainder:
        for _ in range(STAGED_EVERY):
            mass = _step(mass, shares, back)
        mass, weight, before = stage(mass, "mass"), weight * fading, reached
        reached = total(mass)
        left = min((reached - before) * fading / (1 - fading), weight * DAMPING)
    return mass


def judge(pages: DataFrame, rules: list[tuple] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, trust and distrust of the host, and verdict of every page.

    Null urls and urls without ``://`` have an empty host and path: no rule fits, no link counts, the verdict is allow.
    Null html has no links. Repeated rows are judged each, and their links count each. Equally long rules: the later by
    name wins. Hosts that no walk reaches are allowed. Walks go on until they settle. Extra columns are not read; an empty table gives an empty result.
    """
    ruled = with_rules(pages.select("page_id", "url"), rules)
    hosts = ruled.filter("host != '' and ruling is not null").groupBy("host")
    seeds = stage(hosts.agg(F.avg((F.col("ruling") == "allow").cast("double")).alias("allowed")), "seeds")
    edges = stage(host_edges(pages.select(host_of(F.col("url")).alias("host"), "html")), "links")
    trusted = seeds.filter("allowed > 0").select("host", F.col("allowed").alias("weight"))
    blocked = seeds.filter("allowed < 1").select("host", (1 - F.col("allowed")).alias("weight"))
    backwards = edges.select(F.col("to").alias("from"), F.col("from").alias("to"), "links")
    trust = settle(edges, trusted).select(F.col("host").alias("of"), F.col("mass").alias("trust"), F.lit(0.0).alias("distrust"))
    distrust = settle(backwards, blocked).select(F.col("host").alias("of"), F.lit(0.0).alias("trust"), F.col("mass").alias("distrust"))
    scores = trust.unionAll(distrust).groupBy("of").agg(F.round(F.sum("trust"), 9).alias("trust"), F.round(F.sum("distrust"), 9).alias("distrust"))
    joined = ruled.join(stage(scores, "scores"), F.col("host") == F.col("of"), "left").na.fill(0.0, ["trust", "distrust"])
    against = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    verdict = F.coalesce("ruling", F.when(against, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", "trust", "distrust", verdict.alias("verdict"))


def op10_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of all pages."""
    return judge(table(spark, sf_dir, "pages"))


def _walk_sql(name: str, source: str, target: str, seeds: str) -> str:
    """CTEs of one walk: the terms of the limit's series, then ``name`` with their sum by host."""
    return f"""{name}_shares AS MATERIALIZED (SELECT {source} AS f, {target} AS t, links / sum(links) OVER (PARTITION BY {source}) AS share FROM e),
{name}_terms AS (SELECT 0 AS k, host, weight * {1 - DAMPING} AS mass FROM {seeds}
  UNION ALL SELECT k + 1, x.t, sum(m.mass * x.share * {DAMPING}) FROM {name}_terms m JOIN {name}_shares x ON x.f = m.host WHERE k < {SQL_TERMS} GROUP BY k + 1, x.t),
{name} AS (SELECT host, sum(mass) AS mass FROM {name}_terms GROUP BY host)"""


def _fits_sql(host: str, prefix: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{prefix}')"


def sql(rules: list[tuple] = RULES) -> str:
    longest = sorted(rules, key=lambda r: (len(r[1] + r[2]), r), reverse=True)
    rule = " ".join(f"WHEN {_fits_sql(h, p)} THEN '{h + p}'" for _, h, p in longest)
    ruling = " ".join(f"WHEN {_fits_sql(h, p)} THEN '{v}'" for v, h, p in longest)
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = low.format("coalesce(regexp_extract({}, '(?s)^.*?://([^/?#]*)', 1), '')")
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE p AS (SELECT page_id, html, {host.format("url")} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS MATERIALIZED (SELECT page_id, html, host, path, CASE {rule} END AS rule, CASE {ruling} END AS ruling FROM p),
k AS (SELECT host AS f, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM p),
e AS MATERIALIZED (SELECT f, t, count(*)::DOUBLE AS links FROM (
  SELECT f, {host.format("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS t FROM k
  WHERE regexp_matches(link, '{AWAY}')) WHERE f <> '' AND t <> '' AND f <> t GROUP BY f, t),
s AS (SELECT host, avg(CASE WHEN ruling = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed FROM r WHERE host <> '' AND ruling IS NOT NULL GROUP BY host),
good AS (SELECT host, allowed AS weight FROM s WHERE allowed > 0),
bad AS (SELECT host, 1 - allowed AS weight FROM s WHERE allowed < 1),
{_walk_sql("up", "f", "t", "good")},
{_walk_sql("down", "t", "f", "bad")},
v AS (SELECT r.page_id, r.host, r.path, r.rule, r.ruling, coalesce(round(a.mass, 9), 0.0) AS trust, coalesce(round(b.mass, 9), 0.0) AS distrust
      FROM r LEFT JOIN up a ON a.host = r.host LEFT JOIN down b ON b.host = r.host)
SELECT page_id, host, path, rule, trust, distrust,
       coalesce(ruling, CASE WHEN distrust >= {THRESHOLD} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM v
"""
