"""URL filters: rules by host and path, and trust that spreads over links between hosts.

Rules decide first. For all other pages the host decides: trust starts at hosts with allowed pages and follows links, distrust
starts at hosts with blocked pages and follows links backwards, as personalised PageRank both. Scores are whole numbers
of ``UNIT`` parts, so they do not depend on the order of additions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UNIT = 1_000_000_000_000  # of one seeded host; smaller where so many are seeded that their sum would not fit into 62 bits
DAMPING = 85  # percent that follows the links
TOLERANCE = 10_000  # no host's score changes by more than one part in so many of a unit in the last CUT rounds
LEAST = 20  # a host is blocked from one part in so many of a unit on
CUT = 5  # rounds between two written tables
# Second levels of two-letter domains below which names are registered (example.co.uk).
SECOND_LEVELS = "ac|co|com|edu|go|gob|gov|gouv|ne|net|or|org"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path as one text) and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def site_hosts(host: Column) -> Column:
    """The host and the hosts it is a part of, up to the registered domain; whether these have pages plays no part.

    The registered domain is the last two labels, or three below a two-letter domain with a second level of its own. Addresses
    and hosts of one label stand alone.
    """
    labels = F.split(host, r"\.")
    least = F.when(host.rlike(rf"\.(?:{SECOND_LEVELS})\.[a-z]{{2}}(?::\d*)?$"), 3).otherwise(2)
    alone = host.rlike(r"^[\d.]+(?::\d*)?$|^\[|@") | (F.size(labels) <= least)
    up = F.transform(F.sequence(F.lit(1), F.size(labels) - least + 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(alone, F.array(host)).otherwise(up)


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Links ``src, dst, n`` between different hosts: absolute links in the pages, and every host with the host it is a part of.

    Hosts between a page's host and its registered domain are there even if they have no page, so hosts of one site are linked.
    """
    target = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), 1)
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(target).alias("dst"))
    links = links.select("src", F.translate("dst", UPPER, UPPER.lower()).alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = pages.where("host <> ''").select("host").distinct()
    levels = hosts.select(site_hosts(F.col("host")).alias("up"))
    steps = F.explode(F.transform(F.slice("up", 2, F.size("up")), lambda parent, i: F.struct(F.col("up")[i].alias("host"), parent.alias("parent"))))
    parts = levels.where(F.size("up") > 1).select(steps.alias("s")).select("s.*").distinct()
    site = parts.select(F.col("host").alias("src"), F.col("parent").alias("dst"), F.lit(1).cast("long").alias("n"))
    site = site.unionByName(site.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    return links.unionByName(site).where("src <> dst").groupBy("src", "dst").agg(F.sum("n").alias("n"))


def unit_for(hosts: int) -> int:
    """The unit at which the scores of so many seeded hosts, which never exceed their seeds in sum, fit into 62 bits."""
    unit = UNIT
    while unit * hosts >= 1 << 62:
        unit //= 10
    return unit


def propagate(seeds: DataFrame, links: DataFrame, tolerance: int = UNIT // TOLERANCE, damping: int = DAMPING) -> DataFrame:
    """Personalised PageRank of ``seeds`` (kind, host, seed) over ``links`` (kind, src, dst, n): ``kind, host, score``.

    Scores start as the part of the seeds that follows no links. Each round, ``damping`` percent of a host's score goes out in the
    shares of its links, and every seed gets that part again, so scores only grow towards their limit. It ends when ``CUT`` rounds
    change no score by more than ``tolerance``. A host without links keeps nothing for others. Scores and shares are cut to whole units.
    """
    out = links.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    shares = materialize(links.join(out, ["kind", "src"]).select("kind", "src", "dst", "n", "all"), "shares")
    again = seeds.select("kind", "host", F.expr(f"seed * {100 - damping} div 100").alias("score"))
    score = again
    while True:
        before = score
        for _ in range(CUT):
            sent = score.withColumnRenamed("host", "src")
            moved = shares.join(sent, ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), F.expr(f"((score div 100) * {damping} + (score % 100) * {damping} div 100) div all * n").alias("score")
            )
            score = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        score = materialize(score, "scores")
        change = score.unionByName(before.select("kind", "host", (-F.col("score")).alias("score"))).groupBy("kind", "host").agg(F.sum("score").alias("change"))
        if (change.agg(F.max("change")).first()[0] or 0) <= tolerance:
            return score


def host_scores(pages: DataFrame, tolerance: int = TOLERANCE) -> tuple[DataFrame, int]:
    """``host, trust, distrust`` of every host with a score, and their unit. ``pages`` has host, verdict (of the rules) and html.

    Seeds: a host's share of allowed (blocked) pages, in units.
    """
    per = pages.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    kinds = F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("allow").alias("k")), F.struct(F.lit("distrust").alias("kind"), F.col("block").alias("k")))).alias("s")
    shares = materialize(per.select("host", "n", kinds).where("s.k > 0").select("s.kind", "host", "s.k", "n"), "seeds")
    unit = unit_for(shares.groupBy("kind").count().agg(F.max("count")).first()[0] or 0)
    # a host may have more pages than leave room for the product
    seeds = shares.select("kind", "host", F.expr(f"{unit} div n * k + {unit} % n * k div n").alias("seed"))
    links = materialize(host_links(pages), "links")
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    scores = propagate(seeds, both, max(1, unit // tolerance))
    kind = lambda name: F.sum(F.when(F.col("kind") == name, F.col("score")).otherwise(0)).alias(name)
    return scores.groupBy("host").agg(kind("trust"), kind("distrust")), unit


def judge_pages(pages: DataFrame, url: str = "url", html: str = "html", rules: list[tuple[str, str, str]] = RULES, least: int = LEAST, tolerance: int = TOLERANCE) -> DataFrame:
    """``pages`` without its html, with ``host, path, rule, verdict, trust, distrust``; columns of these names are replaced.

    The longest rule decides; where none fits, a host is blocked when its distrust is above its trust and at least one part in
    ``least`` of a unit, else allowed. A unit is 10^12, less a power of ten for very many seeded hosts (``unit_for``). A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Null html has
    no links. Repeated rows count as pages of their own.
    """
    added = {"host", "path", "rule", "verdict", "trust", "distrust", "_host"}
    pages = pages.drop(*[c for c in pages.columns if c.lower() in added])
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    parsed = pages.withColumns({"host": host, "path": path})
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": rule, "verdict": verdict})
    scores, unit = host_scores(ruled.select("host", "verdict", F.col(html).alias("html")), tolerance)
    scores = materialize(scores, "hosts").withColumnRenamed("host", "_host")
    joined = ruled.drop(html).join(scores, F.col("host") == F.col("_host"), "left").drop("_host").fillna(0, ["trust", "distrust"])
    by_host = F.when((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= unit // least), "block").otherwise("allow")
    return joined.withColumn("verdict", F.coalesce("verdict", by_host))
