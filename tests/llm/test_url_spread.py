"""Trust and distrust against the limit of the same iteration in floating point, over sites and long chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.llm import urls

COLUMNS = "page_id long, url string, html string"


def test_siblings_of_a_blocked_host(spark):
    rows = [(i, f"http://blog.x.example.net/es/{i}", None) for i in range(4)]
    rows += [(10, "http://www.x.example.net/a", None), (11, "http://y.example.net/a", None), (12, "http://www.other.org/a", None), (13, "http://10.0.0.1/a", "")]
    got = {r["page_id"]: r for r in urls.judge_pages(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got[10]["verdict"] == "block" and got[10]["distrust"] > got[11]["distrust"] > 0
    assert got[12]["verdict"] == got[13]["verdict"] == "allow" and got[12]["distrust"] == got[13]["distrust"] == 0


def test_levels_of_a_site(spark):
    cases = {
        "a.b.example.net": ["a.b.example.net", "b.example.net", "example.net"],
        "example.net": ["example.net"],
        "a.b.example.co.uk:80": ["a.b.example.co.uk:80", "b.example.co.uk:80", "example.co.uk:80"],
        "10.0.0.1:80": ["10.0.0.1:80"],
        "localhost": ["localhost"],
        "": [""],
    }
    frame = spark.createDataFrame([(h,) for h in cases], "host string")
    assert {r[0]: r[1] for r in frame.select("host", urls.site_hosts(F.col("host"))).collect()} == cases


def limit(seeds, links):
    score = {h: 0.0 for e in links for h in e[:2]} | {h: 0.0 for h in seeds}
    for _ in range(500):
        now = {h: 0.15 * seeds.get(h, 0.0) for h in score}
        for src, dst, n in links:
            now[dst] += 0.85 * score[src] * n / sum(e[2] for e in links if e[0] == src)
        score = now
    return score


def test_scores_reach_their_limit(spark):
    links = [(f"h{i}", f"h{i + 1}", 1) for i in range(14)] + [("a", "b", 2), ("a", "c", 1), ("b", "a", 1), ("c", "a", 1)]
    seeds = {"h0": 1.0, "a": 0.5, "c": 1.0}
    given = spark.createDataFrame([("k", h, int(s * urls.UNIT)) for h, s in seeds.items()], "kind string, host string, seed long")
    got = {r["host"]: r["score"] / urls.UNIT for r in urls.propagate(given, spark.createDataFrame([("k", *e) for e in links], "kind string, src string, dst string, n long")).collect()}
    want = limit(seeds, links)
    # a change of at most t leaves at most t * 0.85 / 0.15 for later rounds here
    assert all(0 <= want[h] - got.get(h, 0.0) < 6e-4 for h in want)
    assert abs(got["h10"] - 0.15 * 0.85**10) < 1e-9 and abs(got["h14"] - 0.15 * 0.85**14) < 1e-9


def test_sums_of_very_many_seeds_fit(spark):
    """Seeds that add up to nearly 2^62 meet in one hub and in what it links to; a billion hosts get smaller units."""
    assert urls.unit_for(0) == urls.unit_for(4_000_000) == urls.UNIT
    assert urls.unit_for(10**9) * 10**9 < 1 << 62 and urls.unit_for(10**9) >= 10**8
    n, seed = 200, (1 << 62) // 201
    given = spark.createDataFrame([("k", f"h{i}", seed) for i in range(n)], "kind string, host string, seed long")
    links = [("k", f"h{i}", "hub", 3) for i in range(n)] + [("k", "hub", "out", 1)]
    got = {r["host"]: r["score"] for r in urls.propagate(given, spark.createDataFrame(links, "kind string, src string, dst string, n long"), seed // 10_000).collect()}
    want = limit({f"h{i}": 1.0 for i in range(n)}, [e[1:] for e in links])
    assert abs(got["hub"] / seed - want["hub"]) < 1e-3 and abs(got["out"] / seed - want["out"]) < 1e-3


def test_repeated_rows_and_long_values(spark):
    long = "http://x.example.net/es/" + "a" * 200_000
    html = "<a href='http://y.org/'>" * 20_000
    rows = [(1, long, html), (1, long, html), (2, "http://y.org/a", None), (2, "http://y.org/a", None), (None, None, None)]
    got = sorted(((r["page_id"] or 0), r["rule"], r["verdict"]) for r in urls.judge_pages(spark.createDataFrame(rows, COLUMNS)).collect())
    assert got == [(0, None, "allow"), (1, "net/es/", "block"), (1, "net/es/", "block"), (2, None, "allow"), (2, None, "allow")]
