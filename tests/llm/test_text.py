"""Language, licences, urls, decontamination, quality rules and the pipeline."""

from __future__ import annotations

import hashlib
import os
import random
import re
import string

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillhouse.llm import decontam, langid, licenses, quality, urls
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    got = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("d"), "lang")
    rows = got.join(truth, F.col("doc_id") == F.col("d")).where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(docs):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 !?", "en"), (5, "und der hund", None), (6, "", None), (None, "the dog", None)]
    frame = docs(rows, extra="lang string")
    got = {r["doc_id"]: r for r in langid.identify(frame, F.col("doc_id") < 3).collect()}
    assert {k: r["lang_pred"] for k, r in got.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "de", 6: "und", None: "en"}
    assert got[3]["score"] == 0 and got[5]["score"] > 0.5
    assert {r["lang_pred"] for r in langid.identify(frame, F.lit(False)).collect()} == {"und"}


def test_probabilities_add_up(docs):
    frame = docs([(1, "abab abba baab", "x"), (2, "cdcd cd", "y")], extra="lang string")
    model = langid.train(frame)
    import numpy as np

    # symbols seen in training, and one that stands for all others (hashes of all of them would meet some by chance)
    number = langid.symbol_table(model.letters)
    probe = np.array(sorted({1, *(int(number[ord(c)]) for c in "abcd")}) + [5000], np.int64)
    weight = np.array([1.0] * 5 + [langid.BASE - 5.0])
    for context in ("ab", "ba", "cd", "zz"):
        key = (langid.BASE + int(number[ord(context[0])])) * langid.BASE + int(number[ord(context[1])])
        total = (weight[:, None] * np.exp2(model.log_probability(key * langid.BASE + probe).astype(float))).sum(axis=0)
        assert (abs(total - 1) < 1e-3).all()


def test_licenses(docs):
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore."),
        (2, 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Copyright 2020 A. Person\nAll rights reserved."),
        (5, "the licence of a poet is free"),
        (6, None),
        (7, ""),
        (8, "Licensed under CC BY-NC 4.0.\n\nReleased under the MIT License."),
    ]
    got = {r["doc_id"]: (r["licenses"], r["license_verdict"]) for r in licenses.scan(docs(rows)).collect()}
    assert got == {1: (["MIT"], "free"), 2: (["Apache-2.0"], "free"), 3: (["GPL-3.0"], "restricted"), 4: ([], "unknown"), 5: ([], "none"), 6: ([], "none"), 7: ([], "none"), 8: (["CC-BY-NC-4.0", "MIT"], "restricted")}


def test_url_rules(spark):
    cases = {
        "http://a.com/x": ("com/", "allow"),
        "http://a.com": (None, "allow"),
        "https://WWW.Example.com/en/1?q#f": ("www.example.com/en/", "allow"),
        "https://m.example.com/en/1": ("example.com/en/", "block"),
        "http://x.net/es/#a": ("net/es/", "block"),
        "http://xnet/es/": (None, "allow"),
        None: (None, "allow"),
        "no-scheme.net/es/": (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None, "z") for i, u in enumerate(cases)], "page_id long, url string, html string, verdict string")
    got = {r["url"]: (r["rule"], r["verdict"]) for r in urls.judge_pages(pages).collect()}
    assert got == cases


def test_distrust_follows_links_backwards(spark):
    bad = [(i, f"http://spam.net/es/{i}", "") for i in range(4)]
    pages = [*bad, (10, "http://farm.org/a", "<a href='http://spam.net/'>x</a>"), (11, "http://good.org/a", "<a href='//fine.org/p'>"), (12, "http://seed.com/a", "<A HREF=http://fine.org/q>"), (13, "http://fine.org/a", "")]
    got = {r["page_id"]: r for r in urls.judge_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[10]["verdict"] == "block" and got[11]["verdict"] == "allow" and got[13]["verdict"] == "allow"
    assert got[13]["trust"] > 0 and got[10]["distrust"] > 0
    none = urls.judge_pages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert none.collect() == []


WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def contaminated(rows, items):
    words = lambda t: WORD.findall((t or "").translate(LOW))
    found = {}
    for key, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9)) if w else ():
            found.setdefault(tuple(w[i : i + 10]), set()).add(key)
    sizes = {len(p) for p in found}
    out = []
    for d, t in rows:
        w, hit, own = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                p = tuple(w[i : i + n])
                if p in found:
                    hit |= set(range(i, i + n))
                    own |= found[p]
        own = sorted(str(k) for k in own if k is not None)
        out.append((d, len(w), len(hit), len(own), hashlib.sha256(",".join(own).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination(docs, spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "ÀB"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(rng.randint(8, 40))) for i in range(12)] + [(50, "w1 w2"), (51, None), (52, "?!"), (53, "The THE the"), (54, make(12)), (55, "zzz")]
    items.append((60, items[0][1]))
    rows = [(i, make(rng.randint(0, 60)) + ", " + (rng.choice(items)[1] or "").upper() if i % 2 else make(50)) for i in range(40) if i not in (51,)]
    rows += [(100, None), (101, ""), (102, "the the the the the"), (103, "w1 " * 500), (None, items[0][1]), (7, items[1][1]), (7, items[1][1]), (104, "W1-w2")]
    rows = [(d, t) for d, t in rows]
    frame = docs([(*r, 1) for r in rows], extra="n_hit long")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.digest(decontam.decontaminate(frame, table))
    assert sorted(map(tuple, got.collect()), key=str) == contaminated(rows, items)
    left = decontam.drop_contaminated(docs(rows), table).collect()
    assert sorted(map(str, (r["doc_id"] for r in left))) == sorted(str(r[0]) for r in contaminated(rows, items) if not r[5])
    assert decontam.decontaminate(docs([]), table).collect() == []
    assert not any(r["contaminated"] for r in decontam.decontaminate(docs(rows), table.limit(0)).collect())


def test_proximity(docs, spark):
    items = spark.createDataFrame([(1, "red fox jumps")], "item_id long, text string")
    found = decontam.phrases(items, "text", "item_id")
    index = decontam.build_index(docs([(1, "a red fox jumps"), (2, "fox red a jumps jumps"), (3, "red b b b b b b b b fox")]), "text", "doc_id", found.select(F.explode("terms").alias("term")).distinct())
    rare = decontam.anchors(found, index)
    assert {r["doc"] for r in decontam.starts(index, rare).collect()} == {1}
    assert {r["doc"] for r in decontam.near(index, rare, 3).collect()} == {1, 2}


def quality_counts(t):
    t = t or ""
    w = [x for x in re.split("[\\x20\\x09-\\x0d]+", t) if x]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search("[^\\x20\\x09-\\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)


def test_quality(docs, spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c\n", "\t", "é", "🙂", "#", "the ", "\x0b", "\r\n", "x y z "]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "a b c " * 4000), (904, "word")]
    rows = [(d, t, 7, "x") for d, t in rows]
    got = quality.judge(docs(rows, extra="n_words long, kept string")).collect()
    assert {r["doc_id"]: tuple(r[c] for c in (*quality.BASE, "base_failed")) for r in got} == {d: quality_counts(t) for d, t, *_ in rows}
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.judge(docs([])).collect() == []


def test_quality_keeps_labelled_documents(spark):
    got = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select(F.col("doc_id").alias("d"), "quality")
    rows = got.join(labels, F.col("doc_id") == F.col("d")).where("not base_failed").collect()
    good, poor = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good) and sum(r["kept"] for r in poor) <= 0.05 * len(poor)


def test_native_operators_run_no_python(spark):
    for name in ("op1_license_scan", "op3_url_filter", "op4_decontamination"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in os.listdir(SF):
        db.execute(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    result = db.execute(entry.LLM_ORACLES[name])
    columns = [c[0] for c in result.description]
    got = entry.LLM_QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(result.fetchall(), key=str)


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "suffix_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    base = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        sizes.append(docs.count())
    assert len(base) > sizes[0] >= sizes[1] == sizes[2] >= sizes[3] > 0
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert not any(r[5] for r in contaminated(left.items(), items))
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(left)
