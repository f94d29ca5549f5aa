"""What of the index takes part in the joins that look for places of phrases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.llm import decontam


def test_postings_of_other_terms_are_left_out_before_the_joins(docs, spark, monkeypatch):
    stored = {}

    def keep(frame, label, **options):
        stored[label] = materialize(frame, label, **options)
        return stored[label]

    materialize = decontam.materialize
    items = spark.createDataFrame([(1, "red fox the the jumps")], "item_id long, text string")
    frame = docs([(1, "the a red fox the the jumps the"), (2, "the the the fox red jumps"), (None, "red fox the the jumps"), (3, "the " * 90)])
    found = decontam.phrases(items, "text", "item_id")
    index = decontam.build_index(frame, "text", "doc_id", found.select(F.explode("terms").alias("term")).distinct())
    rare = decontam.anchors(found, index)
    monkeypatch.setattr(decontam, "materialize", keep)
    places = decontam.starts(index, rare).collect()
    assert sorted(((r["doc"], r["start"]) for r in places), key=str) == [(1, 2), (None, 0)]
    assert index.where("term = 'the'").count() > 90
    assert {r["term"] for r in stored["anchored"].collect()} == {rare.first()["t1"], rare.first()["t2"]}
    assert stored["anchored"].count() == 6
