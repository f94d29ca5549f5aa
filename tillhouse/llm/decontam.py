"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (term, document, position) for every word of the corpus that also occurs in the test set; it is
written once. A phrase starts from its rarest term: its postings, shifted by the term's offset in the phrase, are the possible
starts. They are intersected with the shifted postings of the second rarest term, and what is left is compared with the
whole phrase at the document. Everything is joins and built-in functions. A term may hold a large part of all postings, so joins by
term are split: postings by document, phrases by themselves, each over ``PARTS`` parts of every term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.quality import bound
from tillhouse.session import materialize

WINDOW = 10
PARTS = 16
LENGTH = " "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed value: what stands between two words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged. ``lower`` does the same, and faster, where no other capital letter stands."""
    other_capitals = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]"
    return F.when(text.rlike(other_capitals), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """Words of a text, with A-Z lower-cased; none for null."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), BETWEEN), ""), F.array().cast("array<string>"))


def phrases(items: DataFrame, text: str, item_id: str, width: int = WINDOW) -> DataFrame:
    """Distinct windows of ``width`` words of the items (a shorter item is one window): ``phrase, n, terms, items``."""
    tokens = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    first = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))
    cut = tokens.select("item", F.explode(F.transform(first, lambda i: F.slice("w", i + 1, width))).alias("terms"))
    distinct = cut.groupBy("terms").agg(F.collect_set("item").alias("items"))
    return distinct.select(F.sha2(F.array_join("terms", " "), 256).alias("phrase"), F.size("terms").alias("n"), "terms", "items")


def build_index(docs: DataFrame, text: str, doc_id: str, wanted: DataFrame) -> DataFrame:
    """Postings ``term, doc, sig, pos`` of the terms of ``wanted`` (distinct), stored in the shared folder.

    ``sig`` is a hash of the text, so that rows with the same id and different texts stay apart. Every document also
    has a posting of ``LENGTH``, which is no word, at the position behind its last word.
    """
    terms = bound(words(F.col(text)), lambda w: F.array_append(w, F.lit(LENGTH)))
    rows = docs.select(F.col(doc_id).alias("doc"), signature(F.col(text)).alias("sig"), F.posexplode(terms).alias("pos", "term"))
    wanted = wanted.unionByName(docs.sparkSession.sql(f"select '{LENGTH}' as term"))
    return materialize(rows.join(wanted, "term", "left_semi"), "postings")


def signature(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def part_of(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS)).cast("int")


def in_all_parts(df: DataFrame) -> DataFrame:
    """A row per part, for the side of a join that has few rows of a term."""
    return df.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def anchors(found: DataFrame, index: DataFrame) -> DataFrame:
    """Phrases with their two rarest terms: ``t1, o1`` and ``t2, o2`` (the same, where a phrase has one word).

    The offset breaks ties. A phrase with a term that the corpus lacks occurs nowhere and is left out.
    """
    frequency = index.groupBy("term").agg(F.count("*").alias("f"))
    terms = found.select("phrase", "n", F.posexplode("terms").alias("o", "term")).withColumn("part", part_of("phrase", "o"))
    terms = terms.join(in_all_parts(frequency), ["term", "part"])
    ranked = terms.groupBy("phrase", "n").agg(F.sort_array(F.collect_list(F.struct("f", "o", "term"))).alias("r")).where(F.size("r") == F.col("n"))
    second = F.least(F.lit(2), F.size("r"))
    return ranked.select(
        "phrase", "n", F.col("r")[0]["term"].alias("t1"), F.col("r")[0]["o"].alias("o1"), F.element_at("r", second)["term"].alias("t2"), F.element_at("r", second)["o"].alias("o2")
    )


def starts(index: DataFrame, rare: DataFrame) -> DataFrame:
    """Places ``phrase, doc, sig, start`` where both anchors stand at their offsets.

    Most postings are of terms that anchor no phrase; they are left out before anything is shuffled.
    """
    terms = rare.select(F.explode(F.array("t1", "t2")).alias("term")).distinct()
    dealt = materialize(index.join(terms, "term", "left_semi"), "anchored").withColumn("part", part_of("sig", "doc"))
    first = dealt.join(in_all_parts(rare.withColumnRenamed("t1", "term")), ["term", "part"])
    first = first.select("phrase", "t2", "o2", "doc", "sig", (F.col("pos") - F.col("o1")).alias("start")).where("start >= 0")
    other = dealt.join(in_all_parts(rare.select(F.col("t2").alias("term")).distinct()), ["term", "part"], "left_semi")
    other = other.select(F.col("term").alias("t"), F.col("doc").alias("d"), F.col("sig").alias("s"), F.col("pos").alias("p")).distinct()
    both = first.join(other, (F.col("t2") == F.col("t")) & (F.col("sig") == F.col("s")) & F.col("doc").eqNullSafe(F.col("d")) & (F.col("start") + F.col("o2") == F.col("p")))
    return both.select("phrase", "doc", "sig", "start")


def near(index: DataFrame, rare: DataFrame, slop: int) -> DataFrame:
    """Proximity matches ``phrase, doc, sig, start``: the second anchor at most ``slop`` words from its place behind the first."""
    first = index.join(rare, index.term == rare.t1).select("phrase", "t2", "o2", "doc", "sig", (F.col("pos") - F.col("o1")).alias("start"))
    other = index.select(F.col("term").alias("t"), F.col("doc").alias("d"), F.col("sig").alias("s"), F.col("pos").alias("p"))
    # neighbouring cells of the position, so that the join has equal keys; each pair meets in one of them
    cell = lambda c: F.floor(c / F.lit(slop + 1))
    first = first.withColumn("cell", F.explode(F.array(*[cell(F.col("start") + F.col("o2")) + d for d in (-1, 0, 1)])))
    close = F.abs(F.col("p") - F.col("start") - F.col("o2")) <= slop
    both = first.join(other.withColumn("c", cell(F.col("p"))), (F.col("t2") == F.col("t")) & (F.col("sig") == F.col("s")) & F.col("doc").eqNullSafe(F.col("d")) & (F.col("cell") == F.col("c")) & close)
    return both.select("phrase", "doc", "sig", "start").distinct()


def confirmed(tokens: Column, candidates: Column) -> Column:
    """Candidates ``start, n, terms, items`` whose terms stand in the document, as ``start, stop, items``, in order of start."""
    fits = F.filter(candidates, lambda c: F.slice(tokens, c["start"] + 1, c["n"]) == c["terms"])
    return F.array_sort(F.transform(fits, lambda c: F.struct(c["start"].alias("start"), (c["start"] + c["n"]).alias("stop"), c["items"].alias("items"))))


def covered(matches: Column) -> Column:
    """Words inside the union of the matches, which are ordered by start."""
    return F.aggregate(
        matches,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, m: F.struct((s["n"] + F.greatest(F.lit(0), m["stop"] - F.greatest(m["start"], s["end"]))).alias("n"), F.greatest(s["end"], m["stop"]).alias("end")),
        lambda s: s["n"],
    )


RESULT = ("n_words", "n_hit", "n_items", "item_ids", "items_sha256", "contaminated")


def hits(docs: DataFrame, items: DataFrame, text: str, doc_id: str, item_text: str, item_id: str, width: int) -> tuple[DataFrame, DataFrame]:
    """The index, and ``doc, sig, n_hit, item_ids`` of every document with a window of the items (stored)."""
    found = materialize(phrases(items, item_text, item_id, width), "phrases")
    index = build_index(docs, text, doc_id, found.select(F.explode("terms").alias("term")).distinct())
    rare = materialize(anchors(found, index), "anchors")
    places = materialize(starts(index, rare), "places")
    # only documents with a possible start are read again
    wanted = materialize(places.select(F.col("doc").alias("_d"), F.col("sig").alias("_s")).distinct(), "candidates")
    texts = docs.select(F.col(doc_id).alias("_doc"), signature(F.col(text)).alias("_sig"), F.col(text).alias("_text"))
    texts = texts.join(wanted, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_sig") == F.col("_s")), "left_semi")
    by_doc = places.join(found, "phrase").groupBy("doc", "sig").agg(F.collect_set(F.struct(F.col("start").cast("int").alias("start"), "n", "terms", "items")).alias("found"))
    read = texts.join(by_doc, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_sig") == F.col("sig")))

    def conclude(m: Column) -> Column:
        ids = F.array_sort(F.array_distinct(F.flatten(F.transform(m, lambda x: x["items"]))))
        return F.struct(covered(m).cast("long").alias("n_hit"), ids.alias("item_ids"))

    result = bound(words(F.col("_text")), lambda w: bound(confirmed(w, F.col("found")), conclude))
    return index, materialize(read.select("doc", "sig", result.alias("r")).select("doc", "sig", "r.*").where("n_hit > 0").distinct(), "hits")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", width: int = WINDOW) -> DataFrame:
    """``docs`` without its text, with ``n_words, n_hit`` (words inside an occurrence of a window), ``n_items, item_ids`` (sorted
    as text), ``items_sha256`` and ``contaminated``; columns of these names are replaced.

    Null texts have no words and are never hit; items without words have no windows. Rows that share an id, also a null one,
    are each judged on their own text. A null item id has no name: it counts as hit but not as an item.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {*RESULT, "_d", "_s", "_sig"}])
    index, found = hits(docs, items, text, doc_id, item_text, item_id, width)
    counts = index.where(F.col("term") == LENGTH).groupBy("doc", "sig").agg(F.max("pos").cast("long").alias("n_words"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    found = found.withColumnsRenamed({"doc": "_hd", "sig": "_hs"})
    both = counts.join(found, F.col("doc").eqNullSafe(F.col("_hd")) & (F.col("sig") == F.col("_hs")), "left").select(
        F.col("doc").alias("_d"),
        F.col("sig").alias("_s"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("item_ids"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
    rows = docs.withColumn("_sig", signature(F.col(f"`{text}`"))).drop(text)
    joined = rows.join(both, F.col(f"`{doc_id}`").eqNullSafe(F.col("_d")) & (F.col("_sig") == F.col("_s")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], *RESULT)


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that no window of the items hits."""
    _, found = hits(docs, items, text, doc_id, item_text, item_id, width)
    found = found.select(F.col("doc").alias("_hd"), F.col("sig").alias("_hs"))
    return docs.join(found, F.col(f"`{doc_id}`").eqNullSafe(F.col("_hd")) & (signature(F.col(f"`{text}`")) == F.col("_hs")), "left_anti")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
