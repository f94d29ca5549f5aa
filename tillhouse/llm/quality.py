"""Quality rules: a table of thresholds, compiled into one projection.

Every measure is an expression over the text, every rule a row of ``RULES``: a measure, the lowest and the highest value
that passes. Nothing is shuffled and no user function runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages in use.
STOP_WORDS = (
    "the and of that with this is for "
    "der die das und ist nicht mit den "
    "le les et des est une dans pour "
    "que los las del por con una para"
).split()

SYMBOLS = "#*$%&|<>"

# Measure, lowest and highest value that passes (None: no bound).
RULES: list[tuple[str, float | None, float | None]] = [
    ("mean_word_length", 2.0, 12.0),
    ("symbols_per_word", None, 0.1),
    ("dup_line_share", None, 0.5),
    ("stop_words_found", 2, None),
    ("digit_share", None, 0.3),
    ("capital_share", None, 0.5),
    ("ellipsis_line_share", None, 0.3),
    ("bullet_line_share", None, 0.9),
]


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words which occurs twice or more in ``words``.

    Windows are compared by 64-bit hashes. Texts whose windows all differ, which are most, need no sorting.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def places(sorted_: Column) -> Column:
        twice = lambda x, k: ((k > 0) & (sorted_[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | (
            (k + 1 < F.size(sorted_)) & (sorted_[F.least(k + 1, F.size(sorted_) - 1)]["h"] == x["h"])
        )
        return F.sort_array(F.transform(F.filter(sorted_, twice), lambda x: x["i"]))

    # each window adds the words behind the end of the window before it
    def total(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
            lambda s: s["n"],
        )

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bound(ordered, lambda w: bound(places(w), total)))

    return F.when(n < 4, F.lit(0)).otherwise(bound(hashes, count))


def base_measures(text: Column, blanks: Column) -> dict[str, Column]:
    """Counts over a text; ``blanks`` is the text with one kind of white space only."""
    words = F.array_remove(F.split(blanks, " "), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "w": bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))),
        "word_chars": F.length(F.replace(blanks, F.lit(" "), F.lit(""))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "l": bound(
            lines,
            lambda x: F.struct(
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                F.size(x).alias("lines"),
                F.size(F.filter(x, lambda y: y.rlike(r"(?:\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("ellipsis"),
                F.size(F.filter(x, lambda y: y.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("bullets"),
            ),
        ),
        # a word that stands somewhere between two blanks counts once
        "stops": sum((F.contains(blanks, F.lit(f" {w} ")).cast("int") for w in STOP_WORDS), F.lit(0)),
        "digits": F.regexp_count(text, F.lit("[0-9]")).cast("long"),
        "capitals": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
    }


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("_m.w.n_words"), F.lit(1))
    lines = F.greatest(F.col("_m.l.lines"), F.lit(1))
    chars = F.greatest(F.col("_m.word_chars"), F.lit(1))
    return {
        "mean_word_length": F.col("_m.word_chars") / words,
        "symbols_per_word": F.col("_m.n_symbols") / words,
        "dup_line_share": F.col("_m.l.n_dup_lines") / lines,
        "stop_words_found": F.col("_m.stops"),
        "digit_share": F.col("_m.digits") / chars,
        "capital_share": F.col("_m.capitals") / chars,
        "ellipsis_line_share": F.col("_m.l.ellipsis") / lines,
        "bullet_line_share": F.col("_m.l.bullets") / lines,
    }


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, text: str = "text", rules: list[tuple[str, float | None, float | None]] = RULES) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``failed_rules`` (names, in the order of the table) and ``kept``.

    Columns of these names in the input are replaced. Null text counts as empty: it has no words and fails the base
    rule. Rows are judged one by one, so ties and repeated rows do not matter.
    """
    added = {*BASE, "base_failed", "failed_rules", "kept", "_m"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def measures(t: Column) -> Column:
        blanks = t
        for c in "\t\n\x0b\x0c\r":
            blanks = F.replace(blanks, F.lit(c), F.lit(" "))
        return bound(blanks, lambda b: F.struct(*[c.alias(k) for k, c in base_measures(t, b).items()]))

    # one row each, behind a generator: a filter on the verdict is not pushed below it, where it would measure again per rule
    out = docs.withColumn("_m", F.explode_outer(F.transform(F.array(source), measures)))
    base = {c: F.col(f"_m.w.{c}") for c in ("n_words", "n_repeat_words")} | {"n_dup_lines": F.col("_m.l.n_dup_lines")} | {c: F.col(f"_m.{c}") for c in ("word_chars", "n_symbols")}
    values = ratios()
    failed = []
    for name, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (values[name] < low)
        if high is not None:
            bad = bad | (values[name] > high)
        failed.append(F.when(bad, F.lit(name)))
    base_failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[base[c].alias(c) for c in BASE],
        base_failed.alias("base_failed"),
        F.array_compact(F.array(*failed)).alias("failed_rules"),
        (~base_failed & (F.size(F.array_compact(F.array(*failed))) == 0)).alias("kept"),
    )
