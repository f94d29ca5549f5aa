"""Constraints that are enforced when rows are loaded.

A row that breaks a check or leaves a required column empty goes to quarantine with the names of all rules it breaks. Of the
rest, the first row of a key is loaded, and rows that come later, or whose key is loaded already, go to quarantine with
the name of the key. The keys of a table are settled one after the other: a row that lost one does not count for the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.rules import KEYS, row_rules
from tillhouse.session import materialize


@dataclass(frozen=True)
class Enforced:
    loaded: DataFrame
    quarantined: DataFrame  # the row, and ``broken_rules array<string>``

    def counts(self) -> DataFrame:
        """``rule, rows`` of the quarantine."""
        return self.quarantined.select(F.explode("broken_rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))


def broken_rules(table: str) -> Column:
    found = [F.when(bad, F.lit(name)) for name, bad in row_rules(table).items()]
    return F.filter(F.array(*found), lambda name: name.isNotNull()) if found else F.array().cast("array<string>")


def key_rule(key: tuple[str, ...]) -> str:
    return "unique:" + ",".join(key)


def enforce(df: DataFrame, table: str, before: DataFrame | None = None, keys: tuple[tuple[str, ...], ...] | None = None) -> Enforced:
    """Split ``df`` by the constraints of ``table``; ``before`` holds the rows that were loaded earlier.

    Rows are first in the order they are read in, which is fixed by writing them once with a number. A key with a null part
    is not compared. The winners of a key are found by an aggregate that combines before the shuffle and are told apart by
    row number, so a key that holds a large part of the table does not gather in one task.
    """
    tagged = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_broken", broken_rules(table))
    rows = materialize(tagged, f"constraints-{table}")
    lost = None
    for key in KEYS.get(table, ()) if keys is None else keys:
        whole = F.lit(True)
        for c in key:
            whole = whole & F.col(c).isNotNull()
        standing = rows.where(F.size("_broken") == 0)
        if lost is not None:
            standing = standing.join(lost.select("_row"), "_row", "left_anti")
        standing = standing.where(whole)
        # one aggregate over the rows and those loaded before says which row of a key gets in, if any
        offers = standing.select(*key, "_row", F.lit(False).alias("_taken"))
        if before is not None:
            offers = offers.unionByName(before.where(whole).select(*key, F.lit(None).cast("bigint").alias("_row"), F.lit(True).alias("_taken")))
        firsts = offers.groupBy(*key).agg(F.min("_row").alias("_first"), F.max("_taken").alias("_taken"))
        winners = firsts.where(~F.col("_taken")).select(F.col("_first").alias("_row"))
        losers = standing.select("_row").join(winners, "_row", "left_anti")
        losers = materialize(losers.select("_row", F.array(F.lit(key_rule(key))).alias("_lost")), f"losers-{table}")
        lost = losers if lost is None else lost.unionByName(losers)
    if lost is None:
        done = rows.withColumn("broken_rules", F.col("_broken"))
    else:
        done = rows.join(lost, "_row", "left").withColumn("broken_rules", F.coalesce("_lost", "_broken")).drop("_lost")
    done = done.drop("_row", "_broken")
    good = F.size("broken_rules") == 0
    return Enforced(done.where(good).drop("broken_rules"), done.where(~good))
