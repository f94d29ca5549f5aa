"""Table tests: each returns the failing rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- generic tests --------------------------------------------------------------------------------


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def test_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Repeated keys with their number of rows; a key with a null part is not tested."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(present).groupBy(*columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def test_accepted_values(df: DataFrame, column: str, *allowed: object) -> DataFrame:
    """Values outside the list with their number of rows."""
    outside = df.where(~F.col(column).isin(*allowed))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def test_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key is set but unknown to the parent."""
    keys = parent.select(F.col(field).alias("_parent_key")).distinct()  # a frequent key is sent once
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


# pytest must not collect these as tests when a test module imports them
for _test in (test_not_null, test_unique, test_accepted_values, test_relationships):
    _test.__test__ = False


# --- singular tests -------------------------------------------------------------------------------


def assert_gmv_positive(fact_orders: DataFrame) -> DataFrame:
    """Orders that were not returned but bring no money."""
    return fact_orders.where((F.col("status") != "returned") & (F.col("order_amount") <= 0))


def assert_reorder_matches(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Snapshots whose reorder threshold differs from the catalog's."""
    catalog = products.select("product_id", F.col("reorder_threshold").alias("catalog_threshold"))
    differs = F.col("reorder_threshold") != F.col("catalog_threshold")
    return inventory.join(catalog, "product_id").where(differs).select("product_id")


def assert_no_future_orders(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    return orders.where(F.col("order_date") > today)


def assert_amount_matches(orders: DataFrame) -> DataFrame:
    """Orders more than a cent away from quantity times unit price."""
    expected = F.round(F.col("quantity") * F.col("unit_price"), 2)
    return orders.where(F.abs(F.col("order_amount") - expected) > F.lit("0.01").cast("decimal(3,2)"))


# --- staging constraints --------------------------------------------------------------------------

# Required columns, keys and checks of the staging tables.
REQUIRED_COLUMNS = {
    "customers": ("customer_id",),
    "products": ("product_id", "sku"),
    "orders": ("order_line_id", "order_id", "customer_id", "product_id", "quantity", "order_amount", "order_date", "order_status"),
    "inventory": ("snapshot_date", "product_id", "quantity_on_hand", "warehouse_region"),
    "events": ("event_id", "event_type", "event_timestamp"),
}
KEYS = {
    "customers": (("customer_id",),),
    "products": (("product_id",), ("sku",)),
    "orders": (("order_line_id",),),
    "inventory": (("snapshot_date", "product_id", "warehouse_region"),),
    "events": (("event_id",),),
}
CHECKS = {
    "orders": {"quantity_positive": "quantity > 0", "order_amount_in_range": "order_amount BETWEEN 0.01 AND 50000"},
    "run_log": {"status_known": "status IN ('running', 'success', 'failed')"},
}


def row_rules(table: str) -> dict[str, Column]:
    """Rule name to violation. A check whose value is null passes, as in SQL."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in REQUIRED_COLUMNS.get(table, ())}
    rules |= {f"check:{name}": ~F.expr(test) for name, test in CHECKS.get(table, {}).items()}
    return rules


def split_by_constraints(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that hold all row constraints, rows that do not with the names of the broken ones)."""
    broken = F.filter(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in row_rules(table).items()]), lambda name: name.isNotNull()
    )
    tagged = df.withColumn("broken_rules", broken)
    return tagged.where(F.size("broken_rules") == 0).drop("broken_rules"), tagged.where(F.size("broken_rules") > 0)


def staging_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, constraint_name, violations) for every row constraint and key of the tables."""
    parts = []
    for name, df in tables.items():
        rules = row_rules(name)
        if rules:
            counted = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
            rows = [F.struct(F.lit(rule).alias("constraint_name"), F.col(f"`{rule}`").alias("violations")) for rule in rules]
            parts.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
        for key in KEYS.get(name, ()):
            repeated = test_unique(df, *key).agg(F.count("*").alias("violations"))
            label = F.lit("unique:" + ",".join(key)).alias("constraint_name")
            parts.append(repeated.select(F.lit(name).alias("table_name"), label, "violations"))
    return reduce(DataFrame.unionByName, parts)


# --- a whole suite of table tests -----------------------------------------------------------------


def run_table_tests(
    tables: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]],
    keys: Mapping[str, Sequence[str]],
    domains: Mapping[str, Mapping[str, Sequence[object]]],
    references: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """(table_name, test_name, column_name, failures) for every declared test.

    Null and domain tests of a table share one pass; every key and every reference adds one.
    """
    parts = []
    for name, df in tables.items():
        tests = [("not_null", c, F.col(c).isNull()) for c in required.get(name, ())]
        tests += [("accepted_values", c, ~F.col(c).isin(*allowed)) for c, allowed in domains.get(name, {}).items()]
        if tests:
            counted = df.agg(*[F.count_if(bad).alias(f"_t{i}") for i, (_, _, bad) in enumerate(tests)])
            rows = [
                F.struct(F.lit(test).alias("test_name"), F.lit(c).alias("column_name"), F.col(f"_t{i}").alias("failures"))
                for i, (test, c, _) in enumerate(tests)
            ]
            parts.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
        for c in keys.get(name, ()):
            parts.append(_failures(test_unique(df, c), name, "unique", c))
    for child, column, parent, field in references:
        parts.append(_failures(test_relationships(tables[child], column, tables[parent], field), child, "relationships", column))
    return reduce(DataFrame.unionByName, parts)


def _failures(failing: DataFrame, table: str, test: str, column: str) -> DataFrame:
    return failing.agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(test).alias("test_name"), F.lit(column).alias("column_name"), "failures"
    )
