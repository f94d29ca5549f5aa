"""Field-level PII masking with its audit trail, and pattern scans over free text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.exprs import email_hash

# Audit record id preference and mask literals.
RECORD_ID_ORDER = ("event_id", "customer_id", "order_id", "product_id")
NAME_MASK = "MASKED_NAME"
PHONE_MASK = "MASKED_PHONE"
SUPPRESS = "suppress"

# Patterns that say what kind of personal data an address holds. They only enrich the audit text.
ADDRESS_ENTITIES = {
    "LOCATION": r"\b[0-9]+ [A-Z][A-Za-z.]*( [A-Z][A-Za-z.]*)* (St|Street|Ave|Avenue|Rd|Road|Blvd|Lane|Ln|Dr|Drive)\b|, [A-Z]{2} [0-9]{5}\b",
    "PERSON": r"\b(Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]+|\bc/o ",
}

EntityDetector = Callable[[Column], Column]


def _kinds_found(c: Column) -> list[Column]:
    """The entity kinds in their order, null where a text has none of that kind."""
    return [F.when(c.rlike(pattern), F.lit(kind)) for kind, pattern in sorted(ADDRESS_ENTITIES.items())]


def address_entities(c: Column) -> Column:
    """Sorted array of the entity kinds found in a text."""
    return F.filter(F.array(*_kinds_found(c)), lambda kind: kind.isNotNull())


def suppression_action(c: Column, detect: EntityDetector = address_entities) -> Column:
    """``suppress`` or ``suppress (entities: A, B)``.

    The patterns are matched once per text, in compiled code: they stand in one place, and not below a lambda.
    """
    kinds = _kinds_found(c) if detect is address_entities else [F.array_sort(F.array_distinct(detect(c)))]
    return F.concat(F.lit(SUPPRESS), F.regexp_replace(F.concat_ws(", ", *kinds), "^(.+)$", " (entities: $1)"))


@dataclass(frozen=True)
class MaskRule:
    """How one column is masked: its new value, new name, and the action named in the audit trail."""

    value: Callable[[Column], Column]
    action: Callable[[Column], Column]
    target: str | None = None


def _constant(text: str) -> Callable[[Column], Column]:
    return lambda c: F.when(c.isNotNull(), F.lit(text))


def mask_rules(detect: EntityDetector = address_entities) -> dict[str, MaskRule]:
    """Rules by column. The mask never depends on detection, so a miss cannot leak a value."""
    replace = lambda c: F.lit("replace")
    return {
        "customer_name": MaskRule(_constant(NAME_MASK), replace),
        "customer_email": MaskRule(email_hash, lambda c: F.lit("sha256_hash"), target="hashed_email"),
        "customer_phone": MaskRule(_constant(PHONE_MASK), replace),
        "shipping_address": MaskRule(lambda c: F.lit(None).cast("string"), lambda c: suppression_action(c, detect)),
    }


def record_id_column(columns: list[str]) -> str:
    for name in RECORD_ID_ORDER:
        if name in columns:
            return name
    raise ValueError(f"no record id column among {sorted(columns)}")


def mask_dataframe(df: DataFrame, rules: dict[str, MaskRule] | None = None) -> DataFrame:
    """Mask every column that has a rule; card columns and all others pass through."""
    record_id_column(df.columns)
    rules = rules or mask_rules()
    out = []
    for name in df.columns:
        rule = rules.get(name)
        out.append(rule.value(F.col(name)).alias(rule.target or name) if rule else F.col(name))
    return df.select(*out)


_CELL = "struct<field_name:string,masking_action:string,original_length:int>"


def audit_cells(columns: list[str], rules: dict[str, MaskRule]) -> Column:
    """Array with one entry per non-null PII value of a row; holds lengths and actions, never values."""
    none = F.array().cast(f"array<{_CELL}>")
    cells = [
        F.when(
            F.col(name).isNotNull(),
            F.array(
                F.struct(
                    F.lit(name).alias("field_name"),
                    rule.action(F.col(name)).alias("masking_action"),
                    F.length(name).alias("original_length"),
                ).cast(_CELL)
            ),
        ).otherwise(none)
        for name, rule in rules.items()
        if name in columns
    ]
    return F.concat(*cells) if cells else none


def mask_with_audit(df: DataFrame, rules: dict[str, MaskRule] | None = None) -> DataFrame:
    """The masked table with its audit cells in ``_pii``: one pass serves the table and the audit log."""
    rules = rules or mask_rules()
    tagged = df.withColumn("_pii", audit_cells(df.columns, rules))
    return mask_dataframe(tagged, rules)


def audit_rows_of(masked: DataFrame, run_id: str | Column, masked_at: Column | None = None) -> DataFrame:
    """The audit log of a table from ``mask_with_audit``."""
    event_id = F.col("event_id") if "event_id" in masked.columns else F.lit(None).cast("string")
    base = masked.select(
        F.col(record_id_column(masked.columns)).cast("string").alias("record_id"),
        event_id.alias("event_id"),
        (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("pipeline_run_id"),
        (F.current_timestamp() if masked_at is None else masked_at).alias("masked_at"),
        F.explode("_pii").alias("cell"),
    )
    return base.select("record_id", "event_id", "cell.*", "pipeline_run_id", "masked_at")


def pii_audit_rows(
    df: DataFrame, run_id: str | Column, masked_at: Column | None = None, rules: dict[str, MaskRule] | None = None
) -> DataFrame:
    """One audit row per non-null PII value of the unmasked table, in a single pass over it."""
    return audit_rows_of(df.withColumn("_pii", audit_cells(df.columns, rules or mask_rules())), run_id, masked_at)


def masked_count(audit: DataFrame) -> DataFrame:
    """(field_name, masked_values)."""
    return audit.groupBy("field_name").agg(F.count("*").alias("masked_values"))


# Patterns for personal data in free text. They use neither look-around nor word boundaries, so that they
# mean the same in every regex engine. An address starts where its run of characters starts, so that long junk stays cheap;
# what stands before it is the first group. Letters outside ASCII belong to the run.
TEXT_PATTERNS = {
    "email": r"(^|[\x00-\x24\x26-\x2A\x2C\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F])[^\x00-\x24\x26-\x2A\x2C\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"[0-9]{4,}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4,}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{4,5}|[0-9]{13,}",
    "phone": r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}",
}
TEXT_MASKS = {"email": "[EMAIL]", "card": "[CARD]", "phone": "[PHONE]"}
# A cheap test that holds for every text with a match, so that the pattern runs on few texts.
_HINTS = {
    "email": lambda c: c.contains("@"),
    "card": lambda c: c.rlike("[0-9]{4}[ -]?[0-9]{4}"),
    "phone": lambda c: c.rlike("[0-9]{3}[ .-][0-9]{4}"),
}


def scan_text(df: DataFrame, id_column: str, text: str = "text") -> DataFrame:
    """Counts of each kind of personal data per row of whole text."""
    c = F.col(text)
    none = F.when(c.isNotNull(), 0)
    counts = [
        F.when(_HINTS[kind](c), F.regexp_count(c, F.lit(pattern))).otherwise(none).cast("bigint").alias(f"{kind}_count")
        for kind, pattern in TEXT_PATTERNS.items()
    ]
    return df.select(id_column, *counts)


def redact_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every match with its mask, e-mail first, then cards, then phones."""
    out = df
    for kind, pattern in TEXT_PATTERNS.items():
        c = F.col(text)
        out = out.withColumn(text, F.when(_HINTS[kind](c), F.regexp_replace(c, pattern, ("$1" if kind == "email" else "") + TEXT_MASKS[kind])).otherwise(c))
    return out
