from __future__ import annotations

import json

from pyspark.sql import functions as F

from collected import rows
from tillhouse.operators import ingest

GOOD = {"event_id": "e1", "event_type": "order_placed", "event_timestamp": "2024-01-15T10:00:00.000Z", "quantity": 2, "order_amount": 21.0}


def message(**changes):
    return json.dumps(GOOD | changes)


def reasons(spark, *texts):
    parsed = ingest.parse_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    found = {r["raw_value"]: r["reject_reason"] for r in parsed.collect()}
    return [found[t] for t in texts]


def test_contract(spark):
    assert reasons(
        spark,
        message(),
        message(quantity=2.0, order_amount=3, customer_id=None),
        message(extra={"order_id": 5}),
        '{"event_id": "e1"',
        "[1]",
        "",
        None,
        message(event_id=None),
        message(event_type="price_changed"),
        message(event_id=5),
        message(status=True),
        message(quantity="2"),
        message(quantity=2.5),
        message(order_amount="1"),
        message(customer_name='says "order_id": 5'),
    ) == [
        None, None, None, "malformed", "malformed", "malformed", "malformed", "missing:event_id", "unknown:event_type",
        "type:event_id", "type:status", "type:quantity", "type:quantity", "type:order_amount", None,
    ]


def test_values_survive(spark):
    parsed = ingest.parse_events(spark.createDataFrame([(message(quantity=2.0, unit_price=10.5),)], "value string"))
    row = ingest.accepted(parsed).first()
    assert (row["event_id"], row["quantity"], row["unit_price"], row["order_amount"]) == ("e1", 2, 10.5, 21.0)
    assert "reject_reason" not in row.asDict()


def test_every_message_is_accepted_or_quarantined(spark):
    texts = [message(), message(event_type="x"), "{", message(event_id="e2")]
    parsed = ingest.parse_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert ingest.accepted(parsed).count() + ingest.quarantined(parsed).count() == 4
    assert rows(ingest.ingest_metrics(parsed)) == [("order_placed", 2, 0), ("unknown", 0, 2)]


def test_filter_is_not_pushed_into_the_parser(spark):
    parsed = ingest.quarantined(ingest.parse_events(spark.createDataFrame([("{}",)], "value string")))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 2


def test_event_day(spark, frame):
    df = frame(
        "event_type string, event_timestamp string",
        ("a", "2024-01-15T23:30:00+05:00"), (None, "2024-02-30T00:00:00Z"), ("b", None), ("c", "nonsense"), ("d", "2024-01-16"),
    )
    got = ingest.with_bronze_partition(df, today=F.lit("2020-01-01").cast("date"))
    assert [(r[0], str(r[2])) for r in got.collect()] == [
        ("a", "2024-01-15"), ("unknown", "2020-01-01"), ("b", "2020-01-01"), ("c", "2020-01-01"), ("d", "2024-01-16"),
    ]


def test_pin_event_date(spark, frame):
    df = frame("id string, t string", ("a", "2024-05-01T13:14:15.678Z")).select("id", F.try_to_timestamp("t").alias("event_timestamp"))
    got = ingest.pin_event_date(df, "2024-02-29").select(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    assert got == "2024-02-29 13:14:15.678"
