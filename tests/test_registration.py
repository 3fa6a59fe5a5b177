import json

import pytest
from pyspark.sql import functions as F

from lakewarden.functions import registration as reg
from lakewarden.operators import report
from tests.helpers import one


def test_target_name(spark):
    name = reg.target_name(F.col("c"), F.col("s"), F.col("t"))
    assert one(spark, name, c="gold_dev", s="dwh", t="sales") == "uc_gold_dev_dwh_sales"
    assert one(spark, name, c="gold_dev", s=None, t="sales") is None


def test_tag_operation(spark):
    assert one(spark, reg.tag_operation(F.col("m")), m=True) == "create"
    assert one(spark, reg.tag_operation(F.col("m")), m=False) == "skip"


@pytest.mark.parametrize(
    ("registered", "conflict", "table_type", "table_format", "location_ok", "expected"),
    [
        (True, True, "VIEW", "CSV", False, ("skip", "exists")),
        (False, True, "VIEW", "CSV", False, ("conflict", "ambiguous name")),
        (False, False, "EXTERNAL", "CSV", False, ("skip", "type:EXTERNAL")),
        (False, False, None, "DELTA", True, ("skip", "type:unknown")),
        (False, False, "MANAGED", "CSV", False, ("skip", "format:CSV")),
        (False, False, "MANAGED", None, True, ("skip", "format:unknown")),
        (False, False, "MANAGED", "DELTA", False, ("skip", "location")),
        (False, False, "MANAGED", "DELTA", True, ("create", "new")),
    ],
)
def test_route(spark, registered, conflict, table_type, table_format, location_ok, expected):
    decision = reg.route(
        registered=F.col("r"),
        conflict=F.col("c"),
        table_type=F.col("t").cast("string"),
        table_format=F.col("f").cast("string"),
        location_ok=F.col("l"),
        table_types=["MANAGED"],
    )
    values = {"r": registered, "c": conflict, "t": table_type, "f": table_format, "l": location_ok}
    assert tuple(one(spark, decision, **values)) == expected


def test_request_payload(spark):
    payload = reg.request_payload(F.col("t"), F.col("l"), F.col("s"), "conn")
    text = one(spark, payload, t="uc_a_b_c", l="https://acct/gold", s="dwh/c")
    assert json.loads(text) == {
        "path": "Tables",
        "name": "uc_a_b_c",
        "target": {"adlsGen2": {"location": "https://acct/gold", "subpath": "dwh/c", "connectionId": "conn"}},
    }


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ('{"moreDetails":[{"message":"first"},{"message":"second"}]}', "first"),
        ('{"moreDetails":[]}', reg.NO_MESSAGE),
        ('{"moreDetails":[{"code":1}]}', reg.NO_MESSAGE),
        ("{}", reg.NO_MESSAGE),
        ("not json", reg.NO_MESSAGE),
        (None, reg.NO_MESSAGE),
    ],
)
def test_first_message(spark, body, expected):
    assert one(spark, reg.first_message(F.col("b").cast("string")), b=body) == expected


def test_parse_response(spark):
    body = '{"name":"uc_x","moreDetails":[{"message":"m"}],"other":1}'
    parsed = one(spark, reg.parse_response(F.col("b")), b=body)
    assert parsed.name == "uc_x"
    assert parsed.moreDetails[0].message == "m"
    assert one(spark, reg.parse_response(F.col("b")), b="not json").name is None


@pytest.mark.parametrize(
    ("status", "message", "expected"),
    [
        (200, reg.NO_MESSAGE, "created"),
        (201, reg.NO_MESSAGE, "created"),
        (400, reg.ALREADY_REGISTERED_MESSAGE, "skipped"),
        (400, reg.ALREADY_REGISTERED_MESSAGE + " ", "failed"),
        (400, f"Error: {reg.ACCESS_DENIED_TEXT} x", "denied"),
        (400, "other", "failed"),
        (403, reg.NO_MESSAGE, "denied"),
        (429, reg.NO_MESSAGE, "throttled"),
        (500, reg.ALREADY_REGISTERED_MESSAGE, "failed"),
        (None, reg.NO_MESSAGE, "failed"),
    ],
)
def test_classify_attempt(spark, status, message, expected):
    outcome = reg.classify_attempt(F.col("s").cast("int"), F.col("m"))
    assert one(spark, outcome, s=status, m=message) == expected


@pytest.mark.parametrize(
    ("status", "expected"),
    [(200, "deleted"), (404, "already_absent"), (429, "throttled"), (500, "failed"), (None, "failed")],
)
def test_classify_removal(spark, status, expected):
    assert one(spark, reg.classify_removal(F.col("s").cast("int")), s=status) == expected


def test_first_settled_attempt_decides(spark):
    rows = [
        ("a", 1, "throttled"), ("a", 2, "created"), ("a", 3, "skipped"),
        ("b", 1, "skipped"), ("b", 2, "created"),
        ("c", 1, "denied"), ("c", 2, "throttled"), ("c", 3, "failed"),
        ("d", 0, "created"),
    ]
    df = spark.createDataFrame(rows, "target string, attempt bigint, outcome string")
    assert dict(report.final_outcomes(df).collect()) == {"a": "created", "b": "skipped", "c": "failed", "d": "created"}


def test_run_counters_add_up_failures(spark):
    outcomes = ["created", "created", "skipped", "failed", "denied", "throttled", "deleted", "already_absent"]
    df = spark.createDataFrame([(outcome,) for outcome in outcomes], "outcome string")
    assert report.run_counters(df).first().asDict() == {"created": 2, "skipped": 1, "failed": 3, "deleted": 1}
