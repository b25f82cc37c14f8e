from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.operators import validation

GOOD = dict(transaction_id="t", amount="100.0", merchant_category="restaurant", hour_of_day="14",
            day_of_week="2", user_age="35", location_risk_score="0.2")

CASES = {
    "valid": ({}, ""),
    "optional missing": (dict(user_age=None, location_risk_score=None), ""),
    "zero amount": (dict(amount="0"), ""),
    "several rules": (dict(amount="-100", hour_of_day="25", merchant_category=None),
                      "amount:range,merchant_category:missing,hour_of_day:range"),
    "missing required": (dict(transaction_id=None, hour_of_day=None, day_of_week=None),
                         "transaction_id:missing,hour_of_day:missing,day_of_week:missing"),
    "uncastable": (dict(amount="invalid_amount"), "amount:type"),
    "out of range": (dict(amount="-100.0", hour_of_day="25", day_of_week="8"),
                     "amount:range,hour_of_day:range,day_of_week:range"),
    "nan amount": (dict(amount="NaN"), "amount:range"),
    "hour 23": (dict(hour_of_day="23"), ""),
    "hour 24": (dict(hour_of_day="24"), "hour_of_day:range"),
    "day 6": (dict(day_of_week="6"), ""),
    "day 7": (dict(day_of_week="7"), "day_of_week:range"),
    "age 120": (dict(user_age="120"), ""),
    "age 121": (dict(user_age="121"), "user_age:range"),
    "risk 1": (dict(location_risk_score="1"), ""),
    "risk 1.01": (dict(location_risk_score="1.01"), "location_risk_score:range"),
}


def _rows(spark):
    rows = [dict(GOOD, case=name, **{k: v for k, v in change.items() if k not in GOOD}) | change
            for name, (change, _) in CASES.items()]
    return spark.createDataFrame(rows, f"case string, {schemas.RAW_TRANSACTION}")


def test_every_broken_rule_is_named(spark):
    got = {r.case: (r.is_valid, ",".join(r.errors)) for r in validation.validate_transactions(_rows(spark)).collect()}
    assert got == {name: (errors == "", errors) for name, (_, errors) in CASES.items()}


def test_verdict_is_the_absence_of_errors(spark):
    rows = validation.validate_transactions(_rows(spark).unionByName(_rows(spark).drop("user_age"), True))
    assert rows.filter("is_valid <> (size(errors) = 0) or is_valid is null").count() == 0


def test_quarantine_keeps_all_rows(spark):
    valid, invalid = validation.quarantine_split(_rows(spark))
    assert valid.count() + invalid.count() == len(CASES)
    assert dict(valid.dtypes)["amount"] == "double" and dict(invalid.dtypes)["amount"] == "string"


def test_typed_frames_and_missing_columns(spark):
    typed = spark.createDataFrame([("t", float("nan"), "x", 10.0), ("t", 5.0, "x", 10.5)],
                                  "transaction_id string, amount double, merchant_category string, hour_of_day double")
    errors = [r.errors for r in validation.validate_transactions(typed).orderBy(F.col("amount").desc()).collect()]
    assert errors == [["amount:range", "day_of_week:missing"], ["hour_of_day:type", "day_of_week:missing"]]


def test_batch_guard_boundary_and_null_request(spark):
    rows = spark.range(201).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        F.when(F.col("id") < 100, "small").when(F.col("id") == 200, None).otherwise("mid").alias("request_id"))
    rows = rows.unionByName(rows.filter("request_id = 'mid'").limit(1))
    got = {r.request_id: (r.batch_size, r.accepted) for r in validation.batch_guard(rows).collect()}
    assert got == {"small": (100, True), "mid": (101, False), None: (None, False)}


def test_quality_gate_and_empty_input(spark):
    judged = spark.createDataFrame([(True,)] * 9 + [(False,)], "is_valid boolean")
    assert validation.data_quality_score(judged).first().asDict() == {"score": 0.9, "passed": True}
    assert validation.data_quality_score(judged.limit(0)).first().asDict() == {"score": None, "passed": False}


def test_payload_screen(spark):
    hostile = {"'; DROP TABLE users; --": "sql", "' OR '1'='1": "sql", "admin'; --": "sql",
               "<script>alert('xss')</script>": "script", "javascript:alert('xss')": "script",
               "<img src=x onerror=alert('xss')>": "event", "x" * 10000: "oversized",
               "grocery": "", "gas_station": "", "O'Neill and sons": ""}
    rows = spark.createDataFrame([(k,) for k in hostile], "merchant_category string")
    for row in validation.payload_screen(rows, ["merchant_category"]).collect():
        wanted = hostile[row.merchant_category]
        assert (not row.reasons) if not wanted else any(wanted in r for r in row.reasons), row


def test_safe_response_and_required_fields(spark):
    rows = spark.createDataFrame(
        [(400, "sql", None, True), (413, "sql", None, False), (413, "oversized", None, True),
         (200, "script", None, False), (None, "sql", "timeout", True)],
        "status_code int, kind string, error string, wanted boolean")
    assert all(r.safe == r.wanted for r in validation.safe_response(rows).collect())
    maps = spark.createDataFrame([({"a": "1"},), ({"a": "1", "b": "2"},)], "m map<string,string>")
    assert [r.missing for r in validation.required_fields_check(maps, "m", ["a", "b"]).collect()] == [["b"], []]


def test_event_time(spark):
    rows = spark.createDataFrame([("2024-01-01T10:00:00.5",), ("2024-01-01",), ("soon",), (None,)], "timestamp string")
    got = [(str(r.event_time), str(r.event_date)) for r in validation.parse_event_time(rows).collect()]
    assert got == [("2024-01-01 10:00:00.500000", "2024-01-01"), ("2024-01-01 00:00:00", "2024-01-01"),
                   ("None", "None"), ("None", "None")]
