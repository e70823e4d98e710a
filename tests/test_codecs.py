"""Decoding is permissive; bad rows are kept and split off, never silently lost."""

from pyspark.sql import functions as F

from actiflow.functions import codecs
from actiflow.operators.enrich import parse_event_time
from actiflow.schemas import EVENT_FIELDS

GOOD = ('{"event_id":"evt-000001","event_time":"2024-01-01T10:00:00Z","customer_id":77001,'
        '"gender":"Female","age":61,"city":"Springfield","membership_type":"Gold",'
        '"total_spend":305.75,"items_purchased":3,"average_rating":2.5,'
        '"discount_applied":true,"days_since_last_purchase":4,"satisfaction_level":"Neutral"}')


def bad_records():
    return [
        GOOD,
        "this is not json",
        "",
        GOOD.replace('"event_id":"evt-000001",', ""),
        GOOD.replace('"customer_id":77001', '"customer_id":"abc"'),
        GOOD.replace("2024-01-01T10:00:00Z", "nope"),
        GOOD.replace('"discount_applied":true', '"discount_applied":"true"'),
        GOOD.replace('}', ',"extra":1}'),
    ]


def decoded(spark):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(bad_records())],
                                  "offset long, value string")
    out = codecs.decode_json(frame.withColumn("value", F.col("value").cast("binary")),
                             keep=["offset"])
    return out.withColumn("event_time", parse_event_time("event_time"))


def test_bad_records_are_kept_and_classified(spark):
    rows = {r["offset"]: r for r in codecs.with_validity(decoded(spark)).collect()}
    assert len(rows) == 8
    assert rows[0]["reject_reason"] is None
    assert rows[1]["reject_reason"] == "missing event_id"
    assert rows[2]["reject_reason"] == "missing event_id"
    assert rows[3]["reject_reason"] == "missing event_id"
    assert rows[4]["reject_reason"] == "missing customer_id"
    assert rows[4]["city"] == "Springfield"          # other fields survive one bad field
    assert rows[5]["reject_reason"] == "missing event_time"
    assert rows[6]["reject_reason"] is None and rows[6]["discount_applied"] is None
    assert rows[7]["reject_reason"] is None        # unknown fields are ignored


def test_split_valid_partitions_all_rows(spark):
    valid, rejects = codecs.split_valid(decoded(spark))
    assert valid.count() + rejects.count() == 8
    assert valid.count() == 3


def test_json_round_trip(spark):
    src = decoded(spark).filter(F.col("offset") == 0).select(*EVENT_FIELDS)
    back = codecs.decode_json(codecs.encode_json(src))
    back = back.withColumn("event_time", parse_event_time("event_time"))
    assert back.collect() == src.collect()


def test_csv_message_reads_python_booleans(spark):
    lines = [("5001,Male,44,Shelbyville,Silver,99.5,2,3.25,True,7,Neutral",),
             ("5002,Female,,Ogdenville,Bronze,12.25,1,1.5,False,90,Unsatisfied",)]
    out = codecs.decode_csv(spark.createDataFrame(lines, "value string")).collect()
    assert out[0]["discount_applied"] is True and out[1]["discount_applied"] is False
    assert out[1]["age"] is None
    assert abs(out[0]["total_spend"] - 99.5) < 1e-4   # FLOAT, as declared


def test_csv_text_null_fields_are_empty(spark):
    df = spark.createDataFrame([(1, None, True)], "customer_id int, gender string, flag boolean")
    assert df.select(codecs.csv_text(df, ["customer_id", "gender", "flag"])).first()[0] == "1,,true"
