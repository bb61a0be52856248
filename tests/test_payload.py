import json

import pytest
from pyspark.sql import functions as F

from changefeed.functions.payload import decode_event, new_image, typed_attribute, unpack_records
from changefeed.functions.sequence import norm_seq
from changefeed.functions.times import arrival_epoch, arrival_timestamp
from changefeed.schema import event_schema

# The item of the tests of any such feed: a number and a string, change struct named at will.
EVENT = event_schema(image={"id": "N", "n": "S"}, keys={"id": "N"}, body="streamRecord")


def document(n):
    change = {
        "ApproximateCreationDateTime": 1,
        "Keys": {"id": {"N": n}},
        "NewImage": {"id": {"N": n}, "n": {"S": n}},
        "SequenceNumber": "1",
        "SizeBytes": 3,
        "StreamViewType": "NEW_AND_OLD_IMAGES",
    }
    return json.dumps({"awsRegion": "r", "streamRecord": change, "eventID": "e"}).encode()


def test_new_image_path_and_number(spark):
    rows = spark.createDataFrame([(document(str(n)),) for n in range(1, 6)], "data binary")
    decoded = decode_event(rows, EVENT)
    text = decoded.select(new_image("n", "S", body="streamRecord").alias("n"))
    assert sorted(r.n for r in text.collect()) == ["1", "2", "3", "4", "5"]
    number = decoded.select(typed_attribute("n", "S", "int", body="streamRecord").alias("n"))
    assert sorted(r.n for r in number.collect()) == [1, 2, 3, 4, 5]


def test_bad_number_is_null_or_fails(spark):
    rows = decode_event(spark.createDataFrame([(document("x"),)], "data binary"), EVENT)
    lenient = typed_attribute("n", "S", "int", body="streamRecord")
    assert rows.select(lenient.alias("n")).first().n is None
    strict = typed_attribute("n", "S", "int", body="streamRecord", strict=True)
    with pytest.raises(Exception, match="attribute n is not int: x"):
        rows.select(strict.alias("n")).collect()


def test_text_that_is_no_document_is_null(spark):
    rows = decode_event(spark.createDataFrame([(b"\x00\x01",), (None,)], "data binary"), EVENT)
    values = rows.select(new_image("n", "S", body="streamRecord").alias("n")).collect()
    assert [r.n for r in values] == [None, None]


def test_unpack(spark):
    rows = spark.createDataFrame(
        [(1, b'[{"a":1},{"a":[2,3]}]'), (2, b'{"a":4}'), (3, b"[]"), (4, b"plain"), (5, b' ["x"]')],
        "id int, data binary",
    )
    got = unpack_records(rows)
    assert got.columns == ["data", "id", "subSequence"]
    found = sorted((r.id, r.subSequence, bytes(r.data)) for r in got.collect())
    assert found == [
        (1, 0, b'{"a":1}'),
        (1, 1, b'{"a":[2,3]}'),
        (2, 0, b'{"a":4}'),
        (3, 0, b"[]"),
        (4, 0, b"plain"),
        (5, 0, b"x"),
    ]


def test_times_and_sequence(spark):
    row = spark.range(1).select(
        arrival_epoch(arrival_timestamp(F.lit(1_704_067_200_999))).alias("s"),
        arrival_epoch(arrival_timestamp(F.lit(-1))).alias("before"),
        (norm_seq(F.lit("9")) < norm_seq(F.lit("10"))).alias("ordered"),
    ).first()
    assert (row.s, row.before, row.ordered) == (1_704_067_200, -1, True)


def test_null_part_stays_null(spark):
    rows = unpack_records(spark.createDataFrame([(b'["a",null]',), (b"[]",), (None,)], "data binary"))
    found = sorted(((r["subSequence"], r["data"] and bytes(r["data"])) for r in rows.collect()), key=repr)
    assert found == sorted([(0, b"a"), (1, None), (0, b"[]"), (0, None)], key=repr)
