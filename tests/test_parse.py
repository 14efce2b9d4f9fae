from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salestream import sinks
from salestream.operators.aggregate import windowed_sales
from salestream.operators.parse import decode, missing_field, parse_events, split_valid_invalid
from salestream.schema import SALE_COLUMNS, wire_schema
from tests.conftest import SALES, at, plan_text, rows

DIRTY = [
    '{"id_pedido":"a","categoria":"Casa","valor":10.5,"timestamp":"2024-11-25T10:30:00.123456"}',
    '{"id_pedido":"b","categoria":"Casa","valor":"12.5","timestamp":"2024-11-25T10:30:00"}',
    '{"id_pedido":"c","categoria":"Casa"}',
    "not json",
    "",
    None,
    '{"id_pedido":null,"categoria":"Livros","valor":3,"timestamp":"2024-11-25T10:31:00","x":1}',
    '{"id_pedido":"d","categoria":"Casa","valor":1e3,"timestamp":"garbage"}',
]


@pytest.fixture
def envelope(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(DIRTY)], "n int, value string")
    return df.withColumn("value", F.col("value").cast("binary"))


def test_decode_gives_text(envelope):
    assert decode(envelope).columns == ["json_value"]
    assert rows(decode(envelope))[3] == ("not json",)


def test_every_kind_of_bad_message(envelope):
    got = rows(parse_events(envelope))
    assert got == [
        ("a", "Casa", 10.5, datetime(2024, 11, 25, 10, 30, 0, 123456)),
        ("b", "Casa", None, at("10:30:00")),
        ("c", "Casa", None, None),
        (None, None, None, None),
        (None, None, None, None),
        (None, None, None, None),
        (None, "Livros", 3.0, at("10:31:00")),
        ("d", "Casa", 1000.0, None),
    ]


def test_dirty_messages_in_windows(envelope):
    got = sorted(rows(windowed_sales(parse_events(envelope))))
    assert got == [
        (at("10:30:00"), at("10:31:00"), "Casa", 10.5, 2),
        (at("10:31:00"), at("10:32:00"), "Livros", 3.0, 0),
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-11-25T10:30:00-03:00", datetime(2024, 11, 25, 13, 30)),
        ("2024-11-25", datetime(2024, 11, 25)),
        ("", None),
    ],
)
def test_time_texts(spark, text, expected):
    df = spark.createDataFrame([(f'{{"timestamp":"{text}"}}',)], "value string")
    assert rows(parse_events(df), "event_time") == [(expected,)]


def test_keep_raw(envelope):
    assert [r[0] for r in rows(parse_events(envelope, keep_raw=True), "raw")] == DIRTY


def test_other_field_names(spark):
    df = spark.createDataFrame([('{"i":"1","c":"x","a":2.5,"t":"2024-11-25"}',)], "value string")
    names = dict(sale_id="i", category="c", amount="a", event_time="t")
    assert rows(parse_events(df, names)) == [("1", "x", 2.5, datetime(2024, 11, 25))]


def test_split_by_default_follows_the_aggregation(envelope):
    events = parse_events(envelope)
    valid, rejected = split_valid_invalid(events)
    assert valid.count() == 3 and rejected.count() == 5
    assert sorted(rows(windowed_sales(valid))) == sorted(rows(windowed_sales(events)))
    assert {r[0] for r in rows(rejected, "reject_reason")} == {"event_time"}


def test_strict_split_names_the_first_missing_field(envelope):
    valid, rejected = split_valid_invalid(parse_events(envelope, keep_raw=True), SALE_COLUMNS)
    assert rows(valid, "sale_id") == [("a",)]
    assert sorted(rows(rejected, "reject_reason", "raw"), key=str) == sorted([
        ("amount", DIRTY[1]), ("amount", DIRTY[2]), ("sale_id", DIRTY[3]), ("sale_id", DIRTY[4]),
        ("sale_id", DIRTY[5]), ("sale_id", DIRTY[6]), ("event_time", DIRTY[7]),
    ], key=str)


def test_missing_field_is_null_for_whole_events(spark):
    df = spark.createDataFrame([("1", "x", 1.0, at("10:00:00"))], SALES)
    assert rows(df.select(missing_field())) == [(None,)]


def test_messages_are_parsed_once(envelope, tmp_path):
    envelope.write.parquet(str(tmp_path / "e"))
    spark = envelope.sparkSession
    plan = plan_text(windowed_sales(parse_events(spark.read.parquet(str(tmp_path / "e")))))
    executed = plan.split("== Initial Plan ==")[-1]
    assert executed.count("from_json") == 1


ODD = [
    '{"id_pedido":"a","categoria":"Casa","valor":10.5,"timest',
    '[{"id_pedido":"a","valor":1},{"id_pedido":"b"}]',
    '{"id_pedido":{"deep":1},"categoria":["x"],"valor":true,"timestamp":20241125}',
    '{"id_pedido":"a","id_pedido":"b"}',
    '{"valor":NaN,"categoria":"x"}',
    '{"valor":1e400}',
    "{}", "[]", "null", "17", '"text"', "{'id_pedido':'single'}",
    '{"ID_PEDIDO":"case","Categoria":"x"}',
]


def test_odd_messages_parse_as_a_plain_projection_would(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "value string")
    plain = df.select(F.from_json("value", wire_schema()).alias("data")).select("data.*")
    got = parse_events(df).drop("event_time")
    assert list(map(str, rows(got))) == list(map(str, rows(plain.drop("timestamp"))))


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(
    st.tuples(
        st.one_of(st.none(), st.text(max_size=8)),
        st.one_of(st.none(), st.text(max_size=8)),
        st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
        st.one_of(st.none(), st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1))),
    ),
    min_size=1, max_size=10,
))
def test_any_sale_survives_the_round_trip(spark, sales):
    sales = [tuple(v.encode("utf-8", "replace").decode() if isinstance(v, str) else v for v in r)
             for r in sales]
    df = spark.createDataFrame(sales, SALES)
    assert rows(parse_events(sinks.to_envelope(df))) == rows(df)


def test_encode_matches_the_wire_form(spark):
    df = spark.createDataFrame(
        [
            ("a", "Casa", 10.5, datetime(2024, 11, 25, 10, 30, 0, 120000)),
            ("b", "Casa", 10.0, at("10:30:00")),
            (None, None, None, None),
        ],
        SALES,
    )
    texts = [r[0].decode() for r in rows(sinks.to_envelope(df))]
    assert texts == [
        '{"id_pedido":"a","categoria":"Casa","valor":10.5,'
        '"timestamp":"2024-11-25T10:30:00.120000"}',
        '{"id_pedido":"b","categoria":"Casa","valor":10.0,"timestamp":"2024-11-25T10:30:00"}',
        '{"id_pedido":null,"categoria":null,"valor":null,"timestamp":null}',
    ]


def test_round_trip_is_lossless(spark):
    df = spark.createDataFrame(
        [("ü\"\\\n", "Casa, █", 0.1 + 0.2, datetime(2024, 2, 29, 23, 59, 59, 999999))], SALES
    )
    assert rows(parse_events(sinks.to_envelope(df))) == rows(df)
