import json
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

import clickstream as cs
from tests.conftest import rows

D = Decimal


def test_empty_openid_is_a_visitor(records):
    log = records({"openid": ""}, {"openid": ""}, {"openid": None}, {})
    assert rows(cs.pv_uv(log)) == [(2, 1)]


def test_traffic_report(spark, records):
    log = records({"openid": "a"}, {"openid": "a"}, {"openid": "b"}, {})
    fixed = datetime(2024, 1, 1, 12)
    assert rows(cs.traffic_report(log, fixed)) == [(fixed, 3, 2)]
    assert cs.traffic_report(log).first().report_time.year >= 2024
    # The view is there for the user's own SQL, and a second report replaces it.
    assert spark.sql("SELECT count(*) FROM access_log").first()[0] == 4


def test_visits_of_no_lines(spark):
    none = spark.createDataFrame([], "value string")
    expected = cs.pv_uv_raw(none)
    assert cs.pv_uv_raw_of(cs.visits(none)).first() == expected.first()
    assert cs.pv_uv_raw_of(cs.visits(none)).dtypes == expected.dtypes


def test_area_distribution(records):
    asia = {"openid": "a", "province": "ASIA", "city": "X"}
    log = records(asia, asia, {**asia, "openid": "b"}, {**asia, "openid": None}, {"openid": "a"})
    assert rows(cs.area_distribution(log)) == sorted(
        [("a", "ASIA", "X", 2), ("b", "ASIA", "X", 1), ("a", None, None, 1)], key=repr
    )
    assert rows(cs.area_distribution(log, by=("province", "city"))) == [
        ("ASIA", "X", 3),
        (None, None, 1),
    ]


def test_visitor_provinces(records):
    log = records(
        {"openid": "b", "province": "P"},
        {"openid": "b", "province": "P"},
        {"openid": "a"},
        {"openid": "a", "province": "Q"},
        {"province": "R"},
    )
    pairs = [("a", None), ("a", "Q"), ("b", "P")]
    assert rows(cs.visitor_provinces(log)) == sorted(pairs, key=repr)
    assert [tuple(r) for r in cs.visitor_provinces(log, 2).collect()] == pairs[:2]


def test_with_category(spark, records):
    log = records(*[{"openid": "u", "cid": c} for c in ("1", "4", "9", None)])
    assert rows(cs.with_category(log), "cid", "category") == sorted(
        [("1", "books"), ("4", "phones"), ("9", "unknown"), (None, "unknown")], key=repr
    )
    chinese = cs.with_category(log, cs.category_dim(spark, "zh"))
    labels = Counter(r.category for r in chinese.collect())
    assert labels == {"图书": 1, "手机": 1, "unknown": 2}


def test_ambiguous_dim_does_not_multiply_rows(spark, records):
    dim = spark.createDataFrame([("1", "b"), ("1", "a")], "cid string, category string")
    assert rows(cs.with_category(records({"cid": "1"}), dim), "category") == [("a",)]


def test_dim_of_a_caller_is_not_broadcast_by_force(spark, records):
    dim = spark.range(10).selectExpr("cast(id AS string) cid", "concat('c', id) category")
    joined = cs.with_category(records({"cid": "1"}, {"cid": "77"}), dim)
    assert "strategy=broadcast" not in joined._jdf.queryExecution().analyzed().toString()
    assert rows(joined, "cid", "category") == [("1", "c1"), ("77", "unknown")]


def view(cid, pid, n=1, **more):
    return [{"openid": "u", "event_type": 1, "cid": cid, "pid": pid, **more}] * n


def test_category_product_views(records):
    log = records(
        *view("1", "x", 3),
        *view("8", "y", 1),
        *view("9", "y", 2),  # a second foreign code: same label, same product
        *view("1", "x", event_type=2),
        *view("1", "x", openid=None),
        *view(None, "x"),
    )
    assert rows(cs.category_product_views(log)) == [("books", "x", 3), ("unknown", "y", 3)]


def test_top_products_ties(records):
    log = records(*view("1", "b", 2), *view("1", "c", 2), *view("1", "a", 2), *view("2", "z"))
    best = [("books", "a", 2, 1), ("books", "b", 2, 2), ("clothing", "z", 1, 1)]
    assert rows(cs.top_products(log)) == best
    assert len(rows(cs.top_products(log, n=5000))) == 4


@pytest.mark.parametrize("n", [1, 3, 4, 5, 100])
def test_top_products_of_many(records, n):
    products = [(f"p{i:02}", 1 + i % 4) for i in range(20)]
    log = records(*[v for pid, count in products for v in view("1", pid, count)])
    best = sorted(products, key=lambda p: (-p[1], p[0]))[:n]
    expected = [("books", pid, count, rank) for rank, (pid, count) in enumerate(best, 1)]
    assert rows(cs.top_products(log, n=n), "category", "pid", "views", "rank") == sorted(expected)


SALES = [
    {"time": "2024-01-01 10:00:00", "cid": "1", "province": "P", "total_money": 5, "event_type": 4},
    {"time": "2024-01-02 00:00:00", "cid": "7", "province": "P", "total_money": "0.25"},
    {"time": "2024-01-02 18:00:00", "cid": "8", "province": None, "total_money": 1},
    {"time": "2024-01-02 18:00:01", "cid": "2", "province": "Q", "total_money": None},
]


def test_sales(records):
    log = records(*SALES)
    assert rows(cs.total_sales(log)) == [(D("6.25"),)]
    assert rows(cs.total_sales(log, event_types=[4])) == [(D("5.00"),)]
    assert rows(cs.sales_today(log, "2024-01-02 18:00:00")) == [(D("1.25"),)]
    assert rows(cs.sales_by_day(log)) == [
        (date(2024, 1, 1), D("5.00")),
        (date(2024, 1, 2), D("1.25")),
    ]
    assert rows(cs.sales_by_category(log)) == sorted(
        [("books", D("5.00")), ("unknown", D("1.25")), ("clothing", None)], key=repr
    )
    assert rows(cs.sales_by_province(log)) == sorted(
        [("P", D("5.25")), (None, D("1.00")), ("Q", None)], key=repr
    )


def test_no_sales_is_null(records):
    assert rows(cs.total_sales(records({"openid": "u"}))) == [(None,)]


def test_offsets(spark):
    df = spark.createDataFrame(
        [("t", 0, 5), ("t", 0, 7), ("t", 10, 1), ("t", 2, 3), ("s", 0, 0)],
        "topic string, partition int, offset long",
    )
    ranges = cs.offset_ranges(df)
    assert rows(ranges) == [("s", 0, 0, 1), ("t", 0, 5, 8), ("t", 10, 1, 2), ("t", 2, 3, 4)]
    text = cs.starting_offsets_json(ranges.withColumnRenamed("until_offset", "offset")).first()[0]
    assert json.loads(text) == {"t": {"0": 8, "2": 4, "10": 2}, "s": {"0": 1}}
    assert text.index('"2"') < text.index('"10"')
    saved = ranges.withColumnRenamed("until_offset", "offset")
    assert cs.kafka_options("a:1", "t", saved)["startingOffsets"] == text


def test_dedup_offsets(spark):
    once = spark.range(50).selectExpr("'t' topic", "0 partition", "id offset", "'v' value")
    hot = once.filter("offset = 1").union(once.filter("offset = 1"))
    assert cs.dedup_offsets(once.union(once).union(hot)).count() == 50


def test_kafka_options():
    assert cs.kafka_options(["a:1", "b:1"], ["t", "s"], max_per_trigger=9, min_partitions=4) == {
        "kafka.bootstrap.servers": "a:1,b:1",
        "subscribe": "t,s",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "9",
        "minPartitions": "4",
    }
    assert cs.kafka_options("a:1", "t", "latest", group="g")["kafka.group.id"] == "g"
    assert cs.rate_cap(partitions=3, seconds=2) == 6000


def test_envelope(spark):
    df = spark.sql(
        "SELECT cast('k' AS binary) key, cast('手' AS binary) value, 't' topic, 0 partition, "
        "5L offset, timestamp'2024-01-01' timestamp, 0 timestampType"
    )
    row = cs.envelope(df).first()
    assert (row.key, row.value, row.offset) == ("k", "手", 5)


text = st.sampled_from(["a", "b", "", None])
record = st.fixed_dictionaries(
    {
        "time": st.sampled_from(["2024-01-01 00:00:00", "2024-01-02 23:59:59", "bad", None]),
        "openid": text,
        "province": text,
        "city": text,
        "cid": st.sampled_from(["1", "2", "9", None]),
        "total_money": st.one_of(st.none(), st.integers(-(10**6), 10**6)),
    }
)
line = st.one_of(record.map(json.dumps), st.sampled_from(["", " ", "no", '{"openid":"a"', "[]"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(line, min_size=1, max_size=30))
def test_sums_and_counts_agree(lines, values):
    raw = lines(*values)
    log = cs.valid(cs.parse_log(raw)).persist()
    counts = cs.pv_uv_raw(raw).first()
    assert counts.uv <= counts.pv <= counts.parsed <= counts.pv_raw == len(values)
    assert counts.parsed + counts.malformed == counts.pv_raw
    assert sum(r.views for r in cs.area_distribution(log).collect()) == counts.pv
    assert rows(cs.pv_uv(log)) == [(counts.pv, counts.uv)]
    counted = cs.visits(raw)
    assert cs.pv_uv_raw_of(counted).first() == counts
    assert rows(cs.areas_of(counted)) == rows(cs.area_distribution(log))

    def total(df):
        return sum(r[-1] for r in df.collect() if r[-1] is not None)

    expected = total(cs.total_sales(log))
    assert total(cs.sales_by_day(log)) == expected
    assert total(cs.sales_by_category(log)) == expected
    assert total(cs.sales_by_province(log)) == expected
    values_of = cs.kpi_values(log)
    assert total(values_of.filter("kpi = 'province'")) == expected
    assert total(values_of) == 4 * expected
    log.unpersist()


def test_sales_today_of_a_moment_with_a_zone(spark, records):
    sales = [
        {"time": "2024-01-01 12:00:00", "total_money": 1},
        {"time": "2024-01-02 01:00:00", "total_money": 2},
    ]
    log = records(*sales)
    # The same moment, said in three ways; its day is that of the session, UTC.
    for as_of in ("2024-01-02 06:00:00+08:00", "2024-01-01 22:00:00", "2024-01-01 22:00:00+00:00"):
        assert rows(cs.sales_today(log, as_of)) == [(D("1.00"),)]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        today = cs.sales_today(records(*sales), "2024-01-01 22:00:00+00:00")
        assert rows(today) == [(D("2.00"),)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
