from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import clickstream as cs
from checks.fixtures import MALFORMED
from clickstream.schema import LOG_FIELDS, TIME_FORMAT
from tests.conftest import rows

# Which lines of the matrix hold a record.
PARSED = [True, True, False, False, True, False, False, True, True, True, True, False]


@pytest.mark.parametrize("fields", [LOG_FIELDS, ("openid",), ("page", "total_money"), ()])
def test_malformed_matrix(lines, fields):
    parsed = cs.parse_log(lines(*MALFORMED), fields)
    verdict = {row.value: row.ok for row in parsed.select("value", "ok").collect()}
    assert [verdict[line] for line in MALFORMED] == PARSED


def test_matrix_counts(lines):
    row = cs.pv_uv_raw(lines(*MALFORMED)).first().asDict()
    assert row == {"pv_raw": 12, "parsed": 7, "malformed": 5, "pv": 5, "uv": 5}


def test_types(lines):
    row = cs.parse_log(lines(MALFORMED[0])).first()
    assert row.event_time == datetime(2024, 1, 5, 10) and row.dt == date(2024, 1, 5)
    assert row.event_type == 1 and row.total_money == Decimal("10.00")
    assert (row.openid, row.province, row.city) == ("u1", "ASIA", "CHINA")
    assert (row.cid, row.pid) == ("1", "1")


def test_numbers_as_text_and_text_as_numbers(records):
    got = records(
        {"openid": 3, "event_type": "1", "total_money": "7"},
        {"openid": "a", "event_type": "x", "total_money": "much"},
        {"openid": "b", "total_money": 99999999999},
        {"openid": "c", "total_money": 1.5},
    )
    assert rows(got, "openid", "event_type", "total_money") == [
        ("3", 1, Decimal("7.00")),
        ("a", None, None),
        ("b", None, Decimal("99999999999.00")),
        ("c", None, Decimal("1.50")),
    ]


def test_times_of_another_form_are_null(spark, lines):
    times = [
        "2024-01-05 10:00:00", "2024-02-29 23:59:59", "0001-01-01 00:00:00", "9999-12-31 00:00:00",
        "2024-02-30 00:00:00", "2024-01-05 24:00:00", "2024-01-05 10:60:00", "2024-01-05",
        "2024-1-5 10:00:00", "2024-01-05T10:00:00", "2024-01-05 10:00:00.5", "2024-01-05 10:00",
        " 2024-01-05 10:00:00", "2024-01-05 10:00:00 ", "2024-01-05 10:00:00\n", "10:00:00",
        "2024-01-05 10:00:0Z", "-024-01-05 10:00:00", "2024-01-05 10:00:00Z", "bad", "", None,
    ]
    log = cs.parse_log(lines(*[{"time": t} for t in times]))
    strict = F.try_to_timestamp("time", F.lit(TIME_FORMAT))
    moments = [F.col("event_time").cast("string"), strict.cast("string").alias("strict"), "dt"]
    got = log.select("time", *moments).collect()
    assert [r.time for r in got if r.event_time != r.strict] == []
    assert [r.time for r in got if r.event_time] == times[:4]
    assert all((r.dt is None) == (r.event_time is None) for r in got)


def test_malformed_kinds_and_envelope(spark):
    lines = spark.createDataFrame(
        [(7, "not json"), (8, ""), (9, "  "), (10, "\t"), (11, "{}")], "offset long, value string"
    )
    bad = cs.malformed(cs.parse_log(lines))
    assert bad.columns == ["offset", "value", "kind"]
    assert rows(bad) == [
        (10, "\t", "blank"),
        (7, "not json", "corrupt"),
        (8, "", "blank"),
        (9, "  ", "blank"),
    ]


def test_valid_keeps_the_envelope_and_drops_the_judgement(spark):
    lines = spark.createDataFrame([(1, '{"openid":"u"}')], "offset long, value string")
    record = cs.valid(cs.parse_log(lines, ["openid"]))
    assert record.columns == ["offset", "openid"]


def test_single_columns_of_parsed_lines(lines):
    parsed = cs.parse_log(lines(*MALFORMED))
    assert rows(parsed.select("openid").dropna()) == [(v,) for v in ("3", "u1", "u2", "u3", "u4")]
    assert parsed.select("page").count() == 12
    assert parsed.select("_corrupt").dropna().count() == 4


def test_unknown_field_is_refused(lines):
    with pytest.raises(ValueError, match="opneid"):
        cs.parse_log(lines("{}"), ["opneid"])


def test_null_line_is_malformed(spark):
    lines = spark.createDataFrame([(None,)], "value string")
    assert cs.pv_uv_raw(lines).first().asDict() == {
        "pv_raw": 1, "parsed": 0, "malformed": 1, "pv": 0, "uv": 0
    }


def test_each_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "log").write_text('{"openid":"u","province":"p"}\n')
    log = cs.valid(cs.parse_log(cs.read_lines(spark, str(tmp_path / "log"))))
    plan = cs.area_distribution(log)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_read_json(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text("\n".join(MALFORMED) + "\n")
    log = cs.read_json(spark, str(path))
    assert log.count() == 11  # a row for each line but the empty one
    assert rows(cs.pv_uv(log)) == [(5, 5)]
    assert dict(log.dtypes)["total_money"] == "decimal(18,2)"
    inferred = cs.read_json(spark, str(path), schema=None)
    assert rows(cs.pv_uv(inferred)) == [(5, 5)]


def test_read_json_pushes_filter_and_prunes(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"openid":"u","province":"p"}\n')
    report = cs.pv_uv(cs.read_json(spark, str(tmp_path / "log.json")))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(openid)]" in plan
    assert "ReadSchema: struct<openid:string>" in plan


def test_recode(spark):
    text = ["手机 x", "plain", "", None, "é"]
    garbled = [t and t.encode().decode("latin-1") for t in text]
    df = spark.createDataFrame([(g,) for g in garbled], "value string")
    assert rows(cs.recode(df)) == sorted([(t,) for t in text], key=repr)


def test_recode_gbk_and_dirty_bytes(spark):
    garbled = "手机".encode("gbk").decode("latin-1")
    df = spark.createDataFrame([(garbled,), (None,)], "value string")
    assert rows(cs.recode(df, "GBK")) == sorted([("手机",), (None,)], key=repr)
    dirty = spark.createDataFrame([("a\xffb",), ("中",)], "value string")
    assert rows(cs.recode(dirty)) == [("?",), ("a�b",)]


def test_between_times(records):
    times = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 12:00:00", "bad"]
    log = records(*[{"time": t} for t in times])
    got = cs.between_times(log, "2024-01-02", "2024-01-02 12:00:00")
    assert rows(got, "time") == [(times[1],)]
    got = cs.between_times(log, "2024-01-02", datetime(2024, 1, 2, 12), include_hi=True)
    assert rows(got, "time") == [(times[1],), (times[2],)]


def test_between_times_prunes_an_archive(spark, records, tmp_path):
    path = str(tmp_path / "archive")
    log = records(*[{"time": f"2024-01-{day:02d} 10:00:00", "openid": "u"} for day in range(1, 20)])
    log.write.partitionBy("dt").parquet(path)
    got = cs.between_times(spark.read.parquet(path), "2024-01-05", "2024-01-06 11:00:00")
    assert got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
