import hmac
from datetime import UTC, date, datetime
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veiledlake.functions.tokens import KeyedTokens, hmac_sha256
from veiledlake.operators.feed import count_operations, stamp_full_load
from veiledlake.operators.shape import (
    exclude_columns,
    mask_dates,
    parse_dates,
    parse_timestamps,
    rename_columns,
    stamp_ingestion,
    strip_characters,
    tokenise_keyed,
)
from veiledlake.plans.clean import clean, run_clean
from veiledlake.policy import DatasetPolicy, PolicyError

KEY = b"0123456789abcdef"
TOKENS = KeyedTokens(KEY)
RUN_TS = datetime(2024, 5, 1, 12, 0, tzinfo=UTC)


def token(pii_type, value):
    return hmac.new(KEY, f"{pii_type}:{value}".encode(), sha256).hexdigest()


def test_rename_ignores_absent_and_case(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert rename_columns(df, {"a": "x", "nope": "y"}).columns == ["x", "b"]
    assert rename_columns(df, {"a": "b", "b": "a"}).columns == ["b", "a"]
    with pytest.raises(PolicyError):
        rename_columns(df, {"a": "B"})


def test_exclude_ignores_absent_and_case(spark):
    df = spark.createDataFrame([(1, 2)], "SUBJ int, b int")
    assert exclude_columns(df, ["subj", "nope"]).columns == ["b"]


def test_strip_applies_patterns_in_order(spark, rows):
    df = spark.createDataFrame([("123-45 6789",), (None,), ("ab",)], "ssn string")
    assert rows(strip_characters(df, {"ssn": [" ", "-"]})) == [("123456789",), ("ab",), (None,)]
    assert rows(strip_characters(df, {"ssn": ["b", "a$"]}))[1] == ("123-45 6789",)


def test_parse_dates(spark, rows):
    df = spark.createDataFrame(
        [("1980-12-31", date(2000, 1, 2)), ("31/12/1980", None), (None, None)], "a string, b date"
    )
    parsed = parse_dates(df, {"A": "yyyy-MM-dd", "b": "MM/dd/yyyy", "nope": "yyyy"})
    assert [t for _, t in parsed.dtypes] == ["date", "date"]
    assert rows(parsed) == [
        (date(1980, 12, 31), date(2000, 1, 2)),
        (None, None),
        (None, None),
    ]


def test_parse_timestamps(spark, rows):
    df = spark.createDataFrame([("01.02.2003 04:05",), ("x",)], "a string")
    parsed = parse_timestamps(df, {"a": "dd.MM.yyyy HH:mm"})
    assert rows(parsed.select(F.date_format("a", "yyyyMMddHHmm"))) == [("200302010405",), (None,)]


@pytest.mark.parametrize(
    "keep, expected",
    [
        ("month", [date(1980, 12, 1), date(1980, 12, 1), date(999, 5, 1), None]),
        ("year", [date(1980, 1, 1), date(1980, 1, 1), date(999, 1, 1), None]),
        ("decade", [date(1980, 1, 1), date(1980, 1, 1), date(990, 1, 1), None]),
    ],
)
def test_mask_dates(spark, keep, expected):
    values = ["1980-12-31", "1980-12-01", "0999-05-04", None]
    for kind in ("string", "date", "timestamp"):
        df = spark.createDataFrame([(v,) for v in values], "d string")
        masked = mask_dates(df.select(F.col("d").cast(kind)), ["d"], keep)
        assert [r["d"] for r in masked.collect()] == expected
        assert masked.dtypes == [("d", "date")]


def test_bad_date_text_masks_to_null(spark):
    df = spark.createDataFrame([("not a date",)], "d string")
    assert mask_dates(df, ["d"]).first()["d"] is None


def test_stamp_is_one_value(spark):
    df = stamp_ingestion(spark.range(100).repartition(4))
    assert df.select("rec_ingested_dt").distinct().count() == 1


@settings(max_examples=15, deadline=None)
@given(st.binary(min_size=16, max_size=100), st.text(min_size=1, max_size=80))
def test_hmac_equals_standard_library(spark, key, message):
    df = spark.createDataFrame([(message,)], "m string")
    expected = hmac.new(key, message.encode(), sha256).hexdigest()
    assert df.select(hmac_sha256(F.col("m"), key)).first()[0] == expected


def test_keyed_tokens(spark, rows):
    df = spark.createDataFrame([("1234", 1234), ("", None), (None, 5)], "a string, b int")
    done = tokenise_keyed(df, {"a": "ssn", "b": "case_id"}, TOKENS)
    assert [tuple(r) for r in done.collect()] == [
        (token("ssn", "1234"), token("case_id", "1234")),
        ("", ""),
        ("", token("case_id", "5")),
    ]
    kept = tokenise_keyed(df, {"a": "ssn"}, KeyedTokens(KEY, blank="null"), suffix="_hash")
    assert kept.columns == ["a", "b", "a_hash"]
    assert [r["a_hash"] for r in kept.collect()] == [token("ssn", "1234"), None, None]


def test_weak_key_is_refused_and_key_is_not_shown():
    with pytest.raises(ValueError):
        KeyedTokens("short")
    assert KEY.decode() not in repr(TOKENS)


PERSON = DatasetPolicy(
    "person",
    keys=("id",),
    renames={"uid": "id"},
    drops=("subj",),
    strips={"ssn": (" ", "-")},
    dates={"stus_dt": "yyyy-MM-dd"},
    timestamps={"seen": "yyyy-MM-dd HH:mm"},
    pii={"ssn": "ssn", "lnm": "person_nm", "dob": "dob"},
)
LAYOUT = "uid int, SSN string, lnm string, dob string, stus_dt string, seen string, subj string"
PEOPLE = [
    (1, "123-45 6789", "Doe", "1980-12-31", "2020-01-02", "2020-01-02 03:04", "free text"),
    (2, "123456789", "", "1980-01-31", "02/01/2020", None, None),
    (3, None, None, None, None, "x", None),
]


def test_clean_applies_all_steps_without_a_shuffle(spark):
    df = clean(spark.createDataFrame(PEOPLE, LAYOUT), PERSON, TOKENS, RUN_TS)
    assert df.columns == ["id", "SSN", "lnm", "dob", "stus_dt", "seen", "rec_ingested_dt"]
    first, second, third = df.orderBy("id").collect()
    assert first["SSN"] == second["SSN"] == token("ssn", "123456789")
    assert (first["lnm"], second["lnm"], third["lnm"]) == (token("person_nm", "Doe"), "", "")
    assert (first["dob"], third["dob"]) == (date(1980, 12, 1), None)
    assert (first["stus_dt"], second["stus_dt"]) == (date(2020, 1, 2), None)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_clean_schema_does_not_depend_on_rows(spark):
    full = clean(spark.createDataFrame(PEOPLE, LAYOUT), PERSON, TOKENS, RUN_TS)
    empty = clean(spark.createDataFrame([], LAYOUT), PERSON, TOKENS, RUN_TS)
    assert full.dtypes == empty.dtypes


def test_run_clean_reports_and_appends(spark, tmp_path):
    path = f"{tmp_path}/person"
    raw = spark.createDataFrame(PEOPLE, LAYOUT)
    report = run_clean(raw, PERSON, path, TOKENS)
    assert report.rows == 3
    assert report.blanks == {"SSN": 1, "lnm": 2}
    assert report.unparsed == {"stus_dt": 1, "seen": 1, "dob": 0}
    run_clean(raw, PERSON, path, TOKENS)
    assert spark.read.parquet(path).count() == 6


def test_empty_batch_writes_nothing(spark, tmp_path):
    report = run_clean(spark.createDataFrame([], LAYOUT), PERSON, f"{tmp_path}/x", TOKENS)
    assert report.rows == 0 and report.blanks == {"SSN": 0, "lnm": 0}
    assert not (tmp_path / "x").exists()


def test_partition_values_keep_leading_zero(spark, tmp_path, rows):
    policy = DatasetPolicy("c", keys=("id",), partitions=("st",))
    df = spark.createDataFrame([(1, "01"), (2, "10"), (3, None)], "id int, st string")
    run_clean(df, policy, f"{tmp_path}/c", TOKENS)
    back = spark.read.schema("id int, st string").parquet(f"{tmp_path}/c")
    assert rows(back) == [(1, "01"), (2, "10"), (3, None)]


def test_stamp_full_load(spark, rows):
    df = spark.createDataFrame([(1,)], "a int")
    assert stamp_full_load(df).columns == ["op", "a"]
    stamped = stamp_full_load(df, RUN_TS)
    assert stamped.columns == ["op", "a", "dms_commit_ts"]
    assert rows(count_operations(stamped)) == [("I", 1)]
