import json

import pytest

from veiledlake.jobs import main
from veiledlake.policy import PolicyError
from veiledlake.sinks.curated import BucketTable

REGISTRY = {
    "cases": {
        "table_name": "cases",
        "primary_key_col": ["ST", "case_id"],
        "partition_cols": ["st"],
        "pii_col": {"ssn": "ssn"},
        "exclude_cols": ["remark"],
        "s3_target_write_folder": "area/cases",
        "char_rep_trns": {"ssn": ["/", "_"]},
    }
}
RAW = "op string, st string, case_id int, ssn string, remark string, dms_commit_ts timestamp"


@pytest.mark.parametrize("tokens", ["vault", "key-file"])
def test_both_hops_from_the_command_line(spark, tmp_path, tokens):
    name = f"lake_{tokens.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name}_clean")
    spark.sql(f"CREATE DATABASE {name}_curated")
    (tmp_path / "policies.json").write_text(json.dumps(REGISTRY))
    (tmp_path / "key").write_text("0123456789abcdef0123456789abcdef\n")
    common = ["--registry", f"{tmp_path}/policies.json", "--dataset", "cases"]
    source = str(tmp_path / ("vault" if tokens == "vault" else "key"))

    def run(*data):
        df = spark.createDataFrame(list(data), RAW.replace("timestamp", "string"))
        df = df.withColumn("dms_commit_ts", df["dms_commit_ts"].cast("timestamp"))
        df.write.mode("append").parquet(f"{tmp_path}/raw/area/cases")
        main(
            ["clean", *common, "--source", f"{tmp_path}/raw", "--target", f"{tmp_path}/clean"]
            + [f"--{tokens}", source, "--catalog", f"{name}_clean"]
        )
        main(
            ["curate", *common, "--source", f"{tmp_path}/clean", "--target", f"{tmp_path}/curated"]
            + ["--source-table", f"{name}_clean.cases", "--catalog", f"{name}_curated"]
        )

    run(
        ("I", "01", 1, "1/2", "text", "2024-01-01"),
        ("U", "01", 1, "1_3", "text", "2024-01-02"),
        ("I", "02", 2, "12", "text", "2024-01-01"),
    )
    run(("U", "02", 2, None, "text", "2024-01-03"), ("I", "10", 3, "12", None, "2024-01-03"))
    clean = spark.table(f"{name}_clean.cases")
    assert clean.count() == 5 and "remark" not in clean.columns
    first = {(r["st"], r["case_id"]): r["ssn"] for r in clean.filter("op = 'I'").collect()}
    assert first["01", 1] == first["02", 2] == first["10", 3] != "12"
    curated = {(r["st"], r["case_id"]): r["ssn"] for r in spark.table(f"{name}_curated.cases").collect()}
    assert curated.keys() == {("01", 1), ("02", 2), ("10", 3)}
    assert curated["02", 2] == "" and curated["10", 3] == first["10", 3] != curated["01", 1]


def test_path_only_run_keeps_partition_codes(spark, tmp_path):
    (tmp_path / "policies.json").write_text(json.dumps(REGISTRY))
    (tmp_path / "key").write_text("0123456789abcdef")
    common = ["--registry", f"{tmp_path}/policies.json", "--dataset", "cases"]
    df = spark.createDataFrame([("I", "01", 1, "5", "x", None)], RAW)
    df.write.parquet(f"{tmp_path}/raw/area/cases")
    main(
        ["clean", *common, "--source", f"{tmp_path}/raw", "--target", f"{tmp_path}/clean"]
        + ["--key-file", f"{tmp_path}/key"]
    )
    main(["curate", *common, "--source", f"{tmp_path}/clean", "--target", f"{tmp_path}/curated"])
    table = BucketTable(spark, f"{tmp_path}/curated/area/cases", ["st", "case_id"])
    assert [r["st"] for r in table.read().collect()] == ["01"]


def test_unknown_dataset(spark, tmp_path):
    (tmp_path / "policies.json").write_text("{}")
    with pytest.raises(PolicyError, match="nope"):
        main(
            ["curate", "--registry", f"{tmp_path}/policies.json", "--dataset", "nope"]
            + ["--source", "x", "--target", "y"]
        )
