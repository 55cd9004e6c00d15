import pytest
from pyspark.sql.types import StructType

from veiledlake.functions.tokens import KeyedTokens
from veiledlake.plans import clean as clean_plan
from veiledlake.plans.clean import clean
from veiledlake.policy import DatasetPolicy
from veiledlake.sinks.curated import BucketTable
from veiledlake.sources.vault import Vault
from veiledlake.streaming.jobs import read_clean, stream_clean, stream_curate

RAW = "op string, ssn string, st string, v int, dms_commit_ts int"
POLICY = DatasetPolicy("person", keys=("st", "ssn"), partitions=("st",), pii={"ssn": "ssn"})
TOKENS = KeyedTokens("0123456789abcdef")


@pytest.fixture
def pipeline(spark, tmp_path):
    shaped = clean(spark.createDataFrame([], RAW), POLICY, TOKENS)
    schema = StructType(shaped.schema.fields)
    target = BucketTable(spark, f"{tmp_path}/curated", POLICY.keys)

    class Pipeline:
        tokens = TOKENS

        def drop(self, *data):
            spark.createDataFrame(list(data), RAW).write.mode("append").parquet(f"{tmp_path}/raw")

        def run(self):
            stream_clean(
                spark, f"{tmp_path}/raw", RAW, POLICY, f"{tmp_path}/clean", f"{tmp_path}/cp1", self.tokens
            )
            stream_curate(spark, f"{tmp_path}/clean", schema, POLICY, target, f"{tmp_path}/cp2")

        def clean_rows(self):
            return read_clean(spark, f"{tmp_path}/clean", schema)

        def curated(self):
            return target.read()

    return Pipeline()


@pytest.mark.parametrize("vault", [False, True])
def test_two_hops_over_arriving_files(spark, tmp_path, pipeline, rows, vault):
    if vault:
        pipeline.tokens = Vault(spark, f"{tmp_path}/vault")
    pipeline.drop(("I", "1", "01", 10, 1), ("I", "2", "02", 20, 1), ("U", "1", "01", 11, 2))
    pipeline.run()
    pipeline.run()
    assert pipeline.clean_rows().count() == 3
    assert rows(pipeline.curated(), "st", "v") == [("01", 11), ("02", 20)]
    pipeline.drop(("U", "2", "02", 21, 3), ("I", "3", "02", 30, 3), ("I", None, "02", 0, 3))
    pipeline.run()
    assert pipeline.clean_rows().count() == 6
    assert rows(pipeline.curated(), "st", "v") == [("01", 11), ("02", 0), ("02", 21), ("02", 30)]
    assert not {"1", "2", "3"} & {r["ssn"] for r in pipeline.curated().collect()}


def test_repeated_batch_adds_nothing(spark, tmp_path, pipeline, monkeypatch):
    pipeline.drop(("I", "1", "01", 10, 1))
    real, calls = clean_plan.append_parquet, []

    def fails_after_writing(*args, **kwargs):
        real(*args, **kwargs)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("driver lost after the write")

    monkeypatch.setattr(clean_plan, "append_parquet", fails_after_writing)
    with pytest.raises(Exception, match="driver lost"):
        pipeline.run()
    pipeline.run()
    assert len(calls) == 2 and pipeline.clean_rows().count() == 1


def test_lost_checkpoint_does_not_overwrite_earlier_batches(spark, tmp_path, pipeline):
    import shutil

    pipeline.drop(("I", "1", "01", 10, 1))
    pipeline.run()
    shutil.rmtree(f"{tmp_path}/cp1")
    pipeline.drop(("U", "1", "01", 11, 2))
    pipeline.run()
    assert pipeline.clean_rows().count() == 3  # the first row came twice, none is gone
    assert [r["v"] for r in pipeline.curated().collect()] == [11]
