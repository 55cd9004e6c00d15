"""The two hops as jobs for spark-submit.

    spark-submit -m veiledlake.jobs clean  --registry policies.json --dataset person \\
        --source s3a://raw --target s3a://clean --vault s3a://vault
    spark-submit -m veiledlake.jobs curate --registry policies.json --dataset person \\
        --source s3a://clean --target s3a://curated

Each run takes the files that arrived since the last one, and prints what each
batch counted, one line of JSON each. Paths are base paths;
a dataset lies below them in the folder its policy names.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from veiledlake.functions.columns import MASKS
from veiledlake.functions.tokens import KeyedTokens
from veiledlake.plans.curate import MergeOptions
from veiledlake.policy import DatasetPolicy, PolicyError
from veiledlake.session import build_session
from veiledlake.sinks.catalog import sync_catalog
from veiledlake.sinks.curated import BUCKETS, BucketTable, MergeTable, PartitionedTable
from veiledlake.sources.vault import Vault
from veiledlake.storage import read_text
from veiledlake.streaming.jobs import BATCH, clean_schema, stream_clean, stream_curate


def main(arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session(f"{args.hop} {args.dataset}")
    registry = DatasetPolicy.load_registry(read_text(spark, args.registry))
    if args.dataset not in registry:
        raise PolicyError(f"no dataset {args.dataset} in {args.registry}")
    policy = registry[args.dataset]
    if args.hop == "clean":
        _clean(spark, args, policy)
    else:
        _curate(spark, args, policy)


def _clean(spark: SparkSession, args: argparse.Namespace, policy: DatasetPolicy) -> None:
    source, target = policy.path(args.source), policy.path(args.target)
    schema = _schema(spark, args, source)
    if args.vault:
        tokens = Vault(spark, args.vault, args.blank, args.wait)
    else:
        tokens = KeyedTokens(read_text(spark, args.key_file).strip(), blank=args.blank)
    reports = stream_clean(
        spark,
        source,
        schema,
        policy,
        target,
        f"{target}/_checkpoint",
        tokens,
        keep=args.keep,
        strict=not args.lenient,
        max_files_per_batch=args.max_files_per_batch,
    )
    _tell(args, reports)
    if args.catalog and reports:
        done = clean_schema(spark, schema, policy, with_batch=True, strict=not args.lenient)
        table = f"{args.catalog}.{policy.table}"
        sync_catalog(spark, table, target, (BATCH, *policy.partitions), done)


def _curate(spark: SparkSession, args: argparse.Namespace, policy: DatasetPolicy) -> None:
    source, target = policy.path(args.source), policy.path(args.target)
    schema = _schema(spark, args, source)
    schema = StructType([f for f in schema.fields if f.name != BATCH])
    if args.merge_format:
        if not args.catalog:
            raise PolicyError("a table with MERGE needs --catalog")
        table = MergeTable(spark, f"{args.catalog}.{policy.table}", args.merge_format)
    elif args.catalog and policy.partitions:
        table = PartitionedTable(spark, f"{args.catalog}.{policy.table}", target, policy.partitions)
    else:
        table = BucketTable(spark, target, policy.keys, args.buckets)
    options = MergeOptions(
        order_by=args.order_by,
        nulls=args.nulls,
        missing=args.missing,
        null_safe=args.null_safe,
        apply_deletes=args.apply_deletes,
        only_if_newer=args.only_if_newer,
    )
    reports = stream_curate(
        spark,
        source,
        schema,
        policy,
        table,
        f"{target}/_checkpoint",
        options,
        max_files_per_batch=args.max_files_per_batch,
    )
    _tell(args, reports)
    if args.catalog and isinstance(table, BucketTable) and table.exists():
        table.register(f"{args.catalog}.{policy.table}")


def _tell(args: argparse.Namespace, reports: Sequence) -> None:
    for report in reports:
        print(json.dumps({"hop": args.hop, "dataset": args.dataset, **asdict(report)}), flush=True)


def _schema(spark: SparkSession, args: argparse.Namespace, path: str) -> StructType:
    """The source's columns: as declared in the catalog, else as found in the files.

    Partition columns found in folder names are taken as text, which keeps codes such as ``01``.
    """
    if args.source_table:
        return spark.table(args.source_table).schema
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return spark.read.parquet(path).schema
    finally:
        spark.conf.set(setting, before)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    hops = parser.add_subparsers(dest="hop", required=True)
    clean, curate = hops.add_parser("clean"), hops.add_parser("curate")
    for hop in (clean, curate):
        hop.add_argument("--registry", required=True, help="JSON file: dataset name to policy")
        hop.add_argument("--dataset", required=True)
        hop.add_argument("--source", required=True, help="base path to read")
        hop.add_argument("--target", required=True, help="base path to write")
        hop.add_argument("--source-table", help="catalog table that declares the source's columns")
        hop.add_argument("--catalog", help="database to register the result in")
        hop.add_argument("--max-files-per-batch", type=int, help="split a large backlog")
    tokens = clean.add_mutually_exclusive_group(required=True)
    tokens.add_argument("--vault", help="folder of the token vault: random tokens")
    tokens.add_argument("--key-file", help="file with the secret key: computed tokens")
    clean.add_argument("--blank", default="empty", help="what becomes of blank values")
    clean.add_argument("--wait", type=float, default=0, help="seconds to wait for a vault in use")
    clean.add_argument("--keep", choices=sorted(MASKS), default="month", help="what a masked date keeps")
    clean.add_argument("--lenient", action="store_true", help="PII columns may be absent")
    curate.add_argument("--order-by", help="column that tells the latest row; default: commit time")
    curate.add_argument("--nulls", choices=("first", "last"), default="first")
    curate.add_argument("--missing", choices=("error", "null"), default="error")
    curate.add_argument("--merge-format", help="table format with MERGE, such as delta")
    curate.add_argument("--null-safe", action="store_true")
    curate.add_argument("--apply-deletes", action="store_true")
    curate.add_argument("--only-if-newer", metavar="COLUMN")
    curate.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a new table without partitions")
    return parser


if __name__ == "__main__":
    main()
