"""The jobs for `spark-submit` and `python -m clickstream`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from clickstream.plans import kafka_kpis, line_report, sql_report


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="clickstream")
    jobs = parser.add_subparsers(dest="job", required=True)
    for job in ("lines", "sql"):
        jobs.add_parser(job, help=f"report on a log, from {job}").add_argument("path")
    kafka = jobs.add_parser("kafka", help="sales indicators of Kafka topics")
    kafka.add_argument("--brokers", required=True)
    kafka.add_argument("--topics", required=True)
    kafka.add_argument("--table", required=True)
    kafka.add_argument("--checkpoint", required=True)
    kafka.add_argument("--starting", default="earliest")
    kafka.add_argument("--max-per-trigger", type=int)
    kafka.add_argument("--min-partitions", type=int)
    kafka.add_argument("--group")
    kafka.add_argument("--offsets", help="table of the offset ranges of each batch")
    kafka.add_argument("--malformed", help="table of the lines that hold no record")
    kafka.add_argument("--raw", help="archive of the records, by day")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("clickstream").getOrCreate()
    if args.job == "kafka":
        source = {
            "starting": args.starting,
            "max_per_trigger": args.max_per_trigger,
            "min_partitions": args.min_partitions,
            "group": args.group,
        }
        kafka_kpis(
            spark,
            args.brokers,
            args.topics,
            args.table,
            args.checkpoint,
            source,
            offsets_path=args.offsets,
            malformed_path=args.malformed,
            raw_path=args.raw,
        ).awaitTermination()
        return
    report = line_report if args.job == "lines" else sql_report
    for name, result in report(spark, args.path).items():
        print(name)
        result.show(10, truncate=False)


if __name__ == "__main__":
    main()
