"""Command line for ``spark-submit``: clean, score, report, train, all of them in order, or upkeep.

    spark-submit --py-files casemill.zip casemill/app.py clean --root hdfs:///lake \\
        --servers broker:9092 --topic reports --every "30 seconds"
    spark-submit --py-files casemill.zip casemill/app.py score --root hdfs:///lake
    spark-submit --py-files casemill.zip casemill/app.py tidy --root hdfs:///lake --keep-days 7

The warehouse password is read from the file named by ``--jdbc-password-file``.
"""

from __future__ import annotations

import argparse
import pathlib
from typing import get_args

from casemill import CleanSpec, JdbcSpec, StreamSpec, Zones, session
from casemill.operators import model
from casemill.plans import jobs
from casemill.spec import DedupMode
from casemill.streaming import run_clean_stream


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="casemill")
    parser.add_argument("job", choices=["clean", "score", "report", "train", "all", "tidy"])
    parser.add_argument("--root", required=True, help="folder of the data zones")
    parser.add_argument("--key-buckets", type=int, default=64, help="folders of the key index, fixed for a lake")
    parser.add_argument("--keep-days", type=float, default=7.0, help="how long replaced rows stay (tidy)")
    source = parser.add_argument_group("message source")
    source.add_argument("--servers")
    source.add_argument("--topic")
    source.add_argument("--inbox", help="folder of message files, instead of a topic")
    source.add_argument("--starting-offsets", default="earliest")
    source.add_argument("--max-per-trigger", type=int)
    cleaning = parser.add_argument_group("cleaning")
    cleaning.add_argument("--dedup", choices=get_args(DedupMode), default="global")
    cleaning.add_argument("--delay", default="1 day", help="how long ids are remembered (watermark), or rows may be behind (late)")
    cleaning.add_argument("--late", action="store_true", help="set rows aside that are further behind than the delay")
    cleaning.add_argument("--compact-every", type=int, help="gather small files after every so many batches")
    cleaning.add_argument("--every", help="run as a service, one batch per interval")
    cleaning.add_argument("--lenient", action="store_true", help="keep misshapen records and blank ids")
    gold = parser.add_argument_group("scores and reports")
    gold.add_argument("--version")
    gold.add_argument("--as-of")
    gold.add_argument("--incremental", action="store_true", help="report from sums per batch of silver")
    gold.add_argument("--tune", action="store_true", help="search model parameters")
    gold.add_argument("--jdbc-url")
    gold.add_argument("--jdbc-user", default="")
    gold.add_argument("--jdbc-password-file")
    gold.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    return parser.parse_args(argv)


def _source(args: argparse.Namespace) -> StreamSpec:
    common = dict(starting_offsets=args.starting_offsets, max_per_trigger=args.max_per_trigger)
    if args.inbox:
        return StreamSpec(kind="files", path=args.inbox, **common)
    return StreamSpec(kind="kafka", servers=args.servers, topic=args.topic, **common)


def _warehouse(args: argparse.Namespace) -> JdbcSpec | None:
    if not args.jdbc_url:
        return None
    password = pathlib.Path(args.jdbc_password_file).read_text().strip() if args.jdbc_password_file else ""
    return JdbcSpec(args.jdbc_url, args.jdbc_user, password, args.jdbc_driver)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = session.build(f"casemill-{args.job}")
    zones, warehouse = Zones(args.root, args.key_buckets), _warehouse(args)
    spec = CleanSpec.compat() if args.lenient else CleanSpec()
    if args.job == "clean":
        trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
        streams = run_clean_stream(
            spark,
            _source(args),
            zones,
            spec,
            dedup=args.dedup,
            delay=args.delay,
            late=args.late,
            compact_every=args.compact_every,
            trigger=trigger,
        )
        for stream in streams:
            stream.awaitTermination()
    elif args.job == "score":
        jobs.run_score(spark, zones, version=args.version, jdbc=warehouse)
    elif args.job == "report":
        report = jobs.run_incremental_report if args.incremental else jobs.run_report
        report(spark, zones, as_of=args.as_of, jdbc=warehouse)
    elif args.job == "tidy":
        jobs.tidy(spark, zones, older_than=86_400 * args.keep_days)
    elif args.job == "train":
        jobs.run_training(spark, zones, version=args.version, grids=model.GRIDS if args.tune else None)
    else:
        jobs.run_all(
            spark, _source(args), zones, spec, version=args.version, as_of=args.as_of, jdbc=warehouse
        )


if __name__ == "__main__":
    main()
