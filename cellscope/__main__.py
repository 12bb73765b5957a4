"""Command line for spark-submit.

    python -m cellscope load        --lake ROOT --warehouse ROOT --date YYYY-MM-DD
    python -m cellscope run-date    --lake ROOT --warehouse ROOT --date YYYY-MM-DD [--late drop|upsert|replace]
    python -m cellscope kpi         --warehouse ROOT --date YYYY-MM-DD
    python -m cellscope stream-load --lake ROOT --warehouse ROOT --checkpoint DIR [--on-malformed failfast|quarantine]
    python -m cellscope stream-facts --warehouse ROOT --checkpoint DIR [--delay SECONDS]
    python -m cellscope merge-late  --warehouse ROOT --fact fct_voice_call|fct_data_session
    python -m cellscope land        --lake ROOT --checkpoint DIR --servers HOST:PORT --topic NAME
                                    [--batch-size N] [--max-batches N]

`load` and `run-date` end with status 1 if objects could not be loaded, `run-date` also if a
serving check failed.
"""

from __future__ import annotations

import argparse
import json
import sys

from cellscope.session import get_spark


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cellscope")
    sub = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        for o in options:
            p.add_argument(o, required=True)
        return p

    for name, text in (("load", "load one date from the lake into the raw table"),
                       ("run-date", "load one date and publish every layer")):
        p = command(name, text, "--lake", "--warehouse", "--date")
        p.add_argument("--on-malformed", choices=("failfast", "quarantine"), default="failfast")
        if name == "run-date":
            p.add_argument("--late", choices=("upsert", "drop", "replace"), default="upsert")
    command("kpi", "replace the hourly KPI of the event dates that one ingestion date touches", "--warehouse", "--date")
    p = command("stream-facts", "add newly loaded raw rows to the facts, late ones to their side tables", "--warehouse", "--checkpoint")
    p.add_argument("--delay", type=int, default=0)
    command("merge-late", "add a fact's late rows to it", "--warehouse", "--fact")
    p = command("stream-load", "load newly landed objects once, from a checkpoint", "--lake", "--warehouse", "--checkpoint")
    p.add_argument("--on-malformed", choices=("failfast", "quarantine"), default="failfast")
    p = command("land", "land the change stream in the lake", "--lake", "--checkpoint", "--servers", "--topic")
    p.add_argument("--batch-size", type=int, default=200)
    p.add_argument("--max-batches", type=int, default=None)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = get_spark()
    out: dict = {}
    status = 0
    if args.command in ("load", "run-date"):
        from cellscope.plans.load import MalformedObjects, load_date
        from cellscope.plans.pipeline import run_pipeline

        try:
            if args.command == "load":
                out = load_date(spark, args.lake, args.warehouse, args.date, args.on_malformed).__dict__
            else:
                res = run_pipeline(spark, args.lake, args.warehouse, args.date, late=args.late,
                                   on_malformed=args.on_malformed)
                out = {"load": res.load.__dict__, "counts": res.counts, "failed_checks": res.failed}
                status = int(bool(res.failed))
        except MalformedObjects as e:
            out, status = {**e.result.__dict__, "error": str(e)}, 1
    elif args.command == "kpi":
        from cellscope.plans.pipeline import publish_kpi

        publish_kpi(spark, args.warehouse, args.date)
    elif args.command == "stream-facts":
        from cellscope.streaming.facts import stream_facts

        stream_facts(spark, args.warehouse, args.checkpoint, args.delay).awaitTermination()
    elif args.command == "merge-late":
        from cellscope.streaming.facts import merge_late

        out = {"rows_added": merge_late(spark, args.warehouse, args.fact)}
    elif args.command == "stream-load":
        from cellscope.streaming.loader import stream_load

        stream_load(spark, args.lake, args.warehouse, args.checkpoint, on_malformed=args.on_malformed).awaitTermination()
    else:
        from cellscope.streaming.landing import kafka_source, land_stream

        messages = kafka_source(spark, args.servers, args.topic, args.batch_size)
        land_stream(messages, args.lake, args.checkpoint, max_batches=args.max_batches).awaitTermination()
    print(json.dumps(out))
    return status


if __name__ == "__main__":
    sys.exit(main())
