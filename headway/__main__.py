"""Command line: ``python -m headway first-load|batch|poll ...``."""

from __future__ import annotations

import argparse

from headway.functions.batch_ids import new_batch_id
from headway.plans.layers import Lake
from headway.plans.snapshots import run
from headway.session import open_session
from headway.sources.state import PollState, load_batch_id, save_batch_id
from headway.streaming.poll import file_sink, kafka_sink, poll_batch, read_records, start_poll


def main() -> None:
    parser = argparse.ArgumentParser(prog="headway")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("first-load", "batch"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="lake root; documents are below <root>/landing")
        job.add_argument("--batch-id", help="default: the one the landing marker names")
        job.add_argument("--lines", action="store_true", help="per-route documents are newline-delimited")
    mark = jobs.add_parser("new-batch")
    mark.add_argument("--root", required=True)
    poll = jobs.add_parser("poll")
    poll.add_argument("--records", required=True)
    poll.add_argument("--state", required=True)
    poll.add_argument("--checkpoint", required=True)
    poll.add_argument("--out", help="folder for message files")
    poll.add_argument("--kafka", help="bootstrap servers")
    poll.add_argument("--route", action="append", default=[])
    poll.add_argument("--source", default="transit-v3")
    poll.add_argument("--full-backfill", action="store_true")
    poll.add_argument("--once", action="store_true")
    args = parser.parse_args()

    spark = open_session()
    if args.job == "poll":
        if bool(args.out) == bool(args.kafka):
            parser.error("give one of --out and --kafka")
        sink = file_sink(args.out) if args.out else kafka_sink(args.kafka)
        body = poll_batch(
            PollState(spark, args.state), sink, args.route, source=args.source, full_backfill=args.full_backfill
        )
        start_poll(read_records(spark, args.records), args.checkpoint, body, args.once).awaitTermination()
        return
    lake = Lake(spark, args.root)
    if args.job == "new-batch":
        batch_id = new_batch_id()
        save_batch_id(spark, lake.landing, batch_id)
        print(batch_id)
        return
    batch_id = args.batch_id or load_batch_id(spark, lake.landing)
    for table, counts in run(lake, batch_id, full=args.job == "first-load", lines=args.lines).items():
        if counts:
            print(table, counts)


if __name__ == "__main__":
    main()
