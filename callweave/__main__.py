"""Command line: list, explain or run the registered queries, or run the
end-to-end summarisation over the overlay tables.

  python -m callweave list
  python -m callweave query account_bundle --sf-dir /root/testdata/sf0.01 --out /path/out
  python -m callweave query icp_calls --sf-dir ... --explain
  python -m callweave summarize --sf-dir ... --out /path/out
  python -m callweave summarize --tables crm. --run-date 2025-01-06 --out /path/out
  python -m callweave ingest --pages /landing --artifacts files --recorded recorded_calls --out /path/out
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import time

from callweave.plans.catalogue import QUERIES
from callweave.session import build_session


def _session(args):
    return build_session(args.master, "callweave-cli", shuffle_partitions=args.shuffle_partitions)


def cmd_list(_args) -> None:
    for name in QUERIES:
        print(name)


def cmd_query(args) -> None:
    spark = _session(args)
    df = QUERIES[args.name](spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
        return
    t0 = time.perf_counter()
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.write.format("noop").mode("overwrite").save()
    print(json.dumps({"query": args.name, "seconds": round(time.perf_counter() - t0, 3),
                      "out": args.out}))


def cmd_summarize(args) -> None:
    from callweave.plans import summarization
    from callweave.sources import crm, overlay

    spark = _session(args)
    if args.tables:
        p = args.tables
        inputs = [crm.read_tasks(spark, p + "tasks"), crm.read_opportunities(spark, p + "opportunities"),
                  crm.read_accounts(spark, p + "accounts"), crm.read_users(spark, p + "users"),
                  spark.table(p + "transcripts"), spark.table(p + "artifacts")]
        responses = spark.table(p + "responses")
    else:
        sf = args.sf_dir
        inputs = [source(spark, sf) for source in (overlay.tasks, overlay.opportunities, overlay.accounts,
                                                   overlay.users, overlay.transcripts, overlay.artifacts)]
        responses = overlay.responses(spark, sf)
    day = dt.date.fromisoformat(args.run_date) if args.run_date else overlay.RUN_DATE
    b = summarization.build_bundles(*inputs)
    out = args.out.rstrip("/")
    b.transcribe.write.mode("overwrite").parquet(f"{out}/transcribe_requests")
    b.translate.write.mode("overwrite").parquet(f"{out}/translate_requests")
    b.downloads.write.mode("overwrite").parquet(f"{out}/downloads")
    summarization.save_bundles(b, f"{out}/texts", day)
    summarization.save_responses(responses, f"{out}/texts", day)
    summarization.summary_requests(b.bundles, responses, day) \
        .write.mode("overwrite").parquet(f"{out}/summary_requests")
    summarization.account_dim(b.bundles, responses, day, strict=args.strict) \
        .write.mode("overwrite").parquet(f"{out}/dim_icp_account")
    print(json.dumps({"out": out}))


def cmd_ingest(args) -> None:
    from callweave.plans import ingestion

    spark = _session(args)
    prep = ingestion.prepare_ingestion(spark, args.pages, spark.table(args.artifacts), args.recorded, days=args.days)
    prep.requests.write.mode("overwrite").parquet(args.out.rstrip("/") + "/transcribe_requests")
    if args.results:
        results = spark.table(args.results)
        ingestion.complete_ingestion(spark, prep.new_rows, results, args.history)
    print(json.dumps({"out": args.out}))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="callweave")
    p.add_argument("--master", default="local[*]")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list").set_defaults(fn=cmd_list)
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out")
    q.add_argument("--explain", action="store_true")
    q.set_defaults(fn=cmd_query)
    s = sub.add_parser("summarize")
    which = s.add_mutually_exclusive_group(required=True)
    which.add_argument("--sf-dir")
    which.add_argument("--tables", help="prefix of the input tables, e.g. crm.")
    s.add_argument("--run-date")
    s.add_argument("--strict", action="store_true")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_summarize)
    i = sub.add_parser("ingest")
    i.add_argument("--pages", required=True)
    i.add_argument("--artifacts", required=True)
    i.add_argument("--recorded", required=True)
    i.add_argument("--history")
    i.add_argument("--results", help="table of transcription results to merge into --history")
    i.add_argument("--days", type=int, default=None)
    i.add_argument("--out", required=True)
    i.set_defaults(fn=cmd_ingest)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
