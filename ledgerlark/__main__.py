"""Command line: ``python -m ledgerlark <command> ...``

  run     --input DIR --out DIR     build every stage table from the shared
                                    tables in DIR (adapters) into DIR/out
  run     --feed PATH --products FILE --new-products FILE --stores FILE
          [--pulls PATH] --out DIR  the same from real files
  ingest  --landing DIR --raw DIR   load new daily CSV files from a landing
                                    folder into the raw table (file stream,
                                    availableNow, date-level idempotence)
  load    --landing DIR --root DIR  load what the landing folder offers, exactly
                                    once, with file ledger, ingestion log and
                                    quality log under the root

The master comes from ``spark-submit`` (or ``--master`` for local runs).
"""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlark")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--input")
    for name in ("--feed", "--products", "--new-products", "--stores", "--pulls"):
        r.add_argument(name)
    r.add_argument("--out", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landing", required=True)
    i.add_argument("--raw", required=True)
    i.add_argument("--checkpoint", default=None)
    e = sub.add_parser("load")
    e.add_argument("--landing", required=True)
    e.add_argument("--root", required=True)
    args = ap.parse_args(argv)

    from ledgerlark.session import get_spark
    spark = get_spark(args.master)
    if args.cmd == "run":
        from ledgerlark.plans.pipeline import FeedPipeline
        if args.feed:
            if not (args.products and args.new_products and args.stores):
                ap.error("--feed needs --products, --new-products and --stores")
            p = FeedPipeline.from_files(spark, args.feed, args.products, args.new_products, args.stores, args.pulls,
                                        materialize=False)
        elif args.input:
            p = FeedPipeline(spark, args.input, materialize=False)
        else:
            ap.error("run needs --input or --feed")
        paths = p.run(args.out)
        print(json.dumps(paths))
    elif args.cmd == "load":
        from ledgerlark.streaming.ledger import load
        print(json.dumps({"root": args.root, "epoch": load(spark, args.landing, args.root)}))
    else:
        from ledgerlark.streaming.incremental import start
        start(spark, args.landing, args.raw, args.checkpoint)
        print(json.dumps({"raw": args.raw}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
