"""Command line: ``python -m marketlake <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from marketlake.plans import jobs, silver
from marketlake.session import build_session
from marketlake.streaming import fold, trades


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marketlake")
    sub = top.add_subparsers(dest="job", required=True)

    p = sub.add_parser("silver", help="raw responses to silver tables")
    p.add_argument("--raw", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--global-schema", default="active_cryptocurrencies bigint, markets bigint, updated_at bigint")

    p = sub.add_parser("gold", help="silver tables to the star schema")
    p.add_argument("--silver", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--mode", choices=["full", "incremental"], default="incremental")
    p.add_argument("--since", help="time of the last run, for incremental; without it the files no build has read count")
    p.add_argument("--snapshot-date", help="add the latest market rows as prices of this date")
    p.add_argument("--flat", action="store_true", help="unpartitioned price fact")

    for name, text in (("analyse", "indicators and patterns"), ("recommend", "recommendations of the top coins")):
        p = sub.add_parser(name, help=text)
        p.add_argument("--gold", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--as-of", required=True)

    p = sub.add_parser("summary", help="summary of the newest run")
    p.add_argument("--out", required=True)

    p = sub.add_parser("trades", help="land raw trades and one-minute candles from message files")
    p.add_argument("--messages", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--candles", required=True)
    p.add_argument("--checkpoints", required=True)
    p.add_argument("--undecodable", help="folder of the messages that cannot be decoded; default: beside bronze")
    p.add_argument("--rows-per-file", type=int, default=trades.FLUSH_ROWS, help="most rows of a bronze file, 0 for no limit")
    p.add_argument("--late", help="folder of the trades whose candles were closed before they came; default: beside the candles")
    p.add_argument("--compact", action="store_true", help="fold the candle files of each symbol and date into one at the end")
    p.add_argument("--final", help="the feed ends here: folder for the candles still open")
    p.add_argument("--seconds", type=int, help="stop after this long; without it drain what is there")
    return top


def run(args: argparse.Namespace) -> None:
    spark = build_session(f"marketlake-{args.job}")
    if args.job == "silver":
        inner = spark.createDataFrame([], args.global_schema).schema
        print("written:", ", ".join(silver.convert_all(spark, args.raw, args.silver, inner)))
    elif args.job == "gold":
        jobs.build_gold(spark, args.silver, args.gold, args.mode, args.since, args.snapshot_date, args.flat)
    elif args.job == "analyse":
        print("patterns stored:", jobs.analyse(spark, args.gold, args.out, args.as_of))
    elif args.job == "recommend":
        jobs.recommend_top(spark, args.gold, args.out, args.as_of)
    elif args.job == "summary":
        jobs.summarise(spark, args.out).select(F.to_json(F.struct("*"))).show(truncate=False)
    else:
        messages = trades.read_messages(spark, args.messages)
        bounded = args.seconds is None
        late = args.late or f"{args.candles.rstrip('/')}_late"
        bad = args.undecodable or f"{args.bronze.rstrip('/')}_undecodable"
        running = [
            trades.land_bronze(messages, args.bronze, f"{args.checkpoints}/bronze", bounded, args.rows_per_file),
            trades.land_undecodable(messages, bad, f"{args.checkpoints}/undecodable", bounded),
            fold.fold_candles(messages, args.candles, late, f"{args.checkpoints}/candles", bounded=bounded),
        ]
        for query in running:
            query.awaitTermination(args.seconds) if args.seconds else query.awaitTermination()
            query.stop()
        print(fold.totals(spark, f"{args.checkpoints}/candles"))
        if args.compact:
            print("files folded:", fold.compact_candles(spark, args.candles))
        if args.final:
            fold.flush_candles(spark, f"{args.checkpoints}/candles", args.final)


if __name__ == "__main__":
    run(parser().parse_args())
