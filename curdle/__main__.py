"""Command line: ``python -m curdle <step> --warehouse DIR [--raw DIR --batch N]``.

steps: bronze (load the manifest files found in --raw as run --batch), silver, gold, test, all.
"""

from __future__ import annotations

import argparse
import json

from curdle.plans import pipeline
from curdle.session import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="curdle")
    p.add_argument("step", choices=["bronze", "silver", "gold", "test", "all"])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--raw")
    p.add_argument("--batch", type=int)
    p.add_argument("--lenient", action="store_true", help="bad text casts give null instead of failing")
    args = p.parse_args(argv)
    spark = build_session()
    if args.step in ("bronze", "all"):
        if not args.raw or args.batch is None:
            p.error("bronze needs --raw and --batch")
        for row in pipeline.run_bronze(spark, args.raw, args.warehouse, args.batch):
            print(json.dumps(row, default=str))
    if args.step in ("silver", "all"):
        pipeline.run_silver(spark, args.warehouse, strict=not args.lenient)
    if args.step in ("gold", "all"):
        pipeline.run_gold(spark, args.warehouse)
    if args.step in ("test", "all"):
        for r in pipeline.run_tests(spark, args.warehouse).orderBy("model", "column_name", "test").collect():
            print(json.dumps(r.asDict()))


if __name__ == "__main__":
    main()
