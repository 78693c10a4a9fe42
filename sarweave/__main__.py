"""python -m sarweave: build, scan, check or query, on the session that spark-submit or the environment gives."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from sarweave import catalog
from sarweave.config import DEFAULT
from sarweave.plans import build, qa
from sarweave.session import session


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sarweave", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in build.STAGES:
        s = sub.add_parser(name, help=f"run the build up to the stage {name}")
        s.add_argument("root")
        s.add_argument("dest")
        s.add_argument("--resume", action="store_true")
        s.add_argument("--tile", type=int, default=DEFAULT.tile)
        s.add_argument("--neg-buffer", type=int, default=DEFAULT.neg_buffer)
        s.add_argument("--neg-ratio", type=float, default=DEFAULT.neg_ratio)
        s.add_argument("--seed", type=int, default=DEFAULT.seed)
        s.add_argument("--label-override", action="append", default=[], metavar="KEY=LABEL")
        s.add_argument("--calibrated-match", action="append", default=[])
        s.add_argument("--uncalibrated-match", action="append", default=[])
    s = sub.add_parser("query", help="show a registered query over a folder of tables")
    s.add_argument("name", choices=sorted(catalog.QUERIES))
    s.add_argument("dir")
    a = p.parse_args(args)
    spark = session()
    if a.command == "query":
        catalog.QUERIES[a.name](spark, a.dir).show(truncate=False)
        return 0
    c = replace(
        DEFAULT, tile=a.tile, stride=max(1, a.tile // 2), neg_buffer=a.neg_buffer, neg_ratio=a.neg_ratio, seed=a.seed,
        label_overrides=dict(x.split("=", 1) for x in a.label_override), calibrated_match=tuple(a.calibrated_match), uncalibrated_match=tuple(a.uncalibrated_match),
    )
    out = build.build(spark, a.root, a.dest, c, fresh=not a.resume, upto=a.command)
    out[a.command].show(20)
    if a.command != "findings":
        return 0
    qa.rollup(out["findings"]).show()
    return 2 if out["findings"].where((F.col("severity") == "hard") & ~F.col("ok")).count() else 0


if __name__ == "__main__":
    sys.exit(main())
