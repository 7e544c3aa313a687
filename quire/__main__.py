"""Run a registered query: ``python -m quire KEY [SF_DIR] [--out PATH] [--show N] [--explain]``.

Without ``--out`` the first N rows are printed; with it the full result is
written as Parquet (one Spark job, nothing collected).  ``--list`` prints
the keys with their one-line descriptions.
"""

from __future__ import annotations

import argparse
import sys

from .plans import load_all
from .session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m quire")
    ap.add_argument("key", nargs="?")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--out")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--master", default=None)
    ap.add_argument("--list", action="store_true")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    args = ap.parse_args(argv)
    reg = load_all()
    if args.list or not args.key:
        for name, q in reg.items():
            doc = (q.build.__doc__ or "").strip().splitlines()
            print(f"{name:28s} {doc[0] if doc else ''}")
        return 0
    if args.key not in reg:
        print(f"unknown key {args.key!r}; use --list", file=sys.stderr)
        return 2
    spark = build_session(args.master, f"quire-{args.key}")
    df = reg[args.key].build(spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    elif args.out:
        df.write.mode("errorifexists").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
