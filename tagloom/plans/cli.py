"""Command line for the daily jobs: one run date per invocation, like the original jobs.

python -m tagloom.plans.cli interest --dt 20240102 --input <behavior table> --state <dir>
python -m tagloom.plans.cli slots    --dt 20240102 --input <browse table> --state <dir> --summary <dir>
python -m tagloom.plans.cli basic    --dt 20240102 --input <member table> --state <dir> [--as-of 2018-07-15]
python -m tagloom.plans.cli push     --dt 20240102 --state <interest dir> --out <parquet dir>
python -m tagloom.plans.cli push     --dt 20240102 --state <interest dir> --jdbc-url <url> --jdbc-table <table>
python -m tagloom.plans.cli push     --dt 20240102 --state <interest dir> --parts <published folder>
python -m tagloom.plans.cli view     --dt 20240102 --state <interest dir> --slots <dir> --summary <dir> --cells <dir> --out <dir>
"""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession

from . import jobs


def _date(s: str) -> str:
    if not re.fullmatch(r"\d{8}|\d{4}-\d{2}-\d{2}", s):
        raise argparse.ArgumentTypeError("expected yyyyMMdd or yyyy-MM-dd")
    return s


def main(argv=None):
    p = argparse.ArgumentParser(prog="tagloom")
    p.add_argument("job", choices=["interest", "slots", "basic", "push", "view"])
    p.add_argument("--dt", required=True, type=_date)
    p.add_argument("--input")
    p.add_argument("--state", required=True)
    p.add_argument("--slots", help="view: the slots job's state")
    p.add_argument("--cells", help="view: the basic job's state")
    p.add_argument("--families", help="view: the families wanted, comma-separated (all if not given)")
    p.add_argument("--summary")
    p.add_argument("--out")
    p.add_argument("--as-of")
    p.add_argument("--rule", default="calendar", choices=["calendar", "reference"], help="age rule of the basic job")
    p.add_argument("--null-int-as-zero", action="store_true", help="basic: a null gender or terminal counts as 0")
    p.add_argument("--missing-birth", default="zero", choices=["zero", "unknown"], help="basic: the age of a missing birth date")
    p.add_argument("--decay", type=float, help="interest: factor of the daily decay")
    p.add_argument("--threshold", type=float, help="interest: weights up to this expire")
    p.add_argument("--buckets", type=int, help="buckets of a state that is written anew")
    p.add_argument("--compact-share", type=float, help="share of the base's cells in deltas that makes a new base")
    p.add_argument("--expire", default="drop", choices=["drop", "keep_stale"])
    p.add_argument("--decay-inactive", action="store_true")
    p.add_argument("--keep-null-product", action="store_true")
    p.add_argument("--summary-slots", default="today", choices=["today", "all"])
    p.add_argument("--seed", default="max", choices=["max", "min"])
    p.add_argument("--exclude-seen", action="store_true")
    p.add_argument("--id-mode", default="md5", choices=["md5", "random"])
    p.add_argument("--parts", help="push: a folder whose dates are published whole (sources/published.py)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-table")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="user, password, driver, ...")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tagloom-{a.job}").getOrCreate()

    def given(**options):
        return {k: v for k, v in options.items() if v not in (None, False)}

    layout = given(buckets=a.buckets, compact_share=a.compact_share)
    if a.job == "interest":
        print(jobs.interest_job(spark, spark.read.parquet(a.input), a.state, a.dt, expire=a.expire,
                                decay_inactive=a.decay_inactive, keep_null_product=a.keep_null_product,
                                **given(decay=a.decay, threshold=a.threshold), **layout))
    elif a.job == "slots":
        print(jobs.slots_job(spark, spark.read.parquet(a.input), a.state, a.summary, a.dt, summary=a.summary_slots, **layout))
    elif a.job == "basic":
        missing = a.missing_birth if a.missing_birth != "zero" else None
        print(jobs.basic_tags_job(spark, spark.read.parquet(a.input), a.state, a.dt, as_of=a.as_of, rule=a.rule,
                                  **given(null_int_as_zero=a.null_int_as_zero, missing_birth=missing), **layout))
    elif a.job == "view":
        families = {"families": tuple(a.families.split(","))} if a.families else {}
        view = jobs.profile_view(spark, a.dt, a.state, a.slots, a.summary, a.cells, **families)
        view.write.mode("overwrite").partitionBy("family").parquet(a.out)
        print(a.out)
    else:
        jdbc = None
        if a.jdbc_url:
            jdbc = {"url": a.jdbc_url, "table": a.jdbc_table, "properties": dict(x.split("=", 1) for x in a.jdbc_property)}
        print(*jobs.push_job(spark, a.state, a.dt, seed=a.seed, exclude_seen=a.exclude_seen, id_mode=a.id_mode,
                             parquet_path=a.out, jdbc=jdbc, **given(parts=a.parts)))


if __name__ == "__main__":
    main()
