"""Write the physical plans of the key operators to PLANS.md.

usage: python scripts/capture_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import importlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from quayside.functions.quoting import encode_columns  # noqa: E402
from quayside.operators import audit as A  # noqa: E402
from quayside.operators import selection as S  # noqa: E402
from quayside.operators import tables as TB  # noqa: E402
from quayside.operators import telemetry as TL  # noqa: E402
from quayside.plans.landing import land_ranges  # noqa: E402
from quayside.plans.registry import manifest  # noqa: E402
from quayside.session import get_session  # noqa: E402
from quayside.sources.feeds import FEED_BY_KEY  # noqa: E402
from quayside.sources.lines import read_numbered_lines, tagged_lines  # noqa: E402

convert_mod = importlib.import_module("quayside.plans.convert")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    t = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    li = t("lineitem")
    fields = [F.col(c).cast("string") for c in ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]]
    text = land_ranges(spark, li.withColumn("value", encode_columns(fields, ";")), "value",
                       ["l_orderkey", "l_linenumber"], "plans-lineitem", 4)
    feed = FEED_BY_KEY["30D_SALES"]
    prof = convert_mod.profile_source(spark, [text], feed)
    table, _, _ = convert_mod.build_table(spark, prof, feed, True)
    parsed = TB.parse(tagged_lines(spark, [text]), feed.delimiter, feed.repair_dangling_quote).withColumn("line_no", F.col("_rid"))
    file, split, place = convert_mod.origin()
    one_pass = TB.to_table_named(parsed, TB.positional_names(4), [file, split, TB.checked(4, place, "bigint").alias("_rid")])
    events = t("events")
    left = li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("string").alias("price"))
    right = li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("string").alias("price"))
    sections = [
        ("Strict conversion, the one pass over the text (A2 + A3 + B2 + A5 + G1)", one_pass),
        ("Conversion with a quarantine, write pass (A5 + G1 over numbered, parsed lines)", table),
        ("Line numbers (A2 + A3)", read_numbered_lines(spark, text)),
        ("Latest file per feed (C1 + C2)", S.latest_by_stamp(S.candidates(manifest(spark, sf)))),
        ("Keep last 1,000 per key (J1)", TL.retain_last(events, ["event_type"], ts="ts", tiebreak="event_id")),
        ("Log expiry (J2)", TL.expire_keys(events, ["user_id"])),
        ("Block digests of a diff (E3)", A.differing_blocks(left, right, ["l_orderkey", "l_linenumber"], ["price"])),
        ("Whole-table diff (E3) of equal tables: the digests have met, nothing is joined", A.table_diff(left, right, ["l_orderkey", "l_linenumber"])),
        ("The full join of a diff (E3)", A.joined_diff(left, right, ["l_orderkey", "l_linenumber"])),
        ("Parquet statistics (D2)", A.parquet_stats(spark, f"{sf}/lineitem.parquet")),
    ]
    out = ["# Physical plans of the key operators", "",
           f"Generated by `scripts/capture_plans.py` on `{os.path.basename(sf)}` (local[8]; AQE re-plans at run time).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan_of(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
