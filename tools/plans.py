"""Write PLANS.md: physical plans of the main queries.

Usage: python tools/plans.py [sf_dir] > PLANS.md

The plans are shown with every broadcast ruled out (Spark's size threshold off), the shape a large cluster run takes when the
dimensions are too big to copy.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakelayer.operators import marts  # noqa: E402
from lakelayer.plans import catalog  # noqa: E402

LAZY = ("tag_duplicate", "daily_summary", "merge_upsert")

NOTES = {
    "tag_duplicate": "Repeated keys come from a partial + final aggregate over the key column alone and join the rows "
                     "null-safely, without a hint: AQE broadcasts them if their bytes are few, else sort-merges and "
                     "splits a hot key's rows.",
    "daily_summary": "The fact is aggregated on (date, store, product) before the joins, so they see one row per "
                     "group, not per sale; the lookups carry no hint.",
    "merge_upsert": "One full outer join on (key, salt), each side read and shuffled once; the salt spreads rows "
                    "with a null key.",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue().strip()
    # Control characters (the legacy-cast trim set) are shown escaped.
    return "".join(c if c >= " " or c == "\n" else f"\\x{ord(c):02x}" for c in text)


def main(argv):
    from lakelayer.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    print("# Physical plans\n")
    print(f"Generated by `python tools/plans.py {sf_dir}`. Broadcasts are ruled out")
    print("(`spark.sql.autoBroadcastJoinThreshold=-1`), the shape a large run takes when dimensions are too big to copy. Plans are")
    print("adaptive; AQE may still coalesce partitions, split skewed ones, or switch a join at run time.")
    print("Dedupe of string columns (`first`, `max(struct)`) plans as a sort-based aggregate, because Spark's")
    print("hash aggregate needs fixed-width buffers; it is still partial (map-side) and spills.\n")
    default_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in LAZY:
        for label in ("no broadcast",):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            if name == "daily_summary":
                df = marts.build_daily_summary(catalog._fact(spark, sf_dir), *catalog._dims(spark, sf_dir))
            else:
                df = catalog.QUERIES[name](spark, sf_dir)
            note = f"{NOTES[name]}\n\n" if name in NOTES else ""
            print(f"## {name} ({label})\n\n{note}```\n{plan_text(df)}\n```\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default_threshold)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
