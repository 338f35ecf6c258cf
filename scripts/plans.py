"""Write the physical plan trees of the headline queries to PLANS.md.

    python scripts/plans.py [sf_dir]
"""
import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HEADLINE = ["fact_build", "dimension_build", "mart_topk_with_score", "mart_topk_per_year", "mart_profile",
            "mart_trend_pivot", "mart_correlation", "filt_partition", "agg_dedup", "win_rank"]


def main():
    from tallystar.plans.catalog import QUERIES
    from tallystar.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/plans.py` on `{Path(sf).name}`: initial physical plans (AQE may still "
           "switch a join to broadcast or coalesce partitions at run time).",
           "Only the operator tree and the scan lines are kept.", ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        scans = [ln for ln in text.splitlines()
                 if re.match(r"^(PushedFilters|PartitionFilters|ReadSchema):", ln)]
        out += [f"## {name}", "", "```", tree.strip(), *scans, "```", ""]
    Path("PLANS.md").write_text("\n".join(out))


if __name__ == "__main__":
    main()
