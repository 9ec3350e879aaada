"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quadrat.queries import QUERIES  # noqa: E402
from quadrat.session import build_session  # noqa: E402

HEADLINE = [
    "share_matrix_pivot", "group_total_mean_max", "composition_rank", "group_mode_tiebreak", "latest_per_group", "monthly_union_mean",
    "forward_fill_by_key", "group_position", "quantile_bins", "quantile_tiers", "even_chunks", "validated_merge_indicator", "hierarchy_lookup",
    "worklist_expand_report", "resume_antijoin", "onehot_encode", "summary_stats", "weighted_crosstab", "ttest_groups", "wls_one_way_fe",
    "fe_two_way", "abstract_rebuild", "paper_subset", "name_clean", "dictionary_substitute", "gazetteer_matches", "html_links", "html_text",
    "village_tables", "compose_inputs", "embed_hash", "entity_extract", "retry_ledger",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds, failed = {}, {}
    for name in HEADLINE:
        start = time.perf_counter()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        except Exception as error:  # the other queries are still measured
            failed[name] = str(error).splitlines()[0][:200]
            print(name, failed[name], file=sys.stderr, flush=True)
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "errors": failed, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
