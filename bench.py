"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rillflow.catalog import QUERIES  # noqa: E402
from rillflow.session import build_session  # noqa: E402

HEADLINE = [
    "sales_by_age", "sales_by_gender", "item_detail_page", "order_wide", "order_match_state",
    "dau_enriched", "dau_by_hour_two_days", "log_split_messages", "log_split_page", "change_facts",
    "word_count", "retract_changelog", "min_vs_minby", "tumbling_15s", "sliding_window",
    "session_window", "count_window_10_2", "full_window_function", "jump_alert", "rise_alarm",
    "late_triage", "inverted_index", "match_or_scored", "match_phrase", "terms_by_avg",
    "scan_family_rows", "salted_sorted_load", "put_documents", "delete_cells",
    "stream_word_count", "stream_tumbling", "stream_jump_alert", "stream_dau", "stream_order_wide",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench")
    names = sys.argv[1:] or HEADLINE
    QUERIES["group_count"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        # Every row and column is computed, none is collected.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
