"""Regenerate docs/plans/: executed (final adaptive) plans of key queries.

Usage: python tools/save_plans.py [sf_dir]   (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from playerlake.plans import gold, silver  # noqa: E402
from playerlake.plans.queries import QUERIES  # noqa: E402
from playerlake.session import build_session  # noqa: E402

KEY_QUERIES = ["gold_player_summary", "gold_daily_metrics", "silver_purchases", "q_active_players"]

SKEW_TEST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")

    def save(name: str, df, note: str) -> None:
        df.write.format("noop").mode("overwrite").save()
        df.collect()  # run through the frame's own execution so its final plan is shown
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(note.strip() + "\n\n" + df._jdf.queryExecution().explainString(mode))

    for name in KEY_QUERIES:
        save(name, QUERIES[name](spark, sf_dir),
             f"# {name} at {os.path.basename(sf_dir)}, local[8]: final adaptive plan after execution")

    for key, value in SKEW_TEST_CONF.items():
        spark.conf.set(key, value)
    ids = F.col("id")
    logs = spark.range(60000).select(
        F.when(ids % 3 == 0, F.lit("P0")).otherwise(F.concat(F.lit("P"), (ids % 2000).cast("string")))
        .alias("_player_id"),
        F.concat(F.lit("S"), ids.cast("string")).alias("_session_id"),
        F.lit("2025-01-01T10:00:00").alias("_login"), F.lit("2025-01-01T11:00:00").alias("_logout"),
        F.array(F.lit("1")).alias("_action"), F.lit("1").alias("_platform"))
    players = spark.range(2000).select(
        F.concat(F.lit("P"), ids.cast("string")).alias("plid"), F.lit("US").alias("country"),
        F.lit("30").alias("age"), F.lit("2024-01-01").alias("acc_creat_date"), F.lit("1").alias("gender"))
    info = gold.players_info(silver.clean_game_logs(logs), silver.clean_players(players))
    save("hot_player_activity", gold.player_activity(info, "2025-01-10", unique_ids=True),
         "# player_activity over sessions x players with broadcast disabled and one player owning a third of\n"
         "# all sessions (tiny skew thresholds so the case shows at test size): SortMergeJoin(skew=true).")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
