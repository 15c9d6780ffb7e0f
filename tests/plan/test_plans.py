"""Physical-plan properties that keep the pipeline fast at scale."""

from __future__ import annotations

import pytest

from playerlake.plans.queries import QUERIES, Layers
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF_SMALL)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("bronze_")])
def test_no_python_udf_no_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_no_expand_in_session_aggregates(layers):
    from playerlake.plans import gold

    for df in (gold.daily_session_metrics(layers.info, unique_ids=True), gold.player_activity(layers.info, unique_ids=True),
               gold.daily_purchase_metrics(layers.paid, unique_ids=True), gold.player_spend(layers.paid, unique_ids=True)):
        assert "Expand" not in _plan(df)


def test_no_expand_without_known_keys(layers):
    """Distinct counts of several columns copy no wide rows, and combine map-side."""
    from playerlake.facts import facts_of
    from playerlake.plans import gold

    assert not facts_of(layers.info_by_action).key and not facts_of(layers.paid_twice).key
    for df in (gold.daily_session_metrics(layers.info_by_action), gold.player_activity(layers.info_by_action, "2024-02-14"),
               gold.daily_purchase_metrics(layers.paid_twice), gold.player_spend(layers.paid_twice)):
        assert "Expand" not in _plan(df)


def test_counts_over_a_known_key_move_no_players(spark, scratch, layers):
    from playerlake.plans import medallion
    from playerlake.sources.tables import write_table

    tables = {name: write_table(layers.tables()[name], f"{scratch}/{name}") for name in ("silver_players", "gold_player_summary")}
    tables |= {name: df for name, df in layers.tables().items() if name not in tables}
    for name in ("q_total_players", "q_active_players", "q_new_players"):
        exchanges = [line for line in _plan(medallion.answers(tables, only=name)[name]).splitlines() if "Exchange" in line]
        assert len(exchanges) == 1 and "SinglePartition" in exchanges[0], name


def test_facts_follow_the_layers(layers):
    from playerlake.facts import facts_of, has_key

    keys = {name: facts_of(df).key for name, df in layers.tables().items()}
    assert keys == {
        "silver_game_logs": ("SessionID",), "silver_players": ("PlayerID",), "silver_purchases": ("TransactionID",),
        "gold_players_info": ("SessionID",), "gold_players_purchases": ("TransactionID",),
        "gold_daily_metrics": ("SessionDate", "Country"), "gold_player_summary": ("PlayerID",),
    }
    for name, df in layers.tables().items():
        assert df.groupBy(*keys[name]).count().where("count > 1").count() == 0, name
    foreign = layers.game_logs.select("*")  # another frame: nothing is known
    from playerlake.plans import gold

    assert not has_key(gold.players_info(foreign, layers.players), "SessionID")
    assert not facts_of(gold.players_info(layers.game_logs, layers.players.select("*"))).determines


def test_distinct_rows_move_only_rows_that_occur_again(layers):
    from playerlake.operators.distinct import distinct_rows

    plan = _plan(distinct_rows(layers.info.drop("Actions")))
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert any("__h1" in line for line in exchanged)


def test_session_statistics_are_hash_aggregates(layers):
    """No list, map or string buffer is carried per player; median and mode see one row for each age."""
    from playerlake.plans import gold

    def above_the_session_table(df):
        plan = _plan(df)
        return plan[: plan.index("Join")]

    daily = above_the_session_table(gold.daily_session_metrics(layers.info, unique_ids=True))
    by_player = [line for line in daily.splitlines() if "PlayerID" in line and "Aggregate" in line]
    assert by_player and all("HashAggregate" in line and "Object" not in line and "percentile" not in line and "max_by" not in line for line in by_player)
    activity = above_the_session_table(gold.player_activity(layers.info, unique_ids=True))
    assert "ObjectHashAggregate" not in activity and "SortAggregate" not in activity and "collect_set" not in activity


def test_unique_ids_change_the_plan_and_not_the_answer(layers):
    from playerlake.plans import analysis, gold

    def close(a, b):
        rows = [sorted((tuple(r.asDict().values()) for r in df.select(sorted(df.columns)).collect()), key=repr) for df in (a, b)]
        assert len(rows[0]) == len(rows[1]) > 0
        for x, y in zip(*rows):
            assert all(p == pytest.approx(q, rel=1e-9) if isinstance(p, float) else p == q for p, q in zip(x, y)), (x, y)

    for build, table in ((gold.daily_session_metrics, layers.info), (gold.daily_purchase_metrics, layers.paid), (gold.player_spend, layers.paid),
                         (lambda t, unique_ids: gold.player_activity(t, "2024-02-14", unique_ids), layers.info),
                         (analysis.players_by_country, layers.players), (analysis.retention, layers.summary),
                         (analysis.transactions_by_payment, layers.paid)):
        close(build(table, unique_ids=True), build(table, unique_ids=False))
    close(analysis.feature_mix(layers.summary, unique_rows=True), analysis.feature_mix(layers.summary))


def test_statistics_of_null_and_single_ages(spark):
    from playerlake.plans import gold

    rows = [("2024-01-01", "US", f"P{k}", f"S{k}", 1.0, age) for k, age in enumerate([None, None])]
    rows += [("2024-01-02", "US", "P9", "S9", 2.0, 30), ("2024-01-03", None, "P1", "Sa", None, 20), ("2024-01-03", None, "P2", "Sb", 1.0, 40)]
    info = spark.createDataFrame(rows, "SessionDate string, Country string, PlayerID string, SessionID string, SessionTimeLength double, Age int")
    got = [sorted((tuple(r) for r in gold.daily_session_metrics(info, unique_ids=u).collect()), key=repr) for u in (True, False)]
    assert got[0] == got[1]


def test_shares_scan_once_and_the_mix_reads_its_columns(spark, scratch, layers):
    from playerlake.plans import analysis
    from playerlake.sources.tables import write_table

    table = write_table(layers.summary, f"{scratch}/gold_player_summary_shares")
    for df in (analysis.retention(table, unique_ids=True), analysis.players_by_country(table, unique_ids=True)):
        assert _plan(df).count("FileScan") == 1
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = analysis.feature_mix(table, unique_rows=True)._jdf.queryExecution().explainString(mode)
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert len(schema.split("struct<", 1)[1].split(",")) == 11
    assert "distinct" not in text.lower()


def test_actions_join_players_without_a_distinct(layers):
    from playerlake.plans import gold

    both = [_plan(gold.actions_exploded(layers.game_logs, layers.players, unique_ids=u)) for u in (True, False)]
    assert both[0].count("Aggregate") < both[1].count("Aggregate")


def test_dedup_is_combined_map_side(layers):
    plan = _plan(layers.purchases)
    # partial and final aggregate around one exchange; no window over whole groups
    assert plan.count("SortAggregate") >= 2 and "Window" not in plan


def test_action_counts_aggregate_before_join(layers):
    plan = _plan(layers.actions_summary)
    generate = plan.find("Generate")
    assert generate != -1 and "HashAggregate" in plan


def test_filters_and_columns_pushed_to_parquet(spark, scratch, layers):
    from playerlake.plans import analysis
    from playerlake.sources.tables import write_table

    table = write_table(layers.summary, f"{scratch}/gold_player_summary")
    df = analysis.active_players(table)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")][0]
    assert "EqualTo(IsActive,true)" in pushed and "GreaterThan(AccountAgeDays,15)" in pushed
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    fields = schema.split("struct<", 1)[1].rstrip(">").split(",")
    assert sorted(fields) == ["AccountAgeDays:int", "IsActive:boolean", "PlayerID:string"]


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_player_is_split_in_the_session_join(spark):
    """One player owns a third of all sessions and players is too big to broadcast."""
    from pyspark.sql import functions as F

    from playerlake.plans import gold, silver

    saved = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        ids = F.col("id")
        logs = spark.range(30000).select(
            F.when(ids % 3 == 0, F.lit("P0")).otherwise(F.concat(F.lit("P"), (ids % 1000).cast("string"))).alias("_player_id"),
            F.concat(F.lit("S"), ids.cast("string")).alias("_session_id"),
            F.lit("2025-01-01T10:00:00").alias("_login"), F.lit("2025-01-01T11:00:00").alias("_logout"),
            F.array(F.lit("1")).alias("_action"), F.lit("1").alias("_platform"))
        players = spark.range(1000).select(
            F.concat(F.lit("P"), ids.cast("string")).alias("plid"), F.lit("US").alias("country"),
            F.lit("30").alias("age"), F.lit("2024-01-01").alias("acc_creat_date"), F.lit("1").alias("gender"))
        info = gold.players_info(silver.clean_game_logs(logs), silver.clean_players(players))
        rows = info.collect()
        assert len(rows) == 30000
        assert "SortMergeJoin(skew=true)" in _plan(info).split("Initial Plan")[0]
        # the same join under a per-player aggregate: split as well (forced skew join)
        for unique_ids in (False, True):
            activity = gold.player_activity(info, "2025-01-10", unique_ids)
            hot = [r.TotalSessions for r in activity.collect() if r.PlayerID == "P0"]
            assert hot == [10000 + 20]  # id % 3 == 0, plus multiples of 1000 not divisible by 3
            assert "SortMergeJoin(skew=true)" in _plan(activity).split("Initial Plan")[0]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
