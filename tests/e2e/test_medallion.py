"""Raw files -> bronze -> silver -> gold tables -> answers equals the lazy in-memory path."""

from __future__ import annotations

import pytest

from __spark_entry__ import comparable
from playerlake.plans import medallion
from playerlake.plans.queries import AS_OF, QUERIES
from playerlake.plans.questions_sql import QUESTIONS
from playerlake.sources import adapter
from playerlake.streaming.ingest import land_raw
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    from playerlake.session import scratch_dir

    root = scratch_dir(spark, "e2e")
    for source, df in adapter.bronze_frames(spark, SF_SMALL).items():
        land_raw(df, source, f"{root}/raw/{source}")
    result = medallion.run(spark, f"{root}/raw", f"{root}/_checkpoints", f"{root}/warehouse", as_of=AS_OF)
    return root, result


def _rows(df):
    return sorted(comparable(df).collect(), key=repr)


@pytest.mark.parametrize("table", [
    "silver_game_logs", "silver_players", "silver_purchases", "gold_players_info",
    "gold_players_purchases", "gold_daily_metrics", "gold_player_summary",
])
def test_tables_equal_in_memory_path(spark, run, table):
    _, result = run
    assert _rows(result.tables[table]) == _rows(QUERIES[table](spark, SF_SMALL))


def test_answers_equal_in_memory_path(spark, run):
    _, result = run
    answers = medallion.answers(result.tables)
    assert len(answers) == 16
    for name, df in answers.items():
        assert _rows(df) == _rows(QUERIES[name](spark, SF_SMALL)), name


def test_sql_questions_run_on_registered_views(spark, run):
    _, result = run
    names = medallion.register_views(result.tables)
    assert "gold_player_summary" in names
    answers = medallion.answers(result.tables)
    assert len(QUESTIONS) == 15
    for name, sql in QUESTIONS.items():
        assert _rows(spark.sql(sql)) == _rows(answers[name]), name


# The order each question asks for and its tie-breaks, columns with -1 descending.
ORDERS = {
    "q_players_by_country": [("Players", -1), ("Country", 1)], "q_hours_by_action": [("HoursPlayed", -1), ("FavoriteAction", 1)],
    "q_hours_by_platform": [("HoursPlayed", -1), ("PrimaryPlatform", 1)], "q_sessions_by_weekday": [("SessionWeekDay", 1)],
    "q_players_by_age_gender": [("AgeBin", 1), ("Gender", 1)], "q_revenue_by_month": [("Month", 1)],
    "q_revenue_by_item": [("TotalRevenue", -1), ("Item", 1)], "q_daily_totals": [("SessionDate", 1)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_answers_come_in_the_order_asked_for(spark, run, name):
    _, result = run
    medallion.register_views(result.tables)
    for rows in (medallion.answers(result.tables)[name].collect(), spark.sql(QUESTIONS[name]).collect()):
        keys = [tuple(r[c] for c, _ in ORDERS[name]) for r in rows]
        assert len(keys) > 1
        for before, after in zip(keys, keys[1:]):
            for x, y, (_, sign) in zip(before, after, ORDERS[name]):
                if x != y:
                    assert (x < y) == (sign > 0)
                    break


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_positions_are_the_order_of_the_answer(spark, run, name):
    from playerlake.plans import analysis

    answer = medallion.answers(run[1].tables)[name]
    placed = sorted(analysis.with_position(answer, name).collect(), key=lambda r: r.position)
    assert [r.position for r in placed] == list(range(1, len(placed) + 1))
    assert [tuple(r)[:-1] for r in placed] == [tuple(r) for r in answer.collect()]


def test_a_live_run_reads_the_clock_once(spark, run, monkeypatch):
    import datetime as dt

    from playerlake import clock
    from playerlake.sources.tables import current_state

    root, _ = run
    assert current_state(spark, f"{root}/warehouse/gold_player_summary").info["as_of"] == str(AS_OF)
    monkeypatch.setattr(medallion, "run_date", lambda: dt.date(2024, 2, 20))
    live = medallion.run(spark, f"{root}/raw", f"{root}/_live", f"{root}/live")
    assert live.as_of == dt.date(2024, 2, 20) and current_state(spark, f"{root}/live/gold_player_summary").info["as_of"] == "2024-02-20"
    ages = {a.PlayerID: a.AccountAgeDays - b.AccountAgeDays for a in live.tables["gold_player_summary"].collect() for b in run[1].tables["gold_player_summary"].collect() if a.PlayerID == b.PlayerID}
    assert ages and set(ages.values()) == {6}
    assert clock.run_date() == clock.run_date() and abs((clock.run_date() - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_purchases_fall_into_several_months(spark, run):
    _, result = run
    assert medallion.answers(result.tables)["q_revenue_by_month"].count() == 4


def test_all_layers_take_the_format_and_the_batch_bound(spark):
    from playerlake.session import local_path, scratch_dir
    import glob

    root = scratch_dir(spark, "e2e-orc")
    for source, df in adapter.bronze_frames(spark, SF_SMALL).items():
        land_raw(df.repartition(6), source, f"{root}/raw/{source}")
    result = medallion.run(spark, f"{root}/raw", f"{root}/_checkpoints", f"{root}/lake", as_of=AS_OF, fmt="orc", max_files_per_trigger=2)
    assert {t: r.batches for t, r in result.ingested.items()} == {t: 3 for t in medallion.BRONZE_TABLES.values()}
    assert result.ingested["bronze_purchases"].rows == 6000
    for name in result.tables:
        files = glob.glob(f"{local_path(root)}/lake/{name}/**/part-*", recursive=True)
        assert files and all(f.endswith(".orc") for f in files), name
    assert _rows(result.tables["gold_player_summary"]) == _rows(QUERIES["gold_player_summary"](spark, SF_SMALL))


def test_catalog_tables(spark):
    """The same run into catalog tables (streaming toTable, saveAsTable)."""
    import uuid

    from playerlake.session import scratch_dir

    root = scratch_dir(spark, "e2e-catalog")
    database = f"playerlake_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    for source, df in adapter.bronze_frames(spark, SF_SMALL).items():
        land_raw(df, source, f"{root}/raw/{source}")
    result = medallion.run(spark, f"{root}/raw", f"{root}/_checkpoints", as_of=AS_OF, database=database)
    tables = {t.name for t in spark.catalog.listTables(database)}
    assert {"bronze_game_logs", "silver_players", "gold_player_summary"} <= tables
    assert _rows(spark.table(f"{database}.gold_player_summary")) == _rows(
        QUERIES["gold_player_summary"](spark, SF_SMALL))
    assert result.ingested["bronze_purchases"].rows == 6000


def test_command_line_job(spark, run, capsys):
    from playerlake.__main__ import INITIAL_PARTITIONS_CONF, main
    from playerlake.sources.tables import read_table

    root, _ = run
    spark.conf.set(INITIAL_PARTITIONS_CONF, "4")
    try:
        assert main(["--raw-root", f"{root}/raw", "--warehouse", f"{root}/cli-lake", "--as-of", "2024-02-14", "--answers"]) == 0
    finally:
        spark.conf.unset(INITIAL_PARTITIONS_CONF)
    out = capsys.readouterr().out
    assert "bronze_game_logs: 1000 new rows" in out
    summary = read_table(spark, f"{root}/cli-lake/gold_player_summary")
    assert _rows(summary) == _rows(QUERIES["gold_player_summary"](spark, SF_SMALL))
    # every answer is written in full
    for name in medallion.answers(run[1].tables):
        assert _rows(read_table(spark, f"{root}/cli-lake/answer_{name}")) == _rows(QUERIES[name](spark, SF_SMALL))


# Runs last: it overwrites the tables the module fixture points at.
def test_rerun_ingests_nothing_new(spark, run):
    root, first = run
    assert first.ingested["bronze_game_logs"].rows == 1000
    summary_rows = first.tables["gold_player_summary"].count()
    # the rerun overwrites silver and gold, so the first run's scans are stale after it
    again = medallion.run(spark, f"{root}/raw", f"{root}/_checkpoints", f"{root}/warehouse", as_of=AS_OF)
    assert {t: r.rows for t, r in again.ingested.items()} == {
        "bronze_game_logs": 0, "bronze_players": 0, "bronze_purchases": 0}
    assert again.tables["gold_player_summary"].count() == summary_rows
