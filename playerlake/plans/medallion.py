"""End-to-end run: raw landing files -> bronze -> silver -> gold tables.

Each layer is written before the next one reads it. The written tables are the
hand-off to BI readers, and they cut the lineage: a lost executor in a gold
stage recomputes from silver files, never from raw text. Gold reports read the
*written* denormalised tables, so the session x player join runs once.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from playerlake.clock import run_date
from playerlake.plans import analysis, gold, silver
from playerlake.session import configure
from playerlake.sources.tables import DEFAULT_FORMAT, read_table, write_table
from playerlake.streaming.ingest import MAX_FILES_PER_TRIGGER, IngestResult, ingest_source

BRONZE_TABLES = {
    "game_logs": "bronze_game_logs",
    "player_profiles": "bronze_players",
    "purchases": "bronze_purchases",
}


@dataclass
class MedallionRun:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    ingested: dict[str, IngestResult] = field(default_factory=dict)
    as_of: gold.AsOf = None


def table_ref(warehouse: str | None, name: str, database: str | None = None) -> str:
    """A path under ``warehouse`` or, without one, a (qualified) catalog table name."""
    if warehouse:
        return f"{warehouse.rstrip('/')}/{name}"
    return f"{database}.{name}" if database else name


def run(
    spark: SparkSession,
    raw_root: str,
    checkpoint_root: str,
    warehouse: str | None = None,
    as_of: gold.AsOf = None,
    fmt: str = DEFAULT_FORMAT,
    database: str | None = None,
    archive_root: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> MedallionRun:
    """Ingest new raw files and rebuild silver and gold.

    ``raw_root`` holds one landing folder per source (``game_logs``,
    ``player_profiles``, ``purchases``). Stream checkpoints live under
    ``checkpoint_root``, which must be shared storage on a cluster. Tables are
    folders under ``warehouse`` or, without one, catalog tables (in
    ``database`` when given). With ``archive_root`` every ingested raw file is
    moved there after its batch commits, so the landing folders stay small.
    ``fmt`` is the format of every layer; a micro-batch reads at most
    ``max_files_per_trigger`` files. ``as_of`` is the day that account ages and
    activity are measured from, by default today: the clock is read once a run, and
    the day is stored with the player summary.
    """
    configure(spark)
    as_of = run_date() if as_of is None else as_of
    out = MedallionRun(as_of=as_of)

    def ref(name: str) -> str:
        return table_ref(warehouse, name, database)

    for source, table in BRONZE_TABLES.items():
        target = ref(table)
        out.ingested[table] = ingest_source(
            spark, source, f"{raw_root.rstrip('/')}/{source}", target,
            f"{checkpoint_root.rstrip('/')}/{source}",
            archive_dir=f"{archive_root.rstrip('/')}/{source}" if archive_root else None,
            sink_format=fmt, max_files_per_trigger=max_files_per_trigger,
        )
        out.tables[table] = read_table(spark, target, fmt)

    cleaners = {
        "silver_game_logs": (silver.clean_game_logs, "bronze_game_logs"),
        "silver_players": (silver.clean_players, "bronze_players"),
        "silver_purchases": (silver.clean_purchases, "bronze_purchases"),
    }
    for table, (clean, source_table) in cleaners.items():
        out.tables[table] = write_table(
            clean(out.tables[source_table]), ref(table), fmt
        )

    logs = out.tables["silver_game_logs"]
    players = out.tables["silver_players"]
    purchases = out.tables["silver_purchases"]

    info = write_table(gold.players_info(logs, players), ref("gold_players_info"), fmt)
    paid = write_table(
        gold.players_purchases(purchases, players), ref("gold_players_purchases"), fmt
    )
    out.tables["gold_players_info"] = info
    out.tables["gold_players_purchases"] = paid

    daily = gold.daily_metrics(gold.daily_session_metrics(info), gold.daily_purchase_metrics(paid))
    out.tables["gold_daily_metrics"] = write_table(daily, ref("gold_daily_metrics"), fmt)

    engagement = gold.player_engagement(info, gold.actions_summary(logs, players), as_of)
    summary = gold.player_summary(engagement, gold.player_spend(paid))
    day = {"as_of": str(as_of)} if isinstance(as_of, (str, _dt.date)) else {}
    out.tables["gold_player_summary"] = write_table(
        summary, ref("gold_player_summary"), fmt, info=day
    )
    return out


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose every layer under its table name as a temporary view.

    SQL written against the layer names (``SELECT ... FROM gold_player_summary``)
    then runs unchanged through ``spark.sql``; the views are lazy plans over the
    written (or in-memory) tables.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def answers(tables: dict[str, DataFrame], only: str | None = None) -> dict[str, DataFrame]:
    """Every analysis question over a set of silver/gold tables (lazy frames), or only one.

    Keys that the tables are known to have (those of ``run`` are) make the plans cheaper.
    """
    players, info, paid = "silver_players", "gold_players_info", "gold_players_purchases"
    daily, summary = "gold_daily_metrics", "gold_player_summary"
    questions = {
        "q_total_players": (analysis.total_players, players),
        "q_active_players": (analysis.active_players, summary),
        "q_new_players": (analysis.new_players, summary),
        "q_players_by_country": (analysis.players_by_country, players),
        "q_hours_by_action": (analysis.hours_by_action, summary),
        "q_hours_by_platform": (analysis.hours_by_platform, summary),
        "q_sessions_by_weekday": (analysis.sessions_by_weekday, info),
        "q_players_by_age_gender": (analysis.players_by_age_gender, info),
        "q_retention": (analysis.retention, summary),
        "q_feature_mix": (analysis.feature_mix, summary),
        "q_revenue_by_month": (analysis.revenue_by_month, paid),
        "q_engagement_spend": (analysis.engagement_spend, summary),
        "q_revenue_by_item": (analysis.revenue_by_item, paid),
        "q_transactions_by_payment": (analysis.transactions_by_payment, paid),
        "q_daily_totals": (analysis.daily_totals, daily),
        "engagement_spend_correlation": (analysis.engagement_spend_correlation, summary),
    }
    chosen = questions if only is None else {only: questions[only]}
    return {name: question(tables[table]) for name, (question, table) in chosen.items()}
