"""Incremental file ingest: exactly the new files, nothing twice."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import uuid

from playerlake.session import local_path
from playerlake.sources.schemas import GAME_LOGS_SCHEMA, PLAYERS_SCHEMA
from playerlake.sources.tables import compact_table, current_state, read_quarantine, read_table
from playerlake.streaming.ingest import RAW_FILE, RAW_RECORD, ingest_source, land_raw


def _players(spark, ids):
    return spark.createDataFrame(
        [(f"P{i}", "US", "30", "2025-01-01", "1") for i in ids], PLAYERS_SCHEMA
    )


def test_two_files_then_rerun_then_third(spark, scratch):
    landing, target, ckpt = f"{scratch}/raw", f"{scratch}/bronze_players", f"{scratch}/_ckpt"
    land_raw(_players(spark, [1, 2]).coalesce(1), "player_profiles", landing)
    land_raw(_players(spark, [3]).coalesce(1), "player_profiles", landing)

    first = ingest_source(spark, "player_profiles", landing, target, ckpt)
    assert first.rows == 3
    assert sorted(r.plid for r in read_table(spark, target).collect()) == ["P1", "P2", "P3"]

    again = ingest_source(spark, "player_profiles", landing, target, ckpt)
    assert again.rows == 0
    assert read_table(spark, target).count() == 3

    land_raw(_players(spark, [4, 5]).coalesce(1), "player_profiles", landing)
    third = ingest_source(spark, "player_profiles", landing, target, ckpt)
    assert third.rows == 2
    assert sorted(r.plid for r in read_table(spark, target).collect()) == ["P1", "P2", "P3", "P4", "P5"]
    assert read_table(spark, target).dtypes == [(f.name, "string") for f in PLAYERS_SCHEMA.fields]


def test_json_source_reads_numbers_as_strings(spark, scratch):
    from playerlake.session import local_path
    import os

    landing = local_path(f"{scratch}/raw_logs")
    os.makedirs(landing)
    with open(f"{landing}/logs-1.json", "w") as fh:
        fh.write('{"_player_id": "P1", "_session_id": "S1", "_login": "2025-01-01T10:00:00", '
                 '"_logout": "2025-01-01T11:00:00", "_action": [0, 3, 1], "_platform": 1}\n')
    result = ingest_source(spark, "game_logs", landing, f"{scratch}/bronze_logs", f"{scratch}/_ckpt_logs")
    row = read_table(spark, f"{scratch}/bronze_logs").collect()[0]
    assert result.rows == 1
    assert row._action == ["0", "3", "1"] and row._platform == "1"


def test_bounded_micro_batches(spark, scratch):
    landing, target, ckpt = f"{scratch}/raw_b", f"{scratch}/bronze_b", f"{scratch}/_ckpt_b"
    for ids in ([1], [2, 3], [4]):
        land_raw(_players(spark, ids).coalesce(1), "player_profiles", landing)
    result = ingest_source(spark, "player_profiles", landing, target, ckpt, max_files_per_trigger=1)
    assert (result.rows, result.batches) == (4, 3)
    assert read_table(spark, target).count() == 4


def test_archive_keeps_the_landing_folder_small(spark, scratch):
    import glob

    from playerlake.session import local_path

    landing, target, ckpt = f"{scratch}/raw_a", f"{scratch}/bronze_a", f"{scratch}/_ckpt_a"
    archive = f"{scratch}/archive"
    for ids in ([1], [2], [3]):
        land_raw(_players(spark, ids).coalesce(1), "player_profiles", landing)
    result = ingest_source(spark, "player_profiles", landing, target, ckpt,
                           max_files_per_trigger=1, archive_dir=archive)
    assert result.rows == 3 and read_table(spark, target).count() == 3
    archived = glob.glob(local_path(archive) + "/**/*.csv", recursive=True)
    left = glob.glob(local_path(landing) + "/*.csv")
    assert len(archived) >= 2 and len(archived) + len(left) == 3


def test_the_report_counts_every_batch(spark, scratch):
    landing, target, ckpt = f"{scratch}/raw_c", f"{scratch}/bronze_c", f"{scratch}/_ckpt_c"
    for k in range(6):
        land_raw(_players(spark, [k]).coalesce(1), "player_profiles", landing)
    result = ingest_source(spark, "player_profiles", landing, target, ckpt, max_files_per_trigger=1)
    assert (result.rows, result.batches) == (6, 6)
    assert ingest_source(spark, "player_profiles", landing, target, ckpt).batches == 0


def _lines(folder, name, *lines):
    os.makedirs(local_path(folder), exist_ok=True)
    with open(f"{local_path(folder)}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


GOOD = '{"_player_id": "P1", "_session_id": "S1", "_action": [0, 3], "_platform": 1}'


def test_broken_json_lines_go_to_the_quarantine(spark, scratch):
    landing, target, ckpt = f"{scratch}/raw", f"{scratch}/bronze_logs", f"{scratch}/_ckpt"
    _lines(landing, "a.json", GOOD, '{"_player_id": "P2", "_sess', "not json", GOOD.replace("S1", "S2"), '{"_player_id": "P3", "_action": "none"}')
    result = ingest_source(spark, "game_logs", landing, target, ckpt)
    assert (result.rows, result.quarantined, result.batches) == (2, 3, 1)
    bronze = read_table(spark, target)
    assert bronze.schema.names == GAME_LOGS_SCHEMA.names and sorted(r._session_id for r in bronze.collect()) == ["S1", "S2"]
    broken = read_quarantine(spark, target).collect()
    assert sorted(r[RAW_RECORD] for r in broken) == sorted(['{"_player_id": "P2", "_sess', "not json", '{"_player_id": "P3", "_action": "none"}'])
    assert all(r[RAW_FILE].endswith("/a.json") for r in broken)
    _lines(landing, "b.json", "{{")
    again = ingest_source(spark, "game_logs", landing, target, ckpt)
    assert (again.rows, again.quarantined) == (0, 1)
    assert read_table(spark, target).count() == 2 and read_quarantine(spark, target).count() == 4


def test_csv_lines_of_other_lengths_go_to_the_quarantine(spark, scratch):
    landing, target, ckpt = f"{scratch}/raw", f"{scratch}/bronze_players", f"{scratch}/_ckpt"
    _lines(landing, "a.csv", "plid,country,age,acc_creat_date,gender", "P1,US,30,2025-01-01,1", "P2,US", "P3,US,30,2025-01-01,1,more,still", 'P4,"A, B",30,2025-01-01,1', "P5,,,,")
    result = ingest_source(spark, "player_profiles", landing, target, ckpt)
    assert (result.rows, result.quarantined) == (3, 2)
    assert sorted((r.plid, r.country) for r in read_table(spark, target).collect()) == [("P1", "US"), ("P4", "A, B"), ("P5", None)]
    assert sorted(r[RAW_RECORD] for r in read_quarantine(spark, target).collect()) == ["P2,US", "P3,US,30,2025-01-01,1,more,still"]


def test_a_batch_is_written_without_a_sort(tmp_path):
    """A task holds none of its rows, as its execution memory tells, though broken and whole records alternate in it."""
    (tmp_path / "raw").mkdir()
    (tmp_path / "log").mkdir()
    lines = "".join(f"P{i},US,30,2025-01-01,1\nP{i},US\n" for i in range(2000))
    (tmp_path / "raw" / "a.csv").write_text("plid,country,age,acc_creat_date,gender\n" + lines)
    code = (
        "import sys\n"
        "from playerlake.session import build_session\n"
        "from playerlake.sources.tables import read_quarantine, read_table\n"
        "from playerlake.streaming.ingest import ingest_source\n"
        "at = sys.argv[1]\n"
        "spark = build_session('local[2]', shuffle_partitions=2, extra={'spark.eventLog.enabled': 'true', 'spark.eventLog.dir': 'file://' + at + '/log', 'spark.eventLog.compress': 'false', 'spark.eventLog.rolling.enabled': 'false'})\n"
        "got = ingest_source(spark, 'player_profiles', at + '/raw', at + '/bronze', at + '/ckpt')\n"
        "print('GOT', got.rows, got.quarantined, read_table(spark, at + '/bronze').where(\"country = 'US' and gender = '1'\").count(), read_quarantine(spark, at + '/bronze').where('_corrupt_record is not null').count())\n"
        "spark.stop()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=root)
    assert "GOT 2000 2000 2000 2000" in out.stdout, out.stderr
    ends = [json.loads(line) for log in (tmp_path / "log").iterdir() for line in log.read_text().splitlines() if '"SparkListenerTaskEnd"' in line]
    written = [e["Task Metrics"] for e in ends if e["Task Metrics"]["Output Metrics"]["Records Written"] == 4000]
    assert len(written) == 1 and written[0]["Peak Execution Memory"] == 0


def test_a_replayed_batch_adds_nothing(spark, scratch):
    """The stream's own commit is lost, as if the job died between the table's commit and the checkpoint's."""
    landing, target, ckpt = f"{scratch}/raw", f"{scratch}/bronze_players", f"{scratch}/_ckpt"
    for ids in ([1, 2], [3]):
        land_raw(_players(spark, ids).coalesce(1), "player_profiles", landing)
    assert ingest_source(spark, "player_profiles", landing, target, ckpt, max_files_per_trigger=1).rows == 3
    state = current_state(spark, target)
    for name in os.listdir(local_path(f"{ckpt}/commits")):
        if name.strip(".").startswith("1"):
            os.remove(local_path(f"{ckpt}/commits/{name}"))
    again = ingest_source(spark, "player_profiles", landing, target, ckpt, max_files_per_trigger=1)
    assert (again.rows, again.batches) == (0, 0)
    assert current_state(spark, target).folders == state.folders and read_table(spark, target).count() == 3
    land_raw(_players(spark, [4]).coalesce(1), "player_profiles", landing)
    assert ingest_source(spark, "player_profiles", landing, target, ckpt).rows == 1
    assert sorted(r.plid for r in read_table(spark, target).collect()) == ["P1", "P2", "P3", "P4"]


def test_two_streams_feed_one_table(spark, scratch):
    target = f"{scratch}/bronze_players"
    for part, ids in (("x", [1, 2]), ("y", [3])):
        land_raw(_players(spark, ids).coalesce(1), "player_profiles", f"{scratch}/raw_{part}")
        ingest_source(spark, "player_profiles", f"{scratch}/raw_{part}", target, f"{scratch}/_ckpt_{part}")
    assert read_table(spark, target).count() == 3
    assert sorted(s["rows"] for s in current_state(spark, target).streams.values()) == [1, 2]


def test_an_empty_landing_folder_gives_an_empty_table(spark, scratch):
    os.makedirs(local_path(f"{scratch}/raw"))
    result = ingest_source(spark, "game_logs", f"{scratch}/raw", f"{scratch}/bronze", f"{scratch}/_ckpt")
    assert (result.rows, result.batches) == (0, 0)
    assert read_table(spark, f"{scratch}/bronze").dtypes == [(f.name, f.dataType.simpleString()) for f in GAME_LOGS_SCHEMA.fields]
    assert read_table(spark, f"{scratch}/bronze").count() == 0 and read_quarantine(spark, f"{scratch}/bronze").count() == 0


def test_compaction_keeps_rows_ledger_and_quarantine(spark, scratch):
    landing, target, ckpt = f"{scratch}/raw", f"{scratch}/bronze_players", f"{scratch}/_ckpt"
    for ids in ([1], [2], [3]):
        land_raw(_players(spark, ids).coalesce(1), "player_profiles", landing)
    _lines(landing, "broken.csv", "plid,country,age,acc_creat_date,gender", "P9")
    ingest_source(spark, "player_profiles", landing, target, ckpt, max_files_per_trigger=1)
    before = current_state(spark, target)
    compact_table(spark, target)
    after = current_state(spark, target)
    assert len(before.folders) == 3 and len(after.folders) == 1 and after.streams == before.streams
    assert sorted(r.plid for r in read_table(spark, target).collect()) == ["P1", "P2", "P3"] and read_quarantine(spark, target).count() == 1
    land_raw(_players(spark, [4]), "player_profiles", landing)
    assert ingest_source(spark, "player_profiles", landing, target, ckpt).rows == 1
    assert read_table(spark, target).count() == 4


def test_a_catalog_table_shows_every_batch(spark, scratch):
    database = f"playerlake_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch}/db'")
    landing, target, ckpt = f"{scratch}/raw", f"{database}.bronze_players", f"{scratch}/_ckpt"
    os.makedirs(local_path(landing))
    assert ingest_source(spark, "player_profiles", landing, target, ckpt).rows == 0
    assert spark.table(target).columns == PLAYERS_SCHEMA.names and spark.table(target).count() == 0
    for ids in ([1], [2, 3], [4]):
        land_raw(_players(spark, ids).coalesce(1), "player_profiles", landing)
    assert ingest_source(spark, "player_profiles", landing, target, ckpt, max_files_per_trigger=1).batches == 3
    assert sorted(r.plid for r in spark.table(target).collect()) == ["P1", "P2", "P3", "P4"]
    compact_table(spark, target)
    assert spark.table(target).count() == 4 and len(current_state(spark, target).folders) == 1
