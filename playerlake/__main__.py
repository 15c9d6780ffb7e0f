"""Command line job: ingest new raw files and rebuild silver and gold.

    python -m playerlake --raw-root RAW --warehouse LAKE [--as-of 2025-03-31]
                         [--database DB] [--format parquet] [--answers]
                         [--max-files-per-trigger N] [--initial-partitions N]

Meant for ``spark-submit`` (the session comes from the submit configuration).
Stream checkpoints belong to the tables they feed: ``<warehouse>/_checkpoints``,
or for catalog tables a folder per database below the cluster's
``spark.checkpoint.dir``; ``--checkpoint-root`` overrides both. ``--answers``
writes every answer in full as a table next to the others.
"""

from __future__ import annotations

import argparse

from playerlake.plans import medallion
from playerlake.session import build_session, checkpoint_root
from playerlake.sources.tables import write_table
from playerlake.streaming.ingest import MAX_FILES_PER_TRIGGER

# AQE merges small partitions but does not split ordinary ones, so a shuffle
# starts with many: 4096 partitions of 128 MB are half a terabyte.
INITIAL_PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INITIAL_PARTITIONS = 4096


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="playerlake", description=__doc__.splitlines()[0])
    parser.add_argument("--raw-root", required=True,
                        help="folder with game_logs/, player_profiles/, purchases/")
    parser.add_argument("--warehouse", help="folder for the tables (default: catalog tables)")
    parser.add_argument("--database", help="catalog database when no --warehouse is given")
    parser.add_argument("--as-of", help="the 'today' of activity and account age (default: current date)")
    parser.add_argument("--format", default="parquet", help="table format (parquet, delta, ...)")
    parser.add_argument("--checkpoint-root", help="stream checkpoints (default: next to the tables)")
    parser.add_argument("--archive-root", help="move ingested raw files here after each batch")
    parser.add_argument("--answers", action="store_true", help="write every analysis answer as a table answer_<name>")
    parser.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES_PER_TRIGGER,
                        help="files of one ingest micro-batch (default %(default)s)")
    parser.add_argument("--initial-partitions", type=int, default=INITIAL_PARTITIONS,
                        help="shuffle partitions before AQE merges them, about the largest shuffle / 128 MB; "
                             "a setting of the cluster wins (default %(default)s)")
    args = parser.parse_args(argv)

    spark = build_session(app_name="playerlake")
    if spark.conf.get(INITIAL_PARTITIONS_CONF, None) is None:
        spark.conf.set(INITIAL_PARTITIONS_CONF, str(args.initial_partitions))
    checkpoints = args.checkpoint_root or (
        f"{args.warehouse.rstrip('/')}/_checkpoints" if args.warehouse
        else f"{checkpoint_root(spark).rstrip('/')}/playerlake-ingest/{args.database or 'default'}"
    )
    run = medallion.run(
        spark, args.raw_root, checkpoints,
        warehouse=args.warehouse, as_of=args.as_of, fmt=args.format, database=args.database,
        archive_root=args.archive_root, max_files_per_trigger=args.max_files_per_trigger,
    )
    for table, result in run.ingested.items():
        print(f"{table}: {result.rows} new rows in {result.batches} batches")
    if args.answers:
        for name, df in medallion.answers(run.tables).items():
            table = medallion.table_ref(args.warehouse, f"answer_{name}", args.database)
            written = write_table(df, table, args.format)
            print(f"{table}: {written.count()} rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
