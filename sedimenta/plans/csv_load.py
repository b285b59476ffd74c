"""Header-less CSV files as a full load of a table and an ORC snapshot."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

from sedimenta.operators.align import align_to
from sedimenta.plans.raw import table_name
from sedimenta.sinks.files import archive_files, has_success_marker, require_own_names, write_many, write_orc
from sedimenta.sinks.tables import replace_all
from sedimenta.sources.csv_scan import read_csv_like
from sedimenta.sources.files import has_files
from sedimenta.sources.ledger import ARCHIVED, CLAIMED, LOADED, SUPERSEDED, Ledger, files_in, only_claimed
from sedimenta.sources.tables import require_schema


def csv_full_load(spark: SparkSession, config: dict[str, Any]) -> int:
    """Replace the table and the snapshot, then archive the files that were read.

    A table beside the target keeps a ledger of files. The load claims those it finds and reads no others: files that
    arrive while it runs are left for the next one. A load that died before both sinks were written is superseded by the
    next one, over its files and those that came since; one that died later has its archiving finished first.
    """
    folder = f"{config['source_path'].rstrip('/')}/{config['tablename']}"
    archive = f"{config['archive_path'].rstrip('/')}/{config['tablename']}"
    table = table_name(config, config["database"], config["tablename"])
    ledger = Ledger.open(spark, table)
    for batch in ledger.batches(LOADED, [ARCHIVED]):
        archive_files(spark, ledger.paths(batch), archive)
        ledger.mark(batch, ARCHIVED)
    for batch in ledger.batches(CLAIMED, [LOADED, SUPERSEDED]):
        ledger.mark(batch, SUPERSEDED)
    if not has_files(spark, folder):
        return 0
    batch = ledger.claim(files_in(spark, folder, "*.csv"))
    claimed = ledger.claimed(batch)
    require_own_names(claimed)
    legacy = config.get("schema_table", table)
    stored = require_schema(spark, table)
    rows = write_many(only_claimed(read_csv_like(spark, folder, legacy, "*.csv"), claimed), [
        lambda df: replace_all(align_to(df, stored), table),
        lambda df: write_orc(df, config["orc_location"]),
    ])
    if rows == 0:
        ledger.mark(batch, SUPERSEDED)
        return 0
    if not has_success_marker(spark, config["orc_location"]):
        raise RuntimeError(f"no _SUCCESS below {config['orc_location']}: inputs stay in place")
    ledger.mark(batch, LOADED)
    archive_files(spark, ledger.paths(batch), archive)
    ledger.mark(batch, ARCHIVED)
    return rows
