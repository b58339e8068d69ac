"""The daily job (X1-X3, L6): gate and land raw batches, transform them,
materialise once, then replace today's slice of each landing table.

Every step is eager only where the reference's step is (gates, writes);
rows never travel to the driver, only gate reports and counts do.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from terrapipe.operators import quality as Q
from terrapipe.operators.hierarchy import transform_municipalities, transform_states
from terrapipe.schemas import MUNICIPALITY_RAW, STATE_RAW
from terrapipe.session import delete_path
from terrapipe.sinks.files import preview, publish, write_csv, write_json, write_parquet
from terrapipe.sinks.landing import replace_day
from terrapipe.sources.readers import read_if_present, read_json, read_parquet

# Dataset registry: raw schema, raw gate rules, transform, contract key and
# landing limits. The load order is fixed: municipalities, then states.
DATASETS = {
    "municipalities": (MUNICIPALITY_RAW, Q.RAW_MUNICIPALITY_RULES, transform_municipalities,
                       ("territory", "municipalities"), Q.MUNICIPALITY_LANDING_RULES),
    "states": (STATE_RAW, Q.RAW_STATE_RULES, transform_states,
               ("territory", "states"), Q.STATE_LANDING_RULES),
}


def _run_id() -> str:
    return uuid.uuid4().hex


def landing_path(base: str, dataset: str) -> str:
    return f"{base.rstrip('/')}/landing/{dataset}"


def ingest(df: DataFrame, dataset: str, raw_base: str, single_pass: bool = False) -> str:
    """Gate 1 on a raw batch, land it as compressed JSON Lines, return the path.

    The gate runs before anything is written. ``single_pass`` gates while
    writing (one read of the input instead of two) and deletes the run
    directory of a batch that is rejected or fails."""
    _, rules, _, _, _ = DATASETS[dataset]
    path = f"{raw_base.rstrip('/')}/{dataset}/run={_run_id()}"
    if single_pass:
        try:
            Q.enforce_while_writing(df, rules, lambda checked: write_json(checked, path, compressed=True), f"raw {dataset}")
        except Exception:
            delete_path(df.sparkSession, path)
            raise
        return path
    Q.enforce(df, rules, f"raw {dataset}")
    return write_json(df, path, compressed=True)


def transform_stage(spark: SparkSession, raw_paths: dict[str, str | None], out_base: str,
                    export_csv: bool = True, preview_rows: int = 0,
                    tables: dict[str, str] | None = None, sort: bool = True) -> dict[str, dict]:
    """For each dataset whose raw input exists, read (explicit schema),
    transform, write Parquet once; CSV export and preview read that Parquet
    back instead of recomputing from the raw input. Missing inputs are
    reported as skipped (S5). With ``tables``, each finished run directory
    is then published as that catalog table (readers switch only after the
    write succeeded). ``sort=False`` leaves out the output order (O1) where
    only a load follows."""
    result: dict[str, dict] = {}
    for dataset, path in raw_paths.items():
        schema, _, transform, _, _ = DATASETS[dataset]
        raw = read_if_present(spark, path, lambda path=path, schema=schema: read_json(spark, path, schema)) if path else None
        if raw is None:
            result[dataset] = {"skipped": True, "path": None}
            continue
        run = f"{out_base.rstrip('/')}/{dataset}/run={_run_id()}"
        parquet = write_parquet(transform(raw, sort=sort), f"{run}/parquet")
        entry = {"skipped": False, "path": parquet}
        if export_csv:
            entry["csv"] = write_csv(read_parquet(spark, parquet), f"{run}/csv")
        if preview_rows:
            entry["preview"] = preview(read_parquet(spark, parquet), preview_rows)
        if tables and dataset in tables:
            publish(spark, tables[dataset], parquet)
            entry["table"] = tables[dataset]
        result[dataset] = entry
    return result


def load_all(spark: SparkSession, datasets: dict[str, DataFrame], base: str,
             load_ts: dt.datetime | str | None = None) -> dict[str, int]:
    """Replace the day slice of each landing table in registry order;
    a dataset without a contract is loaded unchecked (G11)."""
    counts: dict[str, int] = {}
    for dataset in [d for d in DATASETS if d in datasets] + [d for d in datasets if d not in DATASETS]:
        contract, limits = None, ()
        if dataset in DATASETS:
            _, _, _, key, limits = DATASETS[dataset]
            contract = Q.CONTRACTS.get(key)
        counts[dataset] = replace_day(datasets[dataset], landing_path(base, dataset), load_ts,
                                      contract, limits)
    return counts


def run_day(spark: SparkSession, raw_states: DataFrame | None, raw_municipalities: DataFrame | None,
            base: str, load_ts: dt.datetime | str | None = None, export_csv: bool = False,
            single_pass_ingest: bool = False) -> dict[str, int]:
    """Collect -> transform -> load for one day, stopping at the first
    failure. Rerun-safe: the load replaces the day instead of appending.
    Only datasets produced by this run are loaded (D9). Raw batches are
    gated before they are landed; a rejected one leaves nothing behind."""
    base = base.rstrip("/")
    raw_paths: dict[str, str | None] = {}
    for dataset, df in (("municipalities", raw_municipalities), ("states", raw_states)):
        raw_paths[dataset] = (ingest(df, dataset, f"{base}/raw", single_pass_ingest)
                              if df is not None else None)
    staged = transform_stage(spark, raw_paths, f"{base}/processed", export_csv=export_csv, sort=export_csv)
    produced = {d: read_parquet(spark, s["path"]) for d, s in staged.items() if not s["skipped"]}
    return load_all(spark, produced, base, load_ts)
