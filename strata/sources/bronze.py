"""Bronze load: six CSV extracts -> six raw tables, with a load audit.

Each table is a full refresh.  Parsing happens once: the typed rows are
written with the line of those that did not parse in ``_corrupt_record``.  The
bronze table is the rows where that is NULL (pushed down to the files), the
quarantine the others; nothing is sorted or shuffled.  Rows, quarantined lines
and the row-level checks are counted while the files are written.

A table that fails does not stop the others.  What became of each table is
appended to the run's log, the audit shows the latest outcome of each, and the
load raises at its end; a reopened run loads only what is not loaded yet.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import BRONZE, TABLES
from strata.sources.csv import CORRUPT, SOURCE_FILES, read_csv, write_csv
from strata.sources.store import LayerStore, input_state, run_concurrently

AUDIT_SCHEMA = ("layer string, table_name string, row_count long, quarantined long, seconds double, "
                "status string, error string")
BATCH = "(all)"  # the audit row of a whole load
ERROR_CHARS = 500


class LoadFailed(RuntimeError):
    """Some tables of a layer did not load; the run's log has them all."""


def audit(store: LayerStore, layer: str) -> DataFrame:
    """One row per table, with its latest outcome in the run's log, and the
    batch total: 'failed' if a table did, its time that of the last load."""
    rows, batch = {}, {"seconds": 0.0}
    for e in store.events():
        if e["layer"] == layer:
            if e["table"] == BATCH:
                batch = e
            else:
                rows[e["table"]] = e
    done = [(layer, t, rows[t]["rows"], rows[t]["quarantined"], rows[t]["seconds"], rows[t]["status"],
             rows[t]["error"]) for t in TABLES if t in rows]
    status = "loaded" if len(done) == len(TABLES) and all(r[5] == "loaded" for r in done) else "failed"
    total = (layer, BATCH, sum(r[2] for r in done), sum(r[3] for r in done), batch["seconds"], status, None)
    return store.spark.createDataFrame([*done, total], AUDIT_SCHEMA)


def extract_state(spark: SparkSession, landing_dir: str, table: str) -> str:
    """Changes with the extract's files."""
    return input_state(spark, f"{landing_dir.rstrip('/')}/{SOURCE_FILES[table]}")


def load_layer(store: LayerStore, layer: str, load: Callable[[str], tuple[int, int]],
               source: Callable[[str], str | None] = lambda table: None, only: str | None = None) -> DataFrame:
    """Run ``load`` (to rows and quarantined lines) for every table that the
    run's log does not have as loaded, all at the same time; the audit.
    ``source`` tells the state of a table's input, for the log.  ``only`` one
    table: the batch is not ended by it."""
    began = time.time()
    last = {e["table"]: e["status"] for e in store.events() if e["layer"] == layer}

    def one(table: str) -> Exception | None:
        t0 = time.time()
        rows, bad, error, state = 0, 0, None, None
        try:
            state = source(table)
            rows, bad = load(table)
        except Exception as e:  # kept in the log, raised after the other tables
            error = e
        store.log(layer=layer, table=table, rows=rows, quarantined=bad, seconds=round(time.time() - t0, 3),
                  status="failed" if error else "loaded", input=state,
                  error=f"{type(error).__name__}: {error}"[:ERROR_CHARS] if error else None)
        return error

    todo = [t for t in ([only] if only else TABLES) if last.get(t) != "loaded"]
    errors = {t: e for t, e in run_concurrently({t: (lambda t=t: one(t)) for t in todo}).items() if e}
    if not only:
        store.log(layer=layer, table=BATCH, seconds=round(time.time() - began, 3),
                  status="failed" if errors else "loaded")
    if errors:
        raise LoadFailed(f"{layer}: " + "; ".join(f"{t}: {e}" for t, e in errors.items())) \
            from next(iter(errors.values()))
    return audit(store, layer)


def load_csv_table(store: LayerStore, landing_dir: str, table: str, null_values: tuple[str, ...] = ("",),
                   checks: dict[str, Column] | None = None) -> tuple[int, int]:
    """Load one extract into ``bronze/<table>``; returns (rows, quarantined)."""
    raw = read_csv(store.spark, f"{landing_dir.rstrip('/')}/{SOURCE_FILES[table]}",
                   BRONZE[table], null_values=null_values)
    good = F.col(CORRUPT).isNull()
    store.write(raw, "bronze_staged", table, observe={
        "rows": F.count_if(good), "quarantined": F.count(CORRUPT),
        **{k: F.count_if(good & c) for k, c in (checks or {}).items()}})
    seen = store.metrics("bronze_staged", table)
    return seen["rows"], seen["quarantined"]


def bronze_table(store: LayerStore, table: str) -> DataFrame:
    return store.read("bronze_staged", table).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine_table(store: LayerStore, table: str) -> DataFrame:
    return store.read("bronze_staged", table).filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def load_bronze(store: LayerStore, landing_dir: str, null_values: tuple[str, ...] = ("",),
                checks: Callable[[str], dict[str, Column]] = lambda table: {},
                only: str | None = None) -> DataFrame:
    """All six loads (independent, run concurrently), or that of ``only`` one
    table; the audit has one row per table and the batch total."""
    return load_layer(store, "bronze", lambda t: load_csv_table(store, landing_dir, t, null_values, checks(t)),
                      lambda t: extract_state(store.spark, landing_dir, t), only)


def land_sources(spark: SparkSession, tables: dict[str, DataFrame], landing_dir: str,
                 null_value: str = "", malformed: dict[str, DataFrame] | None = None,
                 compression: str = "none") -> None:
    """Write source tables as CSV extracts in the fixed folder layout, with
    the given malformed rows (columns of text) beside them."""
    def one(table: str, df: DataFrame) -> None:
        path = f"{landing_dir.rstrip('/')}/{SOURCE_FILES[table]}"
        write_csv(df, path, null_value, compression=compression)
        if malformed and table in malformed:
            write_csv(malformed[table], path, null_value, append=True, compression=compression)

    run_concurrently({t: (lambda t=t, df=df: one(t, df)) for t, df in tables.items()})
