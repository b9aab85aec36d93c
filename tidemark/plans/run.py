"""One run over all tables of a source."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.names import collisions
from tidemark.operators.catalog import Source
from tidemark.operators.report import REPORT_SCHEMA, write_csv
from tidemark.plans.policy import Policy, modes, policy_frame, resume, unknown_tables
from tidemark.plans.replica import BUCKET_BYTES, Replica, import_state, state


class TablesFailed(RuntimeError):
    """Raised by a strict run; `report` has the details."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__(f"tables failed: {failed}")
        self.report = report


def run(
    spark: SparkSession, sources: Mapping[str, Source], root: str, policy: Policy = Policy(), *,
    exclude: Sequence[str] = (), start_index: int = 0, full_refresh: bool = False, lookback: Mapping[str, object] | None = None,
    order: Mapping[str, Sequence[str]] | None = None, bucket_bytes: int = BUCKET_BYTES, workers: int = 4, strict: bool = False,
    legacy_state: str | None = None, clean_age_seconds: float | None = 86_400.0, report_path: str | None = None,
) -> DataFrame:
    """Bring every table up to date and report on each; a table that fails stays as it was.

    Tables are independent Spark jobs. A few run at once, since most tables of a source
    are small and their cost is the job itself. Before its turn a table loses what crashed
    runs left behind; marks of an old state file are taken over when there is no state.
    Table names that a target could not tell apart fail the run before it starts; names
    that only the policy knows are most likely misspelt and are reported as failures.
    """
    if legacy_state is not None:
        import_state(spark, root, legacy_state)
    listing = spark.createDataFrame([(t,) for t in sources], "table_name STRING")
    rules = policy_frame(spark, policy)
    clash = [r["safe_name"] for r in collisions(listing, "table_name").collect()]
    if clash:
        raise ValueError(f"table names collide after sanitising: {sorted(clash)}")
    strangers = sorted(r[0] for r in unknown_tables(listing, rules).collect())
    plan = modes(listing, rules, state(spark, root), full_refresh, exclude)
    steps = resume(plan, start_index).collect()  # one row per table
    began = time.perf_counter()

    def sync(step) -> tuple:
        name = step["table_name"]
        start = time.perf_counter()
        opened, record, error = start, {}, None
        try:
            source = sources[name]
            df = source() if callable(source) else source
            opened = time.perf_counter()
            replica = Replica(spark, root, name)
            if clean_age_seconds is not None:
                replica.clean(clean_age_seconds)
            rule = policy.incremental.get(name, {})
            settings = {
                "keys": split_key(step["pk"]), "order": (order or {}).get(name) or split_key(rule.get("order")) or None,
                "bucket_bytes": bucket_bytes, **{k: rule.get(k) for k in ("fold_case", "latest", "collation", "track_types")},
            }
            if step["mode"] == "full":
                record = replica.full_refresh(df, field=step["field"], **settings)
            else:
                record = replica.increment(df, step["field"], lookback=(lookback or {}).get(name), **settings)
                if rule.get("deletes"):
                    replica.reconcile(df, bucket_bytes)
        except Exception as failure:
            error = str(failure)
        written = record["sizes"][record["folders"][-1]][0] if record.get("published") else None
        return (
            name, step["mode"], record.get("last_rows", 0) if error is None else 0, written,
            record.get("staged_sec", opened - start), time.perf_counter() - opened - record.get("staged_sec", 0.0),
            time.perf_counter() - began, error is None,
            record.get("watermark_value") if step["mode"] != "full" else None, error,
        )

    with ThreadPoolExecutor(workers) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(sync), steps))
    results += [(t, "unknown", 0, None, 0.0, 0.0, 0.0, False, None, "named in the policy, not in the source") for t in strangers]
    report = spark.createDataFrame(results, REPORT_SCHEMA)
    if report_path is not None:
        write_csv(report, report_path)
    failed = [r[0] for r in results if not r[7]]
    if strict and failed:
        raise TablesFailed(report, failed)
    return report


def split_key(pk: str | None) -> list[str]:
    return [k.strip() for k in pk.split(",")] if pk else []
