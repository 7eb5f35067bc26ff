"""Many tables in one run, and the report on them: O4, O5, R2, R3, K7."""

from __future__ import annotations

import logging
from collections.abc import Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.targets import Target
from .load import RESULT_SCHEMA, LoadResult, load_table
from .spec import TableSpec

log = logging.getLogger(__name__)


def load_all(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    as_of: datetime | None = None,
    *,
    workers: int = 1,
    policy: str = "isolate",
    attempts: int = 1,
    left_out: Mapping[str, str] | None = None,
    expected: Collection[str] = (),
    run_log: Target | None = None,
) -> DataFrame:
    """Load every table and report one row per table.

    ``workers`` tables are loaded at a time; with ``spark.scheduler.mode`` FAIR
    each has its own pool, so that a large table does not hold up the others.
    Under ``isolate`` a failed table is a row of the report and the others go
    on; under ``fail_fast`` the first error ends the run. A table is tried
    ``attempts`` times. Each try finds the rows an earlier one brought in;
    ``append`` does not look for them, so it is tried once. ``left_out`` (table
    -> reason) and the tables of ``expected`` that no spec covers are reported
    as well. The report is also added to ``run_log``, which also tells specs with a
    high-water mark when their table was last loaded.
    """
    if policy not in ("isolate", "fail_fast"):
        raise ValueError(f"unknown failure policy: {policy!r}")
    specs, as_of = list(specs), as_of or datetime.now(UTC)
    marks = _marks(spark, specs, run_log)

    def tried(spec: TableSpec) -> LoadResult:
        for _again in range(0 if spec.mode == "append" else attempts - 1):
            try:
                return load_table(spark, spec, as_of, since=marks.get(spec.name))
            except Exception:
                log.warning("%s: failed, will be tried again", spec.name, exc_info=True)
        return load_table(spark, spec, as_of, since=marks.get(spec.name))

    def one(spec: TableSpec) -> LoadResult:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            return tried(spec)
        except Exception as error:
            if policy == "fail_fast":
                raise
            reason = f"{type(error).__name__}: {error}"
            return LoadResult(spec.name, spec.mode, "failed", reason, as_of=as_of)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if workers == 1:
        results = [one(spec) for spec in specs]
    else:
        with ThreadPoolExecutor(min(workers, len(specs) or 1)) as threads:
            started = [threads.submit(inheritable_thread_target(spark)(one), s) for s in specs]
            try:
                results = [future.result() for future in started]
            except BaseException:
                threads.shutdown(cancel_futures=True)
                raise

    covered = {spec.name for spec in specs}
    for name, reason in (left_out or {}).items():
        results.append(LoadResult(name, "none", "skipped", reason, as_of=as_of))
        covered.add(name)
    results += [
        LoadResult(name, "none", "missing", "expected, not found", as_of=as_of)
        for name in expected
        if name not in covered
    ]
    report = spark.createDataFrame([r.row() for r in results], RESULT_SCHEMA)
    if run_log is not None:
        run_log.append(report.coalesce(1))
    return report


def _marks(spark: SparkSession, specs: list[TableSpec], run_log: Target | None) -> dict[str, int]:
    """Table -> start of its last successful load, for the specs that ask."""
    names = [spec.name for spec in specs if spec.high_water]
    found = last_success(spark, run_log) if names and run_log is not None else None
    if found is None:
        return {}
    micros = F.unix_micros("as_of").alias("micros")
    return {r.table: r.micros for r in found.filter(F.col("table").isin(names)).select("table", micros).collect()}


def totals(report: DataFrame) -> DataFrame:
    """Tables per status."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def last_success(spark: SparkSession, run_log: Target) -> DataFrame | None:
    """When each table was last loaded: columns ``table`` and ``as_of``."""
    log = run_log.read(spark)
    if log is None:
        return None
    return (
        log.filter(F.col("status") == "success")
        .groupBy("table")
        .agg(F.max("as_of").alias("as_of"))
    )
