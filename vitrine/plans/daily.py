"""The gated daily run."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import functions as F

from ..operators import health, quality
from ..session import stored
from ..sources.catalog import Warehouse
from . import publish, raw_load, transform


class GateFailed(RuntimeError):
    """A suite failed or the tables are unhealthy; `rows` holds what went wrong."""

    def __init__(self, message: str, rows):
        super().__init__(message)
        self.rows = rows


def resolver(house: Warehouse):
    return lambda table: house.read(table) if house.exists(table) else None


def quality_gate(house: Warehouse) -> None:
    """Raise unless all checks of the full suite pass. The list of checks is fixed, so its rows are few."""
    results = stored(quality.run_checks(house.spark, quality.full_suite(), resolver(house)), "quality")
    house.replace("report.quality_results", results)
    bad = quality.failed(results).collect()
    if bad:
        raise GateFailed(f"{len(bad)} checks failed: " + "; ".join(r.message for r in bad), bad)


def stage_checks(house: Warehouse, stage: str, run_time: datetime) -> None:
    """Record the checks of a stage in `lineage.stage_checks`, once per run; what fails there does not stop the run."""
    results = stored(quality.run_checks(house.spark, quality.stage_suite(stage), resolver(house)), "stage-checks")
    rows = results.withColumn("run_time", F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp"))
    house.append_once("lineage.stage_checks", rows, "test", run_time.isoformat(), stage)


def health_gate(house: Warehouse, as_of: datetime, report_path: str | None = None) -> str:
    """Raise when the tables are unhealthy; returns the status."""
    started = time.monotonic()
    checks = stored(health.full_check(house.spark, resolver(house), as_of), "health")
    house.replace("report.health_checks", checks)
    if report_path:
        publish.export_report(health.report(checks, as_of, time.monotonic() - started), report_path)
    status = health.summary(checks).first().status
    if status == "unhealthy":
        bad = health.alerts(checks, as_of).collect()
        raise GateFailed("unhealthy: " + "; ".join(r.message for r in bad), bad)
    return status


def daily_run(house: Warehouse, data_dir: str, run_time: datetime, since: datetime | None = None,
              report_path: str | None = None) -> dict:
    """Load, transform, check, publish, watch; stops with an error at a failed gate. Each of the first three stages leaves
    its own check rows."""
    files = stored(raw_load.load_directory(house, data_dir, run_time), "file-results")
    stage_checks(house, "extract", run_time)
    counts = transform.run_all(house, run_time, since)
    stage_checks(house, "transform", run_time)
    quality_gate(house)  # before publishing: a failed gate leaves the report tables as they were
    published = publish.all_to_report(house)
    stage_checks(house, "load", run_time)
    status = health_gate(house, run_time, report_path)
    return {"files": files, "transform": counts, "published": published, "status": status}
