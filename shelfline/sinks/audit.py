"""Run reports and import reconciliation as tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas

SUCCESS = "SUCCESS"
FAILURE = "FAILURE"


@dataclass(frozen=True)
class LoadResult:
    """What a load did."""

    target: str
    row_count: int
    truncated: bool
    first: dt.date | None = None
    last: dt.date | None = None


def first_line(error: Exception) -> str:
    """The first line of the error's text, or its kind where it has none."""
    return next(iter(str(error).splitlines()), "") or type(error).__name__


@dataclass
class JobRuns:
    """The ``job_runs`` table: one row per run, success or failure."""

    spark: SparkSession
    path: str
    clock: Callable[[], dt.datetime] = field(default=lambda: dt.datetime.now(dt.timezone.utc))

    def run(self, job: str, load: Callable[[], LoadResult], *, processed: dt.date | None = None) -> LoadResult:
        """Run ``load`` and append its report; a failure is reported, then raised."""
        started = self.clock()
        try:
            result = load()
        except Exception as error:
            self._append(job, started, processed, None, FAILURE, first_line(error))
            raise
        self._append(job, started, processed, result, SUCCESS, None)
        return result

    def _append(self, job: str, started: dt.datetime, processed: dt.date | None,
                result: LoadResult | None, status: str, message: str | None) -> None:
        ended = self.clock()
        row = (
            job, uuid.uuid4().hex, processed,
            result.target if result else None,
            result.row_count if result else None,
            result.truncated if result else None,
            result.first if result else None,
            result.last if result else None,
            started, ended, (ended - started).total_seconds(), status, message,
        )
        report = self.spark.createDataFrame([row], schemas.JOB_RUNS)
        report.coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(schemas.JOB_RUNS).parquet(self.path)


# The counters an import tool prints.
COUNTERS = {
    "total_paths": r"Total input paths to process : (\d+)",
    "input_records": r"INPUT_RECORDS: (\d+)",
    "output_records": r"OUTPUT_RECORDS: (\d+)",
    "output_records_committed": r"OUTPUT_RECORDS_COMMITTED: (\d+)",
    "output_records_failed": r"OUTPUT_RECORDS_FAILED: (\d+)",
}


def reconcile(logs: DataFrame, run: str, line: str) -> DataFrame:
    """The counters of each run's log lines and whether nothing failed.

    A counter that was never printed is null, and the run is then not complete.
    """
    found = logs.select(run, *[
        F.regexp_extract(line, pattern, 1).try_cast("bigint").alias(name)
        for name, pattern in COUNTERS.items()
    ])
    totals = found.groupBy(run).agg(*[F.max(n).alias(n) for n in COUNTERS])
    return totals.withColumn("complete", F.coalesce(F.col("output_records_failed") == 0, F.lit(False)))


def require_complete(reconciled: DataFrame) -> None:
    """Fail if any run left failed records."""
    if not reconciled.where(~F.col("complete")).isEmpty():
        raise RuntimeError("import left failed or unreported records")
