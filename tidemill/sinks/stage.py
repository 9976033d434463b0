"""Stage area of a load: rows of a run with their run columns, partitioned by job and run."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.predicates import utc_naive
from tidemill.sinks.files import Folder

RUN_COLUMNS = ["ETL_RUN_ID", "ETL_JOB_NAME", "ETL_LOADED_AT"]
_PLAIN = re.compile(r"^[A-Za-z0-9_.-]+$")


class Stage:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._folder = Folder(spark, self.path)

    def _run_path(self, job: str, run_id: str) -> str:
        for name in (job, run_id):
            if not _PLAIN.match(name):
                raise ValueError(f"not a plain name: {name!r}")
        return f"ETL_JOB_NAME={job}/ETL_RUN_ID={run_id}"

    def append(self, df: DataFrame, job: str, run_id: str, loaded_at: datetime) -> int:
        """Write the rows of a run, and return how many. A repeated run replaces its own rows."""
        loaded = F.lit(utc_naive(loaded_at).isoformat(sep=" ")).cast("timestamp_ntz")
        rows = df.select(*self.schema.names).withColumn("ETL_LOADED_AT", loaded)
        rows.write.mode("overwrite").parquet(f"{self.path}/{self._run_path(job, run_id)}")
        # Counted from the footers of the committed files, so retried tasks do not matter.
        return self.rows(job, run_id).count()

    def rows(self, job: str, run_id: str) -> DataFrame:
        """Rows of one run with all run columns."""
        schema = T.StructType([*self.schema.fields, T.StructField("ETL_LOADED_AT", T.TimestampNTZType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{self._run_path(job, run_id)}")
        return rows.withColumns({"ETL_JOB_NAME": F.lit(job), "ETL_RUN_ID": F.lit(run_id)})

    def runs(self, job: str) -> list[str]:
        names = self._folder.names(f"ETL_JOB_NAME={job}")
        return [n.split("=", 1)[1] for n in names if n.startswith("ETL_RUN_ID=")]

    def purge(self, job: str) -> int:
        """Drop all runs of the job, and return how many there were."""
        runs = self.runs(job)
        if runs:
            self._folder.delete(f"ETL_JOB_NAME={job}")
        return len(runs)

    def retain(self, job: str, now: datetime, days: int = 7) -> list[str]:
        """Drop the job's runs that were loaded more than ``days`` ago, or hold no row.

        One pass over the load times of all runs; a row per kept run reaches the driver.
        """
        oldest = utc_naive(now) - timedelta(days=days)
        schema = "ETL_LOADED_AT timestamp_ntz, ETL_RUN_ID string"
        runs = self.runs(job)
        if not runs:
            return []
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/ETL_JOB_NAME={job}")
        newest = rows.groupBy("ETL_RUN_ID").agg(F.max("ETL_LOADED_AT").alias("at")).collect()
        kept = {r.ETL_RUN_ID for r in newest if r["at"] >= oldest}
        dropped = [run_id for run_id in runs if run_id not in kept]
        for run_id in dropped:
            self._folder.delete(self._run_path(job, run_id))
        return dropped
