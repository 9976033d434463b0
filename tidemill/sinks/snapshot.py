"""A keyed table on plain Parquet that can be merged into, with atomic commits.

Rows are placed in buckets by their key. A merge rewrites only the buckets its
rows fall into, into a new version folder, and then publishes one small commit
file that names the version of every bucket and the state of the load jobs.
Readers see either the old commit or the new one.

By default a bucket is a hash of the key. Where keys grow with time, give
``bucket_by``, e.g. ``order_id div 1000000``: an increment then falls into the
few newest buckets, and the rest of a large table is not rewritten.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sinks.files import Folder

CONTROL_SCHEMA = (
    "JOB_NAME string, LAST_CREATED_TS timestamp_ntz, LAST_RUN_ID string,"
    " LAST_SUCCESS_AT timestamp_ntz, LAST_ROWS_READ bigint, LAST_ROWS_MERGED bigint,"
    " UPDATED_AT timestamp_ntz"
)


class CommitConflict(RuntimeError):
    """Another writer published the same version first; run again."""


def _now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


class SnapshotTable:
    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str],
        buckets: int = 64, keep_commits: int = 10, bucket_by: str | None = None,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys, self.buckets, self.keep = keys, buckets, keep_commits
        self.layout = bucket_by or f"pmod(xxhash64({', '.join(keys)}), {buckets})"
        self._log = Folder(spark, f"{self.path}/commits")
        self._data = Folder(spark, f"{self.path}/data")

    # -- commits ---------------------------------------------------------

    def _commit_names(self) -> list[str]:
        return [n for n in self._log.names() if n.endswith(".json")]

    def last_commit(self) -> dict:
        names = self._commit_names()
        if not names:
            return {"version": 0, "buckets": {}, "jobs": {}}
        commit = self._log.read(names[-1])
        if commit["layout"] != self.layout:
            raise ValueError(f"{self.path} was written with buckets by {commit['layout']}")
        return commit

    def _publish(self, previous: dict, versions: dict[str, str], jobs: dict) -> dict:
        commit = {
            "version": previous["version"] + 1,
            "layout": self.layout,
            "buckets": {**previous["buckets"], **versions},
            "jobs": {**previous["jobs"], **jobs},
            "schema": self.schema.jsonValue(),
            "committed_at": _now(),
        }
        if not self._log.write_new(f"{commit['version']:012d}.json", commit):
            raise CommitConflict(f"version {commit['version']} of {self.path} exists already")
        return commit

    def tidy(self) -> None:
        """Drop commits beyond the kept ones, and data folders no kept commit names."""
        names = self._commit_names()
        for name in names[: -self.keep]:
            self._log.delete(name)
        kept = [self._log.read(n) for n in names[-self.keep :]]
        used = {f"version={v}" for c in kept for v in c["buckets"].values()}
        newest = kept[-1]["version"] if kept else 0
        for name in self._data.names():
            if name not in used and int(name.split("=")[1].split("-")[0]) <= newest:
                self._data.delete(name)

    # -- reading ---------------------------------------------------------

    def read(self) -> DataFrame:
        return self._read(self.last_commit(), None)

    def _read(
        self, commit: dict, buckets: set[int] | None, spark: SparkSession | None = None
    ) -> DataFrame:
        """Rows of the given buckets (default all) as of a commit."""
        spark = spark or self.spark
        paths = [
            f"{self.path}/data/version={version}/bucket={bucket}"
            for bucket, version in commit["buckets"].items()
            if version and (buckets is None or int(bucket) in buckets)
        ]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        wanted = self._typed(keys, self.keys).distinct()
        rows = self._read(self.last_commit(), set(self._touched(wanted)), keys.sparkSession)
        return rows.join(wanted, self.keys, "left_semi")

    # -- writing ---------------------------------------------------------

    def bucket(self) -> Column:
        """Bucket number of a row; a NULL key of a ``bucket_by`` goes to bucket -1."""
        return F.coalesce(F.expr(self.layout).cast("bigint"), F.lit(-1))

    def _typed(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """The columns in the table's types, which the bucket of a key depends on."""
        return df.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in columns])

    def _touched(self, rows: DataFrame) -> dict[int, int]:
        """Rows per bucket they fall into: one number per bucket reaches the driver."""
        found = rows.groupBy(self.bucket().alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        return {r.b: r.n for r in found}

    def _checked(self, rows: DataFrame) -> DataFrame:
        """Rows that raise on a NULL key: it would match nothing, and a replay would add it again."""
        missing = F.lit(False)
        for key in self.keys:
            missing |= F.col(key).isNull()
        first = self.keys[0]
        error = F.raise_error(F.lit(f"a key of {self.path} is NULL: {', '.join(self.keys)}"))
        return rows.withColumn(first, F.when(missing, error.cast(self.schema[first].dataType)).otherwise(F.col(first)))

    def _rewrite(self, rows: DataFrame, previous: dict, touched: set[int]) -> dict[str, str]:
        """Write the touched buckets' new content; emptied buckets get an empty version.

        The folder is this attempt's own, so a writer that loses the race to
        publish has touched nothing of the winner's.
        """
        version = f"{previous['version'] + 1}-{uuid.uuid4().hex[:12]}"
        target = f"{self.path}/data/version={version}"
        placed = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        placed.write.partitionBy("bucket").parquet(target)
        written = {
            int(n.split("=")[1])
            for n in self._data.names(f"version={version}")
            if n.startswith("bucket=")
        }
        return {str(b): (version if b in written else "") for b in touched}

    def merge(
        self, changes: DataFrame, touched_by: DataFrame | None = None,
        job: str | None = None, job_state: dict | None = None,
    ) -> dict:
        """Update matching keys, insert the others, and publish with the job's state.

        ``changes`` has one row per key; a NULL in a key raises before anything is
        published. ``touched_by`` may name a cheaper frame that the changes were
        picked from, one per key; buckets and counts are then taken from its
        distinct keys. Returns the commit; its job entry holds ``rows_merged``.
        """
        previous = self.last_commit()
        new = self._checked(self._typed(changes, self.schema.names))
        touched = self._touched(
            new if touched_by is None else self._checked(self._typed(touched_by, self.keys)).distinct()
        )
        versions = {}
        if touched:
            base = self._read(previous, set(touched), changes.sparkSession)
            kept = base.join(new.select(*self.keys), self.keys, "left_anti")
            kept = kept.select(*self.schema.names)
            versions = self._rewrite(kept.unionByName(new), previous, set(touched))
        state = {**(job_state or {}), "rows_merged": sum(touched.values()), "at": _now()}
        return self._publish(previous, versions, {job: state} if job else {})

    def save_job(self, job: str, state: dict) -> dict:
        """Publish a job's state without touching data."""
        previous = self.last_commit()
        return self._publish(previous, {}, {job: {**state, "at": _now()}})

    def delete(self, condition: Column) -> int:
        """Remove the rows the condition holds for, and return how many there were."""
        previous = self.last_commit()
        touched = self._touched(self._read(previous, None).filter(condition))
        if touched:
            kept = self._read(previous, set(touched)).filter(~F.coalesce(condition, F.lit(False)))
            self._publish(previous, self._rewrite(kept, previous, set(touched)), {})
        return sum(touched.values())

    # -- control rows ----------------------------------------------------

    def job_state(self, job: str) -> dict | None:
        return self.last_commit()["jobs"].get(job)

    def control(self) -> DataFrame:
        """The control table: one row per job that loads this table."""
        rows = []
        for job, state in sorted(self.last_commit()["jobs"].items()):
            at = datetime.fromisoformat(state["at"])
            mark = state.get("watermark")
            rows.append((
                job, datetime.fromisoformat(mark) if mark else None, state.get("run_id"),
                at if state.get("run_id") else None, state.get("rows_read", 0),
                state.get("rows_merged", 0), at,
            ))
        return self.spark.createDataFrame(rows, CONTROL_SCHEMA)
