"""Settings of a run and of the Spark session it uses."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from tradeloom.schema import REFERENCE_TICKERS

SESSION_SETTINGS = {
    # year/month/day and date_trunc follow the session zone, so it is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffled join whose measured pieces are this small needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "snappy",
    # Checkpointed group statistics are removed once no plan refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Window state lives off heap and on local disk, with changelogs in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tradeloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings every operator here expects; ``settings`` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without the setting; it then gets a fresh temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="tradeloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


@dataclass(frozen=True)
class Config:
    """Where one run keeps its tables and how its streams behave.

    Paths carry ``run_id``: starting over means taking a new id (``fresh``), so no checkpoint is
    ever cleared under tables that still hold its rows.
    """

    root: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    catalog: str | None = None  # database to register the tables in; one per run if not given
    tickers: tuple[str, ...] = REFERENCE_TICKERS
    anomaly_threshold: float = 0.01
    watermark: str = "10 seconds"
    trigger: str | None = "30 seconds"  # None: process what is there, then stop
    log_retention: str | None = None  # how long the file sinks' logs remember a file, such as "30 days"
    # Most that one micro-batch takes of a backlog, by the source's option for it.
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None

    @property
    def database(self) -> str:
        return self.catalog or f"market_{self.run_id}"

    def table_path(self, table: str) -> str:
        return f"{self.root}/{self.run_id}/{table}"

    def checkpoint_path(self, query: str) -> str:
        return f"{self.root}/{self.run_id}/checkpoints/{query}"

    def source_options(self) -> dict[str, str]:
        limits = {"maxFilesPerTrigger": self.max_files_per_trigger, "maxOffsetsPerTrigger": self.max_offsets_per_trigger}
        return {name: str(n) for name, n in limits.items() if n is not None}

    def fresh(self) -> Config:
        return replace(self, run_id=uuid.uuid4().hex[:12])
