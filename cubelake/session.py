"""Session and shared scratch-space helpers."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC so that minute-precision release
# times never shift, AQE for runtime join/partition choices, and skew handling
# for the keyed writes (rebalance) and the merge join.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    # Partition discovery over many folders (one per day / product) runs as
    # a listing job; a few dozen tasks list thousands of folders without one
    # task per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # Keyed writes (rebalance by product / year) must stay parallel when the
    # shuffled data is small but the number of output folders is large; the
    # 1 MiB default lets AQE fold such a write into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def tune_session(spark: SparkSession) -> None:
    """Apply the runtime SQL settings above that the session left at Spark's default."""
    runtime = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": ("10000", "32"),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": ("1MB", "64KB"),
    }
    for key, value in runtime.items():
        if isinstance(value, tuple):
            default, wanted = value
            if spark.conf.get(key, default) == default:
                spark.conf.set(key, wanted)
        else:
            spark.conf.set(key, value)


def get_spark(master: str | None = None, app: str = "cubelake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only applied when given, so on a cluster the launcher's
    master wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``. A local session without one gets a
    temporary folder; on a cluster, where every machine would have its own,
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cubelake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/cubelake-scratch/{label}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_spark", "shared_root", "scratch_dir", "ship_package", "tune_session"]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cubelake`` importable in Python workers (once per context).

    The package is zipped and added with ``addPyFile``, so the driver hands
    it to every executor.
    """
    import hashlib
    import pathlib
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = pathlib.Path(__file__).resolve().parent
    files = sorted(p for p in pkg.rglob("*.py"))
    digest = hashlib.sha1(b"".join(p.read_bytes() for p in files)).hexdigest()[:12]
    target_dir = tempfile.mkdtemp(prefix="cubelake-pkg-")
    target = f"{target_dir}/cubelake-{digest}.zip"
    with zipfile.ZipFile(target, "w") as zf:
        for p in files:
            zf.write(p, f"cubelake/{p.relative_to(pkg)}")
    sc.addPyFile(target)
    _SHIPPED.add(key)


_MIN_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


class folder_parallel_writes:
    """Context for writes partitioned into many folders (product, year, day).

    Their cost grows with the number of folders, not bytes, so AQE should
    not fold a small but wide write into a couple of tasks. Inside the
    context the coalescing floor is 1 KB; large writes are unaffected (the
    advisory partition size dominates there). Typing a delta makes methods
    over 8000 bytes of code, which the JVM never compiles: Spark takes its
    other way for those, unless the session has a limit of its own. Nested
    and concurrent uses (writes from several driver threads) share one
    setting; the first entry saves the old values and the last exit restores
    them.
    """

    _lock = threading.Lock()
    _depth: dict[int, int] = {}
    _saved: dict[int, dict[str, str | None]] = {}

    def __init__(self, spark: SparkSession, floor: str = "1KB"):
        self.spark, self.floor, self.key = spark, floor, id(spark)

    def __enter__(self):
        with self._lock:
            if self._depth.get(self.key, 0) == 0:
                saved = {k: self.spark.conf.get(k, None) for k in (_MIN_PARTITION, _METHOD_LIMIT)}
                self._saved[self.key] = saved
                self.spark.conf.set(_MIN_PARTITION, self.floor)
                if saved[_METHOD_LIMIT] in (None, "65535"):
                    self.spark.conf.set(_METHOD_LIMIT, "8000")
            self._depth[self.key] = self._depth.get(self.key, 0) + 1
        return self

    def __exit__(self, *exc):
        with self._lock:
            self._depth[self.key] -= 1
            if self._depth[self.key] == 0:
                for name, old in self._saved.pop(self.key).items():
                    if old is None:
                        self.spark.conf.unset(name)
                    else:
                        self.spark.conf.set(name, old)
        return False
