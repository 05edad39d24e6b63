"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job of this package is written for.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages of up to this many rows per group are still cut in the map tasks.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app_name: str = "adloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on. Partition counts stay cluster settings:
    pass them in ``conf`` (dots written as ``__``) or set them at submit time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = RUNTIME_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_conf(shuffled_bytes: int, cores: int, per_partition: int = 256 << 20) -> dict[str, str]:
    """Shuffle settings for a job that moves about ``shuffled_bytes``.

    Adaptive execution merges partitions that turn out small but cannot cut ordinary
    large ones, so the initial number must be high enough for a partition to fit in
    memory; skewed joins are cut from twice that size on."""
    wanted = max(2 * cores, -(-shuffled_bytes // per_partition))
    return {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_partition),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * per_partition),
    }


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCANNED = "spark.sql.files.maxPartitionBytes"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes made meanwhile give up their shuffle files when they are done, not when the driver happens to collect its
    garbage, so a load of several writes takes the disk of its largest one. For writes alone: a frame that is read again later would shuffle again."""
    with _setting(spark, _RELEASE, "true"):
        yield


@contextmanager
def scans_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Scans made meanwhile give a task ``most`` bytes of files, or less where that is set: for rows that are sorted as they are read."""
    with _setting(spark, _SCANNED, str(min(most, in_bytes(spark.conf.get(_SCANNED))))):
        yield


def in_bytes(size: str) -> int:
    """Of a size setting such as ``128m`` or ``134217728``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


_local_roots: list[str] = []


def _local_root() -> str:
    """One folder for this process, removed when it ends."""
    if not _local_roots:
        _local_roots.append(tempfile.mkdtemp(prefix="adloom-"))
        atexit.register(shutil.rmtree, _local_roots[0], ignore_errors=True)
    return _local_roots[0]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a session whose tasks run in the driver's own process (``local[...]``) may run without
    that setting. What is written below a folder that was set stays there until its owner
    clears it; the folder made here goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
