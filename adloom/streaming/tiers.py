"""Tables fed by numbered batches that are folded into larger and larger runs.

``path/batch_id=N`` holds what a batch brought. A fold takes the batches since the last one and, where
``fanout`` runs of a level would come together, these runs too, and writes one run of the next
level: each row is rewritten once per level, so the bytes a fold writes follow the batches since, not the
table. What runs there are is told by a manifest, one small file per fold, written when the run is complete: readers see
the old runs or the new one, and a fold that failed is simply repeated.

The runs and batches that a fold replaced are taken away by the fold after it, so whoever still reads
by the manifest before has one fold's time to finish. Folds of one table run one at a time;
batches may go on arriving meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.sources import folders

BATCH = "batch_id"
FANOUT = 4


class Layout(NamedTuple):
    """How the rows of a table are stored, and what several rows of it come down to."""

    read: Callable[[SparkSession, str, bool], DataFrame]  # rows of a folder; of one that holds batches, with their ``batch_id``
    write: Callable[[DataFrame, str], None]
    combine: Callable[[DataFrame], DataFrame]  # of rows with their ``batch_id``, which it drops
    together: Callable[[SparkSession, dict[int, str], int], DataFrame] | None = None  # rows of many folders, by last batch, in one scan; for a generation


class Run(NamedTuple):
    folder: str
    level: int
    first: int
    last: int


class Manifest(NamedTuple):
    generation: int
    runs: list[Run]

    @property
    def upto(self) -> int | None:
        """The last batch that is in a run."""
        return max((r.last for r in self.runs), default=None)


_ENTRY = "generation bigint, runs array<struct<folder: string, level: bigint, first: bigint, last: bigint>>"


def _folds(path: str) -> str:
    return f"{path.rstrip('/')}-folds"


def manifest(spark: SparkSession, path: str, before: int | None = None) -> Manifest:
    """The newest manifest, or the newest before a generation."""
    if folders.exists(spark, _folds(path)):
        entries = spark.read.schema(_ENTRY).json(f"{_folds(path)}/*")
        newest = (entries if before is None else entries.where(F.col("generation") < before)).orderBy(F.desc("generation")).first()
        if newest is not None:
            return Manifest(newest.generation, [Run(*r) for r in newest.runs])
    return Manifest(0, [])


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Of the batches that are complete."""
    found = [int(n.removeprefix(f"{BATCH}=")) for n in folders.names(spark, path) if n.startswith(f"{BATCH}=")]
    return sorted(b for b in found if folders.exists(spark, f"{path}/{BATCH}={b}/_SUCCESS"))


def _batches(spark: SparkSession, path: str, layout: Layout, after: int | None) -> DataFrame:
    rows = layout.read(spark, path, True)
    return rows if after is None else rows.where(F.col(BATCH) > after)


def _runs(spark: SparkSession, runs: list[Run], layout: Layout) -> list[DataFrame]:
    return [layout.read(spark, r.folder, False).withColumn(BATCH, F.lit(r.last).cast("bigint")) for r in runs]


def _rows(spark: SparkSession, path: str, layout: Layout, now: Manifest, runs: list[Run], batches: list[int]) -> DataFrame:
    """Of some runs and of complete batches after all runs."""
    if layout.together:
        places = {r.last: r.folder for r in runs} | {b: f"{path}/{BATCH}={b}" for b in batches}
        return layout.together(spark, places, now.generation)
    rows = _batches(spark, path, layout, now.upto)
    for run in _runs(spark, runs, layout):
        rows = rows.unionByName(run)
    return rows


def _since(spark: SparkSession, path: str, now: Manifest) -> list[int]:
    return [b for b in batch_ids(spark, path) if now.upto is None or b > now.upto]


def stored(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """All rows with the last batch they come from: the runs, and the batches after them."""
    now = manifest(spark, path)
    return _rows(spark, path, layout, now, now.runs, _since(spark, path, now) if layout.together else [])


def current(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The table as of now. What is all in one run is combined already."""
    now = manifest(spark, path)
    if len(now.runs) == 1 and not any(n.startswith(f"{BATCH}=") and int(n.removeprefix(f"{BATCH}=")) > now.upto for n in folders.names(spark, path)):
        return layout.read(spark, now.runs[0].folder, False)
    return layout.combine(stored(spark, path, layout))


def fold(spark: SparkSession, path: str, layout: Layout, fanout: int = FANOUT) -> int | None:
    """Folds the batches since the last fold into a run; returns the last batch that is in one."""
    now = manifest(spark, path)
    new = _since(spark, path, now)
    if not new:
        return now.upto
    level, taken = 0, []
    while len(same := [r for r in now.runs if r.level == level]) + 1 >= fanout:
        taken += same
        level += 1
    rows = _rows(spark, path, layout, now, taken, new).where(F.col(BATCH) <= new[-1])  # later ones are left for the next fold
    run = Run(f"{path.rstrip('/')}-base-{new[-1]}", level, min([new[0], *(r.first for r in taken)]), new[-1])
    layout.write(layout.combine(rows), run.folder)
    after = Manifest(now.generation + 1, [*(r for r in now.runs if r not in taken), run])
    spark.createDataFrame([(after.generation, after.runs)], _ENTRY).coalesce(1).write.mode("overwrite").json(f"{_folds(path)}/{after.generation}")
    _retire(spark, path, after, now)
    return after.upto


def _retire(spark: SparkSession, path: str, after: Manifest, now: Manifest) -> None:
    """Takes away what neither of the last two manifests leads to."""
    before = manifest(spark, path, now.generation) if now.generation else Manifest(0, [])
    for run in set(before.runs) - set(now.runs) - set(after.runs):
        folders.remove(spark, run.folder)
    for batch in batch_ids(spark, path):
        if now.upto is not None and batch <= now.upto:
            folders.remove(spark, f"{path}/{BATCH}={batch}")
    if before.generation:
        folders.remove(spark, f"{_folds(path)}/{before.generation}")
