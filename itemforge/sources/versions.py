"""Tables in versions: a new one is written aside, a pointer switches to it, and all but the last few go.

A table's folder holds `v-<number>` folders of Parquet files and `current-<number>` files, each of which names a version that is whole. Readers take the
highest pointer, so a writer that is lost before it has made its pointer leaves a folder that nobody reads, and the next one writes beside it.
The file system is Spark's own, whatever the path's scheme.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from itemforge.operators import joins as J

KEEP = 5


class Versions:
    """A table of versions at a path. Writers of one table come one after the other, as batches of a stream do."""

    def __init__(self, spark: SparkSession, path: str, keep: int = KEEP) -> None:
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _numbers(self, kind: str) -> dict[int, str]:
        """Number to name of the entries of a kind."""
        if not self._fs.exists(self._hadoop.Path(self.path)):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._hadoop.Path(self.path))]
        return {int(m[1]): n for n in names if (m := re.fullmatch(rf"{kind}-(\d+)(?:-.*)?", n))}

    def current(self) -> tuple[int, str] | None:
        """The number of the version that readers see, and the mark that its writer left; None before the first."""
        pointers = self._numbers("current")
        if not pointers:
            return None
        last = max(pointers)
        return last, pointers[last].partition(f"current-{last:08d}")[2].lstrip("-")

    def read(self) -> DataFrame | None:
        now = self.current()
        return self.spark.read.parquet(f"{self.path}/v-{now[0]:08d}") if now else None

    def write(self, rows: DataFrame, mark: str = "") -> int:
        """Make rows the current version, under a mark of letters, digits and underscores, and drop those before the last few. The number of the version."""
        number = max([*self._numbers("v"), *self._numbers("current"), 0]) + 1
        rows.write.parquet(f"{self.path}/v-{number:08d}")
        # A name alone is the pointer: making an empty file is one step, on any file system.
        self._fs.createNewFile(self._at(f"current-{number:08d}-{mark}" if mark else f"current-{number:08d}"))
        self.drop_old()
        return number

    def drop_old(self) -> None:
        """Delete versions older than the last `keep` that are whole, pointers first, so no pointer ever names a folder that is gone."""
        pointers = self._numbers("current")
        kept = sorted(pointers)[-self.keep :]
        for n, name in pointers.items():
            if n not in kept:
                self._fs.delete(self._at(name), False)
        for n, name in self._numbers("v").items():
            if kept and n < kept[0]:
                self._fs.delete(self._at(name), True)


def merged(versions: Versions, keys: Sequence[str], order: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that upserts each batch into a table of versions, of several rows under one key the last by `order`.

    The batch's number is the mark of the version that it makes: a batch that comes again after a restart, in whole or after its version was written, changes nothing.
    """

    def put(batch: DataFrame, number: int) -> None:
        now = versions.current()
        if now and now[1] and int(now[1]) >= number:
            return
        base = versions.read()
        sent = [c for c in batch.columns if c not in keys and c != order]
        if base is None:
            base = batch.sparkSession.createDataFrame([], batch.select(*keys, *sent).schema)
        versions.write(J.upsert(base, batch, keys, order), str(number))

    return put
