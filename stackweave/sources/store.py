"""Named datasets as Parquet folders under one root."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from stackweave.session import delete_path, hadoop_path


#: Local file systems look and create in two steps; threads of one driver take turns.
_CLAIMING = threading.Lock()
#: Seconds for which a version that has been replaced stays readable.
GRACE = 3600.0


class DatasetStore:
    """Results under names such as ``proj/mean``; groups are folders.

    Each ``put`` writes a new version folder; it counts once its ``_SUCCESS`` file, written last, is there, so a failed write
    leaves the old version in place and a result may be computed from the dataset it replaces. A DataFrame
    from ``get`` stays with the version it was opened on: replaced versions are removed ``grace`` seconds after their
    replacement, by a later ``put`` or by ``vacuum``. Writers claim their number with a file that only one of them can
    create (as far as the file system creates files exclusively, as HDFS does), so parallel ``put`` calls on one name both survive and the higher number is current.
    """

    def __init__(self, spark: SparkSession, root: str, grace: float = GRACE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.grace = grace

    def _listed(self, name: str) -> tuple[dict[int, float], dict[int, float], list[int]]:
        """Finished versions with the time they were finished, unfinished ones with their last change, and claimed numbers."""
        fs, folder = hadoop_path(self.spark, f"{self.root}/{name}")
        done, open_, claimed = {}, {}, []
        if fs.exists(folder):
            for status in fs.listStatus(folder):
                leaf = status.getPath().getName()
                if leaf.startswith("_claim-") and leaf[7:].isdigit():
                    claimed.append(int(leaf[7:]))
                elif status.isDirectory() and leaf.startswith("v=") and leaf[2:].isdigit():
                    _, mark = hadoop_path(self.spark, f"{self.root}/{name}/{leaf}/_SUCCESS")
                    if fs.exists(mark):
                        done[int(leaf[2:])] = fs.getFileStatus(mark).getModificationTime() / 1000
                    else:
                        open_[int(leaf[2:])] = status.getModificationTime() / 1000
        return done, open_, claimed

    def versions(self, name: str) -> list[int]:
        """Numbers of the versions that can be read, the current one last."""
        return sorted(self._listed(name)[0])

    def _claim(self, name: str) -> int:
        """A version number that no other writer has or gets."""
        done, open_, claimed = self._listed(name)
        number = max([0, *done, *open_, *claimed]) + 1
        while True:
            fs, claim = hadoop_path(self.spark, f"{self.root}/{name}/_claim-{number}")
            try:
                with _CLAIMING:
                    if fs.createNewFile(claim):
                        return number
            except Py4JJavaError:  # another writer was faster by a moment
                if not fs.exists(claim):
                    raise
            number += 1

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as the new version of ``name`` and return it."""
        if not name or name.startswith("/") or any(p in ("", "..") or p.startswith(("v=", "_claim-")) for p in name.split("/")):
            raise ValueError(f"bad dataset name {name!r}")
        version = self._claim(name)
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/v={version}")
        self.vacuum(name)
        return self.get(name, version)

    def vacuum(self, name: str, grace: float | None = None) -> None:
        """Remove versions replaced longer than ``grace`` seconds ago, and writes given up for as long."""
        before = time.time() - (self.grace if grace is None else grace)
        done, open_, claimed = self._listed(name)
        order = sorted(done)
        gone = [old for old, fresh in zip(order, order[1:]) if done[fresh] <= before]
        gone += [v for v, changed in open_.items() if changed <= before and order and v < order[-1]]
        for version in gone:
            delete_path(self.spark, f"{self.root}/{name}/v={version}")
        # A claim below the current version can no longer be the highest number.
        for number in claimed:
            if order and number < order[-1] and number not in open_:
                delete_path(self.spark, f"{self.root}/{name}/_claim-{number}")

    def snapshot(self) -> dict[str, int]:
        """The current version of every dataset, for ``get(name, version)`` later on."""
        return {name: self.versions(name)[-1] for name in self}

    def put_many(self, names: Sequence[str], datasets: Sequence[DataFrame], share: Sequence[DataFrame] = ()) -> dict[str, DataFrame]:
        """Store several results together; a shared parent is computed once.

        A result that is already the stored dataset of that name is left alone.
        """
        if len(names) != len(datasets):
            raise ValueError(f"{len(names)} names for {len(datasets)} datasets")
        for parent in share:
            parent.persist(StorageLevel.DISK_ONLY)
        try:
            return {n: self.get(n) if self._is_stored(n, d) else self.put(n, d) for n, d in zip(names, datasets)}
        finally:
            for parent in share:
                parent.unpersist()

    def update(self, items: Mapping[str, DataFrame], share: Sequence[DataFrame] = ()) -> dict[str, DataFrame]:
        return self.put_many(list(items), list(items.values()), share)

    def _is_stored(self, name: str, df: DataFrame) -> bool:
        stored = getattr(df, "_stored_as", None)
        return stored is not None and stored[:2] == (self.root, name) and stored[2:] == tuple(self.versions(name)[-1:])

    def get(self, name: str, version: int | None = None) -> DataFrame:
        """The current version of a dataset, or an earlier one that is still there."""
        known = self.versions(name)
        if not known or (version is not None and version not in known):
            raise KeyError(name if version is None else (name, version))
        version = known[-1] if version is None else version
        df = self.spark.read.parquet(f"{self.root}/{name}/v={version}")
        df._stored_as = (self.root, name, version)
        return df

    def drop(self, name: str) -> None:
        """Remove a dataset, or a whole group of them."""
        fs, folder = hadoop_path(self.spark, f"{self.root}/{name}")
        if not fs.exists(folder):
            raise KeyError(name)
        fs.delete(folder, True)

    def pop(self, name: str, into: str) -> DataFrame:
        """Remove a dataset and return it; its rows move to the folder ``into`` first."""
        self.get(name).write.mode("overwrite").parquet(into)
        self.drop(name)
        return self.spark.read.parquet(into)

    def popitem(self, into: str) -> tuple[str, DataFrame]:
        for name in self:
            return name, self.pop(name, into)
        raise KeyError("store is empty")

    def clear(self) -> None:
        delete_path(self.spark, self.root)

    def export(self, name: str, path: str) -> None:
        """Copy one dataset to a plain Parquet folder for other tools."""
        self.get(name).write.mode("overwrite").parquet(path)

    def _walk(self, prefix: str) -> Iterator[str]:
        fs, folder = hadoop_path(self.spark, f"{self.root}/{prefix}" if prefix else self.root)
        if not fs.exists(folder):
            return
        leaves = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
        if prefix and any(leaf.startswith("v=") for leaf in leaves):
            if self.versions(prefix):
                yield prefix
        for leaf in leaves:
            if not leaf.startswith("v="):
                yield from self._walk(f"{prefix}/{leaf}" if prefix else leaf)

    def __iter__(self) -> Iterator[str]:
        return self._walk("")

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def __contains__(self, name: str) -> bool:
        return bool(self.versions(name))

    def __getitem__(self, name: str) -> DataFrame:
        return self.get(name)

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self.put(name, df)

    def __delitem__(self, name: str) -> None:
        self.drop(name)
