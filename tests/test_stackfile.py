"""The data source of array files: ranges as partitions, pushed filters, exports that are whole or absent."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, LessThanOrEqual

from conftest import array_of
from stackweave.model import densify
from stackweave.sources import stackfile, stacks
from stackweave.sources.stackfile import NpyPages, StackReader, register_stack_format


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("arrays")
    for k in range(100):
        np.save(root / f"part-{k:03d}.npy", (np.arange(10 * 2 * 3) + 60 * k).reshape(10, 2, 3).astype(np.uint16))
    return str(root)


def frames_read(reader):
    return [t for p in reader.partitions() for b in reader.read(p) for t in b.column("t").to_pylist()]


def test_every_range_is_a_partition(spark, folder):
    register_stack_format(spark)
    frames = spark.read.format("stack").option("chunk", 1).load(folder)
    assert frames.rdd.getNumPartitions() == 1000
    assert spark.read.format("stack").option("chunk", 4).load(folder).rdd.getNumPartitions() == 300
    got = array_of(spark.read.format("stack").load(folder))
    assert np.array_equal(got, np.arange(6000).reshape(1000, 2, 3))


class Watched(NpyPages):
    """Fails outside of frames 250 to 279 and of every file but two."""

    def pages(self, path):
        return 10

    def read(self, path, first, last):
        k = int(path[-7:-4])
        if not 250 <= 10 * k + first < 10 * k + last <= 280:
            raise AssertionError(f"{path} {first} {last} was not asked for")
        return super().read(path, first, last)


def test_filter_opens_only_its_ranges(spark, folder):
    name = register_stack_format(spark, Watched(), "watched")
    frames = spark.read.format(name).option("chunk", 5).load(folder)
    some = frames.where("t >= 250 and t < 280")
    assert some.rdd.getNumPartitions() == 6
    assert sorted(r["t"] for r in some.select("t").collect()) == list(range(250, 280))
    assert frames.where("t in (251, 263, 262) and t > 251").orderBy("t").select("t").collect() == [(262,), (263,)]
    assert frames.where("t = 270 and px[0] < 0").collect() == []


@pytest.mark.parametrize("conditions,wanted", [
    ([GreaterThan(("t",), 15), LessThanOrEqual(("t",), 31)], range(16, 32)),
    ([GreaterThanOrEqual(("t",), 990), LessThan(("t",), 5000)], range(990, 1000)),
    ([EqualTo(("t",), 7)], [7]), ([EqualTo(("t",), 7), EqualTo(("t",), 8)], []), ([EqualTo(("t",), -1)], []),
    ([In(("t",), (3, None, 999, 50)), LessThan(("t",), 60)], [3, 50]),
])
def test_pushed_filters(folder, conditions, wanted):
    reader = StackReader([folder], 4, NpyPages())
    others = [EqualTo(("h",), 2), IsNotNull(("t",)), EqualTo(("t",), "x")]
    assert list(reader.pushFilters(conditions + others)) == others
    assert frames_read(reader) == list(wanted)


def test_paths_patterns_and_single_files(spark, folder, tmp_path):
    np.save(tmp_path / "one.npy", np.ones((2, 2)))
    assert array_of(stacks.load_stack(spark, [f"file:{folder}/part-00[01].npy", str(tmp_path / "one.npy")], "stack").where("t = 20")).tolist() == [[[1, 1], [1, 1]]]
    with pytest.raises(Exception, match="none.npy"):
        spark.read.format("stack").load(f"{folder}/none.npy").count()
    np.save(tmp_path / "wrong.npy", np.ones(3))
    with pytest.raises(Exception, match="two or three axes"):
        spark.read.format("stack").load(str(tmp_path / "wrong.npy")).count()


def test_export_and_append(spark, frames_of, rng, tmp_path):
    stack = rng.random((30, 4, 5))
    out = str(tmp_path / "out")
    register_stack_format(spark)
    frames_of(stack).repartitionByRange(3, "t").sortWithinPartitions("t").write.format("stack").mode("overwrite").save(out)
    listed = json.load(open(f"{out}/{stackfile.MANIFEST}"))
    assert len(listed) == 3 and np.array_equal(array_of(spark.read.format("stack").load(out)), stack)
    # What a failed attempt leaves is not on the list; numbers stay those written.
    np.save(f"{out}/frames-5-1-{'0' * 32}.npy", np.zeros((1, 4, 5)))
    frames_of(stack[:2] + 1, first=30).write.format("stack").mode("append").save(out)
    both = spark.read.format("stack").load(out)
    assert np.array_equal(array_of(both), np.concatenate((stack, stack[:2] + 1)))
    frames_of(stack[:1], first=9).write.format("stack").mode("overwrite").option("dtype", "<f4").save(out)
    assert [tuple(r) for r in spark.read.format("stack").load(out).select("t", "h", "w").collect()] == [(9, 4, 5)]
    assert len([n for n in os.listdir(out) if n in listed]) == 0


def test_export_of_mixed_shapes_and_nothing(spark, frames_of, rng, tmp_path):
    register_stack_format(spark)
    mixed = frames_of(rng.random((2, 2, 2))).unionByName(frames_of(rng.random((2, 3, 1)), first=2)).coalesce(1).sortWithinPartitions("t")
    mixed.write.format("stack").mode("overwrite").save(str(tmp_path / "mixed"))
    got = spark.read.format("stack").load(str(tmp_path / "mixed"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mixed.collect()))
    frames_of([]).write.format("stack").mode("overwrite").save(str(tmp_path / "none"))
    assert spark.read.format("stack").load(str(tmp_path / "none")).count() == 0


class Ranges:
    def pages(self, path):
        return 1500

    def read(self, path, first, last):
        return [np.full((1, 1), float(t)) for t in range(first, last)]


def test_small_rows_with_heavy_work_keep_their_tasks(spark, folder):
    """Adaptive execution folds neither page ranges nor a grid's time axis into one task."""
    from pyspark import TaskContext

    class Told(Ranges):
        def read(self, path, first, last):
            return [np.full((1, 1), float(TaskContext.get().partitionId())) for _ in range(first, last)]

    found = stacks.decode_files(spark, f"{folder}/part-00[0-9].npy", Told())
    assert found.select(F.col("px")[0]).distinct().count() > 50
    grid = densify(spark.createDataFrame([(0, 0, 0, 1.0), (400_000, 1, 1, 2.0)], "t long, y int, x int, v double"), (8, 8))
    assert grid.select("t").rdd.getNumPartitions() > 1 and grid.count() == 400_001 * 64
    assert densify(spark.createDataFrame([], "t long, y int, x int, v double"), (8, 8)).count() == 0
