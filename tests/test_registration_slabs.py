"""Registration in slabs and runs against whole frames, in two and three dimensions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackweave.operators import registration
from stackweave.operators import registration_slabs as rs
from stackweave.session import Scratch


def moving(rng, shape, n=14, reach=2):
    """Copies of one scene rolled by known shifts, with a little noise."""
    scene = rng.random(shape) ** 4
    true = rng.integers(-reach, reach + 1, (n, len(shape)))
    true[0] = 0
    axes = tuple(range(len(shape)))
    return np.stack([np.roll(scene, s, axes) + rng.normal(0, 0.002, shape) for s in true]), true


@pytest.mark.parametrize("rows,columns,as_written", [(3, 2, False), (20, 3, True)])
def test_slabs_find_what_whole_frames_find(spark, frames_of, rng, rows, columns, as_written):
    stack, true = moving(rng, (11, 14))
    frames = frames_of(stack)
    want, moves = registration.estimate_shifts(frames, 2, as_written=as_written), registration.find_template(frames, 2, as_written=as_written)[1]
    scratch = Scratch(spark, "slabs")
    got, distances = rs.estimate_shifts(scratch.write(rs.cut_slabs(frames, rows)), scratch, 2, columns=columns, as_written=as_written)
    got = [tuple(r["shift"]) for r in got.orderBy("t").collect()]
    assert got == [(r["dy"], r["dx"]) for r in want.orderBy("t").collect()]
    np.testing.assert_allclose(distances, moves, atol=1e-12)
    if not as_written:
        spread = np.array(got) + true
        assert (spread == spread[0]).all()


def test_volumes_are_aligned(spark, rng):
    stack, true = moving(rng, (6, 7, 8), n=8)
    rows = [(t, z, y, x, float(stack[t, z, y, x])) for t, z, y, x in np.ndindex(stack.shape)]
    scratch = Scratch(spark, "volumes")
    slabs = scratch.write(rs.volume_slabs(spark.createDataFrame(rows, "t long, z int, y int, x int, v double").repartition(4), (6, 7, 8), 4))
    found, distances = rs.estimate_shifts(slabs, scratch, columns=9)
    got = np.array([r["shift"] for r in found.orderBy("t").collect()])
    assert (got + true == (got + true)[0]).all() and distances[-1] == 0
    rolled = np.zeros(stack.shape)
    for r in rs.slab_pixels(rs.roll_slabs(slabs, found, 4), ("z", "y", "x")).collect():
        rolled[r["t"], r["z"], r["y"], r["x"]] = r["v"]
    assert np.array_equal(rolled, np.stack([np.roll(f, s, (0, 1, 2)) for f, s in zip(stack, got)]))
    assert rolled.std(axis=0).max() < 0.05


def test_absent_pixels_mixed_shapes_and_nothing(spark, frames_of, rng):
    few = spark.createDataFrame([(0, 1, 0, 1, 5.0)], "t long, z int, y int, x int, v double")
    assert rs.volume_slabs(few, (2, 1, 2), 2, fill=9.0).first()["px"] == [9.0, 9.0, 9.0, 5.0]
    scratch = Scratch(spark, "none")
    mixed = rs.cut_slabs(frames_of(rng.random((2, 3, 3))), 2).unionByName(rs.cut_slabs(frames_of(rng.random((2, 3, 4)), first=2), 2))
    with pytest.raises(ValueError, match="in one stack"):
        rs.estimate_shifts(mixed, scratch)
    empty, distances = rs.estimate_shifts(rs.cut_slabs(frames_of([]), 2), scratch)
    assert empty.count() == 0 and distances == []
    still, distances = rs.estimate_shifts(rs.cut_slabs(frames_of(np.ones((2, 3, 3))), 2), scratch)
    assert [r["shift"] for r in still.collect()] == [[0, 0], [0, 0]] and distances == [0.0]
    pixels = rs.slab_pixels(rs.cut_slabs(frames_of(np.arange(12.0).reshape(1, 3, 4)), 2))
    assert sorted(map(tuple, pixels.where(F.col("v") > 9).collect())) == [(0, 2, 2, 10.0), (0, 2, 3, 11.0)]


def test_small_frames_are_transformed_together(spark, frames_of, rng, monkeypatch):
    stack, _ = moving(rng, (5, 6), n=40)
    scratch, grid, groups = Scratch(spark, "together"), rs.Grid((5, 6), 2), []
    slabs = scratch.write(rs.cut_slabs(frames_of(stack), 3))
    group_by = type(slabs).groupBy

    def spy(self, *columns):
        groups.append(self.select(*columns).distinct().count())
        return group_by(self, *columns)

    monkeypatch.setattr(type(slabs), "groupBy", spy)
    found = rs.spectra(slabs, 0.0, grid)
    assert groups == [grid.bands]
    monkeypatch.undo()
    want = np.fft.fft(np.fft.rfft(1 / (stack + 1), axis=2), axis=1)
    rows = found.collect()
    assert len(rows) == 40 * grid.bands
    for r in rows:
        got = (np.array(r["re"]) + 1j * np.array(r["im"])).reshape(5, -1)
        np.testing.assert_allclose(got, want[r["t"]][:, grid.band(r["band"])], atol=1e-12)


def test_small_volumes_are_matched_together(spark, rng, monkeypatch):
    stack, _ = moving(rng, (4, 4, 4), n=20, reach=1)
    rows = [(t, z, y, x, float(stack[t, z, y, x])) for t, z, y, x in np.ndindex(stack.shape)]
    scratch, grid, groups = Scratch(spark, "matched"), rs.Grid((4, 4, 4), 5), []
    slabs = scratch.write(rs.volume_slabs(spark.createDataFrame(rows, "t long, z int, y int, x int, v double"), (4, 4, 4), 2))
    found = scratch.write(rs.spectra(slabs, 0.0, grid))
    template = scratch.write(rs.mean_spectrum(found, None, 20, grid))
    group_by = type(slabs).groupBy

    def spy(self, *columns):
        groups.append(self.select(*columns).distinct().count())
        return group_by(self, *columns)

    monkeypatch.setattr(type(slabs), "groupBy", spy)
    matched = rs.offsets(found, template, grid, 2)
    assert groups == [2, 20]  # slabs of all volumes, then one maximum per volume
    monkeypatch.undo()
    assert matched.count() == 20


@pytest.mark.parametrize("apart", [1, 10**9 + 7])
def test_small_frames_meet_whatever_their_numbers(spark, frames_of, rng, monkeypatch, apart):
    stack, _ = moving(rng, (5, 6), n=40)
    scratch, grid, groups = Scratch(spark, "apart"), rs.Grid((5, 6), 2), []
    slabs = scratch.write(rs.cut_slabs(frames_of(stack).withColumn("t", (F.col("t") - 20) * apart), 3))
    group_by = type(slabs).groupBy

    def spy(self, *columns):
        groups.append(self.select(*columns).distinct().count())
        return group_by(self, *columns)

    monkeypatch.setattr(type(slabs), "groupBy", spy)
    found = rs.spectra(slabs, 0.0, grid)
    monkeypatch.undo()
    template = scratch.write(rs.mean_spectrum(found, None, 40, grid))
    monkeypatch.setattr(type(slabs), "groupBy", spy)
    matched = rs.offsets(found, template, grid, 3)
    assert groups == [grid.bands, 2, 40]
    monkeypatch.undo()
    want = registration.estimate_shifts(frames_of(stack), 2)
    got, _ = rs.estimate_shifts(slabs, scratch, 2, columns=2)
    assert [(r["t"] // apart + 20, *r["shift"]) for r in got.orderBy("t").collect()] == [tuple(r) for r in want.select("t", "dy", "dx").orderBy("t").collect()]
    assert matched.count() == 40


def test_groups_stay_bounded_and_large_frames_alone(spark, monkeypatch):
    frames = spark.range(3000).select((F.col("id") * 1_000_003).alias("t"))
    sizes = lambda values: [r["count"] for r in frames.groupBy(rs._together(frames, None, 1, values)).count().collect()]
    monkeypatch.setattr(rs, "TOGETHER_VALUES", 1000)
    assert len(sizes(10)) == 30 and max(sizes(10)) < 200
    assert sizes(501) == [1] * 3000


def test_slabs_put_pixels_in_order_without_looking_each_up(spark):
    planes, rest, at = 2, 7, {(0, 0, 0): 1.0, (0, 0, 6): 2.0, (1, 0, 3): None, (2, 0, 5): 4.0}
    pixels = spark.createDataFrame([(5, *k, v) for k, v in at.items()], "t long, z int, y int, x int, v double")
    slabs = rs.volume_slabs(pixels, (3, 1, rest), planes, fill=9.0)
    assert "element_at" not in slabs._jdf.queryExecution().analyzed().toString()
    assert [tuple(r) for r in slabs.orderBy("first").collect()] == [
        (5, 0, [3, 1, rest], [1.0, *[9.0] * 5, 2.0, *[9.0] * 7]), (5, 2, [3, 1, rest], [*[9.0] * 5, 4.0, 9.0])]
    # Beyond the shape: ignored inside of a slab, counted downwards for a slab of its own.
    beyond = spark.createDataFrame([(1, 0, 0, 0, 1.0), (1, 3, 1, 0, 2.0), (1, 4, 0, 0, 3.0)], "t long, z int, y int, x int, v double")
    assert [(r["first"], r["px"]) for r in rs.volume_slabs(beyond, (4, 1, 2), 4).orderBy("first").collect()] == [(0, [1.0, *[0.0] * 7]), (4, [3.0, 0.0])]
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        rs.volume_slabs(pixels.unionAll(pixels), (3, 1, rest), planes).collect()
