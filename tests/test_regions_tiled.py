"""Regions of tiled images against the same images as whole frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackweave.functions.kernels import flood, spread_labels
from stackweave.model import frame_batch
from stackweave.operators import regions_tiled as rt
from stackweave.session import Scratch


@pytest.fixture(scope="module")
def masks():
    rng = np.random.default_rng(6)
    snake = np.zeros((7, 8))
    snake[::2] = 1
    snake[1::4, -1] = snake[3::4, 0] = 1
    return np.stack([rng.random((7, 8)) < p for p in (0.2, 0.4, 0.5, 0.6, 0.8, 0.95)] + [np.zeros((7, 8)), np.ones((7, 8)), np.eye(7, 8), snake]).astype(float)


def images(tiles, column, shape, n):
    out = np.zeros((n, *shape), np.int64)
    for r in tiles.collect():
        out[r["t"], r["y0"]:r["y0"] + r["h"], r["x0"]:r["x0"] + r["w"]] = np.array(r[column]).reshape(r["h"], r["w"])
    return out


def frames(spark, **stacks):
    import pyarrow as pa
    first = next(iter(stacks.values()))
    batch = frame_batch({"t": pa.array(np.arange(len(first)))}, first).rename_columns(["t", "h", "w", next(iter(stacks))])
    table = pa.Table.from_batches([batch])
    for name, stack in list(stacks.items())[1:]:
        table = table.append_column(name, frame_batch({}, stack).column("px"))
    return spark.createDataFrame(table).repartition(3)


@pytest.mark.parametrize("size", [(3, 3), (1, 20)])
def test_labels_equal_those_of_whole_frames(spark, masks, size):
    tiles = rt.cut_tiles(frames(spark, mask=masks), size, "mask")
    assert tiles.agg(F.max("h"), F.max("w")).first() == (min(size[0], 7), min(size[1], 8))
    got = images(rt.label_tiles(tiles, Scratch(spark, "labels")), "region", masks.shape[1:], len(masks))
    assert np.array_equal(got, np.stack([spread_labels(m > 0) for m in masks]))


def test_splits_equal_those_of_whole_frames(spark, masks, size=(3, 5)):
    rng = np.random.default_rng(7)
    peaks = ((rng.random(masks.shape) < 0.05) & (masks > 0)).astype(float)
    peaks[-1] = 0
    peaks[-1, 0, 0] = 1  # one peak that must follow the snake to its end
    scratch = Scratch(spark, "split")
    tiles = scratch.write(rt.cut_tiles(frames(spark, mask=masks, peak=peaks), size, "mask", "peak"))
    named = rt.label_tiles(tiles, scratch).join(tiles.select("t", "y0", "x0", "peak"), ["t", "y0", "x0"])
    got = images(rt.split_tiles(named, scratch), "seg", masks.shape[1:], len(masks))
    for image, mask, peak in zip(got, masks, peaks):
        places = np.flatnonzero((peak > 0) & (mask > 0))
        seeds = np.zeros(mask.size, np.int64)
        seeds[places] = np.arange(1, len(places) + 1)
        want = flood(spread_labels(mask > 0), seeds.reshape(mask.shape))
        assert np.array_equal(image, np.concatenate(([0], places + 1))[want])


def test_no_images(spark):
    none = spark.createDataFrame([], "t long, h int, w int, mask array<double>, peak array<double>")
    scratch = Scratch(spark, "none")
    tiles = rt.cut_tiles(none, (3, 3), "mask", "peak")
    assert rt.label_tiles(tiles, scratch).count() == 0
    empty = spark.createDataFrame([], "t long, y0 int, x0 int, h int, w int, region array<long>, peak array<double>")
    assert rt.split_tiles(empty, scratch).count() == 0


def test_tiles_of_mixed_frames(spark, rng):
    a, b = rng.random((2, 4, 5)), rng.random((1, 3, 2))
    both = frames(spark, px=a).unionByName(frames(spark, px=b).withColumn("t", F.col("t") + 2))
    got = {(r["t"], r["y"], r["x"]): r["px"] for r in rt.tile_pixels(rt.cut_tiles(both, (2, 3)), "px").collect()}
    want = {(t, y, x): a[t, y, x] for t in range(2) for y in range(4) for x in range(5)} | {(2, y, x): b[0, y, x] for y in range(3) for x in range(2)}
    assert got == want


@pytest.mark.parametrize("together", [1, 60, 1 << 17])
def test_small_tiles_are_worked_on_together(monkeypatch, together):
    import pyarrow as pa
    monkeypatch.setattr(rt, "TOGETHER_PIXELS", together)
    rng = np.random.default_rng(8)
    shapes = [(2, 3)] * 40 + [(3, 4)] * 20
    masks = [(rng.random(s) < 0.6).astype(float) for s in shapes]
    fixed = {"t": pa.array(np.arange(60)), "y0": pa.array(np.full(60, 2, np.int32)), "x0": pa.array(np.full(60, 3, np.int32)), "h": pa.array([s[0] for s in shapes], pa.int32()),
             "w": pa.array([s[1] for s in shapes], pa.int32()), "width": pa.array(np.full(60, 9))}
    calls = []
    monkeypatch.setattr(rt, "spread_labels", lambda mask: calls.append(1) or spread_labels(mask))
    made = list(rt._local_labels("mask")([pa.RecordBatch.from_pydict(fixed | {"mask": [m.ravel().tolist() for m in masks]})]))
    assert len(calls) == len(made) == {1: 60, 60: 8, 1 << 17: 2}[together]
    rows = {r["t"]: r for batch in made for r in batch.to_pylist()}
    for t, mask in enumerate(masks):
        h, w = mask.shape
        at = spread_labels(mask > 0) - 1
        want = np.where(at >= 0, (2 + at // w) * 9 + 3 + at % w + 1, 0)
        assert rows[t]["region"] == want.ravel().tolist()
        edge = [p for p in np.flatnonzero(want.ravel()) if p // w in (0, h - 1) or p % w in (0, w - 1)]
        assert rows[t]["places"] == edge and rows[t]["labels"] == want.ravel()[edge].tolist()
    # A strip goes to each neighbour that lies in the image, from all tiles of one size at once.
    region = np.ones((30, 4, 5), np.int64)
    steps = np.full(region.shape, rt.FAR)
    steps[::2, 1, 1] = 0
    places = pa.RecordBatch.from_pydict({k: v.slice(0, 30) for k, v in fixed.items()})
    grown = rt._grown(places, 0, (2, 3), {"region": region, "steps": steps, "owner": np.where(steps == 0, 7, rt.FAR)}, None).to_pylist()
    assert [len(r["sent"]) for r in grown] == [8, 0] * 15
    low = next(s for s in grown[2]["sent"] if (s["dy"], s["dx"]) == (1, 0))
    assert low["steps"] == [1, 1, 2] and low["owner"] == [7, 7, 7] and low["region"] == [1, 1, 1]
