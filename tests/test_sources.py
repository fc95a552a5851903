import io
import os

import numpy as np
import pytest

from conftest import array_of
from stackweave.model import to_frames, to_pixels
from stackweave.operators import sampling
from stackweave.sources import stacks
from stackweave.sources.store import DatasetStore


def decode_npy(content):
    yield from np.load(io.BytesIO(content))


@pytest.fixture
def store(spark, tmp_path):
    return DatasetStore(spark, str(tmp_path / "store"))


def test_store_behaves_like_a_mapping(spark, store, tmp_path):
    store["raw"] = spark.range(3)
    store.put("proj/mean", spark.range(5))
    assert sorted(store) == ["proj/mean", "raw"] and len(store) == 2 and "raw" in store and "proj" not in store
    store.put("raw", store["raw"].where("id > 0"))
    assert store["raw"].count() == 2
    assert store.pop("raw", str(tmp_path / "popped")).count() == 2 and "raw" not in store
    store.export("proj/mean", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    name, df = store.popitem(str(tmp_path / "last"))
    assert name == "proj/mean" and df.count() == 5 and len(store) == 0
    for call in (lambda: store["raw"], lambda: store.drop("raw"), lambda: store.popitem(str(tmp_path / "x"))):
        with pytest.raises(KeyError):
            call()
    store["a/b/c"] = spark.range(1)
    del store["a"]
    store["d"] = spark.range(1)
    store.clear()
    assert list(store) == []
    for bad in ("", "/a", "a//b", "../a", "v=1"):
        with pytest.raises(ValueError):
            store.put(bad, spark.range(1))


def test_store_many(spark, store):
    shared = spark.range(10)
    kept = store.update({"low": shared.where("id < 5"), "high": shared.where("id >= 5")}, share=[shared])
    assert [kept[n].count() for n in ("low", "high")] == [5, 5]
    again = store.put_many(["low"], [store["low"]])
    assert again["low"].count() == 5
    with pytest.raises(ValueError):
        store.put_many(["a", "b"], [shared])


def test_readers_stay_with_their_version(spark, tmp_path):
    """What was opened before a put can still be read after it; it goes when the grace time is over."""
    store = DatasetStore(spark, str(tmp_path / "pinned"))
    store["x"] = spark.range(3)
    before, told = store["x"], store.snapshot()
    store["x"] = spark.range(10)
    assert before.count() == 3 and store["x"].count() == 10 and store.versions("x") == [1, 2]
    assert store.get("x", told["x"]).count() == 3 and store.snapshot() == {"x": 2}
    store.vacuum("x", grace=0)
    assert store.versions("x") == [2]
    with pytest.raises(KeyError):
        store.get("x", 1)
    quick = DatasetStore(spark, str(tmp_path / "quick"), grace=0)
    for n in range(3):
        quick["y"] = spark.range(n)
    assert quick.versions("y") == [3] and list(quick) == ["y"]


def test_parallel_writers_get_numbers_of_their_own(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda n: store.put("shared", spark.range(n)).count(), range(6)))
    assert made == list(range(6)) and len(store.versions("shared")) == 6
    assert sorted(store.get("shared", v).count() for v in store.versions("shared")) == list(range(6))


def test_given_up_writes_are_no_versions(spark, store, tmp_path):
    store["x"] = spark.range(3)
    with pytest.raises(Exception):
        store.put("x", spark.range(3).selectExpr("1 / (id - id)"))
    assert store.versions("x") == [1] and store["x"].count() == 3
    store["x"] = spark.range(4)
    assert store.versions("x") == [1, 3]
    store.vacuum("x", grace=0)
    assert [n for n in os.listdir(f"{store.root}/x") if not n.startswith(".") and n.startswith("v=")] == ["v=3"]


def test_failed_write_keeps_the_old_dataset(spark, store):
    store["x"] = spark.range(3)
    with pytest.raises(Exception):
        store.put("x", spark.range(3).selectExpr("1 / (id - id)"))
    assert store["x"].count() == 3


def test_load_files_with_a_decoder(spark, tmp_path, rng):
    parts = [rng.normal(size=(n, 3, 4)) for n in (2, 3, 1)]
    for i, part in enumerate(parts):
        np.save(tmp_path / f"f{i}.npy", part)
    loaded = stacks.load_stack(spark, str(tmp_path / "*.npy"), "binary", decoder=decode_npy)
    np.testing.assert_allclose(array_of(loaded), np.concatenate(parts))
    two = stacks.load_stack(spark, [str(tmp_path / "f1.npy"), str(tmp_path / "f0.npy")], "binary", decoder=decode_npy)
    np.testing.assert_allclose(array_of(two), np.concatenate([parts[1], parts[0]]))
    with pytest.raises(ValueError):
        stacks.load_stack(spark, "x", "binary")
    with pytest.raises(ValueError):
        stacks.load_stack(spark, "x", "other")


def test_load_parquet_and_prune(spark, tmp_path, frames_of, rng):
    stack = rng.normal(size=(30, 2, 2))
    path = str(tmp_path / "frames")
    stacks.chunk(frames_of(stack), 10).write.parquet(path)
    loaded = stacks.load_stack(spark, path)
    np.testing.assert_allclose(array_of(loaded), stack)
    plan = loaded.where("t >= 20")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,20)" in plan


@pytest.mark.parametrize("key", [[4, 0, 4, -1], slice(2, None), slice(1, -2, 2), slice(-3, None), slice(None), 3, -1])
def test_selection_matches_numpy(frames_of, rng, key):
    stack = rng.normal(size=(9, 3, 4))
    want = stack[key] if not isinstance(key, int) else stack[key:key + 1 or None]
    np.testing.assert_allclose(array_of(stacks.select_frames(frames_of(stack), key)), want)


def test_spatial_selection(frames_of, rng):
    stack = rng.normal(size=(4, 5, 6))
    rows = stacks.select_frames(to_pixels(frames_of(stack)), [1], slice(1, 4), slice(0, None, 2), dtype="float").collect()
    got = np.zeros((3, 3))
    for r in rows:
        got[r["y"], r["x"]] = r["v"]
    np.testing.assert_allclose(got, stack[1, 1:4, ::2], rtol=1e-6)
    np.testing.assert_allclose(array_of(stacks.select_frames(frames_of(stack), [3, 1], slice(1, 4), slice(1, None, 2))), stack[[3, 1], 1:4, 1::2])
    frames = frames_of(stack)
    for rows, cols in [(slice(-2, None), slice(None, -1)), ([4, 0, 4], slice(None)), (-1, [5, -6]), (2, 3), (slice(9, 12), slice(None))]:
        kept = [rows] if isinstance(rows, int) else rows
        want = stack[[2]][:, kept][:, :, [cols] if isinstance(cols, int) else cols]
        got = stacks.select_frames(frames, 2, rows, cols).first()
        assert (got["h"], got["w"]) == want.shape[1:]
        np.testing.assert_allclose(np.reshape(got["px"], want.shape), want)
    picked = stacks.select_frames(to_pixels(frames), [1], [3, 0, 3], 2).collect()
    assert sorted((r["y"], r["x"], r["v"]) for r in picked) == [(k, 0, stack[1, y, 2]) for k, y in enumerate([3, 0, 3])]


@pytest.mark.parametrize("key,rows", [([0, 99], None), ([-9], None), (7, None), ([], 0), ([1], [5]), ([1], -6)])
def test_unknown_positions_are_errors(frames_of, rng, key, rows):
    picked = stacks.select_frames(frames_of(rng.normal(size=(4, 5, 6))), key, rows)
    if key:
        with pytest.raises(Exception, match="do not exist|positions"):
            picked.collect()
    else:
        assert picked.count() == 0


def test_pixels_outside_or_twice_are_errors(spark):
    pixels = spark.createDataFrame([(0, 0, 2, 1.0)], "t long, y int, x int, v double")
    with pytest.raises(Exception, match="outside"):
        to_frames(pixels, (2, 2)).collect()
    with pytest.raises(Exception, match="several values"):
        to_frames(pixels.union(pixels), (3, 3)).collect()


class Pages:
    """Files of float64 frames of 2 x 3 that count how often a page is read."""

    def pages(self, path):
        return os.path.getsize(path.removeprefix("file:")) // 48

    def read(self, path, first, last):
        whole = np.fromfile(path.removeprefix("file:")).reshape(-1, 2, 3)
        yield from whole[first:last]


def test_ranges_of_files(spark, tmp_path, rng):
    stack = rng.normal(size=(23, 2, 3))
    for name, part in (("a.raw", stack[:15]), ("b.raw", stack[15:]), ("c.raw", stack[:0])):
        part.tofile(tmp_path / name)
    frames = stacks.decode_files(spark, str(tmp_path), Pages(), range_pages=4)
    np.testing.assert_allclose(array_of(frames), stack)


def test_concatenation_plan_grows_one_by_one(frames_of, rng):
    parts = [rng.normal(size=(2, 1, 1)) for _ in range(60)]
    made = stacks.concat_stacks([frames_of(p) for p in parts])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 4 * len(parts) and "scalar-subquery" not in plan
    np.testing.assert_allclose(array_of(made), np.concatenate(parts))


def test_concatenation_renumbers(frames_of, rng):
    a, b = rng.normal(size=(3, 2, 2)), rng.normal(size=(4, 2, 2))
    np.testing.assert_allclose(array_of(stacks.concat_stacks([frames_of(a, first=5), frames_of(b)])), np.concatenate([a, b]))


def test_shuffle_and_samples(frames_of, rng):
    stack = rng.normal(size=(200, 1, 2))
    frames = frames_of(stack)
    moved = sampling.shuffle_frames(frames, 4).orderBy("t").collect()
    assert [r["t"] for r in moved] == list(range(200)) and sorted(r["t_from"] for r in moved) == list(range(200))
    assert [r["t_from"] for r in moved] != list(range(200))
    assert all(r["px"] == list(stack[r["t_from"]].ravel()) for r in moved)
    chosen = [r["t"] for r in sampling.sample_positions(frames, 20, 4).orderBy("pos").collect()]
    assert chosen == [r["t_from"] for r in moved[:20]]
    assert sampling.sample_frames(frames, 500, 4).count() == 200
    per = sampling.sample_per_block(frames, 64, 10, 4).groupBy("tb").count().orderBy("tb").collect()
    assert [r["count"] for r in per] == [10, 10, 10, 8]
