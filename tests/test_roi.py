import numpy as np
import pytest
from pyspark.sql import functions as F

from stackweave.operators import roi
from stackweave.operators.graph import connected_groups
from stackweave.session import Scratch

PIX = "roi_id int, y int, x int, w double"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def disc(roi_id, cy, cx, r=3, gain=1.0):
    return [(roi_id, y, x, gain * (1.0 + 0.1 * (y - cy) + 0.05 * (x - cx)))
            for y in range(cy - r, cy + r + 1) for x in range(cx - r, cx + r + 1) if (y - cy) ** 2 + (x - cx) ** 2 <= r * r]


def rows_of(df):
    return sorted((r["roi_id"], r["y"], r["x"], round(r["w"], 9)) for r in df.collect())


def brute_pairs(rows, align=0.6, overlap=0.6):
    """Similar pairs among distinct images, by comparing all of them."""
    images = {}
    for i, y, x, w in rows:
        images.setdefault(i, {})[y, x] = w
    first = {}
    for i in sorted(images):
        first.setdefault(tuple(sorted(images[i].items())), i)
    ids = sorted(first.values())
    out = set()
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = images[a].keys() & images[b].keys()
            dot = sum(images[a][p] * images[b][p] for p in shared)
            size = np.prod([np.sqrt(sum(v * v for v in images[i].values())) for i in (a, b)])
            if shared and dot / size >= align - 1e-9 and len(shared) / min(len(images[a]), len(images[b])) >= overlap - 1e-9:
                out.add((a, b))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_pairs_match_brute_force_with_a_hot_pixel(spark, scratch, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(60):
        cells = {(0, 0): 1.0 + i % 3} if i % 3 == 0 else {}
        for _ in range(rng.integers(1, 5)):
            cells[int(rng.integers(0, 4)), int(rng.integers(0, 5))] = float(rng.integers(1, 4))
        rows += [(i, y, x, w) for (y, x), w in cells.items()]
    found = {(r["a"], r["b"]) for r in roi.similar_pairs(spark.createDataFrame(rows, PIX), scratch).collect()}
    assert found == brute_pairs(rows) and found


def test_regions_with_one_pixel_in_common_are_not_measured(spark, scratch):
    """Neighbours share their rarest pixel only, at which they still look promising by what lies ahead."""
    rows = [(i, 1, i // 2, 1.0) for i in range(40)] + [(i, 2, (3 * i + j) % 20, 1.0) for i in range(40) for j in range(3)]
    pixels, params = spark.createDataFrame(rows, PIX), roi.MergeParams()
    _, keys, _ = roi._searchable(pixels, scratch, params)
    met = roi._side(keys, "a").join(roi._side(keys, "b"), ["y", "x"]).where((F.col("a") < F.col("b")) & roi._promising(params))
    assert met.where("a % 2 = 0 AND b = a + 1").count() <= 4
    found = {(r["a"], r["b"]) for r in roi.similar_pairs(pixels, Scratch(spark, "all")).collect()}
    assert found == brute_pairs(rows) and found


def test_scratch_leaves_no_shuffle_files(spark, scratch):
    key, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(key, None)

    class Spy(type(spark.range(1).write)):
        def parquet(self, path, *args, **kwargs):
            seen.append(spark.conf.get(key))
            return super().parquet(path, *args, **kwargs)

    class Rows:
        schema, write = spark.range(3).schema, Spy(spark.range(3))

    assert scratch.write(Rows()).count() == 3 and seen == ["true"]
    assert spark.conf.get(key, None) == before


def test_merge_groups_equal_the_closure_of_all_pairs(spark, scratch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(80):
        cy, cx = (2, 2) if i % 3 == 0 else rng.integers(0, 8, size=2)
        rows += [(i, int(cy + dy), int(cx + dx), float(1 + rng.integers(0, 3))) for dy in (0, 1) for dx in (0, 1) if dy * dx == 0 or i % 2]
    groups = {r["id"]: r["grp"] for r in roi.merge_groups(spark.createDataFrame(rows, PIX), scratch).collect()}
    lead = {i: i for i in range(80)}

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    images = {}
    for i, y, x, w in rows:
        images.setdefault(i, {})[y, x] = w
    same = {}
    for i in sorted(images):
        same.setdefault(tuple(sorted(images[i].items())), []).append(i)
    for a, b in [*brute_pairs(rows), *[(g[0], j) for g in same.values() for j in g[1:]]]:
        a, b = sorted((find(a), find(b)))
        lead[b] = a
    assert all(groups.get(i, i) == find(i) for i in range(80))


def test_copies_merge_and_distant_discs_do_not(spark, scratch):
    rows = disc(1, 10, 10) + disc(2, 10, 10) + disc(3, 11, 10) + disc(4, 40, 40)
    merged = roi.merge_rois(spark.createDataFrame(rows, PIX), scratch)
    assert sorted(r["roi_id"] for r in merged.select("roi_id").distinct().collect()) == [1, 4]
    again = roi.merge_rois(merged, Scratch(spark, "again"))
    assert rows_of(again) == rows_of(merged)
    turned = roi.merge_rois(spark.createDataFrame(rows[::-1], PIX), Scratch(spark, "turned"))
    assert rows_of(turned) == rows_of(merged)
    renamed = roi.renumber(merged, bucket=2)
    assert sorted(r["roi_id"] for r in renamed.select("roi_id").distinct().collect()) == [1, 2]


def test_faint_pixels_go_when_merged(spark, scratch):
    rows = [(1, 0, 0, 100.0), (1, 0, 1, 0.5), (2, 9, 9, 1.0)]
    merged = roi.merge_rois(spark.createDataFrame(rows, PIX), scratch)
    assert rows_of(merged) == [(1, 0, 0, 100.0), (2, 9, 9, 1.0)]


def test_connected_groups(spark, scratch):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101)] + [(200, 200 + i) for i in range(1, 30)]
    groups = {r["id"]: r["grp"] for r in connected_groups(spark.createDataFrame(chain, "a int, b int"), scratch).collect()}
    assert {groups[i] for i in range(41)} == {0} and {groups[i] for i in (100, 101, 102)} == {100}
    assert {groups[200 + i] for i in range(30)} == {200}
    none = connected_groups(spark.createDataFrame([], "a int, b int"), scratch)
    assert none.count() == 0


def test_region_shapes(spark):
    rows = disc(1, 20, 20, 6) + [(2, 5, x, 1.0) for x in range(10)] + [(3, 0, 0, 2.0)]
    got = {r["roi_id"]: r for r in roi.region_props(spark.createDataFrame(rows, PIX), "roi_id").collect()}
    assert got[1]["eccentricity"] == pytest.approx(0, abs=1e-6) and (got[1]["cy"], got[1]["cx"]) == (20, 20)
    assert got[2]["eccentricity"] == 1 and got[2]["minor"] == 0 and got[2]["major"] == pytest.approx(4 * np.std(np.arange(10)))
    assert got[3]["area"] == 1 and got[3]["eccentricity"] == 0 and got[3]["max_v"] == 2


def test_peaks_keep_their_distance(spark):
    rows = [(0, 5, 5, 9.0), (0, 5, 17, 8.0), (0, 5, 40, 7.0), (0, 5, 56, 7.0), (1, 5, 6, 1.0), (0, 80, 80, 2.0), (0, 80, 81, 2.0)]
    kept = roi.keep_distant_peaks(spark.createDataFrame(rows, "t long, y int, x int, wav double"), 16.0).collect()
    assert sorted((r["t"], r["y"], r["x"]) for r in kept) == [(0, 5, 5), (0, 5, 40), (0, 5, 56), (0, 80, 80), (1, 5, 6)]


def test_contour_of_a_pixel(spark):
    got = roi.roi_contours(spark.createDataFrame([(1, 3, 4, 1.0)], PIX)).first()
    assert sorted(zip(got["ys"], got["xs"])) == [(3, 4), (3, 5), (4, 4), (4, 5)]
    angle = np.arctan2(np.array(got["xs"]) - 4.5, np.array(got["ys"]) - 3.5)
    assert (np.diff(angle) > 0).all()


def test_contour_leaves_out_the_inside(spark):
    rows = [(1, y, x, 1.0) for y in range(4) for x in range(5)]
    got = roi.roi_contours(spark.createDataFrame(rows, PIX)).first()
    edge = {(y, x) for y in range(5) for x in range(6) if y in (0, 4) or x in (0, 5)}
    assert set(zip(got["ys"], got["xs"])) == edge and len(got["ys"]) == len(edge)


def test_labels_wrap_in_8_bits(spark):
    rows = [(300, 0, 0, 1.0), (2, 0, 0, 1.0), (7, 1, 1, 1.0)]
    got = {(r["y"], r["x"]): (r["label"], r["label8"]) for r in roi.label_image(spark.createDataFrame(rows, PIX), (2, 2)).collect()}
    assert got == {(0, 0): (300, 44), (0, 1): (0, 0), (1, 0): (0, 0), (1, 1): (7, 7)}


def test_no_regions(spark, frames_of, scratch):
    table, pixels = roi.empty_rois(spark)
    assert table.count() == 0 and pixels.columns == ["roi_id", "y", "x", "w"]
    flat = frames_of(np.zeros((2, 12, 12)), key="atom")
    found, cells = roi.extract_rois(flat, scratch)
    assert found.count() == 0 and cells.count() == 0 and found.columns == table.columns
    assert roi.merge_rois(pixels, scratch).count() == 0


def test_extract_finds_discs(frames_of, scratch):
    y, x = np.mgrid[:60, :64]
    centres = [(15, 15), (15, 45), (45, 30)]
    images = np.array([sum(np.exp(-((y - a) ** 2 + (x - b) ** 2) / 18.0) for a, b in part) for part in (centres[:2], centres[2:])])
    table, pixels = roi.extract_rois(frames_of(images, key="atom"), scratch)
    found = sorted((r["atom"], round(r["cy"]), round(r["cx"])) for r in table.collect())
    assert found == [(0, 15, 15), (0, 15, 45), (1, 45, 30)]
    assert pixels.groupBy("roi_id").agg(F.count("*").alias("n")).where("n < 25").count() == 0
