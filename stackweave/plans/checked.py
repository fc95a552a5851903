"""Queries for iterative operators whose result SQL can still spell out: one atom, two rounds, or stored stages."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.functions.kernels import spline_taps
from stackweave.model import explode_frames, promote, to_pixels
from stackweave.operators import blocks, dictionary, elementwise, normalize, regions_tiled, registration, registration_slabs, roi, tiled
from stackweave.plans import fixtures as fx
from stackweave.plans.pipeline import PipelineParams, run_pipeline
from stackweave.plans.queries import (
    BOUNDS, EMB, HMEAN, LABELS, MEDIAN, NOISE, ORACLES, PEAKS, PROPS, SEED, SHIFTS, SIGNIFICANT, SMALL, peak_rows, pixels, query, region_pixels, rounded, smooth_sql,
    VOL, store_at, taps_sql, volumes,
)
from stackweave.session import Scratch
from stackweave.sources.stackfile import register_stack_format
from stackweave.sources.stacks import load_stack
from stackweave.sources.store import DatasetStore
from stackweave.streaming import jobs

ALPHA = 0.2


def one_atom_sql(rounds: int, keys: tuple[str, ...] = (), batch: int | None = None) -> list[str]:
    """Rounds of learning a single atom as CTEs over ``x(keys, t, y, x, v)`` from ``d0(keys, y, x, v)``.

    With ``batch``, round r sees the r-th run of so many frames. Code: soft threshold of the inner product over the atom's square. Statistics: ``a`` of squared codes and ``b``
    of code times frame, old ones fading by 1 - 1/round. Atom: ``b / a``, brought into the unit ball.
    """
    k = "".join(f"{c}, " for c in keys)
    by = f"GROUP BY {', '.join(keys)}" if keys else ""
    using = f"USING ({', '.join(keys)})" if keys else ""
    join = "JOIN" if keys else "CROSS JOIN"
    out = [f"a0 AS (SELECT {k} CAST(0 AS DOUBLE) AS a FROM d0 {by or 'LIMIT 1'})", f"b0 AS (SELECT {k} y, x, CAST(0 AS DOUBLE) AS b FROM d0)"]
    for r in range(1, rounds + 1):
        p, keep = r - 1, f"CAST({tiled.kept_share(r, batch)!r} AS DOUBLE)"
        x = f"(SELECT * FROM x WHERE t >= {(r - 1) * batch} AND t < {r * batch})" if batch else "x"
        out += [
            f"g{r} AS (SELECT {k} sum(v * v) AS g FROM d{p} {by})",
            f"c{r} AS (SELECT {k} s.t, sum(s.v * d.v) AS c FROM {x} s JOIN d{p} d USING ({k} y, x) GROUP BY {k} s.t)",
            f"k{r} AS (SELECT {k} t, sign(c) * greatest(abs(c) - {ALPHA}, 0) / g AS k FROM c{r} {join} g{r} {using})",
            f"s{r} AS (SELECT {k} sum(k * k) AS s FROM k{r} {by})",
            f"a{r} AS (SELECT {k} {keep} * a + s AS a FROM a{p} {join} s{r} {using})",
            f"m{r} AS (SELECT {k} y, x, sum(q.k * s.v) AS m FROM {x} s JOIN k{r} q USING ({k} t) GROUP BY {k} y, x)",
            f"b{r} AS (SELECT {k} y, x, {keep} * b + m AS b FROM b{p} JOIN m{r} USING ({k} y, x))",
            f"n{r} AS (SELECT {k} y, x, CASE WHEN a > 1e-12 THEN v + (b - a * v) / a ELSE v END AS v, a FROM d{p} JOIN b{r} USING ({k} y, x) {join} a{r} {using})",
            f"u{r} AS (SELECT {k} greatest(1, sqrt(sum(v * v))) AS u FROM n{r} {by})",
            f"d{r} AS (SELECT {k} y, x, CASE WHEN a > 1e-12 THEN v / u ELSE v END AS v FROM n{r} {join} u{r} {using})",
        ]
    return out


ONE = ["x AS (SELECT * FROM emb)", f"d0 AS (SELECT y, x, v FROM emb WHERE t = (SELECT vec_id FROM embeddings ORDER BY md5(vec_id || ':{SEED}'), vec_id LIMIT 1))"]


def atom_rows(atoms: DataFrame) -> DataFrame:
    return rounded(explode_frames(atoms.withColumnRenamed("atom", "t")), "v").withColumnRenamed("t", "atom")


def atom_out(rounds: int) -> str:
    return f"SELECT CAST(0 AS BIGINT) AS atom, y, x, round(v, 6) + 0.0 AS v FROM d{rounds}"


@query(atom_out(3), EMB, *ONE, *one_atom_sql(3))
def dict_fit_one(spark: SparkSession, sf: str) -> DataFrame:
    return atom_rows(dictionary.atoms_frame(spark, dictionary.fit(fx.emb_wide(spark, sf), 1, alpha=ALPHA, rounds=3, seed=SEED)))


@query(atom_out(3), EMB, *ONE, *one_atom_sql(3))
def dict_fit_one_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """One round, the state through its tables, two more rounds."""
    frames = fx.emb_wide(spark, sf)
    state = dictionary.state_tables(spark, dictionary.fit(frames, 1, alpha=ALPHA, rounds=1, seed=SEED))
    learned = dictionary.fit(frames, alpha=ALPHA, rounds=2, state=dictionary.state_from_tables(state))
    return atom_rows(dictionary.atoms_frame(spark, learned))


@query(atom_out(2), EMB, *ONE, *one_atom_sql(2))
def stream_dict_fit_one(spark: SparkSession, sf: str) -> DataFrame:
    root = Scratch(spark, "learn").root
    store = DatasetStore(spark, f"{root}/store")
    jobs.stream_fit(fx.emb_arriving(spark, sf), store, f"{root}/checkpoint", 1, ALPHA, 2, SEED).awaitTermination()
    return atom_rows(dictionary.atoms_frame(spark, jobs.load_state(store)[0]))


@query(atom_out(3), EMB, *ONE, *one_atom_sql(3))
def dict_fit_one_tiled(spark: SparkSession, sf: str) -> DataFrame:
    """The same rounds with atom and statistics in tiles of 20 pixels, the state through its tables after one round."""
    frames, scratch = fx.emb_wide(spark, sf), Scratch(spark, "tiles")
    state = tiled.start_state(dictionary.initial_atoms(frames, 1, SEED), scratch, 20)
    state = tiled.state_from_tables(tiled.state_tables(tiled.learn(frames, state, ALPHA, 1, scratch)))
    return atom_rows(tiled.atoms_of(tiled.learn(frames, state, ALPHA, 2, scratch)))


@query(atom_out(3), EMB, *ONE, *one_atom_sql(3, batch=64))
def dict_fit_one_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Online learning: three mini-batches of 64 frames, one after the other."""
    frames = fx.emb_wide(spark, sf)
    return atom_rows(dictionary.atoms_frame(spark, dictionary.fit(frames, 1, alpha=ALPHA, rounds=3, seed=SEED, batch=64)))


def two_atoms_sql(rounds: int, alpha: float = ALPHA) -> list[str]:
    """Rounds of learning two atoms: the lasso in closed form over all sign patterns, then one atom after the other.

    Of the codes with no atom, one, or both with given signs, the best is the lasso's; a pattern counts if its solution has those signs.
    """
    both = [f"SELECT t, (g11 * (c0 - {p}) - g01 * (c1 - {q})) / det AS k0, (g00 * (c1 - {q}) - g01 * (c0 - {p})) / det AS k1, {i} AS s0, {j} AS s1, c0, c1, g00, g01, g11 FROM q{{r}}"
            for i, p in ((1, alpha), (-1, -alpha)) for j, q in ((1, alpha), (-1, -alpha))]
    out = ["a0 AS (SELECT CAST(0 AS DOUBLE) AS a00, CAST(0 AS DOUBLE) AS a01, CAST(0 AS DOUBLE) AS a11)", "b0 AS (SELECT y, x, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1 FROM d0)"]
    for r in range(1, rounds + 1):
        p, keep = r - 1, f"CAST({1.0 - 1.0 / r!r} AS DOUBLE)"
        out += [
            f"g{r} AS (SELECT sum(v0 * v0) AS g00, sum(v0 * v1) AS g01, sum(v1 * v1) AS g11 FROM d{p})",
            f"q{r} AS (SELECT *, g00 * g11 - g01 * g01 AS det FROM (SELECT e.t, sum(e.v * v0) AS c0, sum(e.v * v1) AS c1 FROM emb e JOIN d{p} d USING (y, x) GROUP BY e.t) CROSS JOIN g{r})",
            f"""p{r} AS (SELECT t, CAST(0 AS DOUBLE) AS k0, CAST(0 AS DOUBLE) AS k1, 0 AS s0, 0 AS s1, c0, c1, g00, g01, g11 FROM q{r}
              UNION ALL SELECT t, sign(c0) * greatest(abs(c0) - {alpha}, 0) / g00, 0, sign(c0), 0, c0, c1, g00, g01, g11 FROM q{r}
              UNION ALL SELECT t, 0, sign(c1) * greatest(abs(c1) - {alpha}, 0) / g11, 0, sign(c1), c0, c1, g00, g01, g11 FROM q{r}
              UNION ALL {" UNION ALL ".join(b.format(r=r) for b in both)})""",
            f"""k{r} AS (SELECT t, k0, k1 FROM p{r} WHERE k0 * s0 >= 0 AND k1 * s1 >= 0
              QUALIFY row_number() OVER (PARTITION BY t ORDER BY 0.5 * (k0*k0*g00 + 2*k0*k1*g01 + k1*k1*g11) - k0*c0 - k1*c1 + {alpha} * (abs(k0) + abs(k1))) = 1)""",
            f"a{r} AS (SELECT {keep} * any_value(a.a00) + sum(k0*k0) AS a00, {keep} * any_value(a.a01) + sum(k0*k1) AS a01, {keep} * any_value(a.a11) + sum(k1*k1) AS a11 FROM k{r} CROSS JOIN a{p} a)",
            f"""b{r} AS (SELECT y, x, {keep} * any_value(b.b0) + sum(k0 * e.v) AS b0, {keep} * any_value(b.b1) + sum(k1 * e.v) AS b1 FROM emb e JOIN k{r} USING (t) JOIN b{p} b USING (y, x) GROUP BY y, x)""",
            f"n{r} AS (SELECT y, x, v0 + (b0 - a00 * v0 - a01 * v1) / a00 AS w, v1, b1, a01, a11 FROM d{p} JOIN b{r} USING (y, x) CROSS JOIN a{r})",
            f"m{r} AS (SELECT y, x, w / greatest(1, sqrt(sum(w * w) OVER ())) AS v0, v1, b1, a01, a11 FROM n{r})",
            f"o{r} AS (SELECT y, x, v0, v1 + (b1 - a01 * v0 - a11 * v1) / a11 AS w FROM m{r})",
            f"d{r} AS (SELECT y, x, v0, w / greatest(1, sqrt(sum(w * w) OVER ())) AS v1 FROM o{r})",
        ]
    return out


TWO = f"""d0 AS (SELECT y, x, max(v) FILTER (place = 1) AS v0, max(v) FILTER (place = 2) AS v1 FROM emb JOIN (SELECT vec_id AS t,
  row_number() OVER (ORDER BY md5(vec_id || ':{SEED}'), vec_id) AS place FROM embeddings QUALIFY place <= 2) USING (t) GROUP BY y, x)"""


@query("""SELECT CAST(0 AS BIGINT) AS atom, y, x, round(v0, 6) + 0.0 AS v FROM d2 UNION ALL SELECT CAST(1 AS BIGINT), y, x, round(v1, 6) + 0.0 FROM d2""", EMB, TWO, *two_atoms_sql(2))
def dict_fit_two(spark: SparkSession, sf: str) -> DataFrame:
    """Two atoms, two rounds: codes that share, statistics that couple, atoms updated one after the other."""
    return atom_rows(dictionary.atoms_frame(spark, dictionary.fit(fx.emb_wide(spark, sf), 2, alpha=ALPHA, rounds=2, seed=SEED)))


@query("""SELECT CAST(0 AS BIGINT) AS atom, y, x, round(v0, 6) + 0.0 AS v FROM d2 UNION ALL SELECT CAST(1 AS BIGINT), y, x, round(v1, 6) + 0.0 FROM d2""", EMB, TWO, *two_atoms_sql(2))
def dict_fit_two_tiled(spark: SparkSession, sf: str) -> DataFrame:
    """The same in tiles of 24 pixels, where the update is a matrix on inner products."""
    frames, scratch = fx.emb_wide(spark, sf), Scratch(spark, "tiles")
    return atom_rows(tiled.fit_tiles(frames, dictionary.initial_atoms(frames, 2, SEED), ALPHA, 2, scratch, size=24))


def two_codes_sql(alpha: float) -> str:
    """Non-zero lasso codes of all frames for two atoms."""
    first_round = ", ".join(two_atoms_sql(1, alpha)[2:6])
    return f"""SELECT atom, t, round(k, 6) + 0.0 AS coef, CAST({alpha} AS DOUBLE) AS alpha FROM (WITH {first_round}
      SELECT CAST(0 AS BIGINT) AS atom, t, k0 AS k FROM k1 UNION ALL SELECT CAST(1 AS BIGINT), t, k1 FROM k1) WHERE abs(k) > 1e-9"""


@query(f"{two_codes_sql(0.05)} UNION ALL {two_codes_sql(0.15)}", EMB, TWO)
def sparse_encode_lars(spark: SparkSession, sf: str) -> DataFrame:
    """Exact lasso codes by the path, at two weights."""
    frames = fx.emb_wide(spark, sf)
    atoms = dictionary.initial_atoms(frames, 2, SEED)
    coded = [dictionary.sparse_encode(frames, atoms, "lars", alpha=a).withColumn("alpha", F.lit(a)) for a in (0.05, 0.15)]
    return rounded(coded[0].unionByName(coded[1]).where("abs(coef) > 1e-9"), "coef")


BLOCK_T = 128
BLOCKS = ["x AS (SELECT e.t, e.y, e.x, e.v, s.tb, e.y // 4 AS yb, e.x // 4 AS xb FROM emb e JOIN share s ON s.tb = e.t // 128)",
          f"first AS (SELECT vec_id // 128 AS tb, vec_id AS t FROM embeddings QUALIFY row_number() OVER (PARTITION BY vec_id // 128 ORDER BY md5(vec_id || ':{SEED}')) = 1)",
          "d0 AS (SELECT x.tb, x.yb, x.xb, x.y, x.x, x.v FROM x JOIN first f ON f.tb = x.tb AND f.t = x.t)"]
SHARE = """share AS (SELECT tb, CAST(sum(k) OVER (ORDER BY tb) - k AS BIGINT) AS atom, k FROM (
    SELECT tb, 4 * frames // n + CASE WHEN row_number() OVER (ORDER BY 4 * frames % n DESC, tb) <= 4 - sum(4 * frames // n) OVER () THEN 1 ELSE 0 END AS k
    FROM (SELECT vec_id // 128 AS tb, count(*) AS frames, (SELECT count(*) FROM embeddings) AS n FROM embeddings GROUP BY 1)) QUALIFY k > 0)"""


@query("SELECT s.atom, d.y, d.x, round(d.v, 6) + 0.0 AS v FROM d2 d JOIN share s USING (tb)", EMB, SHARE, *BLOCKS, *one_atom_sql(2, ("tb", "yb", "xb")))
def dict_fit_blocks_one(spark: SparkSession, sf: str) -> DataFrame:
    """Four atoms for all time blocks: a block gets one at most, each of its tiles learns its own part."""
    return atom_rows(dictionary.fit_blocks(fx.emb_wide(spark, sf), 4, (BLOCK_T, 4, 4), alpha=ALPHA, rounds=2, seed=SEED))


# -- blocks of several stacks --------------------------------------------------------------


def summed_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of the products of two stacks in the 3 x 3 neighbourhood; blocks come with their whole halo."""
    views = np.lib.stride_tricks.sliding_window_view(a * b, (3, 3), axis=(1, 2))
    return np.pad(views.sum(axis=(3, 4)), ((0, 0), (1, 1), (1, 1)))


def smooth_cube(stack: np.ndarray) -> np.ndarray:
    """Mean of 5 x 5 pixels in up to three frames; time ends where the data does."""
    views = np.lib.stride_tricks.sliding_window_view(stack, (5, 5), axis=(1, 2))
    flat = np.pad(views.mean(axis=(3, 4)), ((0, 0), (2, 2), (2, 2)))
    return np.stack([flat[max(k - 1, 0):k + 2].mean(axis=0) for k in range(len(flat))])


@query("""SELECT e.t, e.y, e.x, round(sum(n.v * r.v), 6) + 0.0 AS v FROM emb e JOIN emb n ON n.t = e.t AND abs(n.y - e.y) <= 1 AND abs(n.x - e.x) <= 1
  JOIN emb r ON r.t = (SELECT max(t) FROM emb) - n.t AND r.y = n.y AND r.x = n.x GROUP BY 1, 2, 3""", EMB)
def blocks_two_stacks(spark: SparkSession, sf: str) -> DataFrame:
    """The stack and itself backwards in time, in blocks of 100 x 3 x 5 with nothing beyond the edges."""
    frames = fx.emb_wide(spark, sf)
    backwards = frames.withColumn("t", frames.agg(F.max("t")).scalar() - F.col("t"))
    made = blocks.map_stacks([frames, backwards], summed_product, (100, 3, 5), (0, 1, 1), "constant")
    return rounded(blocks.pieces_to_pixels(made), "v")


@query("""SELECT t, y, x, round(avg(v), 6) + 0.0 AS v FROM (SELECT e.t, e.y, e.x, s.t AS st, avg(s.v) AS v FROM emb e, (VALUES (-2),(-1),(0),(1),(2)) a(d), (VALUES (-2),(-1),(0),(1),(2)) b(d), emb s
    WHERE abs(s.t - e.t) <= 1 AND s.y = CASE WHEN e.y + a.d < 0 THEN -1 - e.y - a.d WHEN e.y + a.d > 7 THEN 15 - e.y - a.d ELSE e.y + a.d END
      AND s.x = least(greatest(e.x + b.d, 0), 7) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""", EMB)
def blocks_borders(spark: SparkSession, sf: str) -> DataFrame:
    """A border of its own on each axis: cut in time, mirrored in y, the edge repeated in x."""
    made = blocks.map_stacks([fx.emb_wide(spark, sf)], smooth_cube, (50, 3, 4), (1, 2, 2), ("cut", "mirror", "edge"))
    return rounded(blocks.pieces_to_pixels(made), "v")


# -- types, export and splitting -----------------------------------------------------------


@query("SELECT t, y, x, CAST(v AS FLOAT) AS v FROM emb", EMB)
def promote_float32(spark: SparkSession, sf: str) -> DataFrame:
    """Stored frames in the working type: the 32-bit input stays 32-bit."""
    frames = fx.frames_from(fx.read(spark, sf, "embeddings"), "vec_id", "embedding", fx.SHAPE, dtype=None)
    return to_pixels(store_at(spark, "promote").put("raw", promote(frames)))


@query("""SELECT t, y, x, CASE WHEN v >= 18446744073709551615 THEN CAST(18446744073709551615 AS DECIMAL(20, 0)) ELSE CAST(CAST(trunc(v) AS HUGEINT) AS DECIMAL(20, 0)) END AS v
  FROM (SELECT t, y, x, (v - lo) * (CAST('18446744073709551615' AS DOUBLE) / (hi - lo)) AS v FROM emb, b)""", EMB, BOUNDS)
def norm_layer_u64(spark: SparkSession, sf: str) -> DataFrame:
    return to_pixels(elementwise.norm_layer(fx.emb(spark, sf), "uint64"))


@query("""SELECT t, y, x, CASE WHEN v = 0 THEN v ELSE round_even(v / s, 0) * s END AS v FROM (SELECT *, pow(2, greatest(floor(log2(nullif(v, 0))), -14) - 10) AS s
  FROM (SELECT t, y, x, (v - lo) * (CAST(1 AS DOUBLE) / (hi - lo)) AS v FROM emb, b))""", EMB, BOUNDS)
def norm_layer_f16(spark: SparkSession, sf: str) -> DataFrame:
    return to_pixels(elementwise.norm_layer(fx.emb(spark, sf), "float16"))


@query("SELECT t, y, x, round(v, 6) + 0.0 AS v FROM emb", EMB)
def store_export(spark: SparkSession, sf: str) -> DataFrame:
    store = store_at(spark, "export")
    store.put("raw", fx.emb(spark, sf))
    store.export("raw", f"{store.root}-plain")
    return pixels(spark.read.parquet(f"{store.root}-plain"))


def exported(spark: SparkSession, sf: str, dtype: str = "<f8") -> str:
    """The frames as array files in the shared folder."""
    folder = f"{Scratch(spark, 'stack').root}/frames"
    register_stack_format(spark)
    # Whole ranges of time per task make long files.
    fx.emb(spark, sf).repartitionByRange(8, "t").sortWithinPartitions("t").write.format("stack").mode("overwrite").option("dtype", dtype).save(folder)
    return folder


@query("SELECT t, y, x, round(v, 6) + 0.0 AS v FROM emb", EMB)
def stack_source(spark: SparkSession, sf: str) -> DataFrame:
    """Exported to array files and read back through the data source, up to 150 pages a partition."""
    return pixels(load_stack(spark, exported(spark, sf), "stack", chunk_frames=150))


@query("SELECT t, y, x, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 6) + 0.0 AS v FROM emb WHERE t > 20 AND t <= 90 AND t <> 33", EMB)
def stack_source_range(spark: SparkSession, sf: str) -> DataFrame:
    """Filters on the frame number: ranges for the source, the rest for Spark; numbers of 32 bits."""
    frames = load_stack(spark, exported(spark, sf, "<f4"), "stack", chunk_frames=16)
    return pixels(frames.where("t > 20 and t <= 90 and t <> 33"))


@query("""SELECT t, CAST(region AS INTEGER) AS region, y, x, seg FROM grow QUALIFY row_number() OVER (PARTITION BY t, y, x ORDER BY d, seg) = 1""",
       EMB, LABELS, PEAKS, """seeds AS (SELECT l.t, l.region, l.y, l.x, row_number() OVER (PARTITION BY l.t ORDER BY l.y, l.x) AS seg
         FROM lab l JOIN peaks p ON p.t = l.t AND p.y = l.y AND p.x = l.x),
       grow(t, region, seg, y, x, d) AS (SELECT t, region, seg, y, x, 0 FROM seeds UNION SELECT g.t, g.region, g.seg, l.y, l.x, g.d + 1 FROM grow g
         JOIN lab l ON l.t = g.t AND l.region = g.region AND abs(l.y - g.y) <= 1 AND abs(l.x - g.x) <= 1 WHERE g.d < 40)""")
def split_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Regions divided among all their peaks: a pixel goes to the nearest peak inside its region, then to the first."""
    rows = region_pixels(spark, sf)
    peaks = peak_rows(spark, sf).join(rows.select("t", "region", "y", "x"), ["t", "y", "x"])
    return roi.split_regions(rows, peaks).select("t", "region", "y", "x", "seg")


GROWN = """seeds AS (SELECT l.t, l.region, l.y, l.x, l.y * 8 + l.x + 1 AS seg FROM lab l JOIN peaks p ON p.t = l.t AND p.y = l.y AND p.x = l.x),
       grow(t, region, seg, y, x, d) AS (SELECT t, region, seg, y, x, 0 FROM seeds UNION SELECT g.t, g.region, g.seg, l.y, l.x, g.d + 1 FROM grow g
         JOIN lab l ON l.t = g.t AND l.region = g.region AND abs(l.y - g.y) <= 1 AND abs(l.x - g.x) <= 1 WHERE g.d < 40)"""


def labelled_tiles(spark: SparkSession, sf: str, scratch: Scratch, size: tuple[int, int]) -> DataFrame:
    """Frames cut into tiles with their regions and peaks; both are found frame by frame and labelled tile by tile."""
    marked = roi.mark_peaks(roi.significant_mask(fx.emb_wide(spark, sf), noise=1.0))
    tiles = scratch.write(regions_tiled.cut_tiles(marked, size, "mask", "peak"))
    named = regions_tiled.label_tiles(tiles, scratch)
    return named.join(tiles.select("t", "y0", "x0", "peak"), ["t", "y0", "x0"])


@query("SELECT t, region, y, x FROM (SELECT t, y, x, CAST(region AS BIGINT) AS region FROM lab)", EMB, LABELS)
def label_regions_tiled(spark: SparkSession, sf: str) -> DataFrame:
    """Regions tied together over the borders of 3 x 3 tiles."""
    named = labelled_tiles(spark, sf, Scratch(spark, "tiles"), (3, 3))
    return regions_tiled.tile_pixels(named, "region").where("region > 0").select("t", "region", "y", "x")


@query("""SELECT t, CAST(region AS BIGINT) AS region, y, x, CAST(seg AS BIGINT) AS seg FROM grow QUALIFY row_number() OVER (PARTITION BY t, y, x ORDER BY d, seg) = 1""",
       EMB, LABELS, PEAKS, GROWN)
def split_regions_tiled(spark: SparkSession, sf: str) -> DataFrame:
    """Regions divided among all their peaks, grown over the borders of 2 x 3 tiles."""
    scratch = Scratch(spark, "tiles")
    cut = regions_tiled.split_tiles(labelled_tiles(spark, sf, scratch, (2, 3)), scratch)
    return regions_tiled.tile_pixels(cut, "region", "seg").where("seg > 0").select("t", "region", "y", "x", "seg")


# -- volumes -------------------------------------------------------------------------------

ZEROED = "z0 AS (SELECT t, z, y, x, v - avg(v) OVER (PARTITION BY t) AS v FROM vol)"


def volume_rows(made: DataFrame) -> DataFrame:
    return rounded(made, "v").select("t", "z", "y", "x", "v")


@query("SELECT t, z, y, x, round(v, 6) + 0.0 AS v FROM z0", EMB, VOL, ZEROED)
def zeroed_mean_volume(spark: SparkSession, sf: str) -> DataFrame:
    return volume_rows(normalize.zeroed_mean(volumes(spark, sf)))


@query("SELECT t, z, y, x, round(v / sum(abs(v)) OVER (PARTITION BY t), 6) + 0.0 AS v FROM vol", EMB, VOL)
def renorm_l1_volume(spark: SparkSession, sf: str) -> DataFrame:
    return volume_rows(normalize.renormalize(volumes(spark, sf), 1))


@query("SELECT t, z, y, x, round(v / max(abs(v)) OVER (PARTITION BY t), 6) + 0.0 AS v FROM vol", EMB, VOL)
def renorm_linf_volume(spark: SparkSession, sf: str) -> DataFrame:
    return volume_rows(normalize.renormalize(volumes(spark, sf), "inf"))


@query("SELECT t, z, y, x, round(v / sqrt(sum(v * v) OVER (PARTITION BY t)), 6) + 0.0 AS v FROM z0", EMB, VOL, ZEROED)
def normalize_data_volume(spark: SparkSession, sf: str) -> DataFrame:
    return volume_rows(normalize.normalize_data(volumes(spark, sf)))


@query("""SELECT t, z, y, x, round(v / sqrt(sum(v * v) OVER (PARTITION BY t)), 6) + 0.0 AS v
  FROM (SELECT t, z, y, x, v - min(v) OVER (PARTITION BY t) AS v FROM vol)""", EMB, VOL)
def normalize_min_volume(spark: SparkSession, sf: str) -> DataFrame:
    return volume_rows(normalize.normalize_min(volumes(spark, sf)))


# -- extraction as a whole ------------------------------------------------------------------


def on(sql: str, **names: str) -> str:
    """A view's SQL with other names for some of its tables and columns."""
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m.group()], sql)


FINER = {n: f"{n}_f" for n in ("stat", "noise", "sig", "cells", "links", "reach", "lab")}
LAST = {n: f"{n}_l" for n in ("sums", "cov2", "eig", "props")}
SPLINE = [taps_sql("s1", spline_taps(1)), taps_sql("s2", spline_taps(2)), smooth_sql("c1y", "emb", "y", "s1"), smooth_sql("c1", "c1y", "x", "s1"),
          smooth_sql("c2y", "c1", "y", "s2"), smooth_sql("c2", "c2y", "x", "s2")]
EXTRACT = [
    EMB, *SPLINE, "wav AS (SELECT a.t, a.y, a.x, a.v - b.v AS v FROM c1 a JOIN c2 b USING (t, y, x))", "fine AS (SELECT a.t, a.y, a.x, a.v - b.v AS v FROM emb a JOIN c1 b USING (t, y, x))",
    on(LABELS, emb="wav"), PROPS, on(NOISE, emb="fine", **FINER),
    "sig_f AS (SELECT f.t, f.y, f.x, f.v FROM fine f JOIN noise_f n USING (t) JOIN sig s ON s.t = f.t AND s.y = f.y AND s.x = f.x WHERE f.v > n.noise_f)",
    on(LABELS[len(SIGNIFICANT) + 2:], **FINER), on(PEAKS, emb="wav"),
    """pix AS (SELECT * FROM (SELECT l.t, l.y, l.x, l.v AS wav, e.v, CASE WHEN p.major BETWEEN 0 AND 10 THEN l.region ELSE -f.region END AS region
      FROM lab l JOIN emb e USING (t, y, x) JOIN props p ON p.t = l.t AND p.region = l.region LEFT JOIN lab_f f ON f.t = l.t AND f.y = l.y AND f.x = l.x) WHERE region IS NOT NULL)""",
    "ranked AS (SELECT *, (rank() OVER (PARTITION BY t, region ORDER BY wav) - 1) / CAST(count(*) OVER (PARTITION BY t, region) AS DOUBLE) AS under FROM pix)",
    "high AS (SELECT r.* FROM ranked r JOIN peaks p ON p.t = r.t AND p.y = r.y AND p.x = r.x WHERE r.under >= 0.5)",
    """seeds AS (SELECT t, region, y, x, row_number() OVER (PARTITION BY t ORDER BY y, x) AS seg FROM high p WHERE NOT EXISTS (SELECT 1 FROM high q WHERE q.t = p.t
      AND (q.wav > p.wav OR (q.wav = p.wav AND (q.y < p.y OR (q.y = p.y AND q.x < p.x)))) AND (q.y-p.y)*(q.y-p.y) + (q.x-p.x)*(q.x-p.x) < 9))""",
    """grow(t, region, seg, y, x, d) AS (SELECT t, region, seg, y, x, 0 FROM seeds UNION SELECT g.t, g.region, g.seg, l.y, l.x, g.d + 1 FROM grow g
      JOIN pix l ON l.t = g.t AND l.region = g.region AND abs(l.y - g.y) <= 1 AND abs(l.x - g.x) <= 1 WHERE g.d < 40)""",
    """cut AS (SELECT o.t, o.y, o.x, o.region, o.seg, e.v FROM (SELECT * FROM grow QUALIFY row_number() OVER (PARTITION BY t, y, x ORDER BY d, seg) = 1) o JOIN emb e USING (t, y, x))""",
    on(PROPS, lab="cut", region="seg", **LAST), "named AS (SELECT DISTINCT t, seg, region FROM cut)",
]
ORACLES["roi_extract"] = f"WITH RECURSIVE {', '.join(EXTRACT)} " + " ".join("""SELECT CAST(row_number() OVER (ORDER BY p.t, n.region, p.seg) AS INTEGER) AS roi_id, p.t AS atom, p.area,
  round(cy, 6) + 0.0 AS cy, round(cx, 6) + 0.0 AS cx, round(major, 6) + 0.0 AS major, round(minor, 6) + 0.0 AS minor, round(eccentricity, 6) + 0.0 AS eccentricity,
  round(max_v, 6) + 0.0 AS max_v FROM props_l p JOIN named n ON n.t = p.t AND n.seg = p.seg WHERE area BETWEEN 2 AND 40 AND eccentricity BETWEEN 0 AND 0.99""".split())


# -- registration in two rounds ------------------------------------------------------------

DRIFTING = """src AS (SELECT e.t, e.y, e.x, e.v + CAST(3 AS DOUBLE) / (1 + pow((e.y - (e.t % 3 - 1) + 8) % 8 - 3, 2) + pow((e.x - e.t % 2 + 8) % 8 - 4, 2)) AS v FROM emb e)"""


def drifting(spark: SparkSession, sf: str) -> DataFrame:
    """A bright spot that moves by up to a pixel, on the noise of the embeddings."""
    spot = F.expr("""transform(px, (v, p) -> v + 3D / (1D + pow((p div 8 - (t % 3 - 1) + 8) % 8 - 3, 2) + pow((p % 8 - t % 2 + 8) % 8 - 4, 2)))""")
    return fx.emb_wide(spark, sf).withColumn("px", spot)


def matched_sql(name: str, template: str) -> list[str]:
    """Offsets ``name(t, dy, dx)`` of the largest overlap with a template, and their rounded mean."""
    return [
        f"o{name} AS (SELECT i.t, (q.y - i.y + 8) % 8 AS oy, (q.x - i.x + 8) % 8 AS ox, sum(i.v * q.m) AS s FROM inv i, {template} q GROUP BY 1, 2, 3)",
        f"""{name} AS (SELECT t, CASE WHEN oy > 4 THEN oy - 8 ELSE oy END AS dy, CASE WHEN ox > 4 THEN ox - 8 ELSE ox END AS dx FROM o{name}
            QUALIFY row_number() OVER (PARTITION BY t ORDER BY s DESC) = 1)""",
        f"{name}_drift AS (SELECT round_even(avg(dy), 0) AS dy, round_even(avg(dx), 0) AS dx FROM {name})",
    ]


TWO_ROUNDS = [
    EMB, DRIFTING, "inv AS (SELECT t, y, x, 1 / (v - ((SELECT min(v) FROM src) - 1)) AS v FROM src)",
    "tm1 AS (SELECT y, x, avg(v) AS m FROM inv GROUP BY y, x)", *matched_sql("r1", "tm1"),
    """rolled AS (SELECT CAST((i.y + r.dy - d.dy + 16) % 8 AS INTEGER) AS y, CAST((i.x + r.dx - d.dx + 16) % 8 AS INTEGER) AS x, i.v
        FROM inv i JOIN r1 r USING (t) CROSS JOIN r1_drift d)""",
    "tm2 AS (SELECT y, x, 0.25 * any_value(tm1.m) + 0.75 * avg(rolled.v) AS m FROM rolled JOIN tm1 USING (y, x) GROUP BY y, x)", *matched_sql("r2", "tm2"),
    "moved AS (SELECT t, CAST(r.dy - d.dy AS INTEGER) AS dy, CAST(r.dx - d.dx AS INTEGER) AS dx FROM r2 r CROSS JOIN r2_drift d)",
]


@query("SELECT t, dy, dx FROM moved", *TWO_ROUNDS)
def register_two_rounds(spark: SparkSession, sf: str) -> DataFrame:
    frames = Scratch(spark, "register").write(drifting(spark, sf))
    return registration.estimate_shifts(frames, rounds=2).select("t", "dy", "dx")


@query("""SELECT t, y, x, round(v, 6) + 0.0 AS v FROM (SELECT t, CAST((y + dy - (SELECT max(dy) FROM moved) + 16) % 8 AS INTEGER) AS y,
    CAST((x + dx - (SELECT max(dx) FROM moved) + 16) % 8 AS INTEGER) AS x, v FROM src JOIN moved USING (t))
  WHERE y < 8 - (SELECT max(dy) - min(dy) FROM moved) AND x < 8 - (SELECT max(dx) - min(dx) FROM moved)""", *TWO_ROUNDS)
def register_images(spark: SparkSession, sf: str) -> DataFrame:
    frames = Scratch(spark, "register").write(drifting(spark, sf))
    return pixels(registration.register(frames, rounds=2)[0])


@query("SELECT t, dy, dx FROM moved", *TWO_ROUNDS)
def register_two_rounds_slabs(spark: SparkSession, sf: str) -> DataFrame:
    """The same rounds with frames in slabs of three rows, and spectra in runs of two columns."""
    scratch = Scratch(spark, "slabs")
    slabs = scratch.write(registration_slabs.cut_slabs(drifting(spark, sf), 3))
    found, _ = registration_slabs.estimate_shifts(slabs, scratch, rounds=2, columns=2)
    return found.select("t", F.col("shift")[0].alias("dy"), F.col("shift")[1].alias("dx"))


@query("SELECT t, y, x, round(v, 6) + 0.0 AS v FROM (SELECT t, CAST((y + dy + 16) % 8 AS INTEGER) AS y, CAST((x + dx + 16) % 8 AS INTEGER) AS x, v FROM emb JOIN shifts USING (t))", EMB, SHIFTS)
def roll_slabs(spark: SparkSession, sf: str) -> DataFrame:
    """Frames in slabs of three rows, rolled by a given table of shifts."""
    slabs = registration_slabs.cut_slabs(fx.emb_wide(spark, sf), 3)
    moved = registration_slabs.roll_slabs(slabs, fx.shifts(spark, sf).select("t", F.array("dy", "dx").alias("shift")), 3)
    return rounded(registration_slabs.slab_pixels(moved), "v")


SPOT = "3 / (1 + pow((z - (t % 3 - 1) + 4) % 4 - 1, 2) + pow((y - t % 2 + 4) % 4 - 2, 2) + pow((x + t % 2) % 4 - 1, 2))"


def matched_volumes_sql(name: str, template: str) -> list[str]:
    axes = "zyx"
    places = ", ".join(f"(q.{a} - i.{a} + 4) % 4 AS o{a}" for a in axes)
    turned = ", ".join(f"CASE WHEN o{a} > 2 THEN o{a} - 4 ELSE o{a} END AS d{a}" for a in axes)
    return [
        f"o{name} AS (SELECT i.t, {places}, sum(i.v * q.m) AS s FROM inv i, {template} q GROUP BY ALL)",
        f"{name} AS (SELECT t, {turned} FROM o{name} QUALIFY row_number() OVER (PARTITION BY t ORDER BY s DESC) = 1)",
        f"{name}_drift AS (SELECT {', '.join(f'round_even(avg(d{a}), 0) AS d{a}' for a in axes)} FROM {name})",
    ]


@query(f"SELECT t, {', '.join(f'CAST(r.d{a} - d.d{a} AS INTEGER) AS d{a}' for a in 'zyx')} FROM r2 r CROSS JOIN r2_drift d", EMB, VOL,
       f"src AS (SELECT t, z, y, x, v + {SPOT} AS v FROM vol)", "inv AS (SELECT t, z, y, x, 1 / (v - ((SELECT min(v) FROM src) - 1)) AS v FROM src)",
       "tm1 AS (SELECT z, y, x, avg(v) AS m FROM inv GROUP BY ALL)", *matched_volumes_sql("r1", "tm1"),
       f"rolled AS (SELECT {', '.join(f'CAST((i.{a} + r.d{a} - d.d{a} + 8) % 4 AS INTEGER) AS {a}' for a in 'zyx')}, i.v FROM inv i JOIN r1 r USING (t) CROSS JOIN r1_drift d)",
       "tm2 AS (SELECT z, y, x, 0.25 * any_value(tm1.m) + 0.75 * avg(rolled.v) AS m FROM rolled JOIN tm1 USING (z, y, x) GROUP BY ALL)", *matched_volumes_sql("r2", "tm2"))
def register_volumes(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds on volumes of three axes, in slabs of two planes."""
    scratch = Scratch(spark, "volumes")
    bright = volumes(spark, sf).withColumn("v", F.col("v") + F.expr(SPOT.replace("3 /", "3D /", 1)))
    slabs = scratch.write(registration_slabs.volume_slabs(bright, (4, 4, 4), 2))
    found, _ = registration_slabs.estimate_shifts(slabs, scratch, rounds=2, columns=5)
    return found.select("t", *[F.col("shift")[k].alias(f"d{a}") for k, a in enumerate("zyx")])


# -- stored stages of the workflow ---------------------------------------------------------

TRIMMED = EMB.replace("emb AS", "whole AS") + ", emb AS (SELECT t - 1 AS t, y, x, v FROM whole WHERE t >= 1 AND t < (SELECT max(t) FROM whole))"
STAGES = [TRIMMED, MEDIAN, "dn AS (SELECT t, y, x, v + ((SELECT min(v) FROM emb) - (SELECT min(v) FROM med)) AS v FROM med)", HMEAN.replace("emb", "dn"),
          "raised AS (SELECT t, y, x, v - value AS v FROM dn JOIN hm USING (y, x))", "sub AS (SELECT t, y, x, v - (SELECT min(v) FROM raised) AS v FROM raised)"]


@query("""SELECT t, y, x, round(CASE WHEN n <> 0 THEN v / nullif(sqrt(n), 0) ELSE v END, 6) + 0.0 AS v FROM
  (SELECT t, y, x, v, sum(v*v) OVER (PARTITION BY t) AS n FROM (SELECT t, y, x, v - min(v) OVER (PARTITION BY t) AS v FROM sub))""", *STAGES)
def workflow_norm(spark: SparkSession, sf: str) -> DataFrame:
    """The stage ``norm`` as the whole workflow stores it: trimmed, denoised, lowered by the background, normalised."""
    params = PipelineParams(register_rounds=0, n_atoms=2, fit_rounds=1, code_atoms=1, seed=SEED, extract=SMALL)
    return pixels(run_pipeline(store_at(spark, "workflow"), fx.emb_wide(spark, sf), params)["norm"])
