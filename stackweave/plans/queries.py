"""The registered queries, each with the SQL that checks it on the same tables.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole table. The SQL is
written against the raw tables and shares nothing with the operators but the definition.
Doubles are rounded to 6 places on both sides; ``+ 0.0`` turns a negative zero into zero.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.functions.kernels import gaussian_taps, spline_taps
from stackweave.model import densify, explode_frames, to_frames, to_pixels
from stackweave.operators import blocks, dictionary, elementwise, filters, normalize, projections, registration, roi, sampling, traces
from stackweave.plans import fixtures as fx
from stackweave.plans.pipeline import PipelineParams, run_pipeline
from stackweave.session import Scratch
from stackweave.sources import stacks
from stackweave.sources.store import DatasetStore
from stackweave.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEED = 7
ATOMS = 16


def query(sql: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its check if there is one."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = (f"WITH RECURSIVE {', '.join(ctes)} " if ctes else "") + " ".join(sql.split())
        return fn
    return add


def r6(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, r6(c))
    return df


def pixels(stack: DataFrame) -> DataFrame:
    return rounded(to_pixels(stack), "v")


def store_at(spark: SparkSession, label: str) -> DatasetStore:
    return DatasetStore(spark, Scratch(spark, label).root)


# -- SQL views -----------------------------------------------------------------------------

EMB = """emb AS (SELECT vec_id AS t, CAST((p - 1) // 8 AS INTEGER) AS y, CAST((p - 1) % 8 AS INTEGER) AS x,
  CAST(val AS DOUBLE) AS v FROM (SELECT vec_id, generate_subscripts(embedding, 1) AS p, unnest(embedding) AS val FROM embeddings))"""
WK = """wk AS (SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) // 7 AS BIGINT) AS t,
  CAST(l_partkey % 8 AS INTEGER) AS y, CAST((l_orderkey + l_linenumber) % 8 AS INTEGER) AS x, sum(l_quantity) AS v
  FROM lineitem GROUP BY 1, 2, 3)"""
TR = """tr AS (SELECT user_id AS roi_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS t,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS value FROM events GROUP BY 1, 2)"""
DENSE = """span AS (SELECT min(t) AS lo, max(t) AS hi FROM tr),
  dense AS (SELECT i.roi_id, g.t, coalesce(tr.value, 0) AS value FROM (SELECT DISTINCT roi_id FROM tr) i
  CROSS JOIN (SELECT unnest(generate_series(lo, hi)) AS t FROM span) g LEFT JOIN tr ON tr.roi_id = i.roi_id AND tr.t = g.t)"""
ROI4 = """roi4 AS (SELECT CAST(1 + (a.id // 4) * 2 + b.id // 4 AS INTEGER) AS roi_id, CAST(a.id AS INTEGER) AS y,
  CAST(b.id AS INTEGER) AS x, CAST(1 AS DOUBLE) AS w FROM range(8) a(id), range(8) b(id))"""
ROI_OV = """roi_ov AS (SELECT CAST(c.roi_id AS INTEGER) AS roi_id, CAST(a.id AS INTEGER) AS y, CAST(b.id AS INTEGER) AS x,
  CAST(1 AS DOUBLE) / (1 + (a.id-c.cy)*(a.id-c.cy) + (b.id-c.cx)*(b.id-c.cx)) AS w
  FROM range(8) a(id), range(8) b(id), (VALUES (1,2,2),(2,3,4),(3,5,5)) AS c(roi_id, cy, cx)
  WHERE (a.id-c.cy)*(a.id-c.cy) + (b.id-c.cx)*(b.id-c.cx) <= 4)"""
SHIFTS = """shifts AS (SELECT DISTINCT vec_id AS t, CAST(vec_id % 5 - 2 AS INTEGER) AS dy, CAST(vec_id % 3 - 1 AS INTEGER) AS dx FROM embeddings)"""
HMEAN = """low AS (SELECT min(v) - 1 AS s FROM emb),
  hm AS (SELECT y, x, 1 / avg(1 / (v - s)) + any_value(s) AS value FROM emb, low GROUP BY y, x)"""
MEDIAN = """nine AS (SELECT e.t, e.y, e.x,
    CASE WHEN e.y+a.d < 0 THEN -1-e.y-a.d WHEN e.y+a.d > 7 THEN 15-e.y-a.d ELSE e.y+a.d END AS sy,
    CASE WHEN e.x+b.d < 0 THEN -1-e.x-b.d WHEN e.x+b.d > 7 THEN 15-e.x-b.d ELSE e.x+b.d END AS sx
    FROM emb e, (VALUES (-1),(0),(1)) a(d), (VALUES (-1),(0),(1)) b(d)),
  med AS (SELECT n.t, n.y, n.x, list_sort(list(s.v))[5] AS v FROM nine n JOIN emb s ON s.t = n.t AND s.y = n.sy AND s.x = n.sx GROUP BY 1, 2, 3)"""
NOISE = """stat AS (SELECT t, avg(v) AS m, stddev_pop(v) AS s FROM emb GROUP BY t),
  noise AS (SELECT e.t, stddev_pop(v) AS noise FROM emb e JOIN stat USING (t) WHERE abs(v - m) <= 3 * s GROUP BY e.t)"""
SIGNIFICANT = NOISE + """, sig AS (SELECT e.t, e.y, e.x, e.v FROM emb e JOIN noise n USING (t) WHERE e.v > n.noise)"""
LABELS = SIGNIFICANT + """, cells AS (SELECT t, y, x, y * 8 + x + 1 AS p FROM sig),
  links AS (SELECT a.t, a.p AS p, b.p AS q FROM cells a JOIN cells b ON a.t = b.t AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
  reach(t, p, q) AS (SELECT t, p, p FROM cells UNION SELECT r.t, r.p, l.q FROM reach r JOIN links l ON l.t = r.t AND l.p = r.q),
  lab AS (SELECT c.t, c.y, c.x, s.v, min(r.q) AS region FROM cells c JOIN reach r ON r.t = c.t AND r.p = c.p
    JOIN sig s ON s.t = c.t AND s.y = c.y AND s.x = c.x GROUP BY 1, 2, 3, 4)"""
PROPS = """sums AS (SELECT t, region, count(*) AS area, CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(y*y) AS DOUBLE) AS syy,
    CAST(sum(x*x) AS DOUBLE) AS sxx, CAST(sum(x*y) AS DOUBLE) AS sxy, max(v) AS max_v FROM lab GROUP BY 1, 2),
  cov2 AS (SELECT *, sy/area AS cy, sx/area AS cx, syy/area - (sy/area)*(sy/area) AS vy, sxx/area - (sx/area)*(sx/area) AS vx,
    sxy/area - (sy/area)*(sx/area) AS vxy FROM sums),
  eig AS (SELECT *, greatest((vy+vx)/2 + sqrt((vy-vx)*(vy-vx)/4 + vxy*vxy), 0) AS l1,
    greatest((vy+vx)/2 - sqrt((vy-vx)*(vy-vx)/4 + vxy*vxy), 0) AS l2 FROM cov2),
  props AS (SELECT t, region, area, cy, cx, 4*sqrt(l1) AS major, 4*sqrt(l2) AS minor,
    CASE WHEN l1 > 1e-12 THEN sqrt(greatest(0, 1 - l2/l1)) ELSE 0 END AS eccentricity, max_v FROM eig)"""
PEAKS = """peaks AS (SELECT e.t, e.y, e.x, e.v FROM emb e JOIN emb n ON n.t = e.t AND abs(n.y-e.y) <= 1 AND abs(n.x-e.x) <= 1
  GROUP BY 1, 2, 3, 4 HAVING e.v >= max(n.v))"""
ATOM = f"""pick AS (SELECT vec_id AS t, row_number() OVER (ORDER BY md5(vec_id || ':{SEED}'), vec_id) - 1 AS atom FROM embeddings
    QUALIFY atom < {ATOMS}),
  atoms AS (SELECT p.atom, e.y, e.x, e.v FROM emb e JOIN pick p USING (t)),
  gram AS (SELECT a.atom AS i, b.atom AS j, sum(a.v * b.v) AS g FROM atoms a JOIN atoms b ON a.y = b.y AND a.x = b.x GROUP BY 1, 2),
  cov AS (SELECT a.atom, e.t, sum(a.v * e.v) AS c FROM atoms a JOIN emb e ON a.y = e.y AND a.x = e.x GROUP BY 1, 2)"""
IMAGES = """img AS (SELECT l_orderkey AS roi_id, CAST(l_partkey // 64 AS INTEGER) AS y, CAST(l_partkey % 64 AS INTEGER) AS x,
    sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2, 3),
  prints AS (SELECT roi_id, list((y, x, w) ORDER BY y, x) AS p FROM img GROUP BY 1),
  reps AS (SELECT roi_id, min(roi_id) OVER (PARTITION BY p) AS rep FROM prints),
  unit AS (SELECT roi_id, y, x, w / sqrt(sum(w*w) OVER (PARTITION BY roi_id)) AS u, count(*) OVER (PARTITION BY roi_id) AS n FROM img),
  lead AS (SELECT u.* FROM unit u JOIN reps USING (roi_id) WHERE roi_id = rep),
  pairs AS (SELECT a.roi_id AS a, b.roi_id AS b, sum(a.u * b.u) AS alignment, count(*) / CAST(least(max(a.n), max(b.n)) AS DOUBLE) AS overlap
    FROM lead a JOIN lead b ON a.y = b.y AND a.x = b.x AND a.roi_id < b.roi_id GROUP BY 1, 2
    HAVING sum(a.u * b.u) >= 0.6 - 1e-9 AND count(*) / CAST(least(max(a.n), max(b.n)) AS DOUBLE) >= 0.6 - 1e-9)"""


def taps_sql(name: str, taps: dict[int, float]) -> str:
    rows = ", ".join(f"({d}, CAST({w!r} AS DOUBLE))" for d, w in taps.items())
    return f"{name}(d, k) AS (VALUES {rows})"


def mirror(expr: str, size: str) -> str:
    return f"CASE WHEN {expr} < 0 THEN -1 - ({expr}) WHEN {expr} >= {size} THEN 2 * {size} - 1 - ({expr}) ELSE {expr} END"


def smooth_sql(name: str, source: str, axis: str, taps: str, size: str = "8") -> str:
    """A weighted neighbour sum along one axis, mirrored at the ends."""
    others = [c for c in ("t", "y", "x") if c != axis]
    on = " AND ".join([f"s.{c} = g.{c}" for c in others] + [f"s.{axis} = g.q"])
    return f"""{name} AS (SELECT g.t, g.y, g.x, sum(g.k * s.v) AS v FROM
      (SELECT b.t, b.y, b.x, k.k, {mirror(f'(b.{axis} + k.d)', size)} AS q FROM {source} b, {taps} k) g
      JOIN {source} s ON {on} GROUP BY 1, 2, 3)"""


PX = "SELECT t, y, x, round(v, 6) + 0.0 AS v FROM {}"
YX = "SELECT y, x, round({}, 6) + 0.0 AS value FROM {}"


# -- sources -------------------------------------------------------------------------------


@query("SELECT t, count(*) AS n, round(sum(v), 6) + 0.0 AS checksum FROM emb GROUP BY t", EMB)
def load_stack(spark, sf):
    stack = stacks.load_stack(spark, f"{sf}/embeddings.parquet", t="vec_id", px="embedding", shape=fx.SHAPE, chunk_frames=100)
    total = F.aggregate("px", F.lit(0.0), lambda a, v: a + v)
    return stack.select("t", F.size("px").cast("long").alias("n"), r6(total).alias("checksum"))


@query("""SELECT t - (SELECT min(t) FROM emb) AS t, y, x, round(v, 6) + 0.0 AS v FROM emb UNION ALL
  SELECT t - (SELECT min(t) FROM wk) + (SELECT max(t) - min(t) + 1 FROM emb), y, x, round(v, 6) + 0.0 FROM wk""", EMB, WK)
def concat_stacks(spark, sf):
    return rounded(stacks.concat_stacks([to_pixels(fx.emb(spark, sf)), fx.wk(spark, sf)]), "v")


@query(PX.format("emb"), EMB)
def assemble_blocks(spark, sf):
    block = (100, 3, 5)
    cut = blocks.cut_blocks(fx.emb_wide(spark, sf), block, (0, 0, 0))
    local = explode_frames(cut, F.col("tb").alias("bt"), F.col("yb").alias("by"), F.col("xb").alias("bx"))
    grid = local.withColumn("t", F.col("t") - F.col("bt") * block[0])
    return rounded(blocks.assemble_blocks(grid, block), "v")


@query(YX.format("avg(v)", "emb GROUP BY y, x"), EMB)
def store_roundtrip(spark, sf):
    store = store_at(spark, "store")
    store.put("proj/mean", projections.proj_max(fx.emb(spark, sf)))
    store["proj/mean"] = projections.proj_mean(fx.emb(spark, sf))
    return rounded(store.get("proj/mean"), "value")


@query("""SELECT 'proj/max' AS name, y, x, round(max(v), 6) + 0.0 AS value FROM emb GROUP BY y, x UNION ALL
  SELECT 'proj/mean', y, x, round(avg(v), 6) + 0.0 FROM emb GROUP BY y, x""", EMB)
def store_many(spark, sf):
    shared = projections.projections(fx.emb(spark, sf))
    store = store_at(spark, "many")
    parts = [shared.select("y", "x", F.col(c).alias("value")) for c in ("max", "mean")]
    kept = store.put_many(["proj/max", "proj/mean"], parts, share=[shared])
    named = [df.select(F.lit(n).alias("name"), "y", "x", r6("value").alias("value")) for n, df in kept.items()]
    return named[0].unionByName(named[1])


@query("""SELECT CAST(a.pos AS BIGINT) AS t, e.y, e.x, round(e.v, 6) + 0.0 AS v FROM emb e
  JOIN (VALUES (0, 7), (1, 3), (2, 7), (3, 499), (4, 0)) a(pos, t) ON a.t = e.t""", EMB)
def select_frames(spark, sf):
    return pixels(stacks.select_frames(fx.emb(spark, sf), [7, 3, 7, 499, 0]))


@query("""SELECT (t - 4) // 3 AS t, CAST(y - 2 AS INTEGER) AS y, x, CAST(v AS FLOAT) AS v FROM emb
  WHERE t >= 4 AND t < (SELECT max(t) + 1 - 5 FROM emb) AND (t - 4) % 3 = 0 AND y >= 2 AND y < 7 AND x < 4""", EMB)
def select_slices(spark, sf):
    return stacks.select_frames(to_pixels(fx.emb(spark, sf)), slice(4, -5, 3), slice(2, 7), slice(None, 4), dtype="float")


@query("""SELECT (t - 4) // 3 AS t, CAST(y - 2 AS INTEGER) AS y, CAST(x // 2 AS INTEGER) AS x, round(v, 6) + 0.0 AS v FROM emb
  WHERE t >= 4 AND t < (SELECT max(t) + 1 - 5 FROM emb) AND (t - 4) % 3 = 0 AND y >= 2 AND y < 7 AND x % 2 = 0""", EMB)
def select_window(spark, sf):
    return pixels(stacks.select_frames(fx.emb(spark, sf), slice(4, -5, 3), slice(2, 7), slice(None, None, 2)))


@query("SELECT p.t, CAST(g // 8 AS INTEGER) AS y, CAST(g % 8 AS INTEGER) AS x, coalesce(wk.v, 0) AS v FROM "
       "(SELECT unnest(generate_series((SELECT min(t) FROM wk), (SELECT max(t) FROM wk))) AS t) p CROSS JOIN range(64) r(g) "
       "LEFT JOIN wk ON wk.t = p.t AND wk.y = g // 8 AND wk.x = g % 8", WK)
def densify_stack(spark, sf):
    return densify(fx.wk(spark, sf), fx.SHAPE)


@query("SELECT t, CAST(y * 8 + x AS INTEGER) AS p, round(v, 6) + 0.0 AS v FROM emb", EMB)
def frame_vector_roundtrip(spark, sf):
    vectors = to_frames(to_pixels(fx.emb(spark, sf)), fx.SHAPE)
    return rounded(vectors.select("t", F.posexplode("px").alias("p", "v")), "v")


# -- elementwise ---------------------------------------------------------------------------


@query("SELECT t - 3 AS t, y, x, round(v, 6) + 0.0 AS v FROM emb WHERE t >= 3 AND t < (SELECT max(t) + 1 FROM emb) - 2", EMB)
def trim_frames(spark, sf):
    return pixels(elementwise.trim_frames(fx.emb(spark, sf), 3, 2))


@query("""SELECT t, y, x, round(v, 6) + 0.0 AS v FROM emb WHERE y < 8 - (SELECT max(abs(dy)) FROM shifts)
  AND x < 8 - (SELECT max(abs(dx)) FROM shifts)""", EMB, SHIFTS)
def crop_to_common(spark, sf):
    return rounded(elementwise.crop_to_common(to_pixels(fx.emb(spark, sf)), fx.shifts(spark, sf), fx.SHAPE), "v")


@query("SELECT t, y, x, round(1 / (v - ((SELECT min(v) FROM emb) - 1)), 6) + 0.0 AS v FROM emb", EMB)
def inverse_frames(spark, sf):
    return pixels(elementwise.inverse_frames(fx.emb(spark, sf)))


BOUNDS = "b AS (SELECT min(v) AS lo, max(v) AS hi FROM emb)"


@query("""SELECT t, y, x, CAST(trunc(least(greatest((v - lo) * (CAST(255 AS DOUBLE) / (hi - lo)), 0), 255)) AS BIGINT) AS v
  FROM emb, b""", EMB, BOUNDS)
def norm_layer_u8(spark, sf):
    return to_pixels(elementwise.norm_layer(fx.emb(spark, sf), "uint8"))


@query("SELECT t, y, x, round(least(greatest((v - lo) * (CAST(1 AS DOUBLE) / (hi - lo)), 0), 1), 6) + 0.0 AS v FROM emb, b", EMB, BOUNDS)
def norm_layer_float(spark, sf):
    return pixels(elementwise.norm_layer(fx.emb(spark, sf), "float64"))


# -- blocks and filters --------------------------------------------------------------------


def box_mean(stack: np.ndarray) -> np.ndarray:
    """Mean of the 3 x 3 neighbourhood inside the frame."""
    wide = np.pad(stack, ((0, 0), (1, 1), (1, 1)), constant_values=np.nan)
    views = np.lib.stride_tricks.sliding_window_view(wide, (3, 3), axis=(1, 2))
    return np.nanmean(views, axis=(3, 4))


@query("""SELECT e.t, e.y, e.x, round(avg(n.v), 6) + 0.0 AS v FROM emb e JOIN emb n
  ON n.t = e.t AND abs(n.y - e.y) <= 1 AND abs(n.x - e.x) <= 1 GROUP BY 1, 2, 3""", EMB)
def block_halo_mean(spark, sf):
    pieces = blocks.map_blocks(fx.emb_wide(spark, sf), box_mean, (128, 3, 5), (0, 1, 1))
    return rounded(blocks.pieces_to_pixels(pieces), "v")


@query(PX.format("med"), EMB, MEDIAN)
def median_filter_3x3(spark, sf):
    return pixels(filters.median_filter(fx.emb_wide(spark, sf), 3))


@query("""SELECT t, y, x, round(v + ((SELECT min(v) FROM emb) - (SELECT min(v) FROM med)), 6) + 0.0 AS v FROM med""", EMB, MEDIAN)
def denoise(spark, sf):
    return pixels(filters.denoise(fx.emb_wide(spark, sf), 3))


BASELINE = """base AS (SELECT roi_id, t, value, quantile_cont(value, 0.25) OVER (PARTITION BY roi_id ORDER BY t
  RANGE BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS f0 FROM {}),"""


@query("SELECT roi_id, t, value, round(f0, 6) + 0.0 AS f0 FROM base", TR, BASELINE.format("tr").rstrip(","))
def baseline_quantile(spark, sf):
    return rounded(traces.rolling_baseline(fx.tr(spark, sf), 7, 0.25, ["roi_id"], block=32), "f0")


@query("SELECT roi_id, t, round((value - f0) / nullif(f0, 0), 6) + 0.0 AS dff FROM base",
       TR, "lift AS (SELECT roi_id, t, value + (1 - (SELECT min(value) FROM tr)) AS value FROM tr)", BASELINE.format("lift").rstrip(","))
def dff(spark, sf):
    return rounded(traces.dff(fx.tr(spark, sf), 7, 0.25, ["roi_id"], block=32), "dff").select("roi_id", "t", "dff")


@query("SELECT l.t, l.y, l.x, round((l.v - f.v) / f.v, 6) + 0.0 AS v FROM lift l JOIN f ON f.t = l.t AND f.y = l.y AND f.x = l.x",
       EMB, taps_sql("tt", gaussian_taps(1.0, 2.0)), taps_sql("ts", gaussian_taps(0.8, 2.0)),
       "lift AS (SELECT t, y, x, v + (1 - (SELECT min(v) FROM emb)) AS v FROM emb)",
       smooth_sql("g", "lift", "t", "tt", "(SELECT max(t) + 1 FROM emb)"),
       """q AS (SELECT t, y, x, quantile_cont(v, 0.25) OVER (PARTITION BY y, x ORDER BY t
         RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS v FROM g)""",
       smooth_sql("fy", "q", "y", "ts"), smooth_sql("f", "fy", "x", "ts"))
def extract_f0(spark, sf):
    return pixels(filters.extract_f0(fx.emb_wide(spark, sf), 3, 0.25, 1.0, 2.0, 0.8, 2.0))


def _line(level: int) -> str:
    return f"""c{level} AS (SELECT b.roi_id, b.t, sum(b.k * s.value) AS value FROM (SELECT d.roi_id, d.t, k.k,
      least(greatest(d.t + k.d, lo), hi) AS q FROM c{level - 1} d, s{level} k, span) b
      JOIN c{level - 1} s ON s.roi_id = b.roi_id AND s.t = b.q GROUP BY 1, 2)"""


# In whole cents every tap is an exact multiple of 1/256, so the values compare unrounded.
@query("""SELECT a.roi_id, a.t, 1 AS level, a.value - b.value AS value FROM c0 a JOIN c1 b ON a.roi_id = b.roi_id AND a.t = b.t
  UNION ALL SELECT a.roi_id, a.t, 2, a.value - b.value FROM c1 a JOIN c2 b ON a.roi_id = b.roi_id AND a.t = b.t
  UNION ALL SELECT roi_id, t, 3, value FROM c2""",
       TR, DENSE, "c0 AS (SELECT roi_id, t, round(value * 100) AS value FROM dense)", taps_sql("s1", spline_taps(1)),
       taps_sql("s2", spline_taps(2)), _line(1), _line(2))
def wavelet_1d(spark, sf):
    cents = traces.dense_series(fx.tr(spark, sf)).withColumn("value", F.round(F.col("value") * 100))
    return traces.wavelet_1d(cents, 2, block=32)


@query("SELECT a.t, a.y, a.x, round(a.v - b.v, 6) + 0.0 AS v FROM c1 a JOIN c2 b ON a.t = b.t AND a.y = b.y AND a.x = b.x",
       EMB, taps_sql("s1", spline_taps(1)), taps_sql("s2", spline_taps(2)), smooth_sql("c1y", "emb", "y", "s1"),
       smooth_sql("c1", "c1y", "x", "s1"), smooth_sql("c2y", "c1", "y", "s2"), smooth_sql("c2", "c2y", "x", "s2"))
def wavelet_2d(spark, sf):
    return pixels(filters.wavelet_2d(fx.emb_wide(spark, sf), 2))


@query("SELECT a.t, a.y, a.x, round(a.v - b.v, 6) + 0.0 AS v FROM emb a JOIN c1 b ON a.t = b.t AND a.y = b.y AND a.x = b.x",
       EMB, taps_sql("s1", spline_taps(1)), smooth_sql("ct", "emb", "t", "s1", "(SELECT max(t) + 1 FROM emb)"),
       smooth_sql("cy", "ct", "y", "s1"), smooth_sql("c1", "cy", "x", "s1"))
def wavelet_3d(spark, sf):
    return pixels(filters.wavelet_transform(fx.emb_wide(spark, sf), 1, block=(100, 8, 8)))


# -- projections and normalisation ---------------------------------------------------------


@query("SELECT round(min(v), 6) + 0.0 AS v_min, round(max(v), 6) + 0.0 AS v_max FROM emb", EMB)
def stack_bounds(spark, sf):
    return rounded(projections.stack_bounds(fx.emb(spark, sf)), "v_min", "v_max")


@query(YX.format("min(v)", "emb GROUP BY y, x"), EMB)
def proj_min(spark, sf):
    return rounded(projections.proj_min(fx.emb(spark, sf)), "value")


@query(YX.format("max(v)", "emb GROUP BY y, x"), EMB)
def proj_max(spark, sf):
    return rounded(projections.proj_max(fx.emb(spark, sf)), "value")


@query(YX.format("avg(v)", "emb GROUP BY y, x"), EMB)
def proj_mean(spark, sf):
    return rounded(projections.proj_mean(fx.emb(spark, sf)), "value")


@query(YX.format("stddev_pop(v)", "emb GROUP BY y, x"), EMB)
def proj_std(spark, sf):
    return rounded(projections.proj_std(fx.emb(spark, sf)), "value")


@query("""SELECT CAST(k AS INTEGER) AS "order", y, x, round(avg(pow(v, k)), 6) + 0.0 AS value FROM emb, range(4) r(k) GROUP BY k, y, x""", EMB)
def proj_moments(spark, sf):
    return rounded(projections.proj_moments(fx.emb(spark, sf), 4), "value")


@query(YX.format("value", "hm"), EMB, HMEAN)
def proj_hmean(spark, sf):
    return rounded(projections.proj_hmean(fx.emb(spark, sf)), "value")


@query("""SELECT y, x, round(any_value(hm.value), 6) + 0.0 AS hmean, round(min(v), 6) + 0.0 AS min, round(max(v), 6) + 0.0 AS max, round(avg(v), 6) + 0.0 AS mean,
  round(stddev_pop(v), 6) + 0.0 AS std FROM emb JOIN hm USING (y, x) GROUP BY y, x""", EMB, HMEAN)
def projections_all(spark, sf):
    return rounded(projections.projections(fx.emb(spark, sf)), "hmean", "min", "max", "mean", "std")


@query("""SELECT y, x, round(max(v), 6) + 0.0 AS max, round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v), 6) + 0.0 AS std
  FROM wk GROUP BY y, x""", WK)
def projections_sparse(spark, sf):
    made = projections.project(fx.wk(spark, sf), max=F.max("v"), mean=F.avg("v"), std=F.stddev_pop("v"))
    return rounded(made, "max", "mean", "std")


def volumes(spark, sf):
    """Every vector as one 4 x 4 x 4 volume, in pixel form."""
    flat = to_pixels(fx.emb(spark, sf)).withColumn("p", F.col("y") * 8 + F.col("x"))
    return flat.selectExpr("t", "cast(p div 16 as int) AS z", "cast(p div 4 % 4 as int) AS y", "cast(p % 4 as int) AS x", "v")


VOL = """vol AS (SELECT t, CAST((y*8+x) // 16 AS INTEGER) AS z, CAST((y*8+x) // 4 % 4 AS INTEGER) AS y, CAST((y*8+x) % 4 AS INTEGER) AS x, v FROM emb)"""


@query("""SELECT z, y, x, round(1 / avg(1 / (v - s)) + any_value(s), 6) + 0.0 AS hmean, round(min(v), 6) + 0.0 AS min, round(max(v), 6) + 0.0 AS max,
  round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v), 6) + 0.0 AS std FROM vol, (SELECT min(v) - 1 AS s FROM emb) GROUP BY z, y, x""", EMB, VOL)
def projections_volume(spark, sf):
    return rounded(projections.projections(volumes(spark, sf), ("z", "y", "x")), "hmean", "min", "max", "mean", "std")


@query("""SELECT CAST(1 + z AS INTEGER) AS roi_id, t, round(avg(v), 6) + 0.0 AS value FROM vol GROUP BY 1, 2""", EMB, VOL)
def roi_traces_volume(spark, sf):
    stack = volumes(spark, sf)
    slabs = stack.select("z", "y", "x").distinct().select((F.col("z") + 1).cast("int").alias("roi_id"), "z", "y", "x", F.lit(1.0).alias("w"))
    return rounded(traces.roi_traces(stack, slabs, space=("z", "y", "x")), "value")


@query("SELECT t, y, x, round(v - (SELECT min(v) FROM sub), 6) + 0.0 AS v FROM sub", EMB, HMEAN,
       "sub AS (SELECT t, y, x, v - value AS v FROM emb JOIN hm USING (y, x))")
def background_subtract(spark, sf):
    return pixels(projections.background_subtract(fx.emb(spark, sf)))


@query("SELECT t, y, x, round(v - avg(v) OVER (PARTITION BY t), 6) + 0.0 AS v FROM emb", EMB)
def zeroed_mean(spark, sf):
    return pixels(normalize.zeroed_mean(fx.emb(spark, sf)))


def _renorm_sql(norm: str, source: str = "raised") -> str:
    return f"""SELECT t, y, x, round(CASE WHEN n <> 0 THEN v / nullif(n, 0) ELSE v END, 6) + 0.0 AS v
      FROM (SELECT t, y, x, v, {norm} OVER (PARTITION BY t) AS n FROM {source})"""


# The vectors have unit length already, so norms are taken of raised frames.
RAISED = "raised AS (SELECT t, y, x, v + 0.5 AS v FROM emb)"


def raised(spark, sf):
    return elementwise.map_values(fx.emb(spark, sf), lambda v: v + 0.5)


@query(_renorm_sql("sum(abs(v))"), EMB, RAISED)
def renorm_l1(spark, sf):
    return pixels(normalize.renormalize(raised(spark, sf), 1))


@query("SELECT t, y, x, round(CASE WHEN n <> 0 THEN v / nullif(sqrt(n), 0) ELSE v END, 6) + 0.0 AS v "
       "FROM (SELECT t, y, x, v, sum(v*v) OVER (PARTITION BY t) AS n FROM raised)", EMB, RAISED)
def renorm_l2(spark, sf):
    return pixels(normalize.renormalize(raised(spark, sf), 2))


@query(_renorm_sql("max(abs(v))"), EMB, RAISED)
def renorm_linf(spark, sf):
    return pixels(normalize.renormalize(raised(spark, sf), "inf"))


@query(_renorm_sql("min(abs(v))"), EMB, RAISED)
def renorm_neg_inf(spark, sf):
    return pixels(normalize.renormalize(raised(spark, sf), "-inf"))


@query(_renorm_sql("sum(CASE WHEN v <> 0 THEN 1.0 ELSE 0.0 END)"), EMB, RAISED)
def renorm_l0(spark, sf):
    return pixels(normalize.renormalize(raised(spark, sf), 0))


@query("SELECT t, y, x, round(v / pow(n, CAST(1 AS DOUBLE) / 3), 6) + 0.0 AS v "
       "FROM (SELECT t, y, x, v, sum(pow(abs(v), 3)) OVER (PARTITION BY t) AS n FROM raised)", EMB, RAISED)
def renorm_l3(spark, sf):
    return pixels(normalize.renormalize(raised(spark, sf), 3))


@query("""SELECT t, y, x, round(CASE WHEN n <> 0 THEN v / nullif(sqrt(n), 0) ELSE v END, 6) + 0.0 AS v FROM
  (SELECT t, y, x, v, sum(v*v) OVER (PARTITION BY t) AS n FROM (SELECT t, y, x, v - avg(v) OVER (PARTITION BY t) AS v FROM emb))""", EMB)
def normalize_data(spark, sf):
    return pixels(normalize.normalize_data(fx.emb(spark, sf)))


@query("""SELECT t, y, x, round(CASE WHEN n <> 0 THEN v / nullif(sqrt(n), 0) ELSE v END, 6) + 0.0 AS v FROM
  (SELECT t, y, x, v, sum(v*v) OVER (PARTITION BY t) AS n FROM (SELECT t, y, x, v - min(v) OVER (PARTITION BY t) AS v FROM emb))""", EMB)
def normalize_min_l2(spark, sf):
    return pixels(normalize.normalize_min(fx.emb(spark, sf)))


# -- traces --------------------------------------------------------------------------------


TRACE = "SELECT roi_id, t, round(sum(w*v) / (SELECT sum(w) FROM {0} r WHERE r.roi_id = m.roi_id), 6) + 0.0 AS value FROM emb JOIN {0} m USING (y, x) GROUP BY roi_id, t"


@query(TRACE.format("roi4"), EMB, ROI4)
def roi_traces(spark, sf):
    return rounded(traces.roi_traces(fx.emb(spark, sf), fx.roi4(spark)), "value")


@query(TRACE.format("roi_ov"), EMB, ROI_OV)
def roi_traces_weighted(spark, sf):
    return rounded(traces.roi_traces(fx.emb(spark, sf), fx.roi_ov(spark)), "value")


@query(TRACE.format("roi4").replace("FROM emb", "FROM wk"), WK, ROI4)
def roi_traces_sparse(spark, sf):
    return rounded(traces.roi_traces(fx.wk(spark, sf), fx.roi4(spark)), "value")


@query(TRACE.format("roi_ov"), EMB, ROI_OV)
def stream_traces(spark, sf):
    root = Scratch(spark, "stream").root
    jobs.stream_traces(fx.emb_arriving(spark, sf), fx.roi_ov(spark), f"{root}/traces", f"{root}/checkpoint").awaitTermination()
    return rounded(jobs.read_traces(spark, f"{root}/traces"), "value")


# -- sampling ------------------------------------------------------------------------------


@query(f"SELECT row_number() OVER (ORDER BY md5(vec_id || ':{SEED}'), vec_id) - 1 AS t, vec_id AS t_from FROM embeddings")
def shuffle_frames(spark, sf):
    return sampling.shuffle_frames(fx.emb(spark, sf), SEED).select("t", "t_from")


@query("SELECT CAST(p.atom AS INTEGER) AS pos, e.t, e.y, e.x, round(e.v, 6) + 0.0 AS v FROM emb e JOIN pick p USING (t)", EMB, ATOM)
def sample_frames(spark, sf):
    return rounded(explode_frames(sampling.sample_frames(fx.emb(spark, sf), ATOMS, SEED), "pos"), "v")


@query(f"""SELECT vec_id // 100 AS tb, CAST(row_number() OVER (PARTITION BY vec_id // 100 ORDER BY md5(vec_id || ':{SEED}'), vec_id) - 1 AS INTEGER) AS pos,
  vec_id AS t FROM embeddings QUALIFY pos < 5""")
def sample_per_block(spark, sf):
    return sampling.sample_per_block(fx.emb(spark, sf), 100, 5, SEED)


# -- registration --------------------------------------------------------------------------


@query("""SELECT t, CAST((y + dy + 8) % 8 AS INTEGER) AS y, CAST((x + dx + 8) % 8 AS INTEGER) AS x, round(v, 6) + 0.0 AS v
  FROM emb JOIN shifts USING (t)""", EMB, SHIFTS)
def roll_frames(spark, sf):
    return pixels(registration.roll_frames(fx.with_shifts(fx.emb(spark, sf))))


@query("""SELECT t, CAST((y + dy + 8) % 8 AS INTEGER) AS y, CAST((x + dx + 8) % 8 AS INTEGER) AS x, round(v, 6) + 0.0 AS v
  FROM emb JOIN shifts USING (t)""", EMB, SHIFTS)
def roll_by_table(spark, sf):
    stack = to_pixels(fx.emb(spark, sf)).withColumn("h", F.lit(8)).withColumn("w", F.lit(8))
    return rounded(registration.roll_frames(registration.join_shifts(stack, fx.shifts(spark, sf))).select("t", "y", "x", "v"), "v")


ALIGN = """SELECT t, y, x, round(v, 6) + 0.0 AS v FROM (SELECT t, CAST((y + {0} + 16) % 8 AS INTEGER) AS y,
  CAST((x + {1} + 16) % 8 AS INTEGER) AS x, v FROM emb JOIN shifts USING (t))
  WHERE y < 8 - (SELECT {2} FROM shifts) AND x < 8 - (SELECT {3} FROM shifts)"""


@query(ALIGN.format("dy - (SELECT max(dy) FROM shifts)", "dx - (SELECT max(dx) FROM shifts)", "max(dy) - min(dy)", "max(dx) - min(dx)"), EMB, SHIFTS)
def align_frames(spark, sf):
    return pixels(registration.align(fx.with_shifts(fx.emb(spark, sf))))


@query(ALIGN.format("least(dy, 0)", "least(dx, 0)", "max(abs(dy))", "max(abs(dx))"), EMB, SHIFTS)
def align_as_written(spark, sf):
    return pixels(registration.align(fx.with_shifts(fx.emb(spark, sf)), as_written=True))


@query("""SELECT t, CAST(dy - (SELECT round_even(avg(dy), 0) FROM s) AS INTEGER) AS dy, CAST(dx - (SELECT round_even(avg(dx), 0) FROM s) AS INTEGER) AS dx FROM s""",
       SHIFTS, "s AS (SELECT t, dy * 3 + 1 AS dy, dx - 2 AS dx FROM shifts)")
def drift_removal(spark, sf):
    moved = fx.shifts(spark, sf).selectExpr("t", "dy * 3 + 1 AS dy", "dx - 2 AS dx")
    return registration.remove_drift(moved)


@query("""SELECT round(avg(sqrt(pow((b.dy - a.dy) / 8.0 / sqrt(2), 2) + pow((b.dx - a.dx) / 8.0 / sqrt(2), 2))), 6) + 0.0 AS distance
  FROM shifts a JOIN (SELECT t, dx AS dy, dy AS dx FROM shifts) b USING (t)""", SHIFTS)
def shift_distance(spark, sf):
    old = fx.shifts(spark, sf)
    new = old.select("t", F.col("dx").alias("dy"), F.col("dy").alias("dx"))
    return rounded(registration.shift_distance(old, new, fx.SHAPE), "distance")


@query("""SELECT t, CAST(dy AS INTEGER) AS dy, CAST(dx AS INTEGER) AS dx FROM (SELECT t, CASE WHEN y > 4 THEN y - 8 ELSE y END AS dy,
  CASE WHEN x > 4 THEN x - 8 ELSE x END AS dx, y, x FROM emb WHERE v > 0.2)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY dy * dy + dx * dx, y, x) = 1""", EMB)
def best_match(spark, sf):
    return registration.best_match(to_pixels(fx.emb(spark, sf)).where("v > 0.2"), fx.SHAPE)


OFFSETS = """inv AS (SELECT t, y, x, 1 / (v - ((SELECT min(v) FROM emb) - 1)) AS v FROM emb),
  tmpl AS (SELECT y, x, avg(v) AS m FROM inv GROUP BY y, x),
  ov AS (SELECT i.t, (q.y - i.y + 8) % 8 AS oy, (q.x - i.x + 8) % 8 AS ox, sum(i.v * q.m) AS s FROM inv i, tmpl q GROUP BY 1, 2, 3),
  raw AS (SELECT t, CASE WHEN oy > 4 THEN oy - 8 ELSE oy END AS dy, CASE WHEN ox > 4 THEN ox - 8 ELSE ox END AS dx FROM ov
    QUALIFY row_number() OVER (PARTITION BY t ORDER BY s DESC) = 1)"""


@query("""SELECT t, CAST(dy - (SELECT round_even(avg(dy), 0) FROM raw) AS INTEGER) AS dy,
  CAST(dx - (SELECT round_even(avg(dx), 0) FROM raw) AS INTEGER) AS dx FROM raw""", EMB, OFFSETS)
def register_round(spark, sf):
    return registration.estimate_shifts(fx.emb_wide(spark, sf), rounds=1).select("t", "dy", "dx")


@query()
def register(spark, sf):
    images, _ = registration.register(Scratch(spark, "register").write(fx.sales(spark, sf)))
    return pixels(images)


# -- dictionary ----------------------------------------------------------------------------


def first_atoms(spark, sf):
    return dictionary.initial_atoms(fx.emb(spark, sf), ATOMS, SEED)


@query("SELECT i, j, round(g, 6) + 0.0 AS value FROM gram", EMB, ATOM)
def dict_gram(spark, sf):
    return rounded(dictionary.gram(first_atoms(spark, sf)), "value")


@query("SELECT atom, t, round(c, 6) + 0.0 AS value FROM cov", EMB, ATOM)
def dict_cov(spark, sf):
    return rounded(dictionary.correlate(fx.emb_wide(spark, sf), first_atoms(spark, sf)), "value")


BEST = """best AS (SELECT c.t, c.atom, c.c, g.g FROM cov c JOIN gram g ON g.i = c.atom AND g.j = c.atom
  QUALIFY row_number() OVER (PARTITION BY c.t ORDER BY abs(c.c) DESC) = 1)"""


@query("SELECT atom, t, round(c / g, 6) + 0.0 AS coef FROM best", EMB, ATOM, BEST)
def sparse_encode_k1(spark, sf):
    return rounded(dictionary.sparse_encode(fx.emb_wide(spark, sf), first_atoms(spark, sf), k=1), "coef")


@query("""SELECT atom, t, round(coef, 6) + 0.0 AS coef FROM (
    SELECT t, a1 AS atom, CASE WHEN a2 IS NULL THEN c1 / g11 ELSE (c1 * g22 - c2 * g12) / (g11 * g22 - g12 * g12) END AS coef FROM two
    UNION ALL SELECT t, a2, (c2 * g11 - c1 * g12) / (g11 * g22 - g12 * g12) FROM two WHERE a2 IS NOT NULL)""",
       EMB, ATOM, BEST, """nxt AS (SELECT b.t, c.atom AS a2, c.c AS c2, x.g AS g12, d.g AS g22, c.c - b.c / b.g * x.g AS r
         FROM best b JOIN cov c ON c.t = b.t AND c.atom <> b.atom JOIN gram x ON x.i = b.atom AND x.j = c.atom
         JOIN gram d ON d.i = c.atom AND d.j = c.atom QUALIFY row_number() OVER (PARTITION BY b.t ORDER BY abs(r) DESC) = 1),
       two AS (SELECT b.t, b.atom AS a1, b.c AS c1, b.g AS g11, n.a2, n.c2, n.g12, n.g22
         FROM best b LEFT JOIN (SELECT * FROM nxt WHERE abs(r) > 1e-12) n USING (t))""")
def sparse_encode(spark, sf):
    return rounded(dictionary.sparse_encode(fx.emb_wide(spark, sf), first_atoms(spark, sf), k=2), "coef")


@query("""SELECT e.t, e.y, e.x, round(sum(b.c / b.g * a.v), 6) + 0.0 AS v FROM best b JOIN atoms a USING (atom)
  JOIN emb e ON e.t = b.t AND e.y = a.y AND e.x = a.x GROUP BY 1, 2, 3""", EMB, ATOM, BEST)
def reconstruct(spark, sf):
    atoms = first_atoms(spark, sf)
    return rounded(dictionary.reconstruct(dictionary.sparse_encode(fx.emb_wide(spark, sf), atoms, k=1), atoms), "v")


@query()
def dict_fit(spark, sf):
    learned = dictionary.fit(fx.emb_wide(spark, sf), ATOMS, alpha=0.2, rounds=5, seed=SEED)
    return rounded(explode_frames(dictionary.atoms_frame(spark, learned).withColumnRenamed("atom", "t")), "v").withColumnRenamed("t", "atom")


@query()
def dict_fit_resume(spark, sf):
    frames = fx.emb_wide(spark, sf)
    half = dictionary.fit(frames, ATOMS, alpha=0.2, rounds=2, seed=SEED)
    again = dictionary.state_from_tables(dictionary.state_tables(spark, half))
    learned = dictionary.fit(frames, alpha=0.2, rounds=2, state=again)
    return dictionary.state_tables(spark, learned)["dict_A"]


@query()
def dict_fit_blocks(spark, sf):
    made = dictionary.fit_blocks(fx.emb_wide(spark, sf), ATOMS, (128, 4, 4), alpha=0.2, rounds=3, seed=SEED)
    return rounded(explode_frames(made.withColumnRenamed("atom", "t")), "v").withColumnRenamed("t", "atom")


@query()
def stream_dict_fit(spark, sf):
    root = Scratch(spark, "learn").root
    store = DatasetStore(spark, f"{root}/store")
    jobs.stream_fit(fx.emb_arriving(spark, sf), store, f"{root}/checkpoint", ATOMS, 0.2, 2, SEED).awaitTermination()
    learned, _ = jobs.load_state(store)
    return dictionary.state_tables(spark, learned)["dict_A"]


@query("""SELECT tb, frames, k, CAST(sum(k) OVER (ORDER BY tb) - k AS BIGINT) AS k_offset FROM (
    SELECT tb, frames, 50 * frames // n + CASE WHEN row_number() OVER (ORDER BY 50 * frames % n DESC, tb) <= 50 - sum(50 * frames // n) OVER ()
      THEN 1 ELSE 0 END AS k
    FROM (SELECT vec_id // 96 AS tb, count(*) AS frames, (SELECT count(*) FROM embeddings) AS n FROM embeddings GROUP BY 1))""")
def block_atom_allocation(spark, sf):
    return dictionary.allocate_atoms(fx.emb(spark, sf), 96, 50)


# -- regions of interest -------------------------------------------------------------------


def significant(spark, sf):
    return roi.significant_mask(fx.emb_wide(spark, sf), noise=1.0)


def region_pixels(spark, sf):
    """Pixels ``(t, region, y, x, w)`` of the regions in every frame."""
    labelled = roi.label_regions(significant(spark, sf)).withColumn("c", F.arrays_zip("px", "region"))
    rows = explode_frames(labelled, px="c", value="c").where("c.region > 0")
    return rows.select("t", F.col("c.region").cast("int").alias("region"), "y", "x", F.col("c.px").alias("w"))


def frame_rois(spark, sf):
    """One region per frame: its significant pixels, numbered from 1."""
    rows = explode_frames(significant(spark, sf).withColumn("c", F.arrays_zip("px", "mask")), px="c", value="c").where("c.mask > 0")
    return rows.select((F.col("t") + 1).cast("int").alias("roi_id"), "y", "x", F.col("c.px").alias("w"))


@query("SELECT t, round(noise, 6) + 0.0 AS noise FROM noise", EMB, NOISE)
def roi_noise(spark, sf):
    return fx.emb(spark, sf).select("t", r6(roi.noise_level(F.col("px"))).alias("noise"))


@query(PX.format("sig"), EMB, SIGNIFICANT)
def roi_significant(spark, sf):
    return rounded(frame_rois(spark, sf).select((F.col("roi_id") - 1).cast("long").alias("t"), "y", "x", F.col("w").alias("v")), "v")


@query("SELECT t, y, x, CAST(region AS INTEGER) AS region FROM lab", EMB, LABELS)
def label_regions(spark, sf):
    return region_pixels(spark, sf).drop("w")


PROPS_OUT = """SELECT t, CAST(region AS INTEGER) AS region, area, round(cy, 6) + 0.0 AS cy, round(cx, 6) + 0.0 AS cx, round(major, 6) + 0.0 AS major,
  round(minor, 6) + 0.0 AS minor, round(eccentricity, 6) + 0.0 AS eccentricity, round(max_v, 6) + 0.0 AS max_v FROM props"""
SHAPE_COLS = ("cy", "cx", "major", "minor", "eccentricity", "max_v")


@query(PROPS_OUT, EMB, LABELS, PROPS)
def region_props(spark, sf):
    return rounded(roi.region_props(region_pixels(spark, sf), "t", "region"), *SHAPE_COLS)


@query(PROPS_OUT + " WHERE area BETWEEN 3 AND 12 AND eccentricity BETWEEN 0 AND 0.9", EMB, LABELS, PROPS)
def roi_shape_filter(spark, sf):
    props = roi.region_props(region_pixels(spark, sf), "t", "region")
    return rounded(roi.within(props, area=(3, 12), eccentricity=(0.0, 0.9)), *SHAPE_COLS)


def peak_rows(spark, sf):
    marked = roi.mark_peaks(fx.emb_wide(spark, sf)).withColumn("c", F.arrays_zip("px", "peak"))
    return explode_frames(marked, px="c", value="c").where("c.peak > 0").select("t", "y", "x", F.col("c.px").alias("v"))


@query("""SELECT p.t, p.y, p.x, round(p.v, 6) + 0.0 AS v FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM peaks q WHERE q.t = p.t
  AND (q.v > p.v OR (q.v = p.v AND (q.y < p.y OR (q.y = p.y AND q.x < p.x))))
  AND (q.y-p.y)*(q.y-p.y) + (q.x-p.x)*(q.x-p.x) < 9)""", EMB, PEAKS)
def local_maxima(spark, sf):
    return rounded(roi.keep_distant_peaks(peak_rows(spark, sf), 3.0, value="v"), "v")


@query("""SELECT l.t, CAST(l.region AS INTEGER) AS region, l.y, l.x, round(l.v, 6) + 0.0 AS v FROM lab l JOIN peaks p ON p.t = l.t AND p.y = l.y AND p.x = l.x
  WHERE (SELECT count(*) FROM lab b WHERE b.t = l.t AND b.region = l.region AND b.v < l.v)
    >= 0.8 * (SELECT count(*) FROM lab b WHERE b.t = l.t AND b.region = l.region)""", EMB, LABELS, PEAKS)
def high_peaks(spark, sf):
    rows = region_pixels(spark, sf).withColumnRenamed("w", "v")
    peaks = peak_rows(spark, sf).join(rows.select("t", "region", "y", "x"), ["t", "y", "x"])
    return rounded(roi.keep_high_peaks(rows, peaks, 0.8, "t", "region", value="v").select("t", "region", "y", "x", "v"), "v")


@query("SELECT a, b, round(alignment, 6) + 0.0 AS alignment, round(overlap, 6) + 0.0 AS overlap FROM pairs", IMAGES)
def roi_pair_similarity(spark, sf):
    return rounded(roi.similar_pairs(fx.order_images(spark, sf), Scratch(spark, "pairs")), "alignment", "overlap")


@query("""SELECT roi_id, y, x, round(w, 6) + 0.0 AS w FROM (SELECT *, max(w) OVER (PARTITION BY roi_id) AS top FROM fused) WHERE w >= top * 0.01""",
       IMAGES, """edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs UNION ALL
         SELECT rep, roi_id FROM reps WHERE rep <> roi_id UNION ALL SELECT roi_id, rep FROM reps WHERE rep <> roi_id),
       walk(v, r) AS (SELECT DISTINCT a, a FROM edges UNION SELECT e.b, w.r FROM walk w JOIN edges e ON e.a = w.v WHERE w.r < e.b),
       grps AS (SELECT v, min(r) AS grp FROM walk GROUP BY v),
       tagged AS (SELECT coalesce(g.grp, i.roi_id) AS grp, i.* FROM img i LEFT JOIN grps g ON g.v = i.roi_id),
       counts AS (SELECT grp, count(DISTINCT roi_id) AS n FROM tagged GROUP BY grp),
       fused AS (SELECT t.grp AS roi_id, y, x, sum(w) / any_value(n) AS w FROM tagged t JOIN counts c ON c.grp = t.grp GROUP BY 1, 2, 3)""")
def roi_merge(spark, sf):
    scratch = Scratch(spark, "merge")
    images = scratch.write(fx.order_images(spark, sf))
    return rounded(roi.merge_rois(images, scratch), "w")


@query("""SELECT CAST(g.i // 8 AS INTEGER) AS y, CAST(g.i % 8 AS INTEGER) AS x, coalesce(max(s.t + 1), 0) AS label,
  CAST(coalesce(max(s.t + 1), 0) & 255 AS INTEGER) AS label8 FROM range(64) g(i) LEFT JOIN sig s ON s.y = g.i // 8 AND s.x = g.i % 8 GROUP BY g.i""",
       EMB, SIGNIFICANT)
def label_image(spark, sf):
    return roi.label_image(frame_rois(spark, sf), fx.SHAPE)


@query("""SELECT CAST(roi_id AS INTEGER) AS roi_id, string_agg(y, ',' ORDER BY a, y, x) AS ys, string_agg(x, ',' ORDER BY a, y, x) AS xs FROM (
    SELECT roi_id, y, x, round(atan2(x - avg(x) OVER (PARTITION BY roi_id), y - avg(y) OVER (PARTITION BY roi_id)), 9) AS a FROM line) GROUP BY roi_id""",
       EMB, SIGNIFICANT, """grown AS (SELECT DISTINCT t + 1 AS roi_id, y + a.d AS y, x + b.d AS x FROM sig, (VALUES (0), (1)) a(d), (VALUES (0), (1)) b(d)),
       line AS (SELECT g.* FROM grown g WHERE (SELECT count(*) FROM grown n WHERE n.roi_id = g.roi_id AND abs(n.y - g.y) + abs(n.x - g.x) = 1) < 4)""")
def roi_contours(spark, sf):
    lines = roi.roi_contours(frame_rois(spark, sf))
    return lines.select("roi_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("ys", "xs")])


SMALL = roi.ExtractParams(significance=3.0, wavelet_scale=2, noise=1.0, major_axis=(0.0, 10.0), below_peak=0.5, peak_distance=3.0,
                          area=(2, 40), eccentricity=(0.0, 0.99))


@query()
def roi_extract(spark, sf):
    table, _ = roi.extract_rois(fx.emb_wide(spark, sf).withColumnRenamed("t", "atom"), Scratch(spark, "extract"), SMALL)
    return rounded(table, *SHAPE_COLS)


@query()
def workflow(spark, sf):
    """All stages from raw frames to traces."""
    params = PipelineParams(register_rounds=2, n_atoms=8, fit_rounds=3, code_atoms=2, seed=SEED, extract=SMALL)
    store = run_pipeline(store_at(spark, "workflow"), fx.sales(spark, sf), params)
    return rounded(store["traces"], "value")
