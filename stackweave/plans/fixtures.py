"""Stacks, series and regions derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.model import frames_from, to_frames
from stackweave.session import hadoop_path

SHAPE = (8, 8)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arriving(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a stream of files, whether it is one file or a folder of them.

    A stream reads folders only: a table of one file is picked out of the folder around it by name.
    """
    path = f"{sf_dir}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    fs, handle = hadoop_path(spark, path)
    if fs.getFileStatus(handle).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def emb_arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames of ``emb`` as a stream."""
    return frames_from(arriving(spark, sf_dir, "embeddings"), "vec_id", "embedding", SHAPE)


def spread_rows(df: DataFrame) -> DataFrame:
    """Give every core work when the input has fewer files than the session has cores.

    A large input already has more splits than cores and is left where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 64-value vector as one 8 x 8 frame."""
    return frames_from(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", SHAPE)


def emb_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames, spread over all cores for numpy work."""
    return spread_rows(emb(spark, sf_dir))


def wk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse stack: quantity by week of shipping, part and line, in pixel form."""
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(
            F.expr("cast(datediff(l_shipdate, DATE'1995-01-01') div 7 as bigint)").alias("t"),
            F.expr("cast(l_partkey % 8 as int)").alias("y"),
            F.expr("cast((l_orderkey + l_linenumber) % 8 as int)").alias("x"),
        )
        .agg(F.sum("l_quantity").alias("v"))
    )


SALES_SHAPE = (17, 7)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly turnover by quantity and line as 17 x 7 frames, falling along both: a steady picture."""
    price = (
        read(spark, sf_dir, "lineitem")
        .groupBy(
            F.expr("cast((year(l_shipdate) - 1992) * 4 + quarter(l_shipdate) - 1 as bigint)").alias("t"),
            F.expr("cast(floor((l_quantity - 1) / 3) as int)").alias("y"),
            F.expr("cast(l_linenumber - 1 as int)").alias("x"),
        )
        .agg((F.sum(F.col("l_extendedprice") / F.col("l_linenumber")) / F.lit(10000.0)).alias("v"))
    )
    first = price.agg(F.min("t")).scalar()
    return to_frames(price.withColumn("t", F.col("t") - first), SALES_SHAPE)


def tr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value of each user as a time series; cents are summed as integers."""
    return (
        read(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").alias("roi_id"),
            F.expr("cast(datediff(ts, DATE'2024-01-01') as bigint)").alias("t"),
        )
        .agg((F.sum(F.round(F.col("value") * 100).cast("long")).cast("double") / F.lit(100.0)).alias("value"))
    )


def roi4(spark: SparkSession) -> DataFrame:
    """Four quadrant masks of weight 1."""
    return spark.sql(
        """SELECT cast(1 + (p div 32) * 2 + (p % 8) div 4 as int) AS roi_id, cast(p div 8 as int) AS y,
                  cast(p % 8 as int) AS x, 1D AS w
           FROM (SELECT explode(sequence(0, 63)) AS p)"""
    )


def roi_ov(spark: SparkSession) -> DataFrame:
    """Three overlapping discs, weights falling with the distance from the centre."""
    return spark.sql(
        """SELECT roi_id, y, x, 1D / (1 + (y-cy)*(y-cy) + (x-cx)*(x-cx)) AS w
           FROM (SELECT roi_id, cy, cx, cast(p div 8 as int) AS y, cast(p % 8 as int) AS x
                 FROM (SELECT roi_id, cy, cx, explode(sequence(0, 63)) AS p
                       FROM VALUES (1,2,2),(2,3,4),(3,5,5) AS c(roi_id, cy, cx)))
           WHERE (y-cy)*(y-cy) + (x-cx)*(x-cx) <= 4"""
    )


def with_shifts(frames: DataFrame) -> DataFrame:
    """Frames with a fixed integer shift each, as columns of the same row."""
    return frames.withColumn("dy", F.expr("cast(t % 5 - 2 as int)")).withColumn("dx", F.expr("cast(t % 3 - 1 as int)"))


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shifts(read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("t")))


def order_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions on a wide canvas: one per order, parts as pixels, quantity as weight.

    The canvas grows with the number of parts, so regions per pixel stay level as data grows.
    """
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_orderkey").alias("roi_id"),
            F.expr("cast(l_partkey div 64 as int)").alias("y"),
            F.expr("cast(l_partkey % 64 as int)").alias("x"),
        )
        .agg(F.sum("l_quantity").alias("w"))
    )
