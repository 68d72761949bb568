"""Lift, ranking quality and inequality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, num, num_sql
from .engineer import bin_expr, quantile_edges
from .ordered import ordered_scan


def _deciles(df: DataFrame, target: str, score: str, bins: int) -> DataFrame:
    edges = quantile_edges(df, score, bins)
    return df.select(
        F.expr(bin_expr(num_sql(df, score), edges)).alias("decile"),
        num(df, target).alias("y"),
        num(df, score).alias("s"),
    ).where(F.col("decile").isNotNull())


def decile_lift(df: DataFrame, target: str, prediction: str, bins: int = 10, digits: int = 3) -> DataFrame:
    """Target and prediction figures per prediction decile (0 lowest), lift and cumulative lift.

    Lift is the decile's rounded mean over the overall mean; cumulative lift is its running average.
    """
    d = _deciles(df, target, prediction, bins)
    base = df.agg(F.avg(num(df, target))).collect()[0][0]
    table = d.groupBy("decile").agg(
        F.count("y").alias("count"),
        *[
            F.round(fn(x), digits).alias(f"{name}_{stat}")
            for name, x in (("target", F.col("y")), ("prediction", F.col("s")))
            for stat, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
        ],
    )
    # one row per decile from here on
    w = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = table.withColumn("lift", F.try_divide(F.col("target_mean"), F.lit(base)))
    return table.withColumn("cumulative_lift", F.sum("lift").over(w) / (F.col("decile") + 1))


def gini_lorenz(df: DataFrame, target: str, prediction: str, key: str) -> DataFrame:
    """1 - 2 x mean cumulative target share, rows by falling prediction (negative for a good model).

    Rows of equal prediction are taken in key order.
    """
    slim = df.select(num(df, target).alias("y"), num(df, prediction).alias("p"), col(key).alias("k"))
    scan = ordered_scan(slim, [-F.col("p"), F.col("k")], {"cum": F.col("y")})
    return scan.agg((1.0 - 2.0 * F.try_divide(F.avg("cum"), F.sum("y"))).alias("gini"), F.count(F.lit(1)).alias("n"))


def response_lift(df: DataFrame, target: str, score: str, bins: int = 10) -> DataFrame:
    """Rows, responders, response rate and cumulative shares per score decile."""
    d = _deciles(df, target, score, bins)
    table = d.groupBy("decile").agg(F.count(F.lit(1)).alias("total"), F.sum("y").alias("responders"))
    everything = Window.partitionBy(F.lit(1))
    w = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table.select(
        "decile",
        "total",
        "responders",
        (F.col("responders") / F.col("total")).alias("response_rate"),
        F.sum("responders").over(w).alias("cumulative_responders"),
        F.try_divide(F.sum("responders").over(w), F.sum("responders").over(everything)).alias("cumulative_response_rate"),
    )


def lorenz_curve(df: DataFrame, column: str) -> DataFrame:
    """Cumulative share of the column against population share, ascending, from the origin.

    Equal values are indistinguishable, so they are counted first and only their totals are ordered;
    the points inside a run of equal values are laid out by its start and step.
    """
    counts = (
        df.select(num(df, column).alias("x")).where(F.col("x").isNotNull()).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    )
    scan = ordered_scan(counts, [F.col("x")], {"rows": F.col("n"), "total": F.col("x") * F.col("n")})
    full = scan.agg(F.max("rows").alias("all_rows"), F.sum(F.col("x") * F.col("n")).alias("all_total")).collect()[0]
    n, total = full["all_rows"], full["all_total"]
    # long runs are cut into pieces before they are expanded, so no task unrolls one hot value alone
    piece = 10_000
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / piece).cast("int")))
    cut = scan.select("x", "n", "rows", "total", pieces.alias("piece"))
    cut = cut.repartition("x", "piece") if n and n > 1_000_000 else cut
    first = F.col("piece") * piece + 1
    last = F.least(F.col("n"), (F.col("piece") + 1) * piece)
    points = cut.select("x", "n", "rows", "total", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("j"))
    curve = points.select(
        (F.col("rows") - F.col("n") + F.col("j")).alias("rank"),
        F.try_divide(F.col("total") - F.col("x") * (F.col("n") - F.col("j")), F.lit(total)).alias("cumulative_share"),
    )
    origin = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("rank"), F.lit(0.0).alias("cumulative_share"))
    return origin.unionByName(curve).select(
        "rank", (F.col("rank") / F.lit(float(n))).alias("population_share"), "cumulative_share"
    )
