"""Running totals over scores in descending order, the base of the ROC curve and its area.

Rows are first counted per distinct score (combined on the map side, so ties and hot scores are one
row). The distinct scores are spread over range partitions of about ``per_bucket`` rows, as many as
that takes; each is ordered on its own, and the totals of those before it are added from a table of
one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import pin, stage

PER_BUCKET = 1 << 16


def ranked_scores(
    scored: DataFrame, score: str = "score", label: str = "label", by: str = "model",
    per_bucket: int = PER_BUCKET,
) -> DataFrame:
    """(by, score, pos, neg, cum_pos, cum_neg, next_pos, next_neg, all_pos, all_neg), best first.

    ``cum_*`` count the rows scored at least this high; ``next_*`` are the counts of the next lower
    score of the same model, NULL at the lowest; ``all_*`` are the model's totals. Rows without a
    score or label are left out.
    """
    points = stage(
        scored.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())
        .groupBy(by, F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )
    parts = points.count() // per_bucket + 1
    spread = points.repartitionByRange(parts, F.col(by), F.desc("score"))
    points = stage(spread.withColumn("bucket", F.spark_partition_id()))

    inside = Window.partitionBy(by, "bucket").orderBy(F.desc("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    counted = points.select(
        by, "bucket", "score", "pos", "neg",
        F.sum("pos").over(upto).alias("in_pos"),
        F.sum("neg").over(upto).alias("in_neg"),
        F.lead("pos").over(inside).alias("n_pos"),
        F.lead("neg").over(inside).alias("n_neg"),
    )
    first = F.max_by(F.struct("pos", "neg"), "score")
    totals = points.groupBy(by, "bucket").agg(
        F.sum("pos").alias("b_pos"), F.sum("neg").alias("b_neg"), first.alias("first")
    )
    along = Window.partitionBy(by).orderBy("bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = pin(
        totals.select(
            by, "bucket",
            F.coalesce(F.sum("b_pos").over(before), F.lit(0)).alias("off_pos"),
            F.coalesce(F.sum("b_neg").over(before), F.lit(0)).alias("off_neg"),
            F.lead("first").over(along)["pos"].alias("f_pos"),
            F.lead("first").over(along)["neg"].alias("f_neg"),
            F.sum("b_pos").over(Window.partitionBy(by)).alias("all_pos"),
            F.sum("b_neg").over(Window.partitionBy(by)).alias("all_neg"),
        )
    )
    return counted.join(offsets, [by, "bucket"]).select(
        by, "score", "pos", "neg",
        (F.col("off_pos") + F.col("in_pos")).alias("cum_pos"),
        (F.col("off_neg") + F.col("in_neg")).alias("cum_neg"),
        F.coalesce("n_pos", "f_pos").alias("next_pos"),
        F.coalesce("n_neg", "f_neg").alias("next_neg"),
        "all_pos", "all_neg",
    )


def placed(df: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """Adds each row's place in the given order, from 0, as a written table."""
    ranked = stage(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = ranked.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    # One row per partition of the sort.
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    place = F.col("__base") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return (
        ranked.withColumn("__part", part).join(F.broadcast(base), "__part")
        .withColumn(name, place).drop("__at", "__part", "__base")
    )
