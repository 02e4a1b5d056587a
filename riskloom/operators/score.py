"""Scoring of new rows: probability, class, band, delta to the base rate, risk factors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.columns import half_even
from riskloom.functions.risk import BASE_RATE, STUDENT_RULES, base_delta, risk_band, risk_factors


def with_probability(df: DataFrame, model) -> DataFrame:
    """The input columns plus ``prob`` (percent, unrounded) and ``pred`` (0/1)."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        (vector_to_array("probability")[1] * 100.0).alias("prob"),
        F.col("prediction").cast("int").alias("pred"),
    )


def explain(scored: DataFrame, rules=STUDENT_RULES, base: float = BASE_RATE) -> DataFrame:
    """Adds band, delta and factors to rows that carry ``prob``; row-wise, batch or stream."""
    return scored.withColumns({
        "band": risk_band(F.col("prob")),
        "delta": base_delta(F.col("prob"), base),
        "factors": risk_factors(rules),
    })


def score(df: DataFrame, model, name: str, rules=STUDENT_RULES, base: float = BASE_RATE) -> DataFrame:
    """Score a table of any size, or a stream, and echo the inputs."""
    return explain(with_probability(df, model), rules, base).withColumn("model", F.lit(name))


def factor_codes(column: str = "factors") -> Column:
    """The codes of the factors as one text, in rule order."""
    return F.concat_ws("|", F.transform(F.col(column), lambda f: f["code"]))


def legacy_score(df: DataFrame, model) -> DataFrame:
    """The input columns plus ``evadiu`` as a boolean and the probability with one decimal."""
    scored = with_probability(df, model)
    return scored.select(
        *df.columns,
        (F.col("pred") == 1).alias("evadiu"),
        half_even(F.col("prob"), 1).alias("probabilidade_evasao"),
    )


def check_scenarios(scored: DataFrame, expected: str = "espera") -> DataFrame:
    """Compares the band with the expected one; a difference is reported, not an error."""
    verdict = F.when(F.col("band") == F.col(expected), "consistente").otherwise("inesperado")
    return scored.withColumn("verdict", verdict)
