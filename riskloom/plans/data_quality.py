"""Generate, clean, document and summarise a labelled table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.columns import ratio
from riskloom.operators.clean import Cleaned, clean, outlier_counts
from riskloom.operators.explore import strongest_correlations
from riskloom.operators.profile import STUDENT_DEFINITIONS, data_dictionary, null_profile
from riskloom.session import local_rows, stage
from riskloom.sources.synth import raw_students, student_ids
from riskloom.sources.tables import write_csv
from riskloom.spec import STUDENTS, RoleSpec, normalise, validate


@dataclass(frozen=True)
class Quality:
    raw: DataFrame
    cleaned: Cleaned
    dictionary: DataFrame
    summary: DataFrame


def summary(raw: DataFrame, clean_table: DataFrame, spec: RoleSpec) -> DataFrame:
    """(item, column, value): sizes, missing values, outliers of the raw table, positive rate, and
    the three strongest correlations with the target."""
    spark = raw.sparkSession
    nulls = null_profile(raw).agg(F.sum("nulls").alias("nulls"), F.max("rows").alias("rows")).first()
    outliers = outlier_counts(raw, spec.outlier).agg(F.sum("outliers")).first()[0] or 0
    after = clean_table.agg(
        F.count("*").alias("rows"), ratio(F.sum(spec.target) * 100.0, F.count(spec.target), None).alias("rate")
    ).first()
    top = strongest_correlations(clean_table, spec.numeric, spec.target, 3).orderBy("place").collect()
    rows = [
        ("raw rows", None, float(nulls["rows"])), ("raw columns", None, float(len(raw.columns))),
        ("clean rows", None, float(after["rows"])), ("clean columns", None, float(len(clean_table.columns))),
        ("missing", None, float(nulls["nulls"])), ("outliers", None, float(outliers)),
        ("positive rate", None, after["rate"]),
    ]
    rows += [(f"correlation {r['place']}", r["column"], r["r"]) for r in top]
    return local_rows(spark, rows, "item string, column string, value double")


def run(raw: DataFrame, spec: RoleSpec, definitions=STUDENT_DEFINITIONS) -> Quality:
    raw = normalise(raw)
    validate(raw, spec)
    cleaned = clean(raw, spec)
    return Quality(
        raw, cleaned, data_dictionary(raw, cleaned.table, definitions), summary(raw, cleaned.table, spec)
    )


def students(spark: SparkSession, n: int = 1500, seed: int = 42, folder: str | None = None) -> Quality:
    """The whole flow on generated students; with a folder, the three tables are written as CSV."""
    raw = stage(raw_students(student_ids(spark, n), seed=seed))
    done = run(raw, STUDENTS)
    if folder:
        write_csv(done.raw, f"{folder}/alunos")
        write_csv(done.cleaned.table, f"{folder}/alunos_limpo")
        write_csv(done.dictionary, f"{folder}/dicionario_dados")
    return done
