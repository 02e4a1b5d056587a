"""Table profile: shape, types, missing values, numeric summary, data dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions.columns import half_even, ratio, rows_of
from riskloom.operators.quantiles import quantile_table
from riskloom.session import local_rows
from riskloom.spec import normalise

# Names under which column types are reported.
TYPE_NAMES = {"tinyint": "int64", "smallint": "int64", "int": "int64", "bigint": "int64",
              "float": "float64", "double": "float64", "boolean": "bool"}


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def type_name(field: T.StructField) -> str:
    return TYPE_NAMES.get(field.dataType.simpleString(), "object")


def null_profile(df: DataFrame) -> DataFrame:
    """(column, rows, nulls, pct_null) of every column, in one pass."""
    df = normalise(df)
    wide = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"n_{c}") for c in df.columns])
    nulls = {c: F.col("rows") - F.col(f"n_{c}") for c in df.columns}
    return rows_of(
        wide, ["column", "rows", "nulls", "pct_null"],
        [[F.lit(c), F.col("rows"), nulls[c], ratio(nulls[c] * 100.0, F.col("rows"))] for c in df.columns],
    )


def profile(df: DataFrame) -> DataFrame:
    """(position, column, dtype, rows, nulls, pct_null, min, max, sum, mean) in one pass."""
    df = normalise(df)
    numeric = set(_numeric(df))
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(c).alias(f"n{i}"))
        if c in numeric:
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.sum(x).alias(f"s{i}")]
    none = F.lit(None).cast("double")
    rows = []
    for i, f in enumerate(df.schema):
        num = f.name in numeric
        nulls = F.col("rows") - F.col(f"n{i}")
        rows.append([
            F.lit(i + 1), F.lit(f.name), F.lit(type_name(f)), F.col("rows"), nulls,
            ratio(nulls * 100.0, F.col("rows")),
            F.col(f"lo{i}") if num else none, F.col(f"hi{i}") if num else none,
            F.col(f"s{i}") if num else none,
            ratio(F.col(f"s{i}"), F.col(f"n{i}"), None) if num else none,
        ])
    names = ["position", "column", "dtype", "rows", "nulls", "pct_null", "min", "max", "sum", "mean"]
    return rows_of(df.agg(*aggs), names, rows)


def describe(df: DataFrame, columns=None) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max), exact quartiles, sample deviation."""
    df = normalise(df)
    columns = list(columns or _numeric(df))
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"d{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    moments = rows_of(
        df.agg(*aggs), ["column", "count", "mean", "std", "min", "max"],
        [[F.lit(c), *[F.col(f"{p}{i}") for p in ("n", "m", "d", "lo", "hi")]] for i, c in enumerate(columns)],
    )
    quartiles = quantile_table(df, columns, [0.25, 0.5, 0.75], ["p25", "p50", "p75"]).drop("n")
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


# What the dictionary says about the student table. ``domain`` is literal text, or
# the name of a rule that reads the clean table's range.
STUDENT_DEFINITIONS = (
    ("id_aluno", "Identificador único do aluno", "rows"),
    ("nome", "Nome completo do aluno", "Texto livre"),
    ("curso", "Curso de vinculação do aluno",
     "Ciência da Computação | Engenharia Civil | Administração | Direito | Medicina"),
    ("periodo", "Período atual do aluno no curso", "int_range"),
    ("cr", "Coeficiente de Rendimento Acadêmico", "decimal_range"),
    ("faltas", "Número total de faltas do aluno", "int_range"),
    ("situacao_financeira", "Situação financeira declarada pelo aluno",
     "estavel | intermediaria | dificuldade"),
    ("reprovacoes", "Quantidade de reprovações acumuladas", "int_range"),
    ("idade", "Idade do aluno em anos", "int_range"),
    ("evadiu", "Variável alvo — indica se o aluno evadiu", "0 = Não evadiu | 1 = Evadiu"),
)
UNKNOWN = "—"


def data_dictionary(raw: DataFrame, clean: DataFrame, definitions=STUDENT_DEFINITIONS) -> DataFrame:
    """One row per raw column: type, description, value domain, percent missing before and after.

    Only the two profiles (one row per column) and the definitions are joined.
    """
    spark = raw.sparkSession
    defs = local_rows(spark, list(definitions), "column string, description string, domain string")
    before = profile(raw).select("position", "column", "dtype", "rows", F.col("pct_null").alias("before"))
    after = profile(clean).select("column", "min", "max", F.col("pct_null").alias("after"))
    domain = (
        F.when(F.col("domain") == "rows", F.format_string("1 a %d", "rows"))
        .when(F.col("domain") == "int_range",
              F.format_string("min=%d | max=%d", F.col("min").cast("long"), F.col("max").cast("long")))
        .when(F.col("domain") == "decimal_range", F.format_string("min=%.1f | max=%.1f", "min", "max"))
        .otherwise(F.coalesce("domain", F.lit(UNKNOWN)))
    )
    return (
        before.join(after, "column", "left").join(defs, "column", "left")
        .select(
            "position",
            F.col("column").alias("coluna"),
            F.col("dtype").alias("tipo_python"),
            F.coalesce("description", F.lit(UNKNOWN)).alias("descricao"),
            domain.alias("valores_possiveis"),
            half_even(F.col("before"), 2).alias("pct_ausentes_antes"),
            half_even(F.coalesce("after", F.lit(0.0)), 2).alias("pct_ausentes_depois"),
        )
    )
