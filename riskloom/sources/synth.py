"""Synthetic students: a labelled table drawn row by row from the keys of any table.

No global shuffle is needed: ids keep their order, the exact number of positives is chosen by hash
order, and each row draws its features from its own key and class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import draws
from riskloom.functions.columns import clip, half_even
from riskloom.operators.selection import hash_cuts, mark_selected, share_quota

# Domains, class-conditional parameters and rates of the student table.
COURSES = ["Ciência da Computação", "Engenharia Civil", "Administração", "Direito", "Medicina"]
FINANCES = ["estavel", "intermediaria", "dificuldade"]
FAILURES = [0, 1, 2, 3, 4, 5, 6]
POSITIVE = dict(
    cr=(4.2, 1.0, 2.0, 7.5),  # mean, deviation, least, most
    absences=(2, 8.8),  # gamma: whole part of the shape, which is that plus one half; scale
    failures=[0.15, 0.20, 0.25, 0.20, 0.12, 0.06, 0.02], finances=[0.10, 0.50, 0.40],
)
NEGATIVE = dict(
    cr=(6.5, 1.0, 3.5, 10.0), absences=(1, 3.3),
    failures=[0.55, 0.28, 0.12, 0.04, 0.01, 0.0, 0.0], finances=[0.386, 0.50, 0.114],
)
UNIFORMS = 19
MAX_ABSENCES = 40
PERIODS = (1, 8)
AGES = (17, 45)
POSITIVE_RATE = 0.30
MISSING_RATE = 0.03

# Names are free text; any lists do.
FIRST_NAMES = ["Ana", "Bento", "Clara", "Davi", "Estela", "Fabiana", "Gil", "Heitor", "Inês", "Jorge",
               "Lívia", "Murilo", "Noemi", "Oscar", "Paula", "Raul", "Sofia", "Tomás", "Vitória", "Zeca"]
LAST_NAMES = ["Aguiar", "Bastos", "Chaves", "Domingues", "Esteves", "Fontes", "Garcia", "Holanda",
              "Junqueira", "Lacerda", "Macedo", "Novaes", "Paiva", "Rangel", "Sales", "Tavares", "Valente"]


def student_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "id_aluno")


def students(ids: DataFrame, key: str = "id_aluno", seed: int = 42, rate: float = POSITIVE_RATE) -> DataFrame:
    """One student per key, exactly int(n * rate) of them positive, no missing values yet."""
    keyed = ids.select(F.col(key).cast("long").alias("id_aluno"))
    classed = mark_selected(keyed, "id_aluno", [], share_quota(rate), seed, "positive")
    drawn = draws.with_uniforms(classed, "id_aluno", UNIFORMS, seed)
    u = [F.col(f"__u{i}") for i in range(UNIFORMS)]

    def per_class(make) -> Column:
        return F.when(F.col("positive"), make(POSITIVE)).otherwise(make(NEGATIVE))

    def parameter(name: str, i: int) -> Column:
        return per_class(lambda p: F.lit(p[name][i]))

    grade = draws.normal(u[0], u[1]) * parameter("cr", 1) + parameter("cr", 0)
    grade = F.when(grade < parameter("cr", 2), parameter("cr", 2)).when(
        grade > parameter("cr", 3), parameter("cr", 3)).otherwise(grade)
    second = per_class(lambda p: F.log(u[5]) if p["absences"][0] == 2 else F.lit(0.0))
    absent = (draws.half_chi_square(draws.normal(u[2], u[3])) - F.log(u[4]) - second) * parameter("absences", 1)
    age = draws.order_statistic(u[12:19], 2)
    return drawn.select(
        "id_aluno",
        F.concat_ws(" ", draws.pick(u[6], FIRST_NAMES), draws.pick(u[7], LAST_NAMES)).alias("nome"),
        draws.pick(u[8], COURSES).alias("curso"),
        draws.uniform_int(u[9], *PERIODS).cast("double").alias("periodo"),
        half_even(grade, 1).alias("cr"),
        clip(F.floor(absent), 0, MAX_ABSENCES).cast("double").alias("faltas"),
        per_class(lambda p: draws.choice(u[10], FINANCES, p["finances"])).alias("situacao_financeira"),
        per_class(lambda p: draws.choice(u[11], FAILURES, p["failures"])).cast("double").alias("reprovacoes"),
        clip(F.floor(age * (AGES[1] - AGES[0]) + AGES[0]), *AGES).cast("double").alias("idade"),
        F.col("positive").cast("int").alias("evadiu"),
    )


def inject_nulls(
    df: DataFrame, key: str, columns, rate: float = MISSING_RATE, seed: int = 42, exact: bool = True, **kw
) -> DataFrame:
    """Set int(n * rate) values of each column to NULL, chosen per column by hash order.

    ``exact=False`` draws every cell on its own, without a pass over the data.
    """
    columns = list(columns)
    if not exact:
        limit = int(rate * 2**32)
        return df.withColumns({
            c: F.when(F.conv(F.substring(_cell_hash(key, c, seed), 1, 8), 16, 10).cast("long") >= limit, F.col(c))
            for c in columns
        })
    cells = df.select(key, F.explode(F.array(*map(F.lit, columns))).alias("column"))
    cuts = hash_cuts(cells, [key, "column"], ["column"], share_quota(rate), seed, **kw).collect()
    cut = {r["column"]: (r["cut_hash"], r["cut_key"][key]) for r in cuts}

    def keep(c: str) -> Column:
        if c not in cut:
            return F.col(c)
        h, last = _cell_hash(key, c, seed), cut[c]
        chosen = (h < last[0]) | ((h == last[0]) & (F.col(key) <= F.lit(last[1])))
        return F.when(~chosen, F.col(c))

    return df.withColumns({c: keep(c) for c in columns})


def _cell_hash(key: str, column: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(column), F.lit(str(seed))))


def raw_students(ids: DataFrame, key: str = "id_aluno", seed: int = 42) -> DataFrame:
    """Students with missing values in every numeric column."""
    made = students(ids, key, seed)
    return inject_nulls(made, "id_aluno", ["periodo", "cr", "faltas", "reprovacoes", "idade"], MISSING_RATE, seed)
