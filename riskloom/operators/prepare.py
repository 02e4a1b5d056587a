"""Split, scale, encode and assemble; everything is fitted on the training rows only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.dictionary import LabelEncoder, fit_labels
from riskloom.operators.selection import mark_selected, proportional_quota, row_hash
from riskloom.session import stage
from riskloom.spec import RoleSpec, normalise

FEATURES = "features"
LABEL = "label"
MOST_CATEGORIES = 1000


def separate(df: DataFrame, spec: RoleSpec) -> DataFrame:
    """Drop identifiers; keep the features and, in the same row, the target as ``label``."""
    return df.select(*spec.features, F.col(spec.target).cast("double").alias(LABEL))


def stratified_split(
    df: DataFrame, spec: RoleSpec, test_share: float = 0.2, seed: int = 42, **kw
) -> DataFrame:
    """``df`` with a boolean ``is_test``: exact counts per class, the same rows on any cluster."""
    if spec.id is None:
        raise ValueError("an exact split needs a unique key")
    quota = proportional_quota(test_share, [spec.target])
    return mark_selected(df, spec.id, [spec.target], quota, seed, "is_test", **kw)


def hash_split(df: DataFrame, spec: RoleSpec, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Row-wise variant without any pass over the data: about ``test_share`` of each class."""
    drawn = F.conv(F.substring(row_hash(spec.id, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("is_test", drawn < int(test_share * 2**32))


def scale_stats(train: DataFrame, columns, categorical=()) -> dict:
    """{column: (mean, population deviation)} from one aggregate, which also sees to it that the
    categorical columns have few enough values."""
    row = train.agg(*[
        f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))
    ], *[F.approx_count_distinct(c).alias(f"d_{c}") for c in categorical]).first()
    for c in categorical:
        _few(c, row[f"d_{c}"])
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def scaled(column: str, stats: dict) -> Column:
    """z-score; a constant column is only centred."""
    mean, dev = stats[column]
    return (F.col(column).cast("double") - F.lit(mean)) / F.lit(dev or 1.0)


def standardise(df: DataFrame, stats: dict) -> DataFrame:
    return df.withColumns({c: scaled(c, stats) for c in stats})


class TooManyCategories(ValueError):
    """A column has more distinct values than an encoding by value is meant for."""


def _few(column: str, count: int) -> None:
    if count > MOST_CATEGORIES:
        raise TooManyCategories(f"{column} has about {count} values; the limit is {MOST_CATEGORIES}")


def categories(train: DataFrame, columns) -> dict:
    """{column: sorted distinct values}, at most ``MOST_CATEGORIES`` each, else an error."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    seen = stage(train.select(F.inline(cells)).filter(F.col("value").isNotNull()).distinct())
    for row in seen.groupBy("column").count().collect():
        _few(*row)
    rows = seen.groupBy("column").agg(F.sort_array(F.collect_set("value")).alias("values")).collect()
    found = {r["column"]: r["values"] for r in rows}
    return {c: found.get(c, []) for c in columns}


def one_hot(df: DataFrame, known: dict, keep=()) -> DataFrame:
    """One 0/1 column per known category, named column_value; unseen and NULL are all zero.

    Meant for plain columns, hence the limit. A vector over any number of categories is
    ``dictionary.with_slots``.
    """
    out = [
        F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in known.items() for v in values
    ]
    return df.select(*keep, *out)


def label_encoder(train: DataFrame, columns) -> LabelEncoder:
    """Sorted categories to 0..k-1 as <column>_enc, any number of them; a value not seen in training
    is an error."""
    return fit_labels(train, columns)


def _scaling(stats: dict) -> SQLTransformer:
    """Scaling as a persistable stage with the fitted constants in it. A missing value, NULL or
    NaN, gets the training mean, which is 0 once scaled; so no row ends a scoring job."""
    parts = [
        f"coalesce(nanvl((CAST(`{c}` AS DOUBLE) - ({(mean or 0.0)!r}D)) / ({(dev or 1.0)!r}D), CAST(NULL AS DOUBLE)), 0.0D)"
        f" AS `__z_{c}`" for c, (mean, dev) in stats.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def fit_preparation(train: DataFrame, spec: RoleSpec) -> PipelineModel:
    """Scaler, one-hot encoder and assembler as one fitted, saveable transformer."""
    z = [f"__z_{c}" for c in spec.numeric]
    index = [f"__i_{c}" for c in spec.categorical]
    hot = [f"__v_{c}" for c in spec.categorical]
    stages = []
    stats = scale_stats(train, spec.numeric, spec.categorical)
    if z:
        stages.append(_scaling(stats))
    if hot:
        stages += [
            StringIndexer(inputCols=list(spec.categorical), outputCols=index,
                          stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=z + hot, outputCol=FEATURES))
    helpers = ", ".join(f"`{c}`" for c in z + index + hot)
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({helpers}) FROM __THIS__"))
    return Pipeline(stages=stages).fit(train)


def feature_names(transformed: DataFrame) -> list[str]:
    """Names by vector slot, from the column's metadata."""
    groups = transformed.schema[FEATURES].metadata["ml_attr"]["attrs"]
    slots = sorted((a for attrs in groups.values() for a in attrs), key=lambda a: a["idx"])
    return [a["name"].removeprefix("__z_").removeprefix("__v_") for a in slots]


@dataclass(frozen=True)
class Prepared:
    """Train and test rows with ``features`` and ``label``, the fitted transformer, slot names."""

    train: DataFrame
    test: DataFrame
    model: PipelineModel
    names: list[str]


def prepare(df: DataFrame, spec: RoleSpec, test_share: float = 0.2, seed: int = 42) -> Prepared:
    """Split, fit on train, transform both. The split is written once so that every later pass,
    and every later run, sees the same rows."""
    split = stage(
        stratified_split(normalise(df), spec, test_share, seed)
        .select(spec.id, *spec.features, F.col(spec.target).cast("double").alias(LABEL), "is_test")
    )
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    model = fit_preparation(train, spec)
    train, test = model.transform(train), model.transform(test)
    return Prepared(train, test, model, feature_names(train))
