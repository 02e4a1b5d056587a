"""Column roles of a labelled table, schema checks and the missing-value rule."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T


@dataclass(frozen=True)
class RoleSpec:
    """Which column plays which role; ``id`` is None where no column is a unique key.

    ``integer`` columns are rounded half-even and cast after cleaning; ``decimals`` maps the
    other numeric columns to the number of decimals they are rounded to.
    """

    id: str | None
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    drop: tuple[str, ...] = ()
    outlier: tuple[str, ...] = ()
    integer: tuple[str, ...] = ()
    decimals: dict[str, int] = field(default_factory=dict)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def columns(self) -> tuple[str, ...]:
        own = (self.id,) if self.id else ()
        return (*own, *self.drop, *self.features, self.target)


# The student table's columns and roles.
STUDENTS = RoleSpec(
    id="id_aluno",
    target="evadiu",
    numeric=("periodo", "cr", "faltas", "reprovacoes", "idade"),
    categorical=("curso", "situacao_financeira"),
    drop=("nome",),
    outlier=("cr", "faltas", "reprovacoes"),
    integer=("periodo", "faltas", "reprovacoes", "idade"),
    decimals={"cr": 1},
)

STUDENT_SCHEMA = T.StructType(
    [
        T.StructField("id_aluno", T.LongType()),
        T.StructField("nome", T.StringType()),
        T.StructField("curso", T.StringType()),
        T.StructField("periodo", T.DoubleType()),
        T.StructField("cr", T.DoubleType()),
        T.StructField("faltas", T.DoubleType()),
        T.StructField("situacao_financeira", T.StringType()),
        T.StructField("reprovacoes", T.DoubleType()),
        T.StructField("idade", T.DoubleType()),
        T.StructField("evadiu", T.IntegerType()),
    ]
)


def normalise(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column; both count as missing."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


class InvalidTable(ValueError):
    """The table does not carry the roles of its spec."""


def validate(df: DataFrame, spec: RoleSpec, unique_id: bool = False) -> DataFrame:
    """Check that every role column exists, the table is not empty and the id is usable.

    ``unique_id`` adds a shuffle of the id column; leave it off where the id is a known key.
    """
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise InvalidTable(f"missing columns: {missing}")
    if df.isEmpty():
        raise InvalidTable("empty table")
    if unique_id:
        if spec.id is None:
            raise InvalidTable("the table has no id")
        repeated = df.groupBy(spec.id).count().filter((F.col("count") > 1) | F.col(spec.id).isNull())
        if not repeated.isEmpty():
            raise InvalidTable(f"{spec.id} is null or repeated")
    return df
