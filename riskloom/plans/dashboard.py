"""The tables behind each chart of the dashboard, for one filter choice, and those of its model tab."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from riskloom.operators import explore, models
from riskloom.operators.evaluate import CLASS_NAMES
from riskloom.plans.modelling import Compared
from riskloom.spec import STUDENTS, RoleSpec

# Display names of the at-risk list.
AT_RISK = {
    "nome": "Nome", "curso": "Curso", "periodo": "Período", "cr": "CR", "faltas": "Faltas",
    "situacao_financeira": "Sit. Financeira", "reprovacoes": "Reprovações",
}


@dataclass(frozen=True)
class View:
    """Which columns of a table the charts show: the filter, the columns whose rates are charted,
    the two axes, the decimals of the mean indicators, class names, hover columns, the list."""

    choice: str
    rates: tuple[str, ...]
    x: str
    y: str
    means: dict[str, int]
    hover: tuple[str, ...]
    shown: dict[str, str]
    names: dict[int, str] = field(default_factory=lambda: dict(CLASS_NAMES))


STUDENT_VIEW = View(
    "curso", ("curso", "situacao_financeira"), "cr", "faltas", {"cr": 2, "faltas": 1}, ("nome", "curso"), AT_RISK)


def tables(
    df: DataFrame, choice: str | None = explore.ALL, spec: RoleSpec = STUDENTS, view: View = STUDENT_VIEW
) -> dict[str, DataFrame]:
    """Rates and correlations cover the whole table; the rest follows the filter. All are lazy,
    except that the indicators by choice, box statistics and the density fix their values first."""
    chosen = explore.only(df, view.choice, choice)
    out = {
        "choices": explore.distinct_values(df, view.choice),
        "kpis": explore.kpis(chosen, spec.target, view.means),
        "kpis_by_choice": explore.kpis_by_choice(df, view.choice, spec.target, view.means),
        "scatter": explore.scatter_points(chosen, view.x, view.y, spec.target, view.names, view.hover),
        "density": explore.density(chosen, view.x, view.y, spec.target),
        "box": explore.box_stats(chosen, [view.x], spec.target),
        "box_outliers": explore.box_outliers(chosen, view.x, spec.target, view.hover),
        "correlations": explore.correlation_bars(df, spec.numeric, spec.target),
        "at_risk": explore.positives(chosen, spec.target, view.shown),
    }
    return out | {f"rate_by_{c}": explore.ranked_rates(df, c, spec.target) for c in view.rates}


def model_tables(done: Compared, top: int = 10) -> dict[str, DataFrame]:
    """The model tab: comparison, winner, confusion, report, curves and explanations."""
    return {
        "metrics": done.metrics, "best": done.best, "confusion": done.confusion, "report": done.report, "roc": done.roc,
        "importances": models.flag_importances(done.importances),
        "top_importances": models.top_importances(done.importances, top), "coefficients": done.coefficients,
    }
