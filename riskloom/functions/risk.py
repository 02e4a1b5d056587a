"""Risk band, delta to the base rate, and named risk factors of a scored row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Band limits in percent, and the base rate shown on the gauge.
BANDS = ((60.0, "alto"), (35.0, "medio"))
LOWEST_BAND = "baixo"
BASE_RATE = 30.0


def risk_band(percent: Column, bands=BANDS, lowest: str = LOWEST_BAND) -> Column:
    """Band of an unrounded probability in percent; an unknown probability has no band."""
    out = F.when(percent.isNull(), F.lit(None).cast("string"))
    for limit, name in bands:
        out = out.when(percent >= limit, name)
    return out.otherwise(lowest)


def base_delta(percent: Column, base: float = BASE_RATE) -> Column:
    return percent - F.lit(base)


@dataclass(frozen=True)
class Level:
    """One step of a rule: ``column op threshold`` gives a level, a code and a message."""

    op: str
    threshold: float | str
    level: str
    code: str
    message: str


_OPS = {
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "==": lambda c, v: c == v,
}

# Rules in the order they are reported; the first step that holds wins.
STUDENT_RULES: tuple[tuple[str, tuple[Level, ...]], ...] = (
    ("cr", (
        Level("<", 5.0, "vermelho", "cr_muito_baixo", "CR muito baixo (%.1f < 5.0)"),
        Level("<", 6.5, "amarelo", "cr_abaixo_da_media", "CR abaixo da média (%.1f)"),
    )),
    ("faltas", (
        Level(">", 15, "vermelho", "faltas_altas", "Alto número de faltas (%.0f)"),
        Level(">", 8, "amarelo", "faltas_acima_da_media", "Faltas acima da média (%.0f)"),
    )),
    ("reprovacoes", (
        Level(">=", 3, "vermelho", "reprovacoes_criticas", "Reprovações críticas (%.0f)"),
        Level(">=", 1, "amarelo", "possui_reprovacoes", "Possui reprovações (%.0f)"),
    )),
    ("situacao_financeira", (
        Level("==", "dificuldade", "vermelho", "financeira_dificuldade",
              "Situação financeira em dificuldade"),
        Level("==", "intermediaria", "amarelo", "financeira_intermediaria",
              "Situação financeira intermediária"),
    )),
)


def risk_factors(rules=STUDENT_RULES) -> Column:
    """Array of (level, code, message), one entry per rule that holds; empty when none does."""
    found = []
    for column, levels in rules:
        entry = None
        for step in levels:
            value = F.col(column)
            text = (
                F.format_string(step.message, value.cast("double"))
                if "%" in step.message else F.lit(step.message)
            )
            row = F.struct(
                F.lit(step.level).alias("level"),
                F.lit(step.code).alias("code"),
                text.alias("message"),
            )
            holds = _OPS[step.op](value, F.lit(step.threshold))
            entry = F.when(holds, row) if entry is None else entry.when(holds, row)
        found.append(entry)
    return F.array_compact(F.array(*found))
