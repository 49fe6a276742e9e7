"""Risk scores and flags as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._args import ColumnOrName, as_column
from .numbers import round_half_up

# Score weights, limits and the wording of the flags.
WEIGHT_FINANCIAL = 0.40
WEIGHT_LEGAL = 0.40
WEIGHT_STABILITY = 0.20
MAD_TO_SIGMA = 1.4826
Z_LIMIT = 3.0
NEUTRAL_SCORE = 50.0
FINANCIAL_ALERT = 40.0
STABILITY_ALERT = 50.0
LINK_THRESHOLD = 0.92
FLAG_NO_FINANCIAL_DATA = "Información Financiera Insuficiente"
FLAG_WEALTH_IMBALANCE = "Desbalance Patrimonial Detectado"
FLAG_ONE_SENTENCE = "Antecedente Penal/Civil Registrado"
FLAG_MANY_SENTENCES = "Múltiples Sentencias (Alto Riesgo Legal)"
FLAG_PARTY_SWITCHING = "Alta Volatilidad Partidaria (Tránsfuga)"
FLAG_SANCTIONED_COMPANY = "Vínculo con Empresa Sancionada por OSCE"


def is_cold_start(income: ColumnOrName, experience: ColumnOrName) -> Column:
    """Neither income nor experience: too little is known for a ratio."""
    return (as_column(income) == 0) & (as_column(experience) == 0)


def wealth_ratio(assets: ColumnOrName, income: ColumnOrName, experience: ColumnOrName) -> Column:
    ratio = F.try_divide(as_column(assets), as_column(income) + F.lit(1.0))
    return F.when(is_cold_start(income, experience), F.lit(None).cast("double")).otherwise(ratio)


def robust_score(value: Column, median: Column, mad: Column) -> Column:
    """100 at or below the median, 0 from three robust deviations above it on.

    No value scores 50; without any spread only the side of the median decides.
    """
    z = F.try_divide(value - median, mad * F.lit(MAD_TO_SIGMA))
    clipped = F.greatest(F.least(z, F.lit(Z_LIMIT)), F.lit(0.0))
    one_sided = F.when(value > median, F.lit(0.0)).otherwise(F.lit(100.0))
    return (
        F.when(value.isNull(), F.lit(NEUTRAL_SCORE))
        .when(mad == 0, one_sided)
        .otherwise(F.lit(100.0) - clipped * F.lit(100.0 / Z_LIMIT))
    )


def legal_score(sentences: ColumnOrName) -> Column:
    count = as_column(sentences)
    return F.when(count == 0, F.lit(100.0)).when(count == 1, F.lit(50.0)).otherwise(F.lit(0.0))


def stability_score(resignations: ColumnOrName, experience: ColumnOrName) -> Column:
    per_year = F.try_divide(as_column(resignations), as_column(experience) + F.lit(1.0))
    return F.greatest(F.lit(100.0) - per_year * F.lit(100.0), F.lit(0.0))


def risk_index(financial: ColumnOrName, legal: ColumnOrName, stability: ColumnOrName) -> Column:
    weighted = (
        as_column(financial) * F.lit(WEIGHT_FINANCIAL)
        + as_column(legal) * F.lit(WEIGHT_LEGAL)
        + as_column(stability) * F.lit(WEIGHT_STABILITY)
    )
    return round_half_up(weighted, 2)


def risk_flags(
    income: ColumnOrName,
    experience: ColumnOrName,
    financial: ColumnOrName,
    sentences: ColumnOrName,
    stability: ColumnOrName,
    link_score: ColumnOrName,
    link_tax_id: ColumnOrName,
) -> Column:
    """The flags that hold, in their fixed order; an empty list if none does."""
    tax_id = as_column(link_tax_id)
    company = F.when(
        tax_id.isNotNull(), F.concat(F.lit(FLAG_SANCTIONED_COMPANY + " (RUC: "), tax_id, F.lit(")"))
    ).otherwise(F.lit(FLAG_SANCTIONED_COMPANY))
    return F.array_compact(
        F.array(
            F.when(is_cold_start(income, experience), F.lit(FLAG_NO_FINANCIAL_DATA)),
            F.when(as_column(financial) < FINANCIAL_ALERT, F.lit(FLAG_WEALTH_IMBALANCE)),
            F.when(as_column(sentences) == 1, F.lit(FLAG_ONE_SENTENCE)),
            F.when(as_column(sentences) > 1, F.lit(FLAG_MANY_SENTENCES)),
            F.when(as_column(stability) < STABILITY_ALERT, F.lit(FLAG_PARTY_SWITCHING)),
            F.when(as_column(link_score) >= LINK_THRESHOLD, company),
        )
    )
