"""From one wide row of figures to one row per indicator."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.functions.scalar import pct_validity, validity_flag
from obsengine.operators.levels import level_name
from obsengine.schema import LEVEL, SERIES

# Fixed value: percent of the expected values from which an indicator is valid.
MIN_SHARE = 75.0


@dataclass(frozen=True)
class DailyIndicator:
    """One daily indicator; the last three name columns or SQL expressions."""

    nome: str
    riferimento: str
    condizione: str
    note: str
    valore: str
    teorici: str
    rilevati: str

    def row(self, min_share: float = MIN_SHARE) -> Column:
        cells = F.expr(self.valore), F.expr(self.teorici), F.expr(self.rilevati)
        return self.row_of(*cells, min_share)

    def row_of(
        self, value: Column, expected: Column, observed: Column, min_share: float = MIN_SHARE
    ) -> Column:
        return F.struct(
            F.lit(self.nome).alias("nome_indicatore"),
            F.lit(self.riferimento).alias("riferimento_normativo"),
            F.lit(self.condizione).alias("condizione_sul_limite"),
            value.cast("double").alias("valore"),
            F.lit(self.note).alias("note_di_lavoro"),
            *_coverage(observed, expected, min_share),
        )


@dataclass(frozen=True)
class AnnualIndicator:
    """One annual indicator; the last three name columns or SQL expressions."""

    nome: str
    limite: str
    condizione: str
    livello_critico: str
    valore: str
    teorici: str
    rilevati: str

    def row(self, min_share: float = MIN_SHARE) -> Column:
        observed, expected = F.expr(self.rilevati), F.expr(self.teorici)
        return F.struct(
            F.lit(self.nome).alias("nome_indicatore"),
            F.lit(self.limite).alias("valore_limite"),
            F.lit(self.condizione).alias("condizione_sul_limite"),
            F.lit(self.livello_critico).alias("livello_critico"),
            F.expr(self.valore).cast("double").alias("valore"),
            *_coverage(observed, expected, min_share),
        )


def _coverage(observed: Column, expected: Column, min_share: float) -> list[Column]:
    return [
        expected.cast("int").alias("dati_teorici"),
        observed.cast("bigint").alias("valori_rilevati"),
        pct_validity(observed, expected).alias("percentuale_validita"),
        validity_flag(observed, expected, min_share).alias("validita_indicatore"),
    ]


def unpivot_indicators(
    figures: DataFrame,
    period: Column,
    indicators: Sequence[DailyIndicator] | Sequence[AnnualIndicator],
    more_rows: Column | None = None,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per indicator from each row of figures, in a single pass.

    ``more_rows`` may add an array of already built indicator rows; ``min_share`` is the
    percentage of expected values that makes an indicator valid.
    """
    rows = F.array(*[indicator.row(min_share) for indicator in indicators])
    if more_rows is not None:
        rows = F.concat(rows, more_rows)
    # The rows are never empty; the outer form saves a filter that would build them twice.
    return figures.select(
        period,
        *SERIES,
        level_name().alias("livello_validazione"),
        LEVEL,
        F.inline_outer(rows),
    )
