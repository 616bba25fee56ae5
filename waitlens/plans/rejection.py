"""Non-pertinence (rejected referral) analyses: P10-P15, P40, P41."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.functions.dates import completed_years
from waitlens.functions.nulls import lenient_sum
from waitlens.functions.numeric import mean_of_rounded, round_half_even
from waitlens.operators.aggregates import count_by, pivot_counts, pivot_values
from waitlens.operators.predicates import between_dates, contains_ignore_case
from waitlens.operators.ranking import rank_within, top_n_per_group
from waitlens.operators.reshape import longer

# Fixed values of the reference: age bands of the rejected-referral analysis.
# Age 18 falls in no band; it gets null, as in the reference.
AGE_BAND_LABELS = ("Menor de 5", "6 a 14", "15 a 17", "18 o más")
# Fixed values of the reference: grouped exit reasons.
REASON_GROUP_LABELS = ("Atendido", "No Pertinente", "Otra")


def _year_window(year: int) -> tuple[str, str]:
    return f"{year}-01-01", f"{year + 1}-01-01"


def np_rate(exits: DataFrame, *, years: Sequence[int], reasons: Mapping[str, str] | DataFrame,
            min_total: int = 10, np_column: str = "no_pertinencia", na_column: str | None = None) -> DataFrame:
    """P10 for one or several years in one pass (U3): exits per destination,
    specialty and reason as columns (0 when absent), total, share of
    non-pertinent exits to 2 digits, groups with at least ``min_total``.

    ``reasons`` maps reason labels to column names (the cleaned labels); given
    the exit-reason dimension, its labels are taken from there (A8), so a new
    reason gets its column. ``na_column`` counts exits whose code has no reason."""
    if isinstance(reasons, DataFrame):
        reasons = pivot_values(reasons, "causal")
    lo, hi = _year_window(min(years))[0], _year_window(max(years))[1]
    df = exits.where(between_dates("f_salida", lo, hi)).withColumn("anio", F.year("f_salida"))
    df = df.where(F.col("anio").isin(list(years)))
    wide = pivot_counts(df, ["abrev_destino", "desc_esp", "anio"], "causal", reasons, total="total_egresos", rest=na_column)
    wide = wide.withColumn("porc_np_total", round_half_even(F.col(np_column) / F.col("total_egresos"), 2))
    return wide.where(F.col("total_egresos") >= min_total)


def np_rate_ordered(rates: DataFrame, *, reference_year: int) -> DataFrame:
    """P11 order (W4): rank of each specialty by its share in the reference
    year, per destination; specialties absent that year get a null rank.

    Two windows over the aggregated rates, both clustered by destination
    (one shuffle of the small aggregate, no second pass over the exits):
    reference-year rows sort first and are numbered, then every row of the
    same destination and specialty takes that number."""
    is_ref = F.col("anio") == reference_year
    by_site = Window.partitionBy("abrev_destino").orderBy(
        is_ref.desc(), F.col("porc_np_total").desc_nulls_last(), F.col("desc_esp").asc_nulls_last())
    df = rates.withColumn("_rank", F.when(is_ref, F.row_number().over(by_site)))
    same = Window.partitionBy("abrev_destino", "desc_esp")
    return df.withColumn("orden_esp", F.max("_rank").over(same)).drop("_rank")


def rejected_diagnosis_counts(exits: DataFrame, *, np_code: str, year: int, specialties: Sequence[str]) -> DataFrame:
    """Rejected referrals of some specialties in a year, by specialty and diagnosis."""
    df = exits.where((F.col("c_salida") == np_code)
                     & (F.col("f_salida") > F.lit(f"{year - 1}-12-31").cast("date"))
                     & (F.col("f_salida") < F.lit(f"{year + 1}-01-01").cast("date"))
                     & F.col("desc_esp").isin(list(specialties)))
    return count_by(df, ["desc_esp", "sospecha_diag"])


def top_rejected_diagnoses(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` diagnoses of rejected referrals per specialty in a year;
    ties broken by diagnosis (N15)."""
    return top_n_per_group(counts, ["desc_esp"], [F.col("n").desc(), F.col("sospecha_diag").asc_nulls_last()], k)


def ranked_diagnoses(counts: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` per specialty by count, with the in-group order used
    to draw them (ascending count, W3 + W5)."""
    first = top_n_per_group(counts, ["desc_esp"], [F.col("n").desc(), F.col("sospecha_diag").asc_nulls_last()], k)
    return rank_within(first, ["desc_esp"], [F.col("n").asc(), F.col("sospecha_diag").asc_nulls_last()],
                       "diagnostico_orden")


def age_band(age: str = "edad_sic"):
    """Age band label of the rejected-referral analysis; 18 and negative ages get null."""
    a = F.col(age)
    return (F.when((a >= 0) & (a <= 5), AGE_BAND_LABELS[0])
            .when((a > 5) & (a <= 14), AGE_BAND_LABELS[1])
            .when((a > 14) & (a < 18), AGE_BAND_LABELS[2])
            .when(a > 18, AGE_BAND_LABELS[3]))


def rejected_by_age_band(exits: DataFrame, *, word: str, np_code: str, exit_from: str,
                         min_age: int = 5) -> DataFrame:
    """Rejected referrals whose diagnosis contains ``word`` (any case),
    by age band and specialty."""
    df = exits.withColumn("edad_sic", completed_years("fecha_nac", "f_entrada")).withColumn("grupo_edad", age_band())
    df = df.where(contains_ignore_case("sospecha_diag", word) & (F.col("c_salida") == np_code)
                  & (F.col("edad_sic") > min_age) & (F.col("f_salida") >= F.lit(exit_from).cast("date")))
    return count_by(df, ["grupo_edad", "desc_esp"])


def rejected_by_diagnosis(exits: DataFrame, *, specialty: str, np_code: str, year: int) -> DataFrame:
    """Rejected referrals of one specialty in a year, by diagnosis."""
    df = exits.where((F.col("c_salida") == np_code) & between_dates("f_salida", f"{year}-01-01", f"{year}-12-31", True)
                     & (F.col("desc_esp") == specialty))
    return count_by(df, ["sospecha_diag"])


def exits_by_reason_group(exits: DataFrame, *, code: str, attended_code: str, np_code: str,
                          year: int) -> DataFrame:
    """Exits of one specialty code by year, origin and grouped reason."""
    c = F.col("c_salida")
    grp = (F.when(c == attended_code, REASON_GROUP_LABELS[0]).when(c == np_code, REASON_GROUP_LABELS[1])
           .otherwise(REASON_GROUP_LABELS[2]))
    df = exits.where((F.col("presta_min") == code) & between_dates("f_salida", *_year_window(year)))
    df = df.withColumns({"year": F.year("f_salida"), "causal_grupo": grp})
    return count_by(df, ["year", "estab_orig", "causal_grupo"])


def yearly_totals(rates: DataFrame, attended_column: str = "atencion_realizada") -> DataFrame:
    """Exits and attended exits per specialty and year (nulls skipped)."""
    return rates.groupBy("desc_esp", "anio").agg(lenient_sum("total_egresos").alias("total_egresos"),
                                                 lenient_sum(attended_column).alias("total_ar"))


def yearly_totals_long(rates: DataFrame, attended_column: str = "atencion_realizada") -> DataFrame:
    """P40 long form."""
    return longer(yearly_totals(rates, attended_column), ["desc_esp", "anio"], ["total_egresos", "total_ar"],
                  "tipo", "valor")


def np_share_mean(rates: DataFrame) -> DataFrame:
    """Mean share of non-pertinent exits per specialty and year (nulls
    skipped); the shares have two decimals, see ``mean_of_rounded``."""
    return rates.groupBy("desc_esp", "anio").agg(mean_of_rounded("porc_np_total", 2).alias("pct_np"))
