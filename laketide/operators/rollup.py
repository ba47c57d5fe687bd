"""Daily encounter rollup (RLP1, RLP2; JN5, AGG1-AGG4).

Grain: date, patient key, payer key, encounter class, purpose (the reason
text, or the description when there is no reason).

:func:`daily_rollup` pre-aggregates procedures per (encounter, date) and
then joins, so each encounter's amounts are summed once.
:func:`daily_rollup_joined` keeps the original join-then-sum form, in which
an encounter's amounts are repeated once per procedure; it exists so both
semantics can be tested side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.functions.dates import run_date
from laketide.operators.joins import hashable_columns, null_spread

GRAIN = ["date", "dim_patient_key", "dim_payer_key", "encounter_class"]


def purpose(reason="reason_description", description="description") -> Column:
    """CASE WHEN reason IS NOT NULL THEN reason ELSE description END."""
    return F.coalesce(F.col(reason), F.col(description))


def _on_date(df: DataFrame, d) -> DataFrame:
    return df if d is None else df.where(F.col("date") == F.lit(run_date(d)))


def procedure_counts(fact_procedure: DataFrame, d=None) -> DataFrame:
    """Per (encounter, date): number of procedures and of non-NULL codes;
    procedures without an encounter belong to none.

    Partial aggregation runs before the shuffle, so an encounter with many
    procedures costs one row per task, not one per procedure.
    """
    return (_on_date(fact_procedure, d).where(F.col("encounter_id").isNotNull())
            .groupBy("encounter_id", "date")
            .agg(F.count("encounter_id").alias("n_procedures"),
                 F.count("code").alias("n_codes")))


def daily_rollup(fact_encounter: DataFrame, fact_procedure: DataFrame, d=None, *,
                 spread_nulls: bool = True) -> DataFrame:
    """Daily rollup with procedures pre-aggregated (each encounter once).

    ``d`` restricts both facts to one date partition (partition pruning on
    both scans); without it every date is rolled up in the same plan.
    ``spread_nulls=False`` joins on (encounter_id, date) alone: facts that are
    bucketed by these two columns then meet without an exchange.
    """
    fe = _on_date(fact_encounter, d)
    pc = procedure_counts(fact_procedure, d)
    on = ["encounter_id", "date"]
    if spread_nulls:
        fe = fe.withColumn("_spread", null_spread(F.col("encounter_id"), hashable_columns(fe)))
        pc = pc.withColumn("_spread", F.lit(-1).cast("long"))
        on = [*on, "_spread"]
    j = fe.join(pc, on, "left")
    return (j.groupBy(*GRAIN, purpose().alias("purpose"))
            .agg(F.count_distinct("encounter_id").alias("total_encounter_num"),
                 F.coalesce(F.sum("n_procedures"), F.lit(0)).cast("long").alias("total_procedure_num"),
                 F.coalesce(F.sum("n_codes"), F.lit(0)).cast("long").alias("total_diagnosis_num"),
                 F.sum("claim_amount").alias("total_claim_amount"),
                 F.sum("coverage_amount").alias("total_coverage_amount"),
                 F.sum("patient_pay_amount").alias("total_patient_pay_amount")))


def daily_rollup_joined(fact_encounter: DataFrame, fact_procedure: DataFrame, d=None) -> DataFrame:
    """Original form: join procedures first, then sum (amounts repeat per
    procedure; ``total_diagnosis_num`` counts procedure codes)."""
    fe = _on_date(fact_encounter, d)
    fe = fe.withColumn("_spread", null_spread(F.col("encounter_id"), hashable_columns(fe)))
    fp = _on_date(fact_procedure, d).select(
        F.col("encounter_id").alias("_p_enc"), F.col("date").alias("_p_date"),
        F.col("code").alias("_p_code"), F.lit(-1).cast("long").alias("_p_spread"))
    j = fe.join(fp, (fe["encounter_id"] == fp["_p_enc"]) & (fe["date"] == fp["_p_date"])
                & (fe["_spread"] == fp["_p_spread"]), "left")
    return (j.groupBy(*GRAIN, purpose().alias("purpose"))
            .agg(F.count_distinct("encounter_id").alias("total_encounter_num"),
                 F.count("_p_enc").alias("total_procedure_num"),
                 F.count("_p_code").alias("total_diagnosis_num"),
                 F.sum("claim_amount").alias("total_claim_amount"),
                 F.sum("coverage_amount").alias("total_coverage_amount"),
                 F.sum("patient_pay_amount").alias("total_patient_pay_amount")))
