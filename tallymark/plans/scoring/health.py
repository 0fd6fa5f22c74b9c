"""Health: patient outcomes and clinical-trial preparation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.conditional import band, rule_table
from tallymark.functions.formulas import adjusted_dosage, bmi
from tallymark.operators.joins import Dim, enrich
from tallymark.operators.kpi import min_sample
from tallymark.plans.scoring.common import row_alerts, staged

# Thresholds and labels of the rules. Bands list (threshold, result) in order.
PATIENT = {
    "hba1c": [
        ({"value_as_number": (">", 9.0)}, "uncontrolled"),
        ({"value_as_number": (">", 7.0)}, "above_target"),
        ({"value_as_number": (">=", 5.7)}, "prediabetic"),
    ],
    "pressure": [(180, "crisis"), (140, "stage2"), (130, "stage1"), (120, "elevated")],
    "normal": "normal",
    "readmission": [
        ({"visit_count_30d": (">=", 3), "age": (">", 65)}, 0.85),
        ({"visit_count_30d": (">=", 2), "comorbidity_count": (">", 3)}, 0.72),
        ({"visit_count_30d": (">=", 2)}, 0.55),
        ({"age": (">", 75)}, 0.45),
    ],
    "readmission_default": 0.15,
    "alert_above": 0.7,
}
TRIAL = {
    "age_from": 18,
    "age_to": 65,
    "weight_from": 45.5,
    "visits_from": 3,
    "statuses": ["active", "completed"],
    "adverse_events_to": 5,
    "phase2_rows": 100,
    "site_rows": 30,
    "age_risk": [(60, 1.5), (40, 1.2)],
    "age_risk_default": 1.0,
}


def patient_outcomes(
    cohort: DataFrame, measurements: DataFrame, drugs: DataFrame, conditions: DataFrame, visits: DataFrame, cfg=PATIENT
) -> DataFrame:
    joined = enrich(cohort, [Dim(df, "person_id") for df in (measurements, drugs, conditions, visits)])
    return staged(
        joined,
        {
            "hba1c_risk": rule_table(cfg["hba1c"], cfg["normal"]),
            "bp_category": band("systolic", cfg["pressure"], cfg["normal"]),
            "readmission_risk": rule_table(cfg["readmission"], cfg["readmission_default"]),
        },
    )


def patient_alerts(scored: DataFrame, cfg=PATIENT) -> DataFrame:
    return row_alerts(
        scored,
        F.col("readmission_risk") > cfg["alert_above"],
        ["person_id", "readmission_risk"],
        {"first_name": "name", "last_name": "name", "social_security_number": "ssn"},
    )


@dataclass(frozen=True)
class TrialPlan:
    """What a caller chooses for one trial run."""

    phase: int
    include_adverse: bool = False
    blinding: str = "open"
    interim: bool = False
    min_age: int = 0
    max_age: int = 0


def phase_predicate(plan: TrialPlan, cfg=TRIAL) -> Column:
    """The row condition of a phase, as one predicate that can be pushed to the source."""
    keep = F.lit(True)
    if plan.phase == 1 and plan.include_adverse and plan.blinding == "double":
        keep = F.col("age").between(cfg["age_from"], cfg["age_to"])
        keep = keep & (F.col("dosage") > 0) & (F.col("weight") >= cfg["weight_from"])
        if plan.interim:
            keep = keep & (F.col("visit_count") >= cfg["visits_from"])
            if plan.min_age > 0:
                keep = keep & (F.col("age") >= plan.min_age)
                # An upper age only counts together with a lower one.
                if plan.max_age > 0:
                    keep = keep & (F.col("age") <= plan.max_age)
    elif plan.phase == 2:
        keep = F.col("status").isin(cfg["statuses"]) & (F.col("adverse_events") <= cfg["adverse_events_to"])
    elif plan.phase == 3:
        keep = F.col("status") == "completed"
    return keep


def trial_results(patients: DataFrame, plan: TrialPlan, cfg=TRIAL) -> DataFrame:
    """Rows of the phase with derived measures; no rows for a phase 2 with too few of them."""
    kept = patients.filter(phase_predicate(plan, cfg))
    if plan.phase == 2:
        enough = kept.agg(F.count(F.lit(1)) >= cfg["phase2_rows"]).scalar()
        kept = kept.filter(enough)
    return staged(
        kept,
        {
            "full_name": F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")),
            "bmi": bmi("weight", "height"),
            "risk_score": band("age", cfg["age_risk"], cfg["age_risk_default"], ">"),
            "adjusted_dosage": adjusted_dosage("dosage"),
        },
    )


def small_sites(patients: DataFrame, cfg=TRIAL) -> DataFrame:
    """Sites whose completed patients are too few, with their mean efficacy."""
    completed = patients.filter(phase_predicate(TrialPlan(phase=3), cfg))
    return min_sample(completed, ["site_id"], cfg["site_rows"], {"avg_eff": F.avg("efficacy_score")})
