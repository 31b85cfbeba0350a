"""Column expressions for clinical flags, groups and risk labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def out_of_range(value: Column, low: Column, high: Column) -> Column:
    """Three-valued: NULL when no bound decides, e.g. for items without normal bounds."""
    return (value < low) | (value > high)


def balance_group(net_ml: Column) -> Column:
    return F.when(net_ml > 0, "Positive").otherwise("Negative")


def mortality_label(dod: Column) -> Column:
    return F.when(dod.isNull(), "Alive").otherwise("Dead")


def age_band(age: Column) -> Column:
    """Bands <18, 18-39, 40-64, 65-89, 90+; a missing age falls to the last band."""
    # Labels are written with an en dash in the published report.
    return (
        F.when(age < 18, "Under 18")
        .when(age < 40, "18–39")
        .when(age < 65, "40–64")
        .when(age < 90, "65–89")
        .otherwise("90+")
    )


def net_balance(total_in: Column, total_out: Column, null_as_zero: bool = True) -> Column:
    """Input minus output; without ``null_as_zero`` a missing side makes the result NULL."""
    if not null_as_zero:
        return total_in - total_out
    zero = F.lit(0.0)
    return F.coalesce(total_in, zero) - F.coalesce(total_out, zero)


def shock_index(heart_rate: Column, sbp: Column) -> Column:
    return F.when(sbp > 0, heart_rate / sbp).otherwise(F.lit(0.0))


def risk_tier(prob: Column, high: float = 0.5, medium: float | None = 0.2) -> Column:
    """Strict thresholds; ``medium=None`` leaves the two-level form."""
    tier = F.when(prob > high, "high")
    if medium is not None:
        tier = tier.when(prob > medium, "medium")
    return F.when(prob.isNotNull(), tier.otherwise("low"))


# Meaning of the three length-of-stay classes.
STAY_CLASSES = {0: "LONG STAY (>7 days)", 1: "MEDIUM (3-7 days)", 2: "SHORT (<3 days)"}


def stay_class_of(los: Column, long: float = 7.0, medium: float = 3.0) -> Column:
    """Index of the length-of-stay class: above ``long``, from ``medium`` on, below; NULL without one."""
    return F.when(los > long, 0).when(los >= medium, 1).when(los.isNotNull(), 2)


def stay_class_label(index: Column) -> Column:
    label = None
    for key, text in STAY_CLASSES.items():
        label = F.when(index == key, text) if label is None else label.when(index == key, text)
    return label.otherwise("Unknown")


def risk_reasons(
    dx_count: Column, has_sepsis: Column, shock: Column, is_emergency: Column
) -> Column:
    """Array of reason codes in a fixed order; ``["stable"]`` when none applies."""
    found = F.array_compact(
        F.array(
            F.when(dx_count > 10, "multimorbidity"),
            F.when(has_sepsis == 1, "sepsis"),
            F.when(shock > 0.9, "hemodynamic_instability"),
            F.when(is_emergency == 1, "emergency_admission"),
        )
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("stable")))
