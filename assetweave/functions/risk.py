"""Risk rules on questionnaire answers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetweave.functions.cleaning import col

#: fixed values: risk classes from low to high
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]


def risk_score(age: Column | str, duration: Column | str) -> Column:
    """max(0, 35 - age) / 35 + min(duration, 5) / 5."""
    youth = F.greatest(F.lit(0), 35 - col(age)) / F.lit(35.0)
    patience = F.least(col(duration), F.lit(5)) / F.lit(5.0)
    return youth + patience


def risk_bin(score: Column | str) -> Column:
    """[0, 0.5] Low, (0.5, 1] Medium, (1, 2] High; NULL outside."""
    s = col(score)
    return (
        F.when((s < 0) | (s > 2), None)
        .when(s <= 0.5, RISK_LABELS[0])
        .when(s <= 1.0, RISK_LABELS[1])
        .when(s <= 2.0, RISK_LABELS[2])
    )


def age_risk(age: Column | str) -> Column:
    """Under 30 Mid, over 50 Low, in between High."""
    a = col(age)
    return F.when(a < 30, "Mid Risk").when(a > 50, "Low Risk").when(a.isNotNull(), "High Risk")


def tolerance_label(tolerance: Column | str) -> Column:
    return F.concat(col(tolerance), F.lit(" Risk"))
