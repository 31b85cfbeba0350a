"""The query library on the star schema: one function per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import interval_seconds
from ..functions.clinical import age_band, balance_group, mortality_label, net_balance
from ..operators.dedup import top_per_key
from ..operators.joins import spread_join
from ..operators.enrich import with_calendar, with_date, with_status
from ..operators.quantiles import percentile_of_counts, value_counts
from ..session import materialise

ROUND = 6


def _double(col: Column, digits: int = ROUND) -> Column:
    return F.round(col, digits).cast("double")


def _mean(name: str, digits: int = ROUND) -> Column:
    """Mean of a decimal column, rounded once."""
    return F.round(F.avg(F.col(name).cast("double")), digits)


# --- stays -------------------------------------------------------------------------------


def stays_calendar(stays: DataFrame, dates: DataFrame) -> DataFrame:
    """Stays with the calendar columns of their admission day."""
    return with_date(stays, dates, "intime_date")


def stays_by_year(stays: DataFrame, dates: DataFrame) -> DataFrame:
    joined = with_date(stays.select("stay_id", "intime_date"), dates, "intime_date")
    counted = joined.groupBy("year").agg(F.count_distinct("stay_id").alias("stay_count"))
    return counted.orderBy(F.col("year").asc_nulls_last())


def stays_by_unit(stays: DataFrame) -> DataFrame:
    known = stays.filter(F.col("first_careunit").isNotNull())
    counted = known.groupBy("first_careunit").agg(F.count_distinct("stay_id").alias("stay_count"))
    return counted.orderBy(F.desc("stay_count"), "first_careunit")


def stays_by_gender(stays: DataFrame, patients: DataFrame) -> DataFrame:
    known = patients.filter(F.col("gender").isNotNull()).select("subject_id", "gender")
    # The count groups by other keys than the join, so AQE may split a heavy subject.
    joined = stays.select("subject_id", "stay_id").dropna().join(known, "subject_id")
    return joined.groupBy("gender").agg(F.count_distinct("stay_id").alias("stay_count"))


def top_codes(stays: DataFrame, diagnoses: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent diagnosis codes; ties are ordered by code and title."""
    joined = stays.select("stay_id", "diagnoses_icd_key").join(diagnoses, "diagnoses_icd_key")
    counted = joined.groupBy("icd_code", "long_title").agg(
        F.count_distinct("stay_id").alias("stay_count")
    )
    return counted.orderBy(F.desc("stay_count"), "icd_code", "long_title").limit(k)


def los_stats(stays: DataFrame, unit: str = "last_careunit") -> DataFrame:
    """Length of stay per unit: count, mean, range and exact median.

    The stays are read once, into the row count of each (unit, length); every figure comes from
    that small table.
    """
    counts = materialise(value_counts(stays, [unit], "los"), "value-counts")
    known = F.when(F.col("_v").isNotNull(), F.col("_n"))
    basic = counts.groupBy(unit).agg(
        F.sum("_n").alias("admission_count"),
        _double(F.sum(F.col("_v") * F.col("_n")) / F.sum(known)).alias("avg_los"),
        F.min("_v").alias("min_los"),
        F.max("_v").alias("max_los"),
    )
    median = percentile_of_counts(counts, [unit], 0.5, "median_los")
    median = median.withColumnRenamed(unit, "_unit")
    joined = basic.join(median, basic[unit].eqNullSafe(median["_unit"]), "left").drop("_unit")
    return joined.orderBy(F.desc("admission_count"), F.col(unit).asc_nulls_last())


# --- vital series ------------------------------------------------------------------------


def aligned_series(
    events: DataFrame, dates: DataFrame, times: DataFrame, item_a, item_b, grain: str = "hour",
    names: tuple[str, str] = ("hr_avg", "spo2_avg"),
) -> DataFrame:
    """Averages of two items side by side for every (stay, day[, hour]) that has both.

    One scan and one shuffle: both items are aggregated conditionally in the same group, and
    groups with only one of them are dropped, which is what joining the two series does.
    """
    wanted = events.filter(F.col("itemid").isin(item_a, item_b)).select(
        "stay_id", "itemid", "valuenum", "charttime_date", "charttime_time"
    )
    placed = with_calendar(wanted, dates, times, "charttime_date", "charttime_time")
    keys = ["stay_id", "chart_date"] + (["hour_of_day"] if grain == "hour" else [])
    is_a, is_b = F.col("itemid") == F.lit(item_a), F.col("itemid") == F.lit(item_b)
    grouped = placed.groupBy(*keys).agg(
        _double(F.avg(F.when(is_a, F.col("valuenum")))).alias(names[0]),
        _double(F.avg(F.when(is_b, F.col("valuenum")))).alias(names[1]),
        F.count_if(is_a).alias("_a"),
        F.count_if(is_b).alias("_b"),
    )
    both = grouped.filter((F.col("_a") > 0) & (F.col("_b") > 0)).drop("_a", "_b")
    return both.orderBy(*keys)


def hourly_vitals(events: DataFrame, dates: DataFrame, times: DataFrame, item) -> DataFrame:
    """Average, range and count of one item per stay, day and hour."""
    wanted = events.filter(F.col("itemid") == F.lit(item)).select(
        "stay_id", "valuenum", "charttime_date", "charttime_time"
    )
    placed = with_calendar(wanted, dates, times, "charttime_date", "charttime_time")
    keys = ["stay_id", "chart_date", "hour_of_day"]
    grouped = placed.groupBy(*keys).agg(
        _double(F.avg("valuenum")).alias("avg_value"),
        F.max("valuenum").alias("max_value"),
        F.min("valuenum").alias("min_value"),
        F.count(F.lit(1)).alias("n_obs"),
    )
    return grouped.orderBy(*keys)


# --- emergency stays ---------------------------------------------------------------------


def ed_triage(ed_stays: DataFrame, triage: DataFrame) -> DataFrame:
    """Emergency stays with their triage vitals; stays without triage keep NULLs."""
    ed = ed_stays.select(
        "stay_id",
        F.col("subject_id").alias("ed_subject_id"),
        "gender",
        "race",
        "arrival_transport",
        "disposition",
    )
    vitals = triage.select(
        "stay_id",
        F.col("subject_id").alias("triage_subject_id"),
        "temperature",
        "heartrate",
        "resprate",
        "o2sat",
        "sbp",
        "dbp",
        "acuity",
    )
    return ed.join(vitals, "stay_id", "left")


def stay_duration(stays: DataFrame) -> DataFrame:
    """Length of each interval in seconds, from its four calendar keys."""
    seconds = interval_seconds(
        F.col("intime_date"), F.col("intime_time"), F.col("outtime_date"), F.col("outtime_time")
    )
    return stays.select("stay_id", seconds.alias("stay_duration_seconds"))


# --- condition against control -----------------------------------------------------------


def status_flag(stays: DataFrame, diagnoses: DataFrame, keyword: str) -> DataFrame:
    flagged = with_status(stays, diagnoses, keyword, 1, 0, "sepsis_flag")
    return flagged.select(
        "stay_id", "subject_id", "los", "first_careunit", "last_careunit", "sepsis_flag"
    )


def status_micro_flag(
    stays: DataFrame, diagnoses: DataFrame, micro: DataFrame, keyword: str
) -> DataFrame:
    """Condition flag per stay, and whether its subject has any microbiology event."""
    seen = micro.select("subject_id").distinct().withColumn("has_micro_event", F.lit(1))
    known = seen.filter(F.col("subject_id").isNotNull())
    joined = spread_join(
        status_flag(stays, diagnoses, keyword), known, ["subject_id"], "left", keys_of=stays
    )
    return joined.fillna(0, subset=["has_micro_event"])


def status_count(stays: DataFrame, diagnoses: DataFrame, keyword: str) -> DataFrame:
    flagged = with_status(stays, diagnoses, keyword)
    counted = flagged.groupBy("sepsis_status").agg(
        F.count_distinct("subject_id").alias("patient_count")
    )
    return counted.orderBy("sepsis_status")


def _status_vitals(
    stays: DataFrame, diagnoses: DataFrame, triage: DataFrame, keyword: str, link: str
) -> DataFrame:
    slim = stays.select(*dict.fromkeys([link, "subject_id", "diagnoses_icd_key"]))
    vitals = triage.drop("subject_id")
    return with_status(slim, diagnoses, keyword).join(vitals, link)


def vitals_stats(
    stays: DataFrame, diagnoses: DataFrame, triage: DataFrame, keyword: str, link="stay_id"
) -> DataFrame:
    """Mean and range of the triage vitals by status, for stays with a temperature."""
    rows = _status_vitals(stays, diagnoses, triage, keyword, link)
    measures = [F.count_distinct("subject_id").alias("patient_count")]
    for vital in ("temperature", "heartrate", "resprate", "o2sat"):
        measures += [
            _mean(vital).alias(f"avg_{vital}"),
            F.min(vital).cast("double").alias(f"min_{vital}"),
            F.max(vital).cast("double").alias(f"max_{vital}"),
        ]
    measures += [_mean(v).alias(f"avg_{v}") for v in ("sbp", "dbp", "acuity")]
    measured = rows.filter(F.col("temperature").isNotNull())
    return measured.groupBy("sepsis_status").agg(*measures).orderBy("sepsis_status")


# Display digits of the comparison report.
MEAN_DIGITS = {"temperature": 1, "heartrate": 0, "resprate": 0, "o2sat": 1, "sbp": 0, "dbp": 0,
               "acuity": 1}
STD_DIGITS = {"temperature": 2, "heartrate": 1, "resprate": 1, "o2sat": 2}


def vitals_compare(
    stays: DataFrame, diagnoses: DataFrame, triage: DataFrame, keyword: str, link="stay_id"
) -> DataFrame:
    """Rounded means and sample standard deviations by status."""
    rows = _status_vitals(stays, diagnoses, triage, keyword, link)
    means = [_mean(v, d).alias(f"avg_{v}") for v, d in MEAN_DIGITS.items()]
    stds = [_double(F.stddev_samp(v), d).alias(f"std_{v}") for v, d in STD_DIGITS.items()]
    counted = F.count_distinct("subject_id").alias("patient_count")
    return rows.groupBy("sepsis_status").agg(counted, *means, *stds).orderBy("sepsis_status")


def complaints_by_status(
    stays: DataFrame, diagnoses: DataFrame, triage: DataFrame, keyword: str, link="stay_id"
) -> DataFrame:
    rows = _status_vitals(stays, diagnoses, triage, keyword, link)
    told = rows.filter(F.col("chiefcomplaint").isNotNull())
    counted = told.groupBy("sepsis_status", "chiefcomplaint").agg(
        F.count(F.lit(1)).alias("complaint_count")
    )
    return counted.orderBy("sepsis_status", F.desc("complaint_count"), "chiefcomplaint")


def abnormal_rules() -> dict[str, Column]:
    """Thresholds of an abnormal triage vital."""
    return {
        "abnormal_temp": (F.col("temperature") > 38.0) | (F.col("temperature") < 36.0),
        "tachycardia": F.col("heartrate") > 100,
        "tachypnea": F.col("resprate") > 20,
        "low_o2": F.col("o2sat") < 95,
        "hypotension": F.col("sbp") < 90,
    }


def abnormal_vitals(
    stays: DataFrame, diagnoses: DataFrame, triage: DataFrame, keyword: str, link="stay_id"
) -> DataFrame:
    """Counts and percentages of abnormal vitals by status."""
    rows = _status_vitals(stays, diagnoses, triage, keyword, link)
    total = F.count(F.lit(1))
    measures = [total.alias("total_patients")]
    for name, rule in abnormal_rules().items():
        measures.append(F.count_if(rule).alias(f"{name}_count"))
        share = F.count_if(rule) * F.lit(100.0) / total
        measures.append(F.round(share, 1).cast("double").alias(f"{name}_pct"))
    return rows.groupBy("sepsis_status").agg(*measures).orderBy("sepsis_status")


def transposed(df: DataFrame, group: str, groups: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Swap groups and measures of a small report: one row per measure, one column per group."""
    renamed = df.select(group, *[F.col(c).alias(label) for c, label in measures.items()])
    long = renamed.unpivot(group, list(measures.values()), "metric", "value")
    return long.groupBy("metric").pivot(group, list(groups)).agg(F.first("value"))


# Row labels of the comparison table.
VITAL_LABELS = {
    "avg_temperature": "Temperature (°C)",
    "avg_heartrate": "Heart Rate (bpm)",
    "avg_resprate": "Resp Rate (breaths/min)",
    "avg_o2sat": "O2 Sat (%)",
    "avg_sbp": "Systolic BP (mmHg)",
    "avg_dbp": "Diastolic BP (mmHg)",
}


def vitals_transposed(
    stays: DataFrame, diagnoses: DataFrame, triage: DataFrame, keyword: str
) -> DataFrame:
    report = vitals_compare(stays, diagnoses, triage, keyword)
    return transposed(report, "sepsis_status", ["Non-Sepsis", "Sepsis"], VITAL_LABELS)


# --- patients, microbiology, items -------------------------------------------------------


def demographics(patients: DataFrame) -> DataFrame:
    grouped = patients.groupBy("gender").agg(
        F.count(F.lit(1)).alias("patient_count"),
        _double(F.avg("anchor_age")).alias("avg_age"),
        F.min("anchor_age").alias("min_age"),
        F.max("anchor_age").alias("max_age"),
    )
    return grouped.orderBy(F.col("gender").asc_nulls_last())


def micro_with_stays(micro: DataFrame, stays: DataFrame, complete: str = "org_name") -> DataFrame:
    """Microbiology events with the stay of their admission.

    ``complete`` names the column that must be present, or ``"all"`` for every event column.
    """
    subset = micro.columns if complete == "all" else [complete]
    admitted = stays.select("subject_id", "hadm_id", "stay_id", "first_careunit", "los")
    return micro.dropna(subset=subset).join(admitted, ["subject_id", "hadm_id"], "left")


def items_listing(items: DataFrame, category: str = "All") -> DataFrame:
    """Item dictionary in item order, optionally for one category."""
    chosen = items if category == "All" else items.filter(F.col("category") == category)
    columns = ("itemid", "label", "category", "unitname", "lownormalvalue", "highnormalvalue")
    return chosen.select(*columns).orderBy("itemid")


def item_categories(items: DataFrame) -> DataFrame:
    return items.select("category").dropna().distinct().orderBy("category")


# --- fluid balance and mortality ---------------------------------------------------------


def fluid_balance(
    stays: DataFrame, inputs: DataFrame, outputs: DataFrame, null_as_zero: bool = True
) -> DataFrame:
    """Total input, total output and balance per stay.

    Both sides are stacked and summed per stay in one aggregation before the join, so nothing
    fans out and the stays are joined once.
    """
    amounts = inputs.select("stay_id", F.col("amount").cast("double").alias("_in")).unionByName(
        outputs.select("stay_id", F.col("value").cast("double").alias("_out")),
        allowMissingColumns=True,
    )
    totals = amounts.groupBy("stay_id").agg(
        F.sum("_in").alias("total_input_ml"), F.sum("_out").alias("total_output_ml")
    )
    joined = stays.select("stay_id", "subject_id", "intime", "outtime")
    joined = joined.join(totals, "stay_id", "left")
    net = net_balance(F.col("total_input_ml"), F.col("total_output_ml"), null_as_zero)
    return joined.withColumn("fluid_balance_ml", net)


def latest_stays(stays: DataFrame) -> DataFrame:
    """The latest stay of each subject; of equal admission times the larger id."""
    order = [F.col("intime").desc(), F.col("stay_id").desc()]
    return top_per_key(stays, ["subject_id"], order, 1)


def with_patient(stays: DataFrame, patients: DataFrame) -> DataFrame:
    """One row per subject with the subject's age and date of death."""
    return stays.join(patients.select("subject_id", "dod", "anchor_age"), "subject_id", "left")


def last_stay(balance: DataFrame, patients: DataFrame) -> DataFrame:
    """The latest stay of each subject with its balance, and the subject's age and date of death.

    Where totals are not there yet, take :func:`latest_stays` first and join them to those only.
    """
    return with_patient(latest_stays(balance), patients)


def mortality_by_balance(last: DataFrame) -> DataFrame:
    labelled = last.select(
        "subject_id",
        balance_group(F.col("fluid_balance_ml")).alias("fluid_balance_group"),
        mortality_label(F.col("dod")).alias("mortality"),
    )
    keys = ["fluid_balance_group", "mortality"]
    return labelled.groupBy(*keys).agg(F.count("subject_id").alias("subject_count")).orderBy(*keys)


def mortality_by_age(last: DataFrame) -> DataFrame:
    labelled = last.select(
        "subject_id",
        age_band(F.col("anchor_age")).alias("age_group"),
        balance_group(F.col("fluid_balance_ml")).alias("fluid_balance_group"),
        mortality_label(F.col("dod")).alias("mortality"),
    )
    keys = ["age_group", "fluid_balance_group", "mortality"]
    counted = labelled.groupBy(*keys).agg(F.count_distinct("subject_id").alias("subject_count"))
    return counted.orderBy(*keys)


# --- trends ------------------------------------------------------------------------------


def ols(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` over complete pairs, one row per group."""
    pairs = df.dropna(subset=[x, y]).select(
        *by, F.col(y).cast("double").alias("_y"), F.col(x).cast("double").alias("_x")
    )
    return pairs.groupBy(*by).agg(
        _double(F.regr_slope("_y", "_x")).alias("slope"),
        _double(F.regr_intercept("_y", "_x")).alias("intercept"),
        _double(F.regr_r2("_y", "_x")).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )

