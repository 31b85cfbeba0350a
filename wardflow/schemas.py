"""Source and table schemas as Spark DDL strings.

Fixed values: column names, order and types of the public clinical source files and tables that
the jobs read and write.  ``NOT NULL`` is not used because file sources always return nullable
columns; required columns are enforced by the quality gates instead.
"""

from __future__ import annotations

SOURCE_DDL: dict[str, str] = {
    "chartevents": (
        "subject_id INT, hadm_id INT, stay_id INT, caregiver_id INT, charttime STRING, "
        "storetime STRING, itemid INT, value STRING, valuenum DOUBLE, valueuom STRING, "
        "warning STRING"
    ),
    "microbiologyevents": (
        "microevent_id INT, subject_id INT, hadm_id INT, micro_specimen_id INT, "
        "order_provider_id STRING, chartdate TIMESTAMP, charttime TIMESTAMP, spec_itemid INT, "
        "spec_type_desc STRING, test_seq INT, storedate TIMESTAMP, storetime TIMESTAMP, "
        "test_itemid INT, test_name STRING, org_itemid INT, org_name STRING, isolate_num INT, "
        "quantity STRING, ab_itemid INT, ab_name STRING, dilution_text STRING, "
        "dilution_comparison STRING, dilution_value DOUBLE, interpretation STRING, "
        "comments STRING"
    ),
    "icustays": (
        "subject_id INT, hadm_id INT, stay_id INT, first_careunit STRING, last_careunit STRING, "
        "intime TIMESTAMP, outtime TIMESTAMP, los DOUBLE"
    ),
    "edstays": (
        "subject_id INT, hadm_id INT, stay_id INT, intime TIMESTAMP, outtime TIMESTAMP, "
        "gender STRING, race STRING, arrival_transport STRING, disposition STRING"
    ),
    "admissions": (
        "subject_id INT, hadm_id INT, admittime TIMESTAMP, dischtime TIMESTAMP, "
        "deathtime TIMESTAMP, admission_type STRING, admit_provider_id STRING, "
        "admission_location STRING, discharge_location STRING, insurance STRING, "
        "language STRING, marital_status STRING, race STRING, edregtime TIMESTAMP, "
        "edouttime TIMESTAMP, hospital_expire_flag SMALLINT"
    ),
    "d_items": (
        "itemid INT, label STRING, abbreviation STRING, linksto STRING, category STRING, "
        "unitname STRING, param_type STRING, lownormalvalue DOUBLE, highnormalvalue DOUBLE"
    ),
    "diagnoses_icd": (
        "subject_id INT, hadm_id INT, seq_num INT, icd_code STRING, icd_version INT"
    ),
    "d_icd_diagnoses": "icd_code STRING, icd_version INT, long_title STRING",
    "patients": (
        "subject_id INT, gender STRING, anchor_age INT, anchor_year INT, "
        "anchor_year_group STRING, dod TIMESTAMP"
    ),
    "triage": (
        "subject_id INT, stay_id INT, temperature DECIMAL(10,4), heartrate DECIMAL(10,4), "
        "resprate DECIMAL(10,4), o2sat DECIMAL(10,4), sbp DECIMAL(10,4), dbp DECIMAL(10,4), "
        "pain STRING, acuity DECIMAL(10,4), chiefcomplaint STRING"
    ),
    "inputevents": (
        "subject_id INT, hadm_id INT, stay_id INT, caregiver_id INT, starttime TIMESTAMP, "
        "endtime TIMESTAMP, storetime TIMESTAMP, itemid INT, amount DOUBLE, amountuom STRING, "
        "rate DOUBLE, rateuom STRING, orderid INT, linkorderid INT, ordercategoryname STRING, "
        "secondaryordercategoryname STRING, ordercomponenttypedescription STRING, "
        "ordercategorydescription STRING, patientweight DOUBLE, totalamount INT, "
        "totalamountuom STRING, isopenbag INT, continueinnextdept INT, "
        "statusdescription STRING, originalamount DOUBLE, originalrate DOUBLE"
    ),
    "outputevents": (
        "subject_id INT, hadm_id INT, stay_id INT, caregiver_id INT, charttime TIMESTAMP, "
        "storetime TIMESTAMP, itemid INT, value INT, valueuom STRING"
    ),
    "fluid_balance_last_stay": (
        "subject_id INT, stay_id INT, total_input_ml DOUBLE, total_output_ml DOUBLE, "
        "fluid_balance_ml DOUBLE, intime TIMESTAMP, outtime TIMESTAMP, dod DATE"
    ),
}

WAREHOUSE_DDL: dict[str, str] = {
    "dim_d_items": (
        "itemid INT, label STRING, abbreviation STRING, category STRING, unitname STRING, "
        "param_type STRING, lownormalvalue DOUBLE, highnormalvalue DOUBLE"
    ),
    "dim_date": (
        "date_key INT, full_date DATE, day INT, week INT, month INT, quarter INT, year INT"
    ),
    "dim_time": "time_key INT, time_value STRING, hour INT, minute INT, second INT",
    "dim_patients": (
        "subject_id INT, gender STRING, anchor_age INT, anchor_year INT, "
        "anchor_year_group STRING, dod DATE"
    ),
    "dim_diagnoses_icd": (
        "diagnoses_icd_key BIGINT, seq_num INT, icd_code STRING, icd_version INT, "
        "long_title STRING"
    ),
    "dim_triage": (
        "stay_id INT, subject_id INT, temperature DECIMAL(10,4), heartrate DECIMAL(10,4), "
        "resprate DECIMAL(10,4), o2sat DECIMAL(10,4), sbp DECIMAL(10,4), dbp DECIMAL(10,4), "
        "pain STRING, acuity DECIMAL(10,4), chiefcomplaint STRING"
    ),
    "dim_admission": (
        "hadm_id INT, subject_id INT, admittime_time INT, admittime_date INT, "
        "dischtime_time INT, dischtime_date INT, deathtime_time INT, deathtime_date INT, "
        "admission_type STRING, admit_provider_id STRING, admission_location STRING, "
        "discharge_location STRING, insurance STRING, language STRING, marital_status STRING, "
        "race STRING, edregtime_time INT, edregtime_date INT, edouttime_time INT, "
        "edouttime_date INT, hospital_expire_flag SMALLINT"
    ),
    "fact_chartevents": (
        "subject_id INT, hadm_id INT, stay_id INT, caregiver_id INT, charttime_date INT, "
        "charttime_time INT, itemid INT, value STRING, valuenum DOUBLE, valueuom STRING, "
        "warning INT"
    ),
    "fact_icustays": (
        "stay_id INT, subject_id INT, hadm_id INT, first_careunit STRING, "
        "last_careunit STRING, intime_time INT, intime_date INT, outtime_time INT, "
        "outtime_date INT, los DOUBLE"
    ),
    "fact_microbiologyevents": (
        "microevent_id INT, subject_id INT, hadm_id INT, micro_specimen_id INT, "
        "order_provider_id STRING, charttime_date INT, charttime_time INT, spec_itemid INT, "
        "spec_type_desc STRING, test_seq INT, test_itemid INT, test_name STRING, "
        "org_itemid INT, isolate_num INT, quantity STRING, ab_itemid INT, ab_name STRING, "
        "dilution_text STRING, dilution_comparison STRING, interpretation STRING, "
        "comments STRING"
    ),
    "fact_edstays": (
        "subject_id INT, hadm_id INT, stay_id INT, intime_date INT, intime_time INT, "
        "outtime_date INT, outtime_time INT, gender STRING, race STRING, "
        "arrival_transport STRING, disposition STRING"
    ),
}


# Column names of older table layouts and what they are called here.
COLUMN_VARIANTS: dict[str, dict[str, str]] = {
    "fact_chartevents": {"chartdate": "charttime_date", "charttime": "charttime_time"},
    "fact_microbiologyevents": {"chartdate": "charttime_date", "charttime": "charttime_time"},
    "dim_d_items": {
        "low_normal_value": "lownormalvalue",
        "high_normal_value": "highnormalvalue",
    },
    "fact_edstays": {"intime": "intime_date", "outtime": "outtime_date"},
}


def split_ddl(ddl: str) -> list[tuple[str, str]]:
    """``"a INT, b DECIMAL(10,4)"`` -> ``[("a", "INT"), ("b", "DECIMAL(10,4)")]``."""
    fields = ddl.replace("(10,4)", "(10;4)").split(", ")
    return [
        (name, dtype.replace(";", ","))
        for name, dtype in (field.strip().split(" ", 1) for field in fields)
    ]


def column_names(ddl: str) -> list[str]:
    return [name for name, _ in split_ddl(ddl)]
