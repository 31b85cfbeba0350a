"""SQL that computes each named query on the same tables in a relational engine.

Written independently of the DataFrame code, from the meaning of each report; used to check
results, never to compute them.
"""

from __future__ import annotations

# --- shared tables -----------------------------------------------------------------------

PATIENTS = """patients AS (
  SELECT c_custkey AS subject_id, c_mktsegment AS gender,
         CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 100 AS INTEGER) AS anchor_age,
         CASE WHEN c_acctbal < 0 THEN DATE '2005-01-01' END AS dod
  FROM customer)"""

STAYS = """lines AS (
  SELECT l_orderkey, max(l_shipdate) AS outtime, min(l_partkey) AS dx
  FROM lineitem GROUP BY l_orderkey),
stays AS (
  SELECT o_orderkey AS stay_id, o_custkey AS subject_id, o_orderkey AS hadm_id,
         o_orderpriority AS first_careunit, o_orderstatus AS last_careunit,
         CAST(o_orderdate AS TIMESTAMP) AS intime, CAST(outtime AS TIMESTAMP) AS outtime,
         dx AS diagnoses_icd_key,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(outtime AS DATE)) AS DOUBLE) AS los,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS intime_date,
         CAST(hour(o_orderdate) * 3600 + minute(o_orderdate) * 60 + second(o_orderdate)
              AS INTEGER) AS intime_time,
         CAST(strftime(outtime, '%Y%m%d') AS INTEGER) AS outtime_date,
         CAST(hour(outtime) * 3600 + minute(outtime) * 60 + second(outtime)
              AS INTEGER) AS outtime_time
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey)"""

STATUS = """flagged AS (
  SELECT s.*, CASE WHEN lower(p_name) LIKE '%widget%' THEN 'Sepsis' ELSE 'Non-Sepsis' END
         AS sepsis_status
  FROM stays s LEFT JOIN part ON p_partkey = s.diagnoses_icd_key)"""

TRIAGE = """triage AS (
  SELECT l_orderkey AS stay_id,
         CAST(35 + max(l_quantity) / 10 AS DECIMAL(10,4)) AS temperature,
         CAST(50 + max(l_quantity) AS DECIMAL(10,4)) AS heartrate,
         CAST(10 + min(l_quantity) / 2 AS DECIMAL(10,4)) AS resprate,
         CAST(100 - max(l_discount) * 100 AS DECIMAL(10,4)) AS o2sat,
         CAST(80 + min(l_quantity) AS DECIMAL(10,4)) AS sbp,
         CAST(50 + min(l_quantity) AS DECIMAL(10,4)) AS dbp,
         CAST(max(l_linenumber) AS DECIMAL(10,4)) AS acuity,
         min(l_returnflag) AS chiefcomplaint, min(l_suppkey) AS triage_subject_id
  FROM lineitem GROUP BY l_orderkey)"""

STATUS_VITALS = f"{STAYS}, {STATUS}, {TRIAGE}, " + """sv AS (
  SELECT sepsis_status, subject_id, t.* FROM flagged f JOIN triage t ON f.stay_id = t.stay_id)"""

MICRO = """micro AS (
  SELECT l_orderkey * 10 + l_linenumber AS microevent_id, l_orderkey AS hadm_id,
         l_suppkey AS spec_itemid, l_returnflag AS spec_type_desc, l_linenumber AS test_seq,
         CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS org_name,
         l_quantity AS quantity, l_extendedprice AS dilution_value, l_shipdate AS charttime,
         o_custkey AS subject_id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""

ITEMS = """items AS (
  SELECT event_type AS itemid, upper(event_type) AS label,
         CASE WHEN event_type IN ('click', 'view') THEN 'browse'
              WHEN event_type = 'error' THEN NULL ELSE 'account' END AS category,
         'unit' AS unitname,
         CASE WHEN event_type <> 'signup' THEN CAST(floor(avg(value) / 2) AS DOUBLE) END
           AS lownormalvalue,
         CASE WHEN event_type <> 'signup' THEN CAST(floor(avg(value) * 2) AS DOUBLE) END
           AS highnormalvalue
  FROM events GROUP BY event_type)"""

SERIES = """series AS (
  SELECT user_id AS stay_id, CAST(ts AS DATE) AS chart_date,
         CAST(hour(ts) AS INTEGER) AS hour_of_day, event_type, value FROM events)"""

BALANCE = f"{STAYS}, " + """ins AS (
  SELECT l_orderkey, sum(l_quantity) AS total_input_ml FROM lineitem
  WHERE l_returnflag <> 'N' GROUP BY 1),
outs AS (
  SELECT l_orderkey, sum(l_quantity) AS total_output_ml FROM lineitem
  WHERE l_returnflag = 'N' GROUP BY 1),
balance AS (
  SELECT stay_id, subject_id, intime, outtime, total_input_ml, total_output_ml,
         coalesce(total_input_ml, 0) - coalesce(total_output_ml, 0) AS fluid_balance_ml
  FROM stays LEFT JOIN ins ON ins.l_orderkey = stay_id
       LEFT JOIN outs ON outs.l_orderkey = stay_id)"""

LAST = f"{BALANCE}, {PATIENTS}, " + """latest AS (
  SELECT * FROM balance
  QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY intime DESC, stay_id DESC) = 1),
last_stay AS (
  SELECT latest.*, dod, anchor_age,
         CASE WHEN fluid_balance_ml > 0 THEN 'Positive' ELSE 'Negative' END AS fluid_balance_group,
         CASE WHEN dod IS NULL THEN 'Alive' ELSE 'Dead' END AS mortality
  FROM latest LEFT JOIN patients USING (subject_id))"""

DIAGNOSES = """dxe AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, l_linenumber AS seq_num,
         p_brand AS icd_code, p_size AS icd_version, p_name AS long_title
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""


# --- 32-bit hash used by the samples -----------------------------------------------------


def _rotl(x: str, r: int) -> str:
    return f"((({x} << {r}) | ({x} >> {32 - r})) & 4294967295::UBIGINT)"


def hash_steps(words: list[str], length: int, start: str, tag: str) -> tuple[list[str], str]:
    """Select-list steps of the 32-bit Murmur3 hash of the given 32-bit words."""
    steps, h = [], start

    def step(name: str, expr: str) -> str:
        steps.append(f"{expr} AS {tag}{name}")
        return f"{tag}{name}"

    for i, word in enumerate(words):
        k = step(f"a{i}", f"({word} * 3432918353::UBIGINT) % 4294967296::UBIGINT")
        k = step(f"b{i}", _rotl(k, 15))
        k = step(f"c{i}", f"({k} * 461845907::UBIGINT) % 4294967296::UBIGINT")
        h = step(f"d{i}", f"xor({h}, {k})")
        h = step(f"e{i}", _rotl(h, 13))
        h = step(f"f{i}", f"({h} * 5::UBIGINT + 3864292196::UBIGINT) % 4294967296::UBIGINT")
    h = step("g", f"xor({h}, {length}::UBIGINT)")
    h = step("h", f"xor({h}, {h} >> 16)")
    h = step("i", f"({h} * 2246822507::UBIGINT) % 4294967296::UBIGINT")
    h = step("j", f"xor({h}, {h} >> 13)")
    h = step("k", f"({h} * 3266489909::UBIGINT) % 4294967296::UBIGINT")
    h = step("l", f"xor({h}, {h} >> 16)")
    return steps, h


def _long_words(col: str) -> list[str]:
    return [f"({col}::UBIGINT & 4294967295::UBIGINT)", f"({col}::UBIGINT >> 32)"]


def _hashed(source: str, keys: list[tuple[str, str]]) -> str:
    """``source`` rows with their unsigned hash ``u`` over ``(kind, column)`` keys, seed 42."""
    steps, h = [], "42::UBIGINT"
    for i, (kind, col) in enumerate(keys):
        words = [f"({col})::UBIGINT"] if kind == "int" else _long_words(col)
        more, h = hash_steps(words, 4 * len(words), h, f"h{i}")
        steps += more
    for step in steps:
        source = f"(SELECT *, {step} FROM {source})"
    return f"SELECT *, {h} AS u FROM {source}"



def _draw(rate: float) -> str:
    return f"((u + 2147483648::UBIGINT) % 4294967296::UBIGINT) < {int(rate * (1 << 32))}::UBIGINT"


EVENT_COLUMNS = (
    "event_id, user_id AS stay_id, ts AS charttime, event_type AS itemid, value AS valuenum"
)


def _sample(keys: list[tuple[str, str]], rate: float) -> str:
    return f"SELECT {EVENT_COLUMNS} FROM ({_hashed('events', keys)}) WHERE {_draw(rate)}"


CRITICAL = f"""WITH {ITEMS}, flagged AS (
  SELECT event_id, e.event_type AS itemid, value AS valuenum,
         (value < lownormalvalue OR value > highnormalvalue) AS is_critical
  FROM events e LEFT JOIN items i ON i.itemid = e.event_type)
SELECT event_id, itemid, valuenum, is_critical
FROM ({_hashed('flagged', [('int', '42'), ('long', 'event_id')])})
WHERE coalesce(is_critical, false) OR {_draw(0.1)}"""


# --- features ----------------------------------------------------------------------------

_VITALS = {"heart_rate": "click", "sbp": "view", "spo2": "purchase", "resp_rate": "error",
           "temperature": "signup"}
_WORDS = {"has_sepsis": "widget", "has_heart_failure": "gizmo", "has_pneumonia": "bolt",
          "has_resp_failure": "ring"}


def _vital_columns() -> str:
    out = []
    for name, fn in (("mean", "avg"), ("min", "min"), ("max", "max")):
        for vital, kind in _VITALS.items():
            out.append(f"{fn}(CASE WHEN event_type = '{kind}' THEN value END) AS {name}_{vital}")
    return ", ".join(out)


_FLAGS = ", ".join(
    f"max(CASE WHEN lower(long_title) LIKE '%{w}%' THEN 1 ELSE 0 END) AS {n}"
    for n, w in _WORDS.items()
)

FEATURES = f"""{PATIENTS}, {DIAGNOSES}, spans AS (
  SELECT user_id AS stay_id, min(ts) AS intime FROM events GROUP BY 1),
vitals AS (
  SELECT stay_id, {_vital_columns()} FROM events JOIN spans ON user_id = stay_id
  WHERE ts < intime + INTERVAL 24 HOUR GROUP BY stay_id),
dx AS (SELECT subject_id, count(*) AS dx_count, {_FLAGS} FROM dxe GROUP BY subject_id),
features AS (
  SELECT s.stay_id, s.stay_id AS subject_id, anchor_age AS age,
         CASE WHEN gender = 'BUILDING' THEN 1 ELSE 0 END AS is_male,
         CASE WHEN lower(gender) LIKE '%machinery%' THEN 1 ELSE 0 END AS is_emergency,
         v.* EXCLUDE (stay_id), coalesce(dx_count, 0) AS dx_count,
         {', '.join(f'coalesce({n}, 0) AS {n}' for n in _WORDS)},
         CASE WHEN mean_sbp > 0 THEN mean_heart_rate / mean_sbp ELSE 0.0 END AS shock_index
  FROM spans s LEFT JOIN patients p ON p.subject_id = s.stay_id
       LEFT JOIN vitals v ON v.stay_id = s.stay_id LEFT JOIN dx ON dx.subject_id = s.stay_id),
reasons AS (
  SELECT stay_id, list_filter([
           CASE WHEN dx_count > 10 THEN 'multimorbidity' END,
           CASE WHEN has_sepsis = 1 THEN 'sepsis' END,
           CASE WHEN shock_index > 0.9 THEN 'hemodynamic_instability' END,
           CASE WHEN is_emergency = 1 THEN 'emergency_admission' END],
           lambda x: x IS NOT NULL) AS found FROM features),
named AS (
  SELECT stay_id, CASE WHEN len(found) > 0 THEN found ELSE ['stable'] END AS reasons
  FROM reasons),
logits AS (
  SELECT *, -4.0 + coalesce(age, 0) * 0.03 + has_sepsis * 0.8 + coalesce(shock_index, 0) * 0.5
              + dx_count * 0.005 AS zm,
         -1.0 + coalesce(age, 0) * 0.01 + dx_count * 0.01 + is_emergency * 0.4 AS zr,
         0.2 + has_sepsis * 0.4 + coalesce(mean_resp_rate, 0) * 0.002 AS z0,
         0.4 + has_pneumonia * 0.2 AS z1,
         0.6 + is_male * 0.1 + coalesce(age, 0) * -0.004 AS z2 FROM features),
scored AS (
  SELECT *, 1 / (1 + exp(-zm)) AS mp, 1 / (1 + exp(-zr)) AS rp,
         CASE WHEN z0 >= greatest(z1, z2) THEN 0 WHEN z1 >= z2 THEN 1 ELSE 2 END AS stay_class,
         exp(greatest(z0, z1, z2)) / (exp(z0) + exp(z1) + exp(z2)) AS conf FROM logits)"""

_ROUNDED = [f"{n}_{v}" for n in ("mean", "min", "max") for v in _VITALS] + ["shock_index"]
_PLAIN = ["stay_id", "subject_id", "age", "is_male", "is_emergency", *_WORDS]

CLEANED = """SELECT user_id AS subject_id, user_id AS stay_id, event_type AS itemid,
  ts AS charttime, CASE WHEN event_type = 'signup' THEN NULL ELSE props END AS value,
  value AS valuenum, CASE WHEN event_type = 'signup' THEN NULL ELSE 'unit' END AS valueuom,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS warning
FROM events WHERE value >= 1"""

_STAT_VITALS = ("temperature", "heartrate", "resprate", "o2sat")


def _pct(rule: str, name: str) -> str:
    hits = f"count(CASE WHEN {rule} THEN 1 END)"
    return (
        f"{hits} AS {name}_count, "
        f"CAST(round(CAST(100.0 * {hits} / count(*) AS DOUBLE), 1) AS DOUBLE) AS {name}_pct"
    )


_COMPARE = f"""WITH {STATUS_VITALS}, compared AS (
  SELECT sepsis_status, count(DISTINCT subject_id) AS patient_count,
    round(avg(temperature), 1) AS avg_temperature, round(avg(heartrate), 0) AS avg_heartrate,
    round(avg(resprate), 0) AS avg_resprate, round(avg(o2sat), 1) AS avg_o2sat,
    round(avg(sbp), 0) AS avg_sbp, round(avg(dbp), 0) AS avg_dbp,
    round(avg(acuity), 1) AS avg_acuity,
    round(stddev_samp(CAST(temperature AS DOUBLE)), 2) AS std_temperature,
    round(stddev_samp(CAST(heartrate AS DOUBLE)), 1) AS std_heartrate,
    round(stddev_samp(CAST(resprate AS DOUBLE)), 1) AS std_resprate,
    round(stddev_samp(CAST(o2sat AS DOUBLE)), 2) AS std_o2sat
  FROM sv GROUP BY sepsis_status)"""

_METRICS = {"Temperature (°C)": "avg_temperature", "Heart Rate (bpm)": "avg_heartrate",
            "Resp Rate (breaths/min)": "avg_resprate", "O2 Sat (%)": "avg_o2sat",
            "Systolic BP (mmHg)": "avg_sbp", "Diastolic BP (mmHg)": "avg_dbp"}


def _aligned(keys: str) -> str:
    return f"""WITH {SERIES}, a AS (
  SELECT {keys}, avg(value) AS x FROM series WHERE event_type = 'click' GROUP BY ALL),
b AS (SELECT {keys}, avg(value) AS y FROM series WHERE event_type = 'view' GROUP BY ALL)
SELECT {keys}, round(x, 6) AS hr_avg, round(y, 6) AS spo2_avg FROM a JOIN b USING ({keys})"""


CHECKS: dict[str, str] = {
    "stays_calendar": f"""WITH {STAYS} SELECT stay_id, subject_id, hadm_id, first_careunit,
        last_careunit, los, diagnoses_icd_key, intime_date, intime_time, outtime_date,
        outtime_time, intime_date AS date_key, CAST(intime AS DATE) AS full_date,
        CAST(extract(day FROM intime) AS INTEGER) AS day,
        CAST(extract(week FROM intime) AS INTEGER) AS week,
        CAST(extract(month FROM intime) AS INTEGER) AS month,
        CAST(extract(quarter FROM intime) AS INTEGER) AS quarter,
        CAST(extract(year FROM intime) AS INTEGER) AS year FROM stays""",
    "stays_by_year": f"""WITH {STAYS} SELECT CAST(extract(year FROM intime) AS INTEGER) AS year,
        count(DISTINCT stay_id) AS stay_count FROM stays GROUP BY 1""",
    "stays_by_unit": """SELECT o_orderpriority AS first_careunit,
        count(DISTINCT o_orderkey) AS stay_count FROM orders
        WHERE o_orderpriority IS NOT NULL GROUP BY 1""",
    "stays_by_segment": """SELECT c_mktsegment AS gender, count(DISTINCT o_orderkey) AS stay_count
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment IS NOT NULL GROUP BY 1""",
    "top10_codes": f"""WITH {STAYS} SELECT p_brand AS icd_code, p_name AS long_title,
        count(DISTINCT stay_id) AS stay_count FROM stays JOIN part
        ON diagnoses_icd_key = p_partkey GROUP BY 1, 2
        ORDER BY stay_count DESC, icd_code, long_title LIMIT 10""",
    "aligned_hourly": _aligned("stay_id, chart_date, hour_of_day"),
    "aligned_daily": _aligned("stay_id, chart_date"),
    "hourly_vitals": f"""WITH {SERIES} SELECT stay_id, chart_date, hour_of_day,
        round(avg(value), 6) AS avg_value, max(value) AS max_value, min(value) AS min_value,
        count(*) AS n_obs FROM series WHERE event_type = 'click' GROUP BY 1, 2, 3""",
    "ed_triage_left": f"""WITH {TRIAGE} SELECT o_orderkey AS stay_id, o_custkey AS ed_subject_id,
        o_orderstatus AS gender, o_orderpriority AS race, o_orderpriority AS arrival_transport,
        o_orderstatus AS disposition, triage_subject_id, temperature, heartrate, resprate, o2sat, sbp, dbp, acuity
        FROM orders LEFT JOIN triage ON stay_id = o_orderkey""",
    "stay_duration": f"""WITH {STAYS} SELECT stay_id,
        CAST(epoch(outtime) - epoch(intime) AS BIGINT) AS stay_duration_seconds FROM stays""",
    "monitored_duration": """SELECT user_id AS stay_id,
        CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts)))
             AS BIGINT) AS stay_duration_seconds FROM events GROUP BY 1""",
    "sepsis_flag": f"""WITH {STAYS}, {STATUS} SELECT stay_id, subject_id, los, first_careunit,
        last_careunit, CASE sepsis_status WHEN 'Sepsis' THEN 1 ELSE 0 END AS sepsis_flag
        FROM flagged""",
    "sepsis_micro_flag": f"""WITH {STAYS}, {STATUS}, {MICRO} SELECT stay_id, subject_id, los,
        first_careunit, last_careunit,
        CASE sepsis_status WHEN 'Sepsis' THEN 1 ELSE 0 END AS sepsis_flag,
        CASE WHEN subject_id IN (SELECT subject_id FROM micro) THEN 1 ELSE 0 END
          AS has_micro_event FROM flagged""",
    "sepsis_count": f"""WITH {STAYS}, {STATUS} SELECT sepsis_status,
        count(DISTINCT subject_id) AS patient_count FROM flagged GROUP BY 1""",
    "vitals_stats": f"""WITH {STATUS_VITALS} SELECT sepsis_status,
        count(DISTINCT subject_id) AS patient_count, """
    + ", ".join(
        f"round(avg({v}), 6) AS avg_{v}, CAST(min({v}) AS DOUBLE) AS min_{v}, "
        f"CAST(max({v}) AS DOUBLE) AS max_{v}"
        for v in _STAT_VITALS
    )
    + """, round(avg(sbp), 6) AS avg_sbp, round(avg(dbp), 6) AS avg_dbp,
        round(avg(acuity), 6) AS avg_acuity
        FROM sv WHERE temperature IS NOT NULL GROUP BY 1""",
    "vitals_compare": f"{_COMPARE} SELECT * FROM compared",
    "vitals_transposed": f"{_COMPARE} "
    + " UNION ALL ".join(
        f"SELECT '{label}' AS metric, "
        f"max(CASE WHEN sepsis_status = 'Non-Sepsis' THEN {c} END) AS non_sepsis, "
        f"max(CASE WHEN sepsis_status = 'Sepsis' THEN {c} END) AS sepsis FROM compared"
        for label, c in _METRICS.items()
    ),
    "complaints_by_status": f"""WITH {STATUS_VITALS} SELECT sepsis_status, chiefcomplaint,
        count(*) AS complaint_count FROM sv WHERE chiefcomplaint IS NOT NULL GROUP BY 1, 2""",
    "abnormal_vitals": f"""WITH {STATUS_VITALS} SELECT sepsis_status,
        count(*) AS total_patients, {_pct('temperature > 38.0 OR temperature < 36.0',
        'abnormal_temp')}, {_pct('heartrate > 100', 'tachycardia')},
        {_pct('resprate > 20', 'tachypnea')}, {_pct('o2sat < 95', 'low_o2')},
        {_pct('sbp < 90', 'hypotension')} FROM sv GROUP BY 1""",
    "demographics": f"""WITH {PATIENTS} SELECT gender, count(*) AS patient_count,
        round(avg(anchor_age), 6) AS avg_age, min(anchor_age) AS min_age,
        max(anchor_age) AS max_age FROM patients GROUP BY 1""",
    "los_median": f"""WITH {STAYS} SELECT last_careunit, count(*) AS admission_count,
        round(avg(los), 6) AS avg_los, min(los) AS min_los, max(los) AS max_los,
        quantile_cont(los, 0.5) AS median_los FROM stays GROUP BY 1""",
    "micro_with_stays": f"""WITH {STAYS}, {MICRO} SELECT m.*, stay_id, first_careunit, los
        FROM micro m LEFT JOIN stays s ON m.subject_id = s.subject_id AND m.hadm_id = s.hadm_id
        WHERE org_name IS NOT NULL""",
    "micro_complete": f"""WITH {STAYS}, {MICRO} SELECT m.*, stay_id, first_careunit, los
        FROM micro m LEFT JOIN stays s ON m.subject_id = s.subject_id AND m.hadm_id = s.hadm_id
        WHERE microevent_id IS NOT NULL AND m.hadm_id IS NOT NULL AND spec_itemid IS NOT NULL
        AND spec_type_desc IS NOT NULL AND test_seq IS NOT NULL AND org_name IS NOT NULL
        AND quantity IS NOT NULL AND dilution_value IS NOT NULL AND charttime IS NOT NULL
        AND m.subject_id IS NOT NULL""",
    "items_listing": f"WITH {ITEMS} SELECT * FROM items",
    "items_in_category": f"WITH {ITEMS} SELECT * FROM items WHERE category = 'account'",
    "item_categories": f"""WITH {ITEMS} SELECT DISTINCT category FROM items
        WHERE category IS NOT NULL""",
    "fluid_balance": f"WITH {BALANCE} SELECT * FROM balance",
    "fluid_balance_strict": f"""WITH {BALANCE} SELECT * REPLACE
        (total_input_ml - total_output_ml AS fluid_balance_ml) FROM balance""",
    "last_stay": f"""WITH {LAST} SELECT stay_id, subject_id, intime, outtime, total_input_ml,
        total_output_ml, fluid_balance_ml, dod FROM last_stay""",
    "mortality_by_balance": f"""WITH {LAST} SELECT fluid_balance_group, mortality,
        count(subject_id) AS subject_count FROM last_stay GROUP BY 1, 2""",
    "mortality_by_age": f"""WITH {LAST} SELECT CASE WHEN anchor_age < 18 THEN 'Under 18'
        WHEN anchor_age < 40 THEN '18–39' WHEN anchor_age < 65 THEN '40–64'
        WHEN anchor_age < 90 THEN '65–89' ELSE '90+' END AS age_group, fluid_balance_group,
        mortality, count(DISTINCT subject_id) AS subject_count FROM last_stay GROUP BY 1, 2, 3""",
    "ols_pair": f"""SELECT round(regr_slope(spo2_avg, hr_avg), 6) AS slope,
        round(regr_intercept(spo2_avg, hr_avg), 6) AS intercept,
        round(regr_r2(spo2_avg, hr_avg), 6) AS r2, count(*) AS n
        FROM ({_aligned('stay_id, chart_date, hour_of_day')})""",
    "ols_triage": f"""WITH {TRIAGE}, pairs AS (
        SELECT CAST(heartrate AS DOUBLE) AS y, CAST(acuity AS DOUBLE) AS x FROM orders
        JOIN triage ON stay_id = o_orderkey WHERE heartrate IS NOT NULL AND acuity IS NOT NULL)
        SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
        round(regr_r2(y, x), 6) AS r2, count(*) AS n FROM pairs""",
    "date_dim_span": f"""WITH {STAYS}, span AS (
        SELECT CAST(least(min(intime), min(outtime)) AS DATE) AS lo,
               CAST(greatest(max(intime), max(outtime)) AS DATE) AS hi FROM stays),
        days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
                 FROM span)
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(extract(day FROM d) AS INTEGER) AS day, CAST(extract(week FROM d) AS INTEGER) AS week,
        CAST(extract(month FROM d) AS INTEGER) AS month,
        CAST(extract(quarter FROM d) AS INTEGER) AS quarter,
        CAST(extract(year FROM d) AS INTEGER) AS year FROM days""",
    "date_attributes": """SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
        CAST(extract(quarter FROM o_orderdate) AS INTEGER) AS quarter,
        CAST(extract(month FROM o_orderdate) AS INTEGER) AS month,
        CAST(extract(week FROM o_orderdate) AS INTEGER) AS week,
        count(*) AS admissions FROM orders GROUP BY 1, 2, 3, 4""",
    "time_dim_hits": """SELECT count(*) AS events,
        CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS time_key,
        strftime(date_trunc('second', ts), '%H:%M:%S') AS time_value,
        CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
        CAST(second(ts) AS INTEGER) AS second FROM events GROUP BY ALL""",
    "calendar_keys": """SELECT event_id,
        CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS charttime_date,
        CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS charttime_time
        FROM events""",
    "keys_roundtrip": """SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP)
        AS charttime_second FROM events""",
    "admission_dim": f"""WITH {STAYS} SELECT hadm_id, subject_id, first_careunit, intime_date,
        intime_time, outtime_date, outtime_time FROM stays""",
    "diagnosis_dim": """WITH coded AS (
        SELECT l_linenumber AS seq_num, p_brand AS icd_code, p_size AS icd_version
        FROM lineitem JOIN part ON p_partkey = l_partkey)
        SELECT CAST(min(seq_num) AS INTEGER) AS seq_num,
        p_brand AS icd_code, p_size AS icd_version, p_name AS long_title
        FROM coded JOIN part ON p_brand = icd_code AND p_size = icd_version
        GROUP BY p_brand, p_size, p_name""",
    "diagnosis_key": f"""WITH {DIAGNOSES}, first_dx AS (
        SELECT hadm_id, icd_code, icd_version FROM dxe QUALIFY row_number() OVER
        (PARTITION BY hadm_id ORDER BY seq_num, icd_code, icd_version) = 1),
        titles AS (SELECT p_brand, p_size, min(p_name) AS long_title FROM part GROUP BY 1, 2)
        SELECT o_orderkey AS stay_id, icd_code, icd_version, long_title,
        icd_code IS NOT NULL AS resolved FROM orders LEFT JOIN first_dx ON hadm_id = o_orderkey
        LEFT JOIN titles ON p_brand = icd_code AND p_size = icd_version""",
    "clean_events": CLEANED,
    "dedup_micro": f"""WITH {MICRO} SELECT microevent_id, subject_id, charttime, spec_itemid,
        quantity, dilution_value FROM micro QUALIFY row_number() OVER (PARTITION BY microevent_id
        ORDER BY charttime, spec_itemid, quantity, dilution_value) = 1""",
    "json_roundtrip": """SELECT event_id, user_id AS stay_id,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS charttime, event_type AS itemid,
        value AS valuenum, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "json_bad_rows": """SELECT CASE event_type WHEN 'error' THEN 'malformed' ELSE event_type END
        AS itemid, count(*) AS n FROM events GROUP BY 1""",
    "message_keys": """SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages
        FROM events GROUP BY 1""",
    "delivery_counters": """SELECT count(*) FILTER (lang = 'en') AS messages_sent,
        count(*) FILTER (lang <> 'en') AS messages_failed,
        CAST(sum(CASE WHEN lang = 'en' THEN strlen(text) END) AS BIGINT) AS bytes_sent
        FROM documents""",
    "normalise_rows": """SELECT event_id, CAST(user_id AS INTEGER) AS stay_id,
        CASE WHEN event_type <> 'signup' THEN value END AS valuenum,
        CASE WHEN event_type <> 'error' THEN upper(event_type) END AS label,
        CASE WHEN event_type = 'view' THEN 'not a time'
             ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') END AS charttime,
        CAST(NULL AS VARCHAR) AS note FROM events""",
    "iso_times": """SELECT event_id, CASE WHEN date_trunc('second', ts) = ts
        THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
        AS iso FROM events""",
    "validation_split": f"""WITH {STAYS} SELECT stay_id, los,
        CASE WHEN los >= 0 THEN 1 ELSE 0 END AS valid FROM stays""",
    "out_of_range": f"""WITH {ITEMS} SELECT event_id, event_type AS itemid, label,
        value AS valuenum, (value < lownormalvalue OR value > highnormalvalue) AS is_critical
        FROM events LEFT JOIN items ON itemid = event_type""",
    "not_null_gate": f"""WITH {STAYS} SELECT stay_id, concat_ws(',',
        CASE WHEN subject_id IS NULL THEN 'subject_id' END,
        CASE WHEN outtime_date IS NULL THEN 'outtime_date' END,
        CASE WHEN diagnoses_icd_key IS NULL THEN 'diagnoses_icd_key' END) AS missing FROM stays
        WHERE subject_id IS NULL OR outtime_date IS NULL OR diagnoses_icd_key IS NULL""",
    "pk_violations": f"""WITH {MICRO} SELECT microevent_id, count(*) AS row_count FROM micro
        GROUP BY 1 HAVING count(*) > 1 OR microevent_id IS NULL""",
    "fk_violations": f"""WITH {PATIENTS} SELECT o_custkey AS subject_id, o_orderkey AS stay_id
        FROM orders WHERE o_custkey IS NOT NULL
        AND o_custkey NOT IN (SELECT subject_id FROM patients WHERE dod IS NULL)""",
    "fk_violation_counts": f"""WITH {PATIENTS} SELECT o_custkey AS subject_id,
        count(*) AS row_count FROM orders WHERE o_custkey NOT IN
        (SELECT subject_id FROM patients WHERE dod IS NULL) GROUP BY 1""",
    "fk_valid": f"""WITH {PATIENTS} SELECT o_custkey AS subject_id, o_orderkey AS stay_id
        FROM orders WHERE o_custkey IN (SELECT subject_id FROM patients WHERE dod IS NULL)""",
    "insert_absent": """SELECT o_orderkey AS stay_id, o_custkey AS subject_id,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS intime_date
        FROM orders""",
    "load_report": f"""WITH {MICRO}, counted AS (
        SELECT 'micro' AS table_name, count(*) AS r, count(DISTINCT microevent_id) AS k FROM micro
        UNION ALL SELECT 'stays', count(*), count(DISTINCT o_orderkey) FROM orders)
        SELECT table_name, r AS rows_read, k AS rows_kept, r - k AS duplicates,
        CAST(0 AS BIGINT) AS incomplete_keys,
        CAST(round(CAST(100.0 * k / r AS DOUBLE), 2) AS DOUBLE) AS kept_pct FROM counted""",
    "dim_counts": """SELECT 'patients' AS table_name, count(*) AS record_count FROM customer
        UNION ALL SELECT 'diagnoses', count(*) FROM part
        UNION ALL SELECT 'stays', count(*) FROM orders
        UNION ALL SELECT 'items', count(DISTINCT event_type) FROM events""",
    "dim_samples": f"WITH {PATIENTS} SELECT * FROM patients ORDER BY subject_id LIMIT 5",
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM (DESCRIBE {t})) AS column_count, "
        f"count(*) AS row_count FROM {t}"
        for t in (
            "region nation customer supplier part orders lineitem events documents embeddings "
            "pages benchmark labels conversations"
        ).split()
    ),
    "table_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value "
        "FROM events"
        for c, t in (
            ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
            ("event_type", "string"), ("value", "double"), ("props", "string"),
        )
    ),
    "sql_on_views": f"""WITH {STAYS} SELECT last_careunit, count(*) AS long_stays FROM stays
        WHERE los > 30 GROUP BY 1""",
    "incremental_window": """SELECT event_id, ts AS charttime FROM events
        WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""",
    "incremental_load": """SELECT user_id AS subject_id, user_id AS hadm_id, user_id AS stay_id,
        CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS charttime_date,
        CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS charttime_time,
        event_type AS itemid, props AS value, value AS valuenum,
        CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS warning FROM events""",
    "sample_uniform": _sample([("int", "42"), ("long", "event_id")], 0.1),
    "sample_critical": CRITICAL,
    "sample_hash": f"""SELECT {EVENT_COLUMNS} FROM ({_hashed('events', [('long', 'user_id')])})
        WHERE CASE WHEN u >= 2147483648 THEN 4294967296 - u ELSE u END % 10 = 0""",
    "sample_stratified": _sample(
        [
            ("int", "42"),
            ("int", "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))"),
            ("long", "event_id"),
        ],
        0.1,
    ),
    "sample_random": _sample([("int", "7"), ("long", "event_id")], 0.25),
    "sample_systematic": f"""SELECT {EVENT_COLUMNS} FROM events
        QUALIFY row_number() OVER (ORDER BY ts, event_id) % 10 = 0""",
    "stay_features": f"""WITH {FEATURES} SELECT {', '.join(_PLAIN)}, dx_count,
        {', '.join(f'round({c}, 6) AS {c}' for c in _ROUNDED)} FROM features""",
    "aligned_features": f"""WITH {FEATURES} SELECT stay_id,
        round(CAST(coalesce(age, 0) AS DOUBLE), 6) AS age,
        round(coalesce(mean_heart_rate, 0), 6) AS mean_heart_rate,
        round(coalesce(shock_index, 0), 6) AS shock_index, CAST(0 AS DOUBLE) AS age_group
        FROM features""",
    "risk_report": f"""WITH {FEATURES} SELECT stay_id, round(mp, 6) AS mortality_prob,
        CASE WHEN mp > 0.5 THEN 'high' WHEN mp > 0.2 THEN 'medium' ELSE 'low' END
          AS mortality_tier,
        round(rp, 6) AS readmission_prob,
        CASE WHEN rp > 0.5 THEN 'high' ELSE 'low' END AS readmission_tier,
        CAST(stay_class AS INTEGER) AS stay_class,
        CASE stay_class WHEN 0 THEN 'LONG STAY (>7 days)' WHEN 1 THEN 'MEDIUM (3-7 days)'
          ELSE 'SHORT (<3 days)' END AS stay_label,
        round(conf, 6) AS stay_confidence, array_to_string(reasons, ',') AS reasons
        FROM scored JOIN named USING (stay_id)""",
    "reason_counts": f"""WITH {FEATURES}, each AS (SELECT unnest(reasons) AS reason FROM named)
        SELECT reason, count(*) AS stays FROM each GROUP BY 1""",
    "trained_risk": f"""WITH {FEATURES}, labelled AS (
        SELECT f.*, CASE WHEN p.dod IS NULL THEN 0.0 ELSE 1.0 END AS died
        FROM features f LEFT JOIN patients p ON p.subject_id = f.stay_id)
        """ + " UNION ALL ".join(
        f"SELECT '{t}' AS term, round(avg(CAST(died * {x} AS DOUBLE)), 4) AS mean FROM labelled"
        for t, x in [("constant", "1"), *[(n, f"coalesce({n}, 0)") for n in (
            "age", "dx_count", "mean_heart_rate", "mean_sbp", "shock_index")]]
    ),
    "stream_bronze_silver": """SELECT event_id, user_id AS stay_id, ts AS charttime,
        event_type AS itemid, value AS valuenum, 'unit' AS valueuom,
        CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS warning FROM events""",
    "stream_quarantine": """SELECT 'bronze' AS table_name,
        2 * count(*) FILTER (event_type <> 'error') AS record_count FROM events
        UNION ALL SELECT 'quarantine', 2 * count(*) FILTER (event_type = 'error') FROM events""",
    "stream_enrich": CRITICAL,
    "stream_monitor": """SELECT count(*) AS total_rows, count(*) AS row_count,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest_time FROM events""",
}

# --- models of the stay class ------------------------------------------------------------

_TERMS = ("age", "dx_count", "heartrate", "sbp", "o2sat", "acuity")
STAY_CLASSES = f"""{PATIENTS}, {STAYS}, {TRIAGE}, coded AS (
  SELECT l_orderkey, count(*) AS dx_count FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1),
classed AS (
  SELECT s.stay_id, CASE WHEN los > 1000 THEN 0 WHEN los >= 300 THEN 1 WHEN los IS NOT NULL THEN 2 END AS y,
         {', '.join(f'coalesce(CAST({x} AS DOUBLE), 0.0) AS {n}' for n, x in zip(
             _TERMS, ('anchor_age', 'c.dx_count', *_TERMS[2:]), strict=True))}
  FROM stays s LEFT JOIN patients p ON p.subject_id = s.subject_id
  LEFT JOIN triage t ON t.stay_id = s.stay_id LEFT JOIN coded c ON c.l_orderkey = s.stay_id)"""

CHECKS["trained_stay_class"] = f"WITH {STAY_CLASSES} " + " UNION ALL ".join(
    f"""SELECT CAST({k} AS INTEGER) AS stay_class, '{t}' AS term,
        round(avg(CASE WHEN y = {k} THEN {x} ELSE 0.0 END), 4) AS mean FROM classed WHERE y IS NOT NULL"""
    for k in range(3)
    for t, x in [("constant", "1.0"), *[(n, n) for n in _TERMS]]
)


def _boost(rounds: int, rate: float) -> str:
    """Newton boosting of three classes with trees of one split, every cut tried."""
    ks = range(3)
    ctes = ["m_0 AS (SELECT *, 0.0::DOUBLE AS m0, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2 FROM classed)"]
    total = "(exp(m0) + exp(m1) + exp(m2))"
    picked = {k: f"CASE f{k} " + " ".join(f"WHEN '{n}' THEN {n}" for n in _TERMS) + " END" for k in ks}
    values = ", ".join("{'f': '%s', 'v': %s}" % (n, n) for n in _TERMS)
    for r in range(rounds):
        ctes.append(f"p_{r} AS (SELECT *, {', '.join(f'exp(m{k}) / {total} AS p{k}' for k in ks)} FROM m_{r})")
        grads = ", ".join(
            f"(y = {k})::DOUBLE - p{k} AS g{k}, greatest(p{k} * (1 - p{k}), 1e-6) AS h{k}" for k in ks
        )
        sums = ", ".join(f"sum(g{k}) AS g{k}, sum(h{k}) AS h{k}" for k in ks)
        ctes.append(
            f"""v_{r} AS (SELECT f, v, {sums} FROM (
              SELECT unnest([{values}], recursive := true), {grads} FROM p_{r} WHERE y IS NOT NULL) GROUP BY f, v)"""
        )
        below = ", ".join(
            f"sum(g{k}) OVER w AS a{k}, sum(h{k}) OVER w AS b{k}, sum(g{k}) OVER (PARTITION BY f) AS c{k}, "
            f"sum(h{k}) OVER (PARTITION BY f) AS d{k}"
            for k in ks
        )
        ctes.append(f"c_{r} AS (SELECT f, (v + lead(v) OVER w) / 2 AS cut, {below} FROM v_{r} WINDOW w AS (PARTITION BY f ORDER BY v))")
        gain = {k: f"a{k} * a{k} / b{k} + (c{k} - a{k}) * (c{k} - a{k}) / (d{k} - b{k})" for k in ks}
        best = ", ".join(
            f"arg_max(f, {gain[k]}) AS f{k}, arg_max(cut, {gain[k]}) AS t{k}, arg_max(a{k} / b{k}, {gain[k]}) AS l{k}, "
            f"arg_max((c{k} - a{k}) / (d{k} - b{k}), {gain[k]}) AS r{k}"
            for k in ks
        )
        ctes.append(f"b_{r} AS (SELECT {best} FROM c_{r} WHERE cut IS NOT NULL)")
        moved = ", ".join(f"m{k} + {rate} * CASE WHEN {picked[k]} <= t{k} THEN l{k} ELSE r{k} END AS m{k}" for k in ks)
        ctes.append(f"m_{r + 1} AS (SELECT stay_id, y, {', '.join(_TERMS)}, {moved} FROM p_{r}, b_{r})")
    chosen = "CASE WHEN m0 >= m1 AND m0 >= m2 THEN 0 WHEN m1 >= m2 THEN 1 ELSE 2 END"
    probs = ", ".join(f"round(exp(m{k}) / {total}, 6) AS prob_{k}" for k in ks)
    return f"WITH {STAY_CLASSES}, {', '.join(ctes)} SELECT stay_id, CAST({chosen} AS INTEGER) AS predicted_class, {probs} FROM m_{rounds}"


CHECKS["boosted_stay_class"] = _boost(3, 0.5)

# --- loads of the registered specs -------------------------------------------------------


def _keys(times: dict[str, str]) -> str:
    return ", ".join(
        f"CAST(strftime({x}, '%Y%m%d') AS INTEGER) AS {n}_date, "
        f"CAST(hour({x}) * 3600 + minute({x}) * 60 + second({x}) AS INTEGER) AS {n}_time"
        for n, x in times.items()
    )


ADMISSIONS = """adm AS (
  SELECT o.*, CAST(o_orderdate AS TIMESTAMP) AS t0, CAST(outtime AS TIMESTAMP) AS t1
  FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS outtime FROM lineitem GROUP BY 1)
       ON o_orderkey = l_orderkey)"""
MICRO_ROWS = """micro_rows AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS INTEGER) AS microevent_id,
         CAST(o_custkey AS INTEGER) AS subject_id, CAST(l_orderkey AS INTEGER) AS hadm_id,
         CAST(l_shipdate AS TIMESTAMP) AS charttime, lineitem.*
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber < 7
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate, l_suppkey, l_quantity, l_extendedprice) = 1)"""
CHECKS |= {
    "load_dim_admission": f"""WITH {ADMISSIONS} SELECT CAST(o_orderkey AS INTEGER) AS hadm_id,
        CAST(o_custkey AS INTEGER) AS subject_id, """ + _keys({
            "admittime": "t0", "dischtime": "t1",
            "deathtime": "CASE WHEN o_orderstatus = 'F' THEN t1 END",
            "edregtime": "(t0 - INTERVAL 2 HOUR)", "edouttime": "(t0 - INTERVAL 30 SECOND)",
        }) + """, o_orderpriority AS admission_type,
        'P' || CAST(o_custkey AS VARCHAR) AS admit_provider_id,
        o_orderstatus AS admission_location, CAST(NULL AS VARCHAR) AS discharge_location,
        'Other' AS insurance, 'EN' AS language, CAST(NULL AS VARCHAR) AS marital_status,
        o_orderpriority AS race,
        CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS SMALLINT) AS hospital_expire_flag
        FROM adm""",
    "load_dim_diagnoses": f"""WITH {DIAGNOSES}, low AS (
        SELECT icd_code, icd_version, CAST(min(seq_num) AS INTEGER) AS seq_num FROM dxe GROUP BY 1, 2)
        SELECT seq_num, icd_code, CAST(icd_version AS INTEGER) AS icd_version,
        min(p_name) AS long_title FROM low JOIN part ON p_brand = icd_code AND p_size = icd_version
        GROUP BY 1, 2, 3""",
    "load_report_dims": f"""WITH {DIAGNOSES}, a AS (SELECT count(*) AS n,
        count(*) FILTER (o_orderkey % 40 = 0) AS twice, count(*) FILTER (o_orderkey % 50 = 0) AS bad
        FROM orders), low AS (SELECT DISTINCT icd_code, icd_version FROM dxe),
        titled AS (SELECT DISTINCT p_brand, p_size, p_name FROM part JOIN low
                   ON p_brand = icd_code AND p_size = icd_version)
        SELECT 'dim_admission' AS table_name, 'loaded' AS status, n + twice + bad AS rows_read,
        n + twice + bad AS rows_sampled, n AS rows_written, twice + bad AS rows_rejected FROM a
        UNION ALL SELECT 'dim_diagnoses_icd', 'loaded',
        (SELECT count(*) FROM dxe) + (SELECT count(*) FROM part), count(*),
        count(DISTINCT (p_brand, p_size)), count(*) - count(DISTINCT (p_brand, p_size)) FROM titled""",
    "load_fact_chartevents": f"""SELECT DISTINCT CAST(user_id AS INTEGER) AS subject_id,
        CAST(NULL AS INTEGER) AS hadm_id, CAST(user_id AS INTEGER) AS stay_id,
        CAST(NULL AS INTEGER) AS caregiver_id, {_keys({'charttime': 'ts'})},
        CAST(length(event_type) * 1000 + ascii(event_type) AS INTEGER) AS itemid,
        value AS valuenum, CASE WHEN event_type <> 'signup' THEN 'unit' END AS valueuom,
        CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS warning FROM events WHERE value >= 1""",
    "stream_micro_silver": f"""WITH {MICRO_ROWS} SELECT microevent_id, subject_id, hadm_id, charttime,
        l_linestatus AS org_name, l_extendedprice AS dilution_value FROM micro_rows""",
    "load_fact_micro": f"""WITH {MICRO_ROWS} SELECT microevent_id, subject_id, hadm_id,
        CAST(l_partkey AS INTEGER) AS micro_specimen_id,
        'P' || CAST(l_suppkey AS VARCHAR) AS order_provider_id, {_keys({'charttime': 'charttime'})},
        CAST(l_suppkey AS INTEGER) AS spec_itemid, l_returnflag AS spec_type_desc,
        CAST(l_linenumber AS INTEGER) AS test_seq, CAST(l_partkey % 1000 AS INTEGER) AS test_itemid,
        l_linestatus AS test_name, CAST(l_suppkey % 10 AS INTEGER) AS org_itemid,
        CAST(l_linenumber AS INTEGER) AS isolate_num,
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity, CAST(NULL AS INTEGER) AS ab_itemid,
        CAST(NULL AS VARCHAR) AS ab_name, CAST(NULL AS VARCHAR) AS dilution_text,
        '<=' AS dilution_comparison, l_returnflag AS interpretation,
        CAST(NULL AS VARCHAR) AS comments FROM micro_rows""",
    "ordered_reports": f"""WITH {STAYS}, units AS (SELECT first_careunit AS k, count(*) AS n FROM stays
        WHERE first_careunit IS NOT NULL GROUP BY 1), codes AS (
        SELECT p_brand, p_name, count(DISTINCT stay_id) AS n FROM stays
        JOIN part ON p_partkey = diagnoses_icd_key GROUP BY 1, 2)
        SELECT 'unit' AS report, k AS item, row_number() OVER (ORDER BY n DESC, k) AS place FROM units
        UNION ALL SELECT 'year', CAST(y AS VARCHAR), row_number() OVER (ORDER BY y)
        FROM (SELECT DISTINCT year(intime) AS y FROM stays)
        UNION ALL SELECT * FROM (SELECT 'code', p_brand,
        row_number() OVER (ORDER BY n DESC, p_brand, p_name) AS r FROM codes) WHERE r <= 10""",
}

# Result types that compare alike in every engine.
_PORTABLE = {
    "stays_calendar": {"full_date": "VARCHAR"},
    "aligned_hourly": {"chart_date": "VARCHAR"},
    "aligned_daily": {"chart_date": "VARCHAR"},
    "hourly_vitals": {"chart_date": "VARCHAR"},
    "date_dim_span": {"full_date": "VARCHAR"},
    "last_stay": {"dod": "VARCHAR"},
    "dim_samples": {"dod": "VARCHAR"},
    "diagnosis_key": {"resolved": "INTEGER"},
    "out_of_range": {"is_critical": "INTEGER"},
    "sample_critical": {"is_critical": "INTEGER"},
    "stream_enrich": {"is_critical": "INTEGER"},
    "ed_triage_left": {
        v: "DOUBLE"
        for v in ("temperature", "heartrate", "resprate", "o2sat", "sbp", "dbp", "acuity")
    },
}
for _name, _casts in _PORTABLE.items():
    _list = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _casts.items())
    CHECKS[_name] = f"SELECT * REPLACE ({_list}) FROM ({CHECKS[_name]})"

# --- ingest ------------------------------------------------------------------------------

_MESSAGE = """'{"event_id":' || event_id || ',"subject_id":' || user_id || ',"hadm_id":' || user_id
        || ',"stay_id":' || user_id || ',"charttime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
        || '","storetime":"NaT","itemid":"' || event_type || '","value":"'
        || replace(replace(props, '\\', '\\\\'), '"', '\\"') || '","valuenum":' || CAST(value AS VARCHAR)
        || ',"valueuom":" unit ","warning":"' || CASE WHEN event_type = 'error' THEN '1.0' ELSE '0.0' END || '"}'"""

CHECKS |= {
    "stream_delivery_counters": f"""WITH m AS (SELECT least((day(ts) - 1) // 7, 4) AS batch_id,
          event_type <> 'error' AS good, strlen({_MESSAGE}) AS size FROM events)
        SELECT batch_id, count(*) FILTER (good) AS messages_sent, count(*) FILTER (NOT good) AS messages_failed,
               CAST(sum(CASE WHEN good THEN size ELSE 0 END) AS BIGINT) AS bytes_sent FROM m GROUP BY 1""",
    "idempotent_append": f"WITH {STAYS} SELECT stay_id, subject_id, intime_date FROM stays",
    "stream_exact_dedup": CHECKS["stream_bronze_silver"],
    "replay_restart": "SELECT event_id, user_id, ts, event_type, value, CAST(1 AS INTEGER) AS in_order FROM events",
    "compacted_events": """SELECT event_type AS itemid, strftime(ts, '%Y%m') AS month, count(*) AS n,
        CAST(sum(event_id) AS BIGINT) AS ids, round(sum(value), 4) AS total, 'few' AS files_left
        FROM events GROUP BY 1, 2""",
}

# --- further loads and stored layouts ----------------------------------------------------

CHECKS |= {
    "load_dim_d_items": f"""WITH {ITEMS} SELECT CAST(length(itemid) * 1000 + ascii(itemid) AS INTEGER) AS itemid,
        label, CAST(NULL AS VARCHAR) AS abbreviation, category, unitname, 'Numeric' AS param_type,
        lownormalvalue, highnormalvalue FROM items""",
    "load_dim_patients": f"""WITH {PATIENTS} SELECT CAST(subject_id AS INTEGER) AS subject_id, gender, anchor_age,
        anchor_age + 2000 AS anchor_year, CAST(NULL AS VARCHAR) AS anchor_year_group,
        CAST(dod AS VARCHAR) AS dod FROM patients""",
    "load_dim_triage": f"""WITH {TRIAGE} SELECT CAST(stay_id AS INTEGER) AS stay_id,
        CAST(triage_subject_id AS INTEGER) AS subject_id, {', '.join(
            f'CAST({c} AS DOUBLE) AS {c}' for c in ('temperature', 'heartrate', 'resprate', 'o2sat', 'sbp', 'dbp', 'acuity'))},
        'unable' AS pain, chiefcomplaint FROM triage""",
    "load_fact_icustays": f"""WITH {STAYS} SELECT CAST(stay_id AS INTEGER) AS stay_id,
        CAST(subject_id AS INTEGER) AS subject_id, CAST(hadm_id AS INTEGER) AS hadm_id, first_careunit,
        last_careunit, intime_time, intime_date, outtime_time, outtime_date, los FROM stays""",
    "load_fact_edstays": f"""WITH {STAYS} SELECT CAST(subject_id AS INTEGER) AS subject_id,
        CAST(hadm_id AS INTEGER) AS hadm_id, CAST(stay_id AS INTEGER) AS stay_id, intime_date, intime_time,
        outtime_date, outtime_time, last_careunit AS gender, first_careunit AS race,
        first_careunit AS arrival_transport, last_careunit AS disposition FROM stays""",
    "balance_files": f"""WITH {BALANCE}, {PATIENTS}, ranked AS (SELECT stay_id, fluid_balance_ml, dod,
          row_number() OVER (PARTITION BY b.subject_id ORDER BY intime DESC, stay_id DESC) AS k
          FROM balance b LEFT JOIN patients p ON p.subject_id = b.subject_id)
        SELECT CAST(b.stay_id AS BIGINT) AS stay_id, b.subject_id, total_input_ml, total_output_ml,
               b.fluid_balance_ml, r.fluid_balance_ml AS told_ml, CAST(dod AS VARCHAR) AS dod
        FROM balance b LEFT JOIN ranked r ON r.stay_id = b.stay_id AND k = 1""",
    "subjects_by_year_unit": f"""WITH {STAYS} SELECT CAST(intime_date // 10000 AS INTEGER) AS year, first_careunit,
        count(*) AS rows, count(DISTINCT subject_id) AS subjects, CAST(1 AS INTEGER) AS within,
        CAST(3.0 * 1.04 / 128 AS DOUBLE) AS relative_error FROM stays GROUP BY 1, 2""",
    "bucketed_vitals": f"""WITH {STAYS}, {TRIAGE} SELECT stay_id, los, CAST(heartrate AS DOUBLE) AS heartrate,
        CAST(acuity AS DOUBLE) AS acuity FROM stays JOIN triage USING (stay_id)""",
    "quarter_by_unit": f"""WITH {STAYS} SELECT first_careunit, CAST(week(intime) AS INTEGER) AS week,
        count(*) AS stays FROM stays WHERE year(intime) = 1995 AND quarter(intime) = 2 GROUP BY 1, 2""",
}

# --- streams and layouts that only tests ran before ---------------------------------------

CHECKS |= {
    "stream_csv_rate": "SELECT event_id, ts, user_id, event_type, value, CAST(4 AS BIGINT) AS batches FROM events",
    "stream_two_queries": """SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
        WHERE event_type IN ('click', 'view') GROUP BY 1""",
    "stream_stamps": "SELECT event_type AS itemid, count(*) AS n, count(*) AS stamped_in_order FROM events GROUP BY 1",
    "keyed_topic": """SELECT CAST(user_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS partitions, count(*) AS messages,
        CAST(0 AS BIGINT) AS out_of_order FROM events GROUP BY 1""",
    "typed_tables": CHECKS["load_fact_icustays"].replace("SELECT CAST(stay_id", "SELECT CAST(0 AS INTEGER) AS tables_left, CAST(stay_id"),
    "source_schema": """SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name,
        CASE data_type WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END
        AS data_type FROM information_schema.columns WHERE table_name = 'events'""",
    "literal_items": """SELECT CASE event_type WHEN 'click' THEN 'Heart rate' ELSE 'SpO2' END AS label, count(*) AS n
        FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""",
}
