"""DuckDB SQL for the correctness oracle.

Independent SQL formulations of the stand-ins (FIXTURES.md) and of every
registered query, run by DuckDB on the same parquet tables (pre-registered
views).  Spark's results and these are compared row for row.  Sums of
doubles are rounded to 2 decimals on both sides (their last bits depend on
summation order).
"""

from __future__ import annotations

D1, D2, D3 = "DATE '1996-01-01'", "DATE '1998-01-01'", "DATE '2000-01-01'"


def _hash(cols: list[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    parts = ", ".join(f"coalesce(CAST({p}{c} AS VARCHAR), '')" for c in cols)
    return f"md5(concat_ws('::', {parts}))"


PATIENT_COLS = ["patient_id", "patient_fullname", "nation_key", "balance", "segment"]
PAYER_COLS = ["payer_id", "payer_name", "nation_key", "balance"]

CTE = {}

CTE["p_base"] = """
SELECT c_custkey AS patient_id, c_name AS patient_fullname, c_nationkey AS nation_key,
       c_acctbal AS balance, c_mktsegment AS segment
FROM customer"""

CTE["s1"] = "SELECT * FROM p_base"

CTE["s2"] = """
SELECT patient_id, patient_fullname, nation_key, balance,
       CASE WHEN patient_id % 10 = 0 THEN 'MACHINERY' ELSE segment END AS segment
FROM p_base WHERE patient_id % 97 <> 0
UNION ALL
SELECT -patient_id - 1, patient_fullname, nation_key, balance, segment
FROM p_base WHERE patient_id % 50 = 0"""

CTE["s3"] = """
SELECT patient_id, patient_fullname,
       CASE WHEN patient_id % 7 = 0 THEN nation_key + 1 ELSE nation_key END AS nation_key,
       balance,
       CASE WHEN patient_id % 10 = 0 AND patient_id % 20 <> 0 THEN 'MACHINERY' ELSE segment END AS segment
FROM p_base
UNION ALL
SELECT -patient_id - 1, patient_fullname, nation_key, balance, segment
FROM p_base WHERE patient_id % 50 = 0 AND patient_id % 100 <> 0"""

CTE["dim1"] = f"""
SELECT md5(CAST(patient_id AS VARCHAR) || '::' || CAST({D1} AS VARCHAR)) AS dim_patient_key,
       patient_id, patient_fullname, nation_key, balance, segment,
       {D1} AS start_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_active
FROM s1"""



def _scd_step(prev: str, snap: str, day: str) -> str:
    """One SCD-2 step, written as the original pipeline meant it: close
    the changed active versions, open versions for changed and new keys,
    leave everything else as it is."""
    cols = ", ".join(f"x.{c}" for c in PATIENT_COLS)
    return f"""
WITH a AS (SELECT *, {_hash(PATIENT_COLS)} AS h FROM {prev} WHERE is_active),
     n AS (SELECT *, {_hash(PATIENT_COLS)} AS h FROM {snap})
SELECT x.dim_patient_key, {cols}, x.start_date, x.end_date, x.is_active
FROM {prev} x WHERE NOT x.is_active
UNION ALL
SELECT x.dim_patient_key, {cols}, x.start_date,
       CASE WHEN n.patient_id IS NOT NULL AND n.h <> x.h THEN {day} ELSE x.end_date END,
       CASE WHEN n.patient_id IS NOT NULL AND n.h <> x.h THEN FALSE ELSE x.is_active END
FROM a x LEFT JOIN n ON x.patient_id = n.patient_id
UNION ALL
SELECT md5(CAST(x.patient_id AS VARCHAR) || '::' || CAST({day} AS VARCHAR)), {cols},
       {day}, CAST(NULL AS DATE), TRUE
FROM n x LEFT JOIN a ON a.patient_id = x.patient_id
WHERE a.patient_id IS NULL OR a.h <> x.h"""


CTE["dim2"] = _scd_step("dim1", "s2", D2)
CTE["dim3"] = _scd_step("dim2", "s3", D3)

CTE["dim_payer"] = f"""
SELECT md5(CAST(s_suppkey AS VARCHAR) || '::' || CAST({D1} AS VARCHAR)) AS dim_payer_key,
       s_suppkey AS payer_id, s_name AS payer_name, s_nationkey AS nation_key, s_acctbal AS balance,
       {D1} AS start_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_active
FROM supplier"""


def _enc(coarse: bool, hot: bool = False) -> str:
    start = "date_trunc('quarter', o_orderdate)" if coarse else "o_orderdate"
    patient = "o_custkey % 5" if hot else "o_custkey"
    npay = "2" if hot else "(SELECT count(*) FROM supplier)"
    return f"""
SELECT o_orderkey AS encounter_id, {patient} AS patient_id, o_orderkey % {npay} AS payer_id,
       CAST({start} AS TIMESTAMP) AS start_time,
       CAST({start} AS TIMESTAMP) + INTERVAL 1 MINUTE * ((o_orderkey % 4) * 1440 + o_orderkey % 1440) AS stop_time,
       o_orderstatus AS encounter_class, 'C' || CAST(o_orderkey % 50 AS VARCHAR) AS code,
       o_orderpriority AS description, o_totalprice / 2 AS base_cost_amount,
       o_totalprice AS claim_amount, floor(CAST(round(o_totalprice * 100) AS BIGINT) * (o_orderkey % 10) / 10) / 100 AS coverage_amount,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'R' || CAST(o_orderkey % 7 AS VARCHAR) END AS reason_code,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'reason ' || CAST(o_orderkey % 7 AS VARCHAR) END AS reason_description
FROM orders"""


def _proc(enc: str) -> str:
    return f"""
SELECT e.stop_time AS start_time,
       e.stop_time + INTERVAL 1 MINUTE * (CAST(floor(l.l_quantity) AS BIGINT)
                                          + CASE WHEN l.l_linenumber = 7 THEN 1440 ELSE 0 END) AS stop_time,
       e.patient_id, e.encounter_id,
       CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_partkey AS VARCHAR) END AS code,
       'procedure ' || CAST(l.l_linenumber AS VARCHAR) AS description,
       l.l_extendedprice AS base_cost_amount, e.reason_code, e.reason_description
FROM lineitem l JOIN {enc} e ON l.l_orderkey = e.encounter_id"""


CTE["enc"] = _enc(False)
CTE["enc_c"] = _enc(True)
CTE["enc_h"] = _enc(True, hot=True)
CTE["proc"] = _proc("enc")
CTE["proc_c"] = _proc("enc_c")


def _valid(alias: str, day: str) -> str:
    return f"{alias}.start_date <= {day} AND ({alias}.end_date > {day} OR {alias}.is_active IS TRUE)"


def _fe(enc: str) -> str:
    day = "CAST(e.stop_time AS DATE)"
    return f"""
SELECT {day} AS date, e.encounter_id, dp.dim_patient_key, dy.dim_payer_key, e.encounter_class,
       e.code, e.description, e.reason_code, e.reason_description, e.start_time, e.stop_time,
       e.base_cost_amount, e.claim_amount, e.coverage_amount,
       e.claim_amount - e.coverage_amount AS patient_pay_amount,
       CAST(date_diff('day', CAST(e.start_time AS DATE), {day}) AS INTEGER) AS length_of_stay_num
FROM {enc} e
LEFT JOIN dim2 dp ON e.patient_id = dp.patient_id AND {_valid('dp', day)}
LEFT JOIN dim_payer dy ON e.payer_id = dy.payer_id AND {_valid('dy', day)}
WHERE e.stop_time IS NOT NULL"""


def _fp(proc: str) -> str:
    day = "CAST(p.stop_time AS DATE)"
    return f"""
SELECT {day} AS date, p.encounter_id, p.code, dp.dim_patient_key, p.description, p.reason_code,
       p.reason_description, p.start_time, p.stop_time, p.base_cost_amount,
       (CAST(epoch(p.stop_time) AS BIGINT) - CAST(epoch(p.start_time) AS BIGINT)) / 60 AS duration_minute_num
FROM {proc} p
LEFT JOIN dim2 dp ON p.patient_id = dp.patient_id AND {_valid('dp', day)}
WHERE p.stop_time IS NOT NULL"""


CTE["fe"] = _fe("enc")
CTE["fp"] = _fp("proc")
CTE["fe_c"] = _fe("enc_c")
CTE["fp_c"] = _fp("proc_c")

# CTE dependency order (a query pulls in what it needs, in this order).
ORDER = ["p_base", "s1", "s2", "s3", "dim1", "dim2", "dim3", "dim_payer",
         "enc", "enc_c", "enc_h", "proc", "proc_c", "fe", "fp", "fe_c", "fp_c"]
DEPS = {
    "s1": ["p_base"], "s2": ["p_base"], "s3": ["p_base"], "dim1": ["s1"],
    "dim2": ["dim1", "s2"], "dim3": ["dim2", "s3"], "proc": ["enc"], "proc_c": ["enc_c"],
    "fe": ["enc", "dim2", "dim_payer"], "fp": ["proc", "dim2"],
    "fe_c": ["enc_c", "dim2", "dim_payer"], "fp_c": ["proc_c", "dim2"],
}


def with_ctes(needed: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively)."""
    todo, seen = list(needed), set()
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo.extend(DEPS.get(n, []))
    parts = [f"{n} AS ({CTE[n]})" for n in ORDER if n in seen]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# ------------------------------------------------------------ the queries
def _cols(cs, alias=""):
    p = f"{alias}." if alias else ""
    return ", ".join(p + c for c in cs)


DIM_COLS = ["dim_patient_key", *PATIENT_COLS, "start_date", "end_date", "is_active"]

_ROLLUP_GRAIN = """fe.date, fe.dim_patient_key, fe.dim_payer_key, fe.encounter_class,
       coalesce(fe.reason_description, fe.description) AS purpose"""

SQL: dict[str, str] = {}

SQL["scd2_changes"] = with_ctes(["dim1", "s2"], f"""
SELECT n.patient_id, n.segment, n.h AS row_hash,
       CASE WHEN a.patient_id IS NULL THEN 'new' ELSE 'changed' END AS change
FROM (SELECT *, {_hash(PATIENT_COLS)} AS h FROM s2) n
LEFT JOIN (SELECT *, {_hash(PATIENT_COLS)} AS h FROM dim1 WHERE is_active) a
  ON a.patient_id = n.patient_id
WHERE a.patient_id IS NULL OR a.h <> n.h""")

SQL["scd2_step"] = with_ctes(["dim2"], f"SELECT {_cols(DIM_COLS)} FROM dim2")

SQL["scd2_close_open"] = with_ctes(["dim2"], f"""
SELECT {_cols(DIM_COLS)} FROM dim2 WHERE end_date = {D2} OR start_date = {D2}""")

SQL["scd2_history"] = with_ctes(["dim3"], f"SELECT {_cols(DIM_COLS)} FROM dim3")
SQL["scd2_iterated"] = SQL["scd2_history"]

SQL["last_date"] = with_ctes(["dim2"], """
SELECT greatest(max(start_date), max(end_date)) AS last_date FROM dim2 WHERE is_active IS TRUE""")

SQL["asof_run_date"] = with_ctes(["enc", "dim2"], """
SELECT e.encounter_id, e.patient_id, d.dim_patient_key
FROM enc e LEFT JOIN dim2 d ON e.patient_id = d.patient_id
  AND d.start_date <= DATE '1999-06-30' AND (d.end_date > DATE '1999-06-30' OR d.is_active IS TRUE)""")

_ASOF_EVENT = """
SELECT e.encounter_id, e.patient_id, CAST(e.start_time AS DATE) AS event_date, d.dim_patient_key
FROM {enc} e LEFT JOIN dim2 d ON e.patient_id = d.patient_id
  AND d.start_date <= CAST(e.start_time AS DATE)
  AND (d.end_date > CAST(e.start_time AS DATE) OR d.is_active IS TRUE)"""
SQL["asof_event_date"] = with_ctes(["enc", "dim2"], _ASOF_EVENT.format(enc="enc"))
SQL["asof_event_date_salted"] = with_ctes(["enc_h", "dim2"], _ASOF_EVENT.format(enc="enc_h"))

SQL["fact_encounter"] = with_ctes(["fe"], "SELECT * FROM fe")
SQL["fact_procedure"] = with_ctes(["fp"], "SELECT * FROM fp")

_ROLLUP = f"""
SELECT {_ROLLUP_GRAIN},
       count(DISTINCT fe.encounter_id) AS total_encounter_num,
       CAST(coalesce(sum(pc.n_procedures), 0) AS BIGINT) AS total_procedure_num,
       CAST(coalesce(sum(pc.n_codes), 0) AS BIGINT) AS total_diagnosis_num,
       round(sum(fe.claim_amount), 2) AS total_claim_amount,
       round(sum(fe.coverage_amount), 2) AS total_coverage_amount,
       round(sum(fe.patient_pay_amount), 2) AS total_patient_pay_amount
FROM fe_c fe
LEFT JOIN (SELECT encounter_id, date, count(encounter_id) AS n_procedures, count(code) AS n_codes
           FROM fp_c GROUP BY encounter_id, date) pc
  ON fe.encounter_id = pc.encounter_id AND fe.date = pc.date
GROUP BY ALL"""
SQL["daily_rollup"] = with_ctes(["fe_c", "fp_c"], _ROLLUP)

_LOST = "CASE WHEN encounter_id % 50 <> 0 THEN encounter_id END AS encounter_id"
CTE["proc_h"] = _proc("enc_h")
CTE["fe_h"], CTE["fp_h"] = _fe("enc_h"), _fp("proc_h")
CTE["fe_l"] = f"SELECT * REPLACE ({_LOST}) FROM fe_h"
CTE["fp_l"] = f"SELECT * REPLACE ({_LOST}) FROM fp_h"
ORDER += ["proc_h", "fe_h", "fp_h", "fe_l", "fp_l"]
DEPS |= {"proc_h": ["enc_h"], "fe_h": ["enc_h", "dim2", "dim_payer"], "fp_h": ["proc_h", "dim2"],
         "fe_l": ["fe_h"], "fp_l": ["fp_h"]}
SQL["daily_rollup_bucketed"] = with_ctes(
    ["fe_l", "fp_l"], _ROLLUP.replace("fe_c fe", "fe_l fe").replace("FROM fp_c", "FROM fp_l"))

SQL["distinct_reroll"] = with_ctes(["enc"], """
SELECT 'month' AS level, CAST(date_trunc('month', start_time) AS DATE) AS date, encounter_class, description,
       count(DISTINCT patient_id) AS n_patients, TRUE AS within_error
FROM enc GROUP BY ALL
UNION ALL
SELECT 'year', CAST(date_trunc('year', start_time) AS DATE), encounter_class, NULL,
       count(DISTINCT patient_id), TRUE
FROM enc GROUP BY ALL""")

SQL["daily_rollup_joined"] = with_ctes(["fe_c", "fp_c"], f"""
SELECT {_ROLLUP_GRAIN},
       count(DISTINCT fe.encounter_id) AS total_encounter_num,
       count(fp.encounter_id) AS total_procedure_num,
       count(fp.code) AS total_diagnosis_num,
       round(sum(fe.claim_amount), 2) AS total_claim_amount,
       round(sum(fe.coverage_amount), 2) AS total_coverage_amount,
       round(sum(fe.patient_pay_amount), 2) AS total_patient_pay_amount
FROM fe_c fe LEFT JOIN fp_c fp ON fe.encounter_id = fp.encounter_id AND fe.date = fp.date
GROUP BY ALL""")

# ------------------------------------------------------- scalar functions
_CLEAN = r"""ltrim(regexp_replace({c}, '[^A-Za-z0-9 \t\n\x0B\f\r,.''";:!?()_&%$#@]', '', 'g'))"""
_TITLE = r"""CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform(
    regexp_extract_all(lower({c}), '([\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_]+)', 1),
    lambda t: CASE WHEN t[1] = 'ß' THEN t WHEN regexp_matches(t, '^\p{{L}}') THEN upper(t[1]) || t[2:] ELSE t END), '') END"""

SQL["clean_text"] = f"SELECT doc_id, {_CLEAN.format(c='text')} AS clean_text FROM documents"
SQL["clean_part_names"] = f"""
SELECT p_partkey, {_CLEAN.format(c='p_name')} AS clean_name, {_TITLE.format(c='p_name')} AS title_name
FROM part"""
SQL["title_case"] = f"SELECT doc_id, {_TITLE.format(c='text')} AS title_text FROM documents"

SQL["upper_lower_concat"] = """
SELECT c_custkey, upper(c_mktsegment) AS segment_upper, lower(c_name) AS name_lower,
       CASE WHEN f IS NULL AND l IS NULL THEN NULL
            WHEN f IS NULL THEN l WHEN l IS NULL THEN f ELSE f || ' ' || l END AS full_name
FROM (SELECT *, CASE WHEN c_nationkey % 5 <> 0 THEN c_name END AS f,
             CASE WHEN c_nationkey > 10 THEN c_mktsegment END AS l FROM customer)"""

SQL["decode_labels"] = """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'FEMALE' WHEN 'M' THEN 'MALE' ELSE '(unknown)' END AS status_label,
       CASE substr(o_orderpriority, 3, 1) WHEN 'M' THEN 'MARRIED' WHEN 'S' THEN 'SINGLE'
            WHEN 'D' THEN 'DIVORCE' ELSE '(unknown)' END AS priority_label
FROM orders"""

SQL["row_hash"] = f"""
SELECT c_custkey, {_hash(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'])} AS row_hash
FROM customer"""

# ------------------------------------------------------- slices and dates
SQL["event_slice"] = with_ctes(["enc"], """
SELECT CAST(start_time AS DATE) AS slice_date, encounter_id FROM enc
UNION
SELECT CAST(stop_time AS DATE), encounter_id FROM enc""")

SQL["day_count"] = "SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY 1"

SQL["date_math"] = with_ctes(["enc"], """
SELECT encounter_id, CAST(stop_time AS DATE) AS date, strftime(start_time, '%Y-%m-%d') AS start_day_text,
       CAST(date_diff('day', CAST(start_time AS DATE), CAST(stop_time AS DATE)) AS INTEGER) AS length_of_stay_num,
       (CAST(epoch(stop_time) AS BIGINT) - CAST(epoch(start_time) AS BIGINT)) / 60 AS duration_minute_num,
       CAST(epoch(start_time) AS BIGINT) AS start_epoch,
       claim_amount - coverage_amount AS patient_pay_amount
FROM enc""")

SQL["rename_recast"] = """
SELECT l_orderkey AS l_orderkey, l_linenumber AS l_line_number,
       CAST(epoch(l_shipdate) AS BIGINT) AS ship_date,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day,
       CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS DOUBLE) AS extended_price,
       TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS qty,
       TRY_CAST(l_returnflag AS DOUBLE) AS flag_number
FROM lineitem"""

# ---------------------------------------------------------------- quality
_ALNUM = r"^[A-Za-z0-9\s\-'']+$"  # quote doubled inside SQL text
_ALPHA = r"^[A-Za-z\s\-'']+$"
_MONEY = r"^-?\d{1,4}\.\d{1,2}$"
_CUST_RULES = [  # (rule, column, kind, failing-row predicate)
    ("c_custkey:not_null", "c_custkey", "not_null", "c_custkey IS NULL"),
    ("c_name:not_null", "c_name", "not_null", "c_name IS NULL"),
    ("c_mktsegment:not_null", "c_mktsegment", "not_null", "c_mktsegment IS NULL"),
    ("c_name:pattern_alphanumeric", "c_name", "pattern",
     f"c_name IS NOT NULL AND NOT regexp_matches(c_name, '{_ALNUM}')"),
    ("c_mktsegment:pattern_alphabet", "c_mktsegment", "pattern",
     f"c_mktsegment IS NOT NULL AND NOT regexp_matches(c_mktsegment, '{_ALPHA}')"),
    ("c_acctbal:type_double", "c_acctbal", "type",
     "c_acctbal IS NOT NULL AND TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) IS NULL"),
    ("c_mktsegment:known", "c_mktsegment", "in_set",
     "c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"),
    ("c_acctbal:money", "c_acctbal", "pattern",
     f"c_acctbal IS NOT NULL AND NOT regexp_matches(CAST(c_acctbal AS VARCHAR), '{_MONEY}')"),
]


def _counts_sql(table: str, rules) -> str:
    parts = [f"""SELECT '{r}' AS rule, '{c}' AS "column", '{k}' AS kind,
       CAST(sum(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT) AS failed_rows,
       count(*) AS total_rows FROM {table}""" for r, c, k, p in rules]
    return "\nUNION ALL\n".join(parts)


SQL["quality_counts"] = _counts_sql("customer", _CUST_RULES)

SQL["quality_quarantine"] = f"""
SELECT c_custkey, failed_rules = '' AS is_clean, failed_rules
FROM (SELECT c_custkey, concat_ws(',', {', '.join(f"CASE WHEN {p} THEN '{r}' END" for r, _, _, p in _CUST_RULES)})
             AS failed_rules FROM customer)"""

SQL["unique_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

SQL["label_quality"] = _counts_sql("labels", [
    ("quality:not_null", "quality", "not_null", "quality IS NULL"),
    ("toxic:not_null", "toxic", "not_null", "toxic IS NULL"),
    ("quality:binary", "quality", "in_set", "quality IS NOT NULL AND quality NOT IN (0, 1)"),
    ("toxic:binary", "toxic", "in_set", "toxic IS NOT NULL AND toxic NOT IN (0, 1)"),
])

SQL["dim_key_unique"] = with_ctes(["dim3"], """
SELECT 'dim_patient_key' AS "check", dim_patient_key AS "key", count(*) AS n_rows
FROM (SELECT * FROM dim3 UNION ALL SELECT * FROM dim3 WHERE patient_id % 10 = 0) x GROUP BY dim_patient_key HAVING count(*) > 1
UNION ALL
SELECT 'active_per_patient', CAST(patient_id AS VARCHAR), count(*)
FROM (SELECT * FROM dim3 UNION ALL SELECT * FROM dim3 WHERE patient_id % 10 = 0) x
WHERE is_active GROUP BY patient_id HAVING count(*) > 1""")

# ----------------------------------------------------- sources and sinks
SQL["ingest_roundtrip"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, DATE '2024-01-01' AS partition_date
FROM orders"""

SQL["partition_overwrite"] = """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS partition_date
FROM events
WHERE CAST(ts AS DATE) <> DATE '2024-01-01' OR event_type = 'click'"""

SQL["materialize_modes"] = """
SELECT o_orderkey,
       CASE WHEN CAST(o_orderdate AS DATE) = DATE '1996-06-01'
            THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS day
FROM orders"""

SQL["materialize_append"] = """
SELECT *, 1 AS load FROM supplier UNION ALL SELECT *, 2 AS load FROM supplier"""

SQL["dimension_versions"] = SQL["scd2_step"]

# untidy snapshots: of the rows of a key the first by its attributes counts
for _n in (1, 2):
    CTE[f"untidy{_n}"] = f"""
SELECT {", ".join(PATIENT_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY {", ".join(c + " NULLS FIRST" for c in PATIENT_COLS[1:])}) AS nth
  FROM (SELECT * FROM s{_n} WHERE patient_id % 13 <> 0 UNION ALL
        SELECT patient_id, patient_fullname, nation_key, balance - {_n} + 1, 'ANY' FROM s{_n}
        WHERE patient_id % 13 <> 0 AND patient_id % 11 = 0) x) y
WHERE nth = 1"""
CTE["untidy_dim1"] = CTE["dim1"].replace("FROM s1", "FROM untidy1")
CTE["untidy_dim2"] = _scd_step("untidy_dim1", "untidy2", D2)
ORDER += ["untidy1", "untidy2", "untidy_dim1", "untidy_dim2"]
DEPS |= {"untidy1": ["s1"], "untidy2": ["s2"], "untidy_dim1": ["untidy1"], "untidy_dim2": ["untidy_dim1", "untidy2"]}
SQL["scd2_null_duplicate_keys"] = with_ctes(["untidy_dim2"], f"SELECT {_cols(DIM_COLS)}, CAST(2 AS BIGINT) AS sides FROM untidy_dim2")

# later and late snapshots: one step after another, in the order of dates
CTE["s4"] = """
SELECT patient_id, patient_fullname, nation_key, balance,
       CASE WHEN patient_id % 6 = 0 THEN 'HOUSEHOLD' ELSE segment END AS segment
FROM p_base WHERE patient_id % 89 <> 0"""
CTE["dim4"] = _scd_step("dim3", "s4", "DATE '2000-06-01'")
ORDER += ["s4", "dim4"]
DEPS |= {"s4": ["p_base"], "dim4": ["dim3", "s4"]}
SQL["scd2_continued"] = with_ctes(["dim4"], f"SELECT {_cols(DIM_COLS)} FROM dim4")
SQL["scd2_late_snapshot"] = SQL["scd2_continued"]
SQL["dimension_log"] = SQL["scd2_continued"]

SQL["asof_event_date_merge"] = """
WITH v AS (
  SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS start_date FROM lineitem GROUP BY 1, 2),
t AS (
  SELECT flag, start_date, md5(flag || '::' || CAST(start_date AS VARCHAR)) AS tariff_key,
         CASE WHEN dayofyear(start_date) % 11 = 0 THEN start_date
              ELSE lead(start_date) OVER (PARTITION BY flag ORDER BY start_date) END AS end_date
  FROM v)
SELECT l.l_orderkey, l.l_linenumber, l.flag, l.day,
       CASE WHEN t.end_date IS NULL OR t.end_date > l.day THEN t.tariff_key END AS tariff_key
FROM (SELECT l_orderkey, l_linenumber, l_returnflag AS flag,
             CAST(l_shipdate AS DATE) + CAST(l_orderkey % 30 AS INTEGER) AS day FROM lineitem) l
ASOF LEFT JOIN t ON l.flag = t.flag AND l.day >= t.start_date
"""

# ----------------------------------------------------------------- silver
def _guid(k: str) -> str:
    h = f"md5(CAST({k} AS VARCHAR))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


_BIRTH = "(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER))"
CTE["raw_p"] = f"""
SELECT upper({_guid('c_custkey')}) AS Id,
       strftime({_BIRTH}, '%d-%m-%Y') AS BIRTHDATE,
       CASE WHEN c_custkey % 10 = 0 THEN strftime({_BIRTH} + 25000, '%d-%m-%Y') END AS DEATHDATE,
       lower(c_mktsegment) AS FIRST, c_name AS LAST,
       substr('MSDX', CAST(c_custkey % 4 + 1 AS INTEGER), 1) AS MARITAL,
       'race ' || CAST(c_nationkey AS VARCHAR) AS RACE,
       CASE WHEN c_custkey % 2 = 0 THEN 'nonhispanic' ELSE 'hispanic' END AS ETHNICITY,
       substr('FMx', CAST(c_custkey % 3 + 1 AS INTEGER), 1) AS GENDER,
       '  Zürich-' || n_name AS BIRTHPLACE,
       CAST(c_custkey AS VARCHAR) || ' Main St. #' || CAST(c_custkey % 7 AS VARCHAR) AS ADDRESS,
       lower(n_name) AS CITY, 'ST' AS STATE, 'County (€)' AS COUNTY,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS ZIP,
       {D1} AS partition_date
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

CTE["conf_p"] = f"""
SELECT lower(trim(Id)) AS patient_id,
       CASE WHEN FIRST IS NULL AND LAST IS NULL THEN NULL
            ELSE concat_ws(' ', {_TITLE.format(c='FIRST')}, {_TITLE.format(c='LAST')}) END AS patient_fullname,
       trim(BIRTHDATE) AS birth_date, trim(DEATHDATE) AS death_date,
       CASE MARITAL WHEN 'M' THEN 'MARRIED' WHEN 'S' THEN 'SINGLE' WHEN 'D' THEN 'DIVORCE'
            ELSE '(unknown)' END AS marital_status,
       {_CLEAN.format(c='RACE')} AS race, {_CLEAN.format(c='ETHNICITY')} AS ethnicity,
       CASE GENDER WHEN 'F' THEN 'FEMALE' WHEN 'M' THEN 'MALE' ELSE '(unknown)' END AS gender,
       {_CLEAN.format(c='BIRTHPLACE')} AS birth_place, {_CLEAN.format(c='ADDRESS')} AS address,
       {_CLEAN.format(c='CITY')} AS city, {_CLEAN.format(c='STATE')} AS state,
       {_CLEAN.format(c='COUNTY')} AS county, {_CLEAN.format(c='ZIP')} AS zip, partition_date
FROM raw_p"""

_ODD_CODE = ("CASE WHEN encounter_id % 17 = 0 THEN code || '/*' WHEN encounter_id % 19 = 0 THEN code || '-2' "
             "ELSE code END")

CTE["raw_e"] = f"""
SELECT {_guid('encounter_id')} AS Id,
       strftime(start_time, '%Y-%m-%d %H:%M:%S') AS "START", strftime(stop_time, '%Y-%m-%d %H:%M:%S') AS STOP,
       {_guid('patient_id')} AS PATIENT, {_guid('payer_id')} AS PAYER,
       lower(encounter_class) AS ENCOUNTERCLASS, {_ODD_CODE} AS CODE, description AS DESCRIPTION,
       CAST(base_cost_amount AS VARCHAR) AS BASE_ENCOUNTER_COST,
       CAST(claim_amount AS VARCHAR) AS TOTAL_CLAIM_COST,
       CASE WHEN encounter_id % 13 = 0 THEN 'n/a' ELSE CAST(coverage_amount AS VARCHAR) END AS PAYER_COVERAGE,
       reason_code AS REASONCODE, reason_description AS REASONDESCRIPTION, {D1} AS partition_date
FROM enc"""

CTE["conf_e"] = f"""
SELECT lower(trim(Id)) AS encounter_id, trim("START") AS start_time, trim(STOP) AS stop_time,
       lower(trim(PATIENT)) AS patient_id, lower(trim(PAYER)) AS payer_id,
       upper(ENCOUNTERCLASS) AS encounter_class,
       CODE AS code, {_CLEAN.format(c='DESCRIPTION')} AS description,
       trim(BASE_ENCOUNTER_COST) AS base_cost_amount, trim(TOTAL_CLAIM_COST) AS claim_amount,
       trim(PAYER_COVERAGE) AS coverage_amount,
       REASONCODE AS reason_code,
       {_CLEAN.format(c='REASONDESCRIPTION')} AS reason_description, partition_date
FROM raw_e"""

CTE["raw_y"] = f"""
SELECT {_guid('s_suppkey')} AS Id, s_name AS NAME, CAST(s_suppkey AS VARCHAR) || ' Payer Road' AS ADDRESS,
       'Baltimore' AS CITY, lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS ZIP, {D1} AS partition_date
FROM supplier"""

CTE["conf_y"] = f"""
SELECT lower(trim(Id)) AS payer_id, NAME AS payer_name, {_CLEAN.format(c='ADDRESS')} AS address,
       {_CLEAN.format(c='CITY')} AS city, {_CLEAN.format(c='ZIP')} AS zip, partition_date
FROM raw_y"""

CTE["conf_r"] = f"""
SELECT strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(stop_time, '%Y-%m-%d %H:%M:%S') AS stop_time,
       {_guid('patient_id')} AS patient_id, {_guid('encounter_id')} AS encounter_id, {_ODD_CODE} AS code,
       {_CLEAN.format(c='description')} AS description,
       CASE WHEN encounter_id % 29 <> 0 THEN CAST(base_cost_amount AS VARCHAR) END AS base_cost_amount,
       reason_code, {_CLEAN.format(c='reason_description')} AS reason_description, {D1} AS partition_date
FROM proc"""

ORDER += ["raw_p", "conf_p", "raw_e", "conf_e", "raw_y", "conf_y", "conf_r"]
DEPS.update({"conf_p": ["raw_p"], "raw_e": ["enc"], "conf_e": ["raw_e"], "conf_y": ["raw_y"], "conf_r": ["proc"]})

SQL["conform_payers"] = with_ctes(["conf_y"], "SELECT * FROM conf_y")
SQL["conform_procedures"] = with_ctes(["conf_r"], """
SELECT * REPLACE (TRY_CAST(start_time AS TIMESTAMP) AS start_time, TRY_CAST(stop_time AS TIMESTAMP) AS stop_time,
                  TRY_CAST(base_cost_amount AS DOUBLE) AS base_cost_amount)
FROM conf_r""")

SQL["conform_patients"] = with_ctes(["conf_p"], """
SELECT patient_id, patient_fullname,
       coalesce(CAST(try_strptime(birth_date, '%d-%m-%Y') AS DATE),
                CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE)) AS birth_date,
       coalesce(CAST(try_strptime(death_date, '%d-%m-%Y') AS DATE),
                CAST(try_strptime(death_date, '%Y-%m-%d') AS DATE)) AS death_date,
       marital_status, race, ethnicity, gender, birth_place, address, city, state, county, zip, partition_date
FROM conf_p""")

SQL["conform_encounters"] = with_ctes(["conf_e"], """
SELECT encounter_id, TRY_CAST(start_time AS TIMESTAMP) AS start_time, TRY_CAST(stop_time AS TIMESTAMP) AS stop_time,
       patient_id, payer_id, encounter_class, code, description,
       TRY_CAST(base_cost_amount AS DOUBLE) AS base_cost_amount, TRY_CAST(claim_amount AS DOUBLE) AS claim_amount,
       TRY_CAST(coverage_amount AS DOUBLE) AS coverage_amount, reason_code, reason_description, partition_date
FROM conf_e""")

_GUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_DMY_RE = r"^(0[1-9]|[12][0-9]|3[01])-(0[1-9]|1[0-2])-\d{4}$"
_ISO_RE = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"


def _nn(c):
    return (f"{c}:not_null", c, "not_null", f"{c} IS NULL")


def _pat(c, name, rx):
    return (f"{c}:pattern_{name}", c, "pattern", f"{c} IS NOT NULL AND NOT regexp_matches(CAST({c} AS VARCHAR), '{rx}')")


def _typ(c, t):
    conv = (f"try_strptime(CAST({c} AS VARCHAR), '%Y-%m-%d %H:%M:%S')" if t == "timestamp"
            else f"TRY_CAST(CAST({c} AS VARCHAR) AS {t.upper()})")
    return (f"{c}:type_{t}", c, "type", f"{c} IS NOT NULL AND {conv} IS NULL")


_ENC_RULES = [*(_nn(c) for c in ("encounter_id", "patient_id", "payer_id", "start_time", "stop_time",
                                  "base_cost_amount", "claim_amount", "coverage_amount")),
              _pat("encounter_id", "guid", _GUID_RE), _pat("patient_id", "guid", _GUID_RE),
              _pat("payer_id", "guid", _GUID_RE),
              _typ("start_time", "timestamp"), _typ("stop_time", "timestamp"),
              _pat("encounter_class", "alphabet", _ALPHA),
              _pat("code", "alphanumeric", _ALNUM), _pat("reason_code", "alphanumeric", _ALNUM),
              _typ("base_cost_amount", "double"), _typ("claim_amount", "double"),
              _typ("coverage_amount", "double")]
SQL["silver_quality"] = with_ctes(["conf_e"], _counts_sql("conf_e", _ENC_RULES))

_PAT_RULES = [*(_nn(c) for c in ("patient_id", "patient_fullname", "birth_date", "city", "state", "county",
                                  "partition_date")),
              _pat("patient_id", "guid", _GUID_RE), _pat("patient_fullname", "alphabet", _ALPHA),
              _pat("birth_date", "date_dmy", _DMY_RE), _pat("death_date", "date_dmy", _DMY_RE),
              _pat("ethnicity", "alphabet", _ALPHA), _pat("gender", "alphabet", _ALPHA),
              _pat("birth_place", "alphabet", _ALPHA), _pat("partition_date", "date_iso", _ISO_RE)]
SQL["patient_quality"] = with_ctes(["conf_p"], _counts_sql("conf_p", _PAT_RULES))

_PAY_RULES = [_nn("payer_id"), _nn("payer_name"), _pat("payer_id", "guid", _GUID_RE),
              _pat("payer_name", "alphabet", _ALPHA)]
SQL["payer_quality"] = with_ctes(["conf_y"], _counts_sql("conf_y", _PAY_RULES))

_PROC_RULES = [*(_nn(c) for c in ("start_time", "stop_time", "patient_id", "encounter_id", "base_cost_amount")),
               _typ("start_time", "timestamp"), _typ("stop_time", "timestamp"),
               _pat("patient_id", "guid", _GUID_RE), _pat("encounter_id", "guid", _GUID_RE),
               _pat("code", "alphanumeric", _ALNUM), _pat("reason_code", "alphanumeric", _ALNUM),
               _typ("base_cost_amount", "double")]
SQL["procedure_quality"] = with_ctes(["conf_r"], _counts_sql("conf_r", _PROC_RULES))

_FACT_RULES = [_nn(c) for c in ("date", "encounter_id", "dim_patient_key", "dim_payer_key", "encounter_class",
                                "start_time", "base_cost_amount", "length_of_stay_num")]
SQL["gold_quality"] = with_ctes(["fe"], _counts_sql("fe", _FACT_RULES))

SQL["gold_uniqueness"] = """
WITH li AS (SELECT l_orderkey AS encounter_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem),
loads(load, first, last) AS (VALUES (1, DATE '1992-01-01', DATE '1996-12-01'),
    (2, DATE '1998-01-01', DATE '2099-12-01'), (3, DATE '1997-01-01', DATE '1997-12-01')),
placed AS (SELECT encounter_id, date, load FROM li JOIN loads ON date BETWEEN first AND last)
SELECT t.load, p.encounter_id, CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT p.date) AS n_dates,
       min(p.date) AS first_date, max(p.date) AS last_date
FROM (SELECT DISTINCT load, encounter_id FROM placed) t JOIN placed p
  ON p.encounter_id = t.encounter_id AND p.load <= t.load
GROUP BY t.load, p.encounter_id HAVING count(*) > 1"""

SQL["publish_audited"] = """
SELECT o_orderkey, round(CASE WHEN date BETWEEN DATE '1995-03-01' AND DATE '1995-06-01'
                              THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS o_totalprice, date
FROM (SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders) o
WHERE date <> DATE '1995-05-01'"""

# ---------------------------------------------------------- whole pipeline
_P_D1 = "DATE '1998-03-01'"
_DAYS = "(DATE '1998-03-01', DATE '1998-03-02')"

CTE["run_fe"] = f"""
SELECT CAST(TRY_CAST(stop_time AS TIMESTAMP) AS DATE) AS date, encounter_id,
       md5(patient_id || '::' || CAST({_P_D1} AS VARCHAR)) AS dim_patient_key,
       md5(payer_id || '::' || CAST({_P_D1} AS VARCHAR)) AS dim_payer_key,
       encounter_class, coalesce(reason_description, description) AS purpose,
       TRY_CAST(claim_amount AS DOUBLE) AS claim_amount,
       TRY_CAST(coverage_amount AS DOUBLE) AS coverage_amount,
       TRY_CAST(claim_amount AS DOUBLE) - TRY_CAST(coverage_amount AS DOUBLE) AS patient_pay_amount
FROM conf_e
WHERE CAST(TRY_CAST(stop_time AS TIMESTAMP) AS DATE) IN {_DAYS}"""

CTE["run_pc"] = f"""
SELECT lower({_guid('encounter_id')}) AS encounter_id, CAST(stop_time AS DATE) AS date,
       count(*) AS n_procedures,
       count(code) AS n_codes
FROM proc
WHERE CAST(stop_time AS DATE) IN {_DAYS}
GROUP BY 1, 2"""

ORDER += ["run_fe", "run_pc"]
DEPS.update({"run_fe": ["conf_e"], "run_pc": ["proc"]})

SQL["daily_run"] = with_ctes(["run_fe", "run_pc"], """
SELECT fe.date, fe.dim_patient_key, fe.dim_payer_key, fe.encounter_class, fe.purpose,
       count(DISTINCT fe.encounter_id) AS total_encounter_num,
       CAST(coalesce(sum(pc.n_procedures), 0) AS BIGINT) AS total_procedure_num,
       CAST(coalesce(sum(pc.n_codes), 0) AS BIGINT) AS total_diagnosis_num,
       round(sum(fe.claim_amount), 2) AS total_claim_amount,
       round(sum(fe.coverage_amount), 2) AS total_coverage_amount,
       round(sum(fe.patient_pay_amount), 2) AS total_patient_pay_amount
FROM run_fe fe LEFT JOIN run_pc pc ON fe.encounter_id = pc.encounter_id AND fe.date = pc.date
GROUP BY ALL""")

# the range run: a patient's versions, of which the second one starts with the
# second extract
_RANGE = "BETWEEN DATE '1998-03-01' AND DATE '1998-04-30'"
CTE["range_dim"] = f"""
SELECT {_guid('c_custkey')} AS patient_id, md5({_guid('c_custkey')} || '::1998-03-01') AS dim_patient_key,
       DATE '1998-03-01' AS start_date,
       CASE WHEN c_custkey % 10 = 0 AND c_custkey % 97 <> 0 THEN DATE '1998-03-21' END AS end_date
FROM customer
UNION ALL
SELECT {_guid('c_custkey')}, md5({_guid('c_custkey')} || '::1998-03-21'), DATE '1998-03-21', NULL
FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 97 <> 0"""
CTE["range_payer"] = f"""
SELECT {_guid('s_suppkey')} AS payer_id, md5({_guid('s_suppkey')} || '::1998-03-01') AS dim_payer_key FROM supplier"""
CTE["range_fe"] = f"""
SELECT e.date, encounter_id, dim_patient_key, dim_payer_key, encounter_class, purpose,
       claim_amount, coverage_amount, claim_amount - coverage_amount AS patient_pay_amount
FROM (SELECT *, CAST(TRY_CAST(stop_time AS TIMESTAMP) AS DATE) AS date, coalesce(reason_description, description) AS purpose
      FROM (SELECT * REPLACE (TRY_CAST(claim_amount AS DOUBLE) AS claim_amount,
                              TRY_CAST(coverage_amount AS DOUBLE) AS coverage_amount) FROM conf_e) c) e
LEFT JOIN range_dim p ON p.patient_id = e.patient_id AND p.start_date <= e.date
     AND (p.end_date IS NULL OR p.end_date > e.date)
LEFT JOIN range_payer y ON y.payer_id = e.payer_id
WHERE e.date {_RANGE}"""
CTE["range_pc"] = CTE["run_pc"].replace(f"IN {_DAYS}", _RANGE)
ORDER += ["range_dim", "range_payer", "range_fe", "range_pc"]
DEPS.update({"range_fe": ["conf_e", "range_dim", "range_payer"], "range_pc": ["proc"]})
SQL["daily_run_range"] = with_ctes(["range_fe", "range_pc"], SQL["daily_run"][SQL["daily_run"].rindex("\nSELECT fe.date"):]
                                   .replace("run_fe", "range_fe").replace("run_pc", "range_pc"))
