"""SQL with the same meaning as each registered query, for DuckDB."""

from __future__ import annotations

from dataclasses import replace

from checks import queries as q

BIG = "4294967296"


# --- digests and keys -----------------------------------------------------------------------


def sha(columns: list[str]) -> str:
    texts = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in columns)
    return f"sha256(concat_ws('||', {texts}))"


def _murmur3(words: str, n_bytes: int) -> str:
    """Murmur3 (32 bit, seed 42) of a list of 32-bit words, as a signed number."""
    for step in (
        f"(k * 3432918353::UBIGINT) % {BIG}",
        "((k << 15) | (k >> 17)) & 4294967295::UBIGINT",
        f"(k * 461845907::UBIGINT) % {BIG}",
    ):
        words = f"list_transform({words}, lambda k: {step})"
    mixed = "((((xor(h, k) << 13) | (xor(h, k) >> 19)) & 4294967295::UBIGINT) * 5::UBIGINT + 3864292196::UBIGINT)"
    h = f"[list_reduce(list_concat([42::UBIGINT], {words}), lambda h, k: {mixed} % {BIG})]"
    for step in (
        f"xor(h, {n_bytes}::UBIGINT)",
        "xor(h, h >> 16)",
        f"(h * 2246822507::UBIGINT) % {BIG}",
        "xor(h, h >> 13)",
        f"(h * 3266489909::UBIGINT) % {BIG}",
        "xor(h, h >> 16)",
    ):
        h = f"list_transform({h}, lambda h: {step})"
    return f"list_transform({h}, lambda h: CASE WHEN h >= 2147483648 THEN h::BIGINT - {BIG} ELSE h::BIGINT END)[1]"


def key(column: str) -> str:
    """The surrogate key of a non-negative bigint."""
    words = f"[({column} % {BIG})::UBIGINT, ({column} // {BIG})::UBIGINT]"
    return f"CASE WHEN {column} IS NULL THEN 42 ELSE abs({_murmur3(words, 8)}) END::BIGINT"


def text_key(column: str, length: int) -> str:
    """The surrogate key of an ASCII text whose length is a multiple of four."""
    parts = " + ".join(f"ascii(substr({column}, 4 * i + {j + 1}, 1)) * {256 ** j}" for j in range(4))
    words = f"list_transform(range(0, {length // 4}), lambda i: ({parts})::UBIGINT)"
    return f"CASE WHEN {column} IS NULL THEN 42 ELSE abs({_murmur3(words, length)}) END::BIGINT"


def date_key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as integer)"


# --- bronze and silver ----------------------------------------------------------------------

# Per entity: the table, its columns as (name, expression), then derived columns.
BRONZE = {
    "vehicle_model": ("nation", [("model_id", "n_nationkey::BIGINT"), ("n_name", "n_name"), ("n_regionkey", "n_regionkey")], []),
    "dealer": ("supplier", [("dealer_id", "s_suppkey::BIGINT"), ("s_name", "s_name"), ("s_nationkey", "s_nationkey"), ("s_acctbal", "s_acctbal")], []),
    "customer": ("customer", [("customer_id", "c_custkey::BIGINT"), ("c_name", "c_name"), ("c_nationkey", "c_nationkey"), ("c_acctbal", "c_acctbal"), ("c_mktsegment", "c_mktsegment")], []),
    "vehicle": (
        "customer",
        [
            ("vin", "c_custkey::BIGINT"),
            ("model_id", "c_nationkey::BIGINT"),
            ("customer_id", "c_custkey::BIGINT"),
            ("dealer_id", "NULL::VARCHAR"),
            ("registration_number", "NULL::VARCHAR"),
            ("production_date", "NULL::DATE"),
            ("delivery_date", "NULL::DATE"),
            ("warranty_start_date", "NULL::DATE"),
            ("warranty_end_date", "NULL::DATE"),
            ("current_odometer_km", "c_acctbal"),
            ("odometer_km", "c_acctbal"),
            ("vehicle_status", "c_mktsegment"),
            ("color", "NULL::VARCHAR"),
            ("engine_number", "NULL::VARCHAR"),
            ("chassis_number", "NULL::VARCHAR"),
            ("powertrain_type", "NULL::VARCHAR"),
            ("emission_standard", "NULL::VARCHAR"),
        ],
        [],
    ),
    "part": ("part", [("part_id", "p_partkey::BIGINT"), ("part_number", "p_name"), ("p_brand", "p_brand"), ("p_type", "p_type"), ("p_retailprice", "p_retailprice")], []),
    "failure_code": ("(SELECT DISTINCT p_size FROM part)", [("failure_code", "p_size::BIGINT")], []),
    "service_order": (
        "orders",
        [
            ("service_order_id", "o_orderkey::BIGINT"),
            ("vin", "o_custkey::BIGINT"),
            ("customer_id", "o_custkey::BIGINT"),
            ("dealer_id", "o_custkey::BIGINT % 100"),
            ("open_timestamp", "o_orderdate"),
            ("labor_cost", "o_totalprice"),
        ],
        [
            ("opened_timestamp", "open_timestamp"),
            ("closed_timestamp", "NULL::TIMESTAMP"),
            ("open_date", "open_timestamp::DATE"),
            ("close_date", "NULL::DATE"),
            ("total_service_cost", "coalesce(labor_cost, 0) + 0 + 0"),
            ("repeat_repair_count", "0"),
        ],
    ),
    "repair_job": (
        "lineitem",
        [
            ("repair_job_id", "l_orderkey::BIGINT * 10 + l_linenumber"),
            ("vin", "l_orderkey::BIGINT % 1500"),
            ("dealer_id", "l_suppkey::BIGINT"),
            ("failure_code", "l_linenumber::BIGINT"),
            ("labor_hours", "l_quantity"),
            ("labor_rate", "l_extendedprice"),
            ("completed_timestamp", "l_shipdate"),
        ],
        [
            ("repair_date", "completed_timestamp::DATE"),
            ("labor_cost", "coalesce(labor_hours, 0) * coalesce(labor_rate, 0)"),
        ],
    ),
    "part_consumption": (
        "lineitem",
        [
            ("part_consumption_id", "l_orderkey::BIGINT * 10 + l_linenumber"),
            ("vin", "l_orderkey::BIGINT % 1500"),
            ("dealer_id", "l_suppkey::BIGINT"),
            ("part_id", "l_partkey::BIGINT"),
            ("quantity", "l_quantity"),
            ("unit_cost", "l_discount"),
            ("consumption_timestamp", "l_shipdate"),
        ],
        [
            ("extended_cost", "coalesce(quantity, 0) * coalesce(unit_cost, 0)"),
            ("consumption_date", "consumption_timestamp::DATE"),
        ],
    ),
    "warranty_claim": (
        "orders",
        [
            ("warranty_claim_id", "o_orderkey::BIGINT"),
            ("vin", "o_custkey::BIGINT"),
            ("dealer_id", "o_custkey::BIGINT % 100"),
            ("claim_submitted_date", "o_orderdate::DATE"),
            ("claim_approved_date", "CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + 30 END"),
            ("claim_rejected_date", "CASE WHEN o_orderstatus = 'O' THEN o_orderdate::DATE + 10 END"),
            ("claim_type", "o_orderpriority"),
        ],
        [
            ("decision_date", "coalesce(claim_approved_date, claim_rejected_date, claim_submitted_date)"),
            ("claim_count", "1"),
            ("warranty_type", "claim_type"),
        ],
    ),
    "vehicle_daily_usage": (
        "events",
        [
            ("vin", "user_id::BIGINT"),
            ("customer_id", "user_id::BIGINT"),
            ("usage_date", "ts::DATE"),
            ("ts", "ts"),
            ("event_id", "event_id"),
            ("distance_km", "value"),
        ],
        [("usage_id", "sha256(concat_ws('||', vin::VARCHAR, usage_date::VARCHAR))")],
    ),
    "breakdown": (
        "(SELECT * FROM events WHERE event_type = 'error')",
        [
            ("breakdown_id", "event_id::BIGINT"),
            ("vin", "user_id::BIGINT"),
            ("customer_id", "user_id::BIGINT"),
            ("dealer_id", "user_id::BIGINT % 100"),
            ("failure_code", "event_id::BIGINT % 7 + 1"),
            ("breakdown_timestamp", "ts"),
            ("resolved_timestamp", "ts + INTERVAL 1 DAY"),
        ],
        [("breakdown_date", "breakdown_timestamp::DATE"), ("resolved_date", "resolved_timestamp::DATE")],
    ),
}

KEYS = {
    "vehicle_model": "model_id",
    "dealer": "dealer_id",
    "customer": "customer_id",
    "vehicle": "vin",
    "part": "part_id",
    "failure_code": "failure_code",
    "service_order": "service_order_id",
    "repair_job": "repair_job_id",
    "part_consumption": "part_consumption_id",
    "warranty_claim": "warranty_claim_id",
    "vehicle_daily_usage": "usage_id",
    "breakdown": "breakdown_id",
}

TIMESTAMPS = {
    "open_timestamp", "opened_timestamp", "closed_timestamp", "completed_timestamp",
    "consumption_timestamp", "breakdown_timestamp", "resolved_timestamp", "ts",
}


def _names(entity: str) -> list[str]:
    _, columns, derived = BRONZE[entity]
    return [n for n, _ in [*columns, *derived]]


def ranked(columns: list[str], keys: list[str], first: list[str] = []) -> str:
    order = [*first, *[c for c in columns if c not in keys and c not in first]]
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order) or "1"
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {by})"


def silver(entity: str, where: str = "true", batch: str = "B1", first: list[str] | None = None) -> str:
    """All silver columns of an entity, timestamps still typed."""
    table, columns, derived = BRONZE[entity]
    names, own = _names(entity), KEYS[entity]
    if first is None:
        first = ["ts", "event_id"] if entity == "vehicle_daily_usage" else []
    bronze = ", ".join(f"{e} AS {n}" for n, e in columns)
    more = "".join(f", {e} AS {n}" for n, e in derived)
    return f"""
        SELECT {', '.join(names)}, '{batch}' AS silver_batch_id, true AS is_valid,
               {sha([own])} AS business_key_hash, {sha(names)} AS record_hash
        FROM (SELECT *, {ranked(names, [own], first)} AS rn
              FROM (SELECT *{more} FROM (SELECT {bronze} FROM {table}) WHERE {where}))
        WHERE rn = 1"""


def silver_query(entity: str) -> str:
    names = _names(entity)
    casts = ", ".join(f"{n}::VARCHAR AS {n}" if n in TIMESTAMPS else n for n in names)
    return f"SELECT {casts}, silver_batch_id, is_valid, business_key_hash, record_hash FROM ({silver(entity)})"


# --- gold -----------------------------------------------------------------------------------

# Per table: silver entity, then (name, kind, silver column).
GOLD = {
    "dim_vehicle_model": ("vehicle_model", [("vehicle_model_key", key, "model_id")]),
    "dim_customer": ("customer", [("customer_key", key, "customer_id")]),
    "dim_dealer": ("dealer", [("dealer_key", key, "dealer_id")]),
    "dim_part": ("part", [("part_key", key, "part_id")]),
    "dim_failure_code": ("failure_code", [("failure_code_key", key, "failure_code")]),
    "dim_vehicle": ("vehicle", [("vehicle_key", key, "vin"), ("vehicle_model_key", key, "model_id")]),
    "fact_service_order": (
        "service_order",
        [
            ("service_order_key", key, "service_order_id"),
            ("vehicle_key", key, "vin"),
            ("dealer_key", key, "dealer_id"),
            ("customer_key", key, "customer_id"),
            ("open_date_key", date_key, "open_date"),
            ("close_date_key", date_key, "close_date"),
            ("total_service_cost", str, "total_service_cost"),
            ("repeat_repair_count", str, "repeat_repair_count"),
        ],
    ),
    "fact_repair_job": (
        "repair_job",
        [
            ("repair_job_key", key, "repair_job_id"),
            ("vehicle_key", key, "vin"),
            ("dealer_key", key, "dealer_id"),
            ("failure_code_key", key, "failure_code"),
            ("repair_date_key", date_key, "repair_date"),
        ],
    ),
    "fact_part_consumption": (
        "part_consumption",
        [
            ("part_consumption_key", key, "part_consumption_id"),
            ("vehicle_key", key, "vin"),
            ("dealer_key", key, "dealer_id"),
            ("part_key", key, "part_id"),
            ("consumption_date_key", date_key, "consumption_date"),
            ("extended_cost", str, "extended_cost"),
        ],
    ),
    "fact_warranty_claim": (
        "warranty_claim",
        [
            ("warranty_claim_key", key, "warranty_claim_id"),
            ("vehicle_key", key, "vin"),
            ("dealer_key", key, "dealer_id"),
            ("submitted_date_key", date_key, "claim_submitted_date"),
            ("decision_date_key", date_key, "decision_date"),
            ("claim_count", str, "claim_count"),
        ],
    ),
    "fact_vehicle_daily_usage": (
        "vehicle_daily_usage",
        [
            ("vehicle_usage_key", lambda c: text_key(c, 64), "usage_id"),
            ("vehicle_key", key, "vin"),
            ("customer_key", key, "customer_id"),
            ("date_key", date_key, "usage_date"),
        ],
    ),
    "fact_breakdown": (
        "breakdown",
        [
            ("breakdown_key", key, "breakdown_id"),
            ("vehicle_key", key, "vin"),
            ("dealer_key", key, "dealer_id"),
            ("customer_key", key, "customer_id"),
            ("failure_code_key", key, "failure_code"),
            ("breakdown_date_key", date_key, "breakdown_date"),
            ("resolved_date_key", date_key, "resolved_date"),
        ],
    ),
}


def gold(name: str) -> str:
    entity, columns = GOLD[name]
    shown = ", ".join(f"{make('s.' + source)} AS {n}" for n, make, source in columns)
    own = KEYS[entity]
    dated = ", NULL::VARCHAR AS effective_to, true AS is_current" if name.startswith("dim_") else ""
    return f"SELECT {shown}, s.{own}{dated} FROM ({silver(entity)}) s"


def gold_row_counts() -> str:
    parts = [
        f"SELECT '{name}' AS table_name, count(DISTINCT {KEYS[entity]}) AS row_count FROM ({silver(entity)})"
        for name, (entity, _) in GOLD.items()
    ]
    return " UNION ALL ".join(parts)


DIM_DATE = """
    WITH days AS (
        SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders)
    SELECT d AS full_date, cast(strftime(d, '%Y%m%d') as integer) AS date_key, d AS calendar_date,
           day(d)::INTEGER AS day_of_month, day(d)::INTEGER AS day_number, dayname(d) AS day_name,
           (dayofweek(d) + 1)::INTEGER AS day_of_week, weekofyear(d)::INTEGER AS week_of_year,
           month(d)::INTEGER AS month_number, monthname(d) AS month_name, quarter(d)::INTEGER AS quarter_number,
           'Q' || quarter(d) AS quarter_name, year(d)::INTEGER AS year_number, dayofweek(d) IN (0, 6) AS is_weekend
    FROM days"""

# --- columns and digests --------------------------------------------------------------------

LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
EVENT = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def shown(columns: list[str]) -> str:
    typed = {"l_shipdate", "ts", "o_orderdate"}
    return ", ".join(f"{c}::VARCHAR AS {c}" if c in typed else c for c in columns)


SURROGATE_KEY = f"""
    SELECT o.o_orderkey, {key('o.o_orderkey')} AS order_key, {key('o.c')} AS customer_key,
           CASE WHEN o.c IS NOT NULL THEN {key('o.c')} END AS known_customer_key
    FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS c FROM orders) o"""

FIRST_EXISTING = """
    SELECT o_orderkey, o_orderdate::VARCHAR AS moment, 0 AS discount, NULL::VARCHAR AS remark,
           nullif(o_orderstatus, 'F') AS by_presence, coalesce(nullif(o_orderstatus, 'F'), o_orderpriority) AS by_value
    FROM orders"""

DERIVE_IF_ABSENT = """
    SELECT o_orderkey AS service_order_id, o_custkey AS vin, o_custkey AS customer_id, o_custkey % 100 AS dealer_id,
           o_orderdate::VARCHAR AS open_timestamp, o_totalprice AS labor_cost, o_totalprice * 2 AS total_service_cost,
           o_orderdate::VARCHAR AS opened_timestamp, NULL::VARCHAR AS closed_timestamp, o_orderdate::DATE AS open_date,
           NULL::DATE AS close_date, 0 AS repeat_repair_count
    FROM orders"""

LINEAGE_COLUMNS = """
    SELECT event_id, event_type AS source_pipeline_id, ts::VARCHAR AS source_ingestion_timestamp,
           NULL::VARCHAR AS source_batch_id, NULL::VARCHAR AS source_record_hash, NULL::VARCHAR AS source_file_name
    FROM events"""

ALIGN_SCHEMA = """
    SELECT l_orderkey::VARCHAR AS "L_ORDERKEY", l_linenumber::BIGINT AS l_linenumber, l_quantity::INTEGER AS l_quantity,
           l_shipdate::DATE AS l_shipdate, l_extendedprice::VARCHAR AS l_extendedprice, NULL::VARCHAR AS inspector,
           NULL::DATE AS inspected_on
    FROM lineitem"""

SIZES = "(SELECT p_partkey, p_size || CASE WHEN p_type = 'ECONOMY' THEN ' in' ELSE '' END AS size_text FROM part)"

# --- merges ---------------------------------------------------------------------------------

OLD = silver("repair_job", f"completed_timestamp <= TIMESTAMP '{q.FIRST_UNTIL}'", "B1")
NEW = silver("repair_job", f"completed_timestamp > TIMESTAMP '{q.SECOND_AFTER}'", "B2")
ACTION = """CASE WHEN n.repair_job_id IS NULL THEN 'KEEP' WHEN o.repair_job_id IS NULL THEN 'INSERT'
                 WHEN n.record_hash IS DISTINCT FROM o.record_hash THEN 'UPDATE' ELSE 'NOOP' END"""
PAIRS = f"({OLD}) o FULL JOIN ({NEW}) n ON o.repair_job_id = n.repair_job_id"


def merged(action: str, takes: str = "action IN ('INSERT', 'UPDATE')") -> str:
    def pick(c: str) -> str:
        return f"CASE WHEN {takes} THEN n_{c} ELSE o_{c} END AS {c}"

    columns = [c for c in q.MERGED if c != "repair_job_id"]
    both = ", ".join(f"o.{c} AS o_{c}, n.{c} AS n_{c}" for c in columns)
    return f"""
        SELECT repair_job_id, {', '.join(pick(c) for c in columns)}, action
        FROM (SELECT coalesce(o.repair_job_id, n.repair_job_id) AS repair_job_id, {both}, {action} AS action FROM {PAIRS})"""


MERGE_PRESERVING = f"""
    SELECT coalesce(n.repair_job_id, o.repair_job_id) AS repair_job_id, o.vin,
           CASE WHEN n.repair_job_id IS NULL THEN o.labor_cost ELSE n.labor_cost END AS labor_cost,
           CASE WHEN n.repair_job_id IS NULL THEN o.repair_date ELSE n.repair_date END AS repair_date,
           coalesce(o.silver_batch_id, n.silver_batch_id) AS silver_batch_id,
           CASE WHEN n.repair_job_id IS NULL THEN o.record_hash ELSE n.record_hash END AS record_hash,
           CASE WHEN n.repair_job_id IS NULL THEN 'KEEP' WHEN o.repair_job_id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action
    FROM {PAIRS}"""

# --- quality --------------------------------------------------------------------------------

DQ_INPUT = """(SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity, nullif(l_returnflag, 'A') AS l_returnflag) FROM lineitem)"""


def _first_failed(rules, null_passes: bool = True) -> str:
    cases = []
    for i, rule in enumerate(rules):
        if rule.blocks:
            cases.append(f"WHEN NOT coalesce({rule.expression}, {str(null_passes).lower()}) THEN {i}")
    return f"CASE {' '.join(cases)} END"


def dq_good(null_passes: bool) -> str:
    return f"""SELECT {', '.join(q.DQ_SHOWN)}, 'PASSED' AS dq_status, NULL::VARCHAR AS dq_error_message
               FROM (SELECT *, {_first_failed(q.DQ_RULES, null_passes)} AS pos FROM {DQ_INPUT}) WHERE pos IS NULL"""


def _per_rule(rules, value) -> str:
    return "CASE pos " + " ".join(f"WHEN {i} THEN '{value(r)}'" for i, r in enumerate(rules)) + " END"


def _rejected(columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, {_first_failed(q.DQ_RULES)} AS pos FROM {DQ_INPUT}) WHERE pos IS NOT NULL"""


REASON = _per_rule(q.DQ_RULES, lambda r: r.reason)
FAILED_ID = _per_rule(q.DQ_RULES, lambda r: r.rule_id)
DQ_REJECTED = _rejected(
    f"{', '.join(q.DQ_SHOWN)}, 'FAILED' AS dq_status, {REASON} AS dq_error_message, {FAILED_ID} AS failed_rule_id"
)
DQ_REJECT_RECORDS = _rejected(
    f"""l_orderkey, l_linenumber, l_quantity, l_returnflag, 'FAILED' AS dq_status, 'A1' AS audit_id,
        'lineitem' AS source_object, 'good_lines' AS target_object, {REASON} AS rejection_reason,
        {FAILED_ID} AS failed_rule_ids, 'HIGH' AS severity"""
)


def dq_results(rules, null_passes: bool = True, source: str = DQ_INPUT, thresholds: bool = False) -> str:
    def text(v) -> str:
        return "NULL::VARCHAR" if v is None else f"'{v}'"

    over = "failed_row_count * 100.0 > threshold_value * evaluated_row_count" if thresholds else "failed_row_count > 0"
    parts = []
    for i, r in enumerate(rules):
        failed = f"pos = {i}" if r.blocks else f"(pos IS NULL OR pos >= {i}) AND NOT coalesce({r.expression}, {str(null_passes).lower()})"
        stops = str(r.stops).lower()
        parts.append(f"""
            SELECT {i} AS rule_position, {text(r.rule_id)} AS rule_id, {text(r.rule_name)} AS rule_name,
                   {text(r.rule_type)} AS rule_type, {text(r.severity)} AS severity,
                   {text(r.failure_action)} AS failure_action, {r.threshold_value}::DOUBLE AS threshold_value, {stops} AS stops,
                   count(*) FILTER (WHERE pos IS NULL OR pos >= {i}) AS evaluated_row_count,
                   count(*) FILTER (WHERE {failed}) AS failed_row_count
            FROM judged""")
    return f"""
        WITH judged AS (SELECT *, {_first_failed(rules, null_passes)} AS pos FROM {source}),
        counted AS ({' UNION ALL '.join(parts)})
        SELECT * EXCLUDE (stops), evaluated_row_count - failed_row_count AS passed_row_count,
               CASE WHEN evaluated_row_count > 0 THEN failed_row_count::DOUBLE / evaluated_row_count * 100 ELSE 0.0::DOUBLE END
                   AS failure_percentage,
               CASE WHEN {over} THEN 'FAILED' ELSE 'PASSED' END AS rule_status
        FROM counted
        WHERE rule_position <= coalesce((SELECT min(rule_position) FROM counted WHERE stops AND {over}), 1000)"""


DQ_RESULT_ROWS = f"""
    SELECT 'A1' AS audit_id, NULL::VARCHAR AS workflow_audit_id, 'B1' AS batch_id, 'P1' AS pipeline_id,
           * EXCLUDE (rule_position), NULL::VARCHAR AS sample_failed_records
    FROM ({dq_results(q.DQ_RULES, False)})"""

REFERRING = """(
    SELECT *, l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AS r1,
        l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY') AS r2,
        (l_orderkey, l_shipdate) IN (SELECT (l_orderkey, l_shipdate) FROM lineitem WHERE l_linenumber % 3 <> 1) AS r3
    FROM (SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity, nullif(l_returnflag, 'A') AS l_returnflag,
                            nullif(l_partkey, 7) AS l_partkey) FROM lineitem))"""
REFERENCE_RULES = [replace(r, expression=r.rule_id.lower()) if r.refers else r for r in q.REFERENCE_RULES]
DQ_REFERENTIAL = f"""
    SELECT {', '.join(q.DQ_SHOWN)}, CASE WHEN pos IS NULL THEN 'PASSED' ELSE 'FAILED' END AS dq_status,
        {_per_rule(REFERENCE_RULES, lambda r: r.reason)} AS dq_error_message,
        {_per_rule(REFERENCE_RULES, lambda r: r.rule_id)} AS failed_rule_id
    FROM (SELECT *, {_first_failed(REFERENCE_RULES)} AS pos FROM {REFERRING})"""

# --- incremental and control ----------------------------------------------------------------

WATERMARK_ADVANCE = f"""
    WITH s AS (SELECT 'PL_' || upper(event_type) AS pipeline_id, max(ts)::VARCHAR AS w FROM events
               WHERE ts <= TIMESTAMP '{q.STATE_UNTIL}' AND event_type <> 'signup' GROUP BY 1),
         m AS (SELECT 'PL_' || upper(event_type) AS pipeline_id, max(ts)::VARCHAR AS w FROM events
               WHERE ts > TIMESTAMP '{q.STATE_UNTIL}' AND event_type <> 'error' GROUP BY 1)
    SELECT coalesce(m.pipeline_id, s.pipeline_id) AS pipeline_id, 'ts' AS watermark_column,
           CASE WHEN m.w IS NOT NULL THEN s.w END AS previous_watermark, coalesce(m.w, s.w) AS current_watermark,
           CASE WHEN m.w IS NOT NULL THEN 'B2' ELSE 'B1' END AS last_successful_batch_id,
           'A-' || coalesce(m.pipeline_id, s.pipeline_id) AS last_successful_audit_id
    FROM s FULL JOIN m ON s.pipeline_id = m.pipeline_id"""

CONFIG = """(SELECT CASE p_type WHEN 'ECONOMY' THEN 'PL_GOLD_' WHEN 'STANDARD' THEN 'PL_OTHER_' ELSE 'PL_SILVER_' END || p_partkey
                    AS pipeline_id, p_brand AS pipeline_group, p_name AS source_object, 't_' || p_name AS target_object,
                    p_size AS execution_order, p_size % 3 <> 0 AS is_active FROM part)"""
SHIPPED = "(pipeline_id LIKE 'PL_SILVER_%' OR pipeline_id LIKE 'PL_GOLD_%')"

def _other(name: str) -> str:
    return f"NOT (starts_with({name}, 'PL_SILVER_') OR starts_with({name}, 'PL_GOLD_'))"


CONTROL_RESET = f"""
    WITH c AS (SELECT * FROM {CONFIG}),
    dependency AS (
        SELECT CASE WHEN execution_order % 2 = 0 THEN source_object ELSE pipeline_id END AS parent,
            CASE WHEN execution_order % 5 = 0 THEN pipeline_id ELSE source_object END AS child FROM c)
    SELECT 'pipeline_config' AS table_name, pipeline_id AS id, pipeline_group AS detail FROM c WHERE {_other('pipeline_id')}
    UNION ALL SELECT 'pipeline_config', pipeline_id, 'RESET' FROM c WHERE is_active
    UNION ALL SELECT 'data_quality_rule', pipeline_id, source_object FROM c WHERE execution_order > 20 AND {_other('pipeline_id')}
    UNION ALL SELECT 'data_quality_rule', pipeline_id, 'NEW' FROM c WHERE execution_order > 40 AND is_active
    UNION ALL SELECT 'pipeline_parameter', pipeline_id, execution_order::VARCHAR FROM c
        WHERE execution_order <= 30 AND {_other('pipeline_id')}
    UNION ALL SELECT 'pipeline_dependency', parent, child FROM dependency WHERE {_other('parent')} AND {_other('child')}
    UNION ALL SELECT 'pipeline_watermark', pipeline_id, execution_order::VARCHAR FROM c WHERE {_other('pipeline_id')}"""

RUNS = """(
    SELECT ts::DATE::VARCHAR || '/' || user_id AS audit_id, 'W-' || ts::DATE AS workflow_audit_id, ts::DATE::VARCHAR AS batch_id,
           'PL_' || user_id AS pipeline_id,
           CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'SKIPPED' ELSE 'SUCCESS' END
               AS run_status,
           date_trunc('day', ts) AS start_timestamp, ts AS end_timestamp, floor(value)::BIGINT AS rows_read,
           nullif(floor(value / 2)::BIGINT, 0) AS rows_inserted, floor(value / 4)::BIGINT AS rows_updated, 0::BIGINT AS rows_deleted,
           CASE WHEN event_type = 'click' THEN 0 ELSE floor(value / 50) END::BIGINT AS rows_rejected,
           CASE WHEN event_type = 'error' THEN props END AS error_message, event_id
    FROM events
    QUALIFY row_number() OVER (PARTITION BY ts::DATE, user_id ORDER BY ts DESC, event_id DESC) = 1)"""

ROLLUP = f"""
    SELECT workflow_audit_id, batch_id, count(*) AS total_pipelines,
           count(*) FILTER (WHERE run_status = 'SUCCESS') AS successful_pipelines,
           count(*) FILTER (WHERE run_status = 'FAILED') AS failed_pipelines,
           count(*) FILTER (WHERE run_status = 'SKIPPED') AS skipped_pipelines,
           count(*) FILTER (WHERE run_status = 'SUCCESS' AND rows_rejected > 0) AS warning_pipelines,
           sum(rows_read)::BIGINT AS total_rows_read, sum(coalesce(rows_inserted, 0))::BIGINT AS total_rows_inserted,
           sum(rows_updated)::BIGINT AS total_rows_updated, sum(rows_deleted)::BIGINT AS total_rows_deleted,
           sum(rows_rejected)::BIGINT AS total_rows_rejected,
           CASE WHEN count(*) FILTER (WHERE run_status = 'FAILED') > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS run_status,
           floor(epoch(max(end_timestamp) - min(start_timestamp)))::BIGINT AS duration_seconds
    FROM {RUNS} GROUP BY workflow_audit_id, batch_id"""

EVENT_LOG = """
    SELECT audit_id || '/' || run_status AS event_id, audit_id, 'W-' || day AS workflow_audit_id, day AS batch_id, pipeline_id,
           CASE run_status WHEN 'RUNNING' THEN 'PIPELINE_START' WHEN 'FAILED' THEN 'PIPELINE_FAILED' ELSE 'PIPELINE_COMPLETE' END
               AS event_type,
           CASE run_status WHEN 'FAILED' THEN 'ERROR' ELSE 'INFO' END AS event_level,
           CASE run_status WHEN 'RUNNING' THEN 'Started ' || pipeline_id WHEN 'FAILED' THEN props ELSE 'Completed ' || pipeline_id END
               AS event_message,
           NULL::VARCHAR AS event_payload, ts::VARCHAR AS event_timestamp
    FROM (SELECT ts::DATE::VARCHAR || '/' || user_id AS audit_id, ts::DATE::VARCHAR AS day, 'PL_' || user_id AS pipeline_id,
                 CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'SKIPPED'
                      ELSE 'SUCCESS' END AS run_status, props, ts FROM events)"""

LATEST_RUNS = f"""
    SELECT audit_id, pipeline_id, run_status, rows_read, rows_inserted, rows_updated, rows_rejected, error_message,
           start_timestamp::VARCHAR AS start_timestamp
    FROM {RUNS} ORDER BY start_timestamp DESC, audit_id LIMIT 50"""

# --- whole loads ----------------------------------------------------------------------------

ORDERS = silver("service_order")
ORDER_COLUMNS = ", ".join(q.ORDER_SHOWN)
LATER = f"opened_timestamp > TIMESTAMP '{q.SLICE_HIGH}'"
SECOND_BATCH = f"CASE WHEN {LATER} THEN 'B2' ELSE 'B1' END"

WRITE_FULL = f"SELECT {ORDER_COLUMNS}, silver_batch_id, 'PASSED' AS dq_status FROM ({ORDERS})"
WRITE_APPEND = f"SELECT {ORDER_COLUMNS}, {SECOND_BATCH} AS silver_batch_id FROM ({ORDERS})"


CONTROL_RESET_LOAD = f"{WRITE_APPEND} UNION ALL SELECT {ORDER_COLUMNS}, 'B3' AS silver_batch_id FROM ({ORDERS})"


def _job_slice(condition: str, batch: str) -> str:
    return silver("repair_job", condition, batch, ["completed_timestamp"])


FIRST_JOBS = _job_slice(f"completed_timestamp <= TIMESTAMP '{q.FIRST_UNTIL}'", "B1")
LATER_JOBS = _job_slice(
    f"completed_timestamp > (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate <= TIMESTAMP '{q.FIRST_UNTIL}')", "B2"
)
JOB_COLUMNS = ", ".join(f"CASE WHEN n.repair_job_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in q.MERGED)
SILVER_LOAD_MERGE = f"""
    SELECT {JOB_COLUMNS}, 'PASSED' AS dq_status
    FROM (SELECT * FROM ({FIRST_JOBS}) WHERE labor_hours >= 2) o
    FULL JOIN (SELECT * FROM ({LATER_JOBS}) WHERE labor_hours >= 2) n ON o.repair_job_id = n.repair_job_id"""
DQ_THRESHOLD_LOAD = f"""
    SELECT {', '.join(q.MERGED)}, 'PASSED' AS dq_status FROM ({_job_slice('true', 'B1')}) WHERE labor_hours >= 2"""
BOTH_LOADS = f"(SELECT 'B1' AS batch_id, * FROM ({FIRST_JOBS}) UNION ALL SELECT 'B2', * FROM ({LATER_JOBS}))"
SILVER_LOAD_REJECTS = f"""
    SELECT batch_id, repair_job_id, 'HOURS: At least two hours' AS rejection_reason
    FROM {BOTH_LOADS} WHERE labor_hours < 2"""
SILVER_LOAD_RESULTS = f"""
    SELECT batch_id, 'HOURS' AS rule_id, count(*) AS evaluated_row_count, count(*) FILTER (WHERE labor_hours < 2) AS failed_row_count,
           count(*) FILTER (WHERE labor_hours >= 2) AS passed_row_count,
           CASE WHEN count(*) FILTER (WHERE labor_hours < 2) > 0 THEN 'FAILED' ELSE 'PASSED' END AS rule_status
    FROM {BOTH_LOADS} GROUP BY batch_id"""
SILVER_LOAD_WATERMARK = f"""
    SELECT 'PL_REPAIR_JOB' AS pipeline_id, 'completed_timestamp' AS watermark_column,
           (max(l_shipdate) FILTER (WHERE l_shipdate <= TIMESTAMP '{q.FIRST_UNTIL}'))::VARCHAR AS previous_watermark,
           max(l_shipdate)::VARCHAR AS current_watermark, 'B2' AS last_successful_batch_id
    FROM lineitem"""
GOLD_LOAD_MERGE = f"""
    SELECT {key('s.service_order_id')} AS service_order_key, s.service_order_id, {key('s.vin')} AS vehicle_key,
           {key('s.dealer_id')} AS dealer_key, {key('s.customer_id')} AS customer_key,
           {date_key('s.open_date')} AS open_date_key, NULL::INTEGER AS close_date_key, s.total_service_cost,
           s.repeat_repair_count, {SECOND_BATCH} AS silver_batch_id
    FROM ({ORDERS}) s"""
MERGE_HISTORY = """
    WITH v AS (SELECT o_custkey::BIGINT AS vin, date_trunc('month', o_orderdate) AS month, o_orderkey::BIGINT AS id,
                      o_totalprice AS labor_cost FROM orders WHERE o_orderkey % 3 < 2),
    last AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY vin, month ORDER BY id % 3 DESC, id DESC) = 1)
    SELECT vin, month::TIMESTAMP::VARCHAR AS effective_from, id AS service_order_id, labor_cost,
           (lead(month) OVER w)::TIMESTAMP::VARCHAR AS effective_to, lead(month) OVER w IS NULL AS is_current
    FROM last WINDOW w AS (PARTITION BY vin ORDER BY month)"""
SURROGATE_COLLISIONS = f"""
    WITH ids AS (SELECT (l_orderkey * 10 + l_linenumber)::BIGINT AS id,
                        min(CASE WHEN l_shipdate <= TIMESTAMP '{q.FIRST_UNTIL}' THEN 1 ELSE 2 END) AS load FROM lineitem GROUP BY 1),
    based AS (SELECT id, load, ({key('id')}) % {1 << q.COLLIDING_BITS} AS base FROM ids),
    keyed AS (SELECT id, base + (row_number() OVER (PARTITION BY base ORDER BY load, id) - 1) * {1 << q.COLLIDING_BITS} AS k FROM based)
    SELECT id AS part_consumption_id, l_partkey::BIGINT AS part_id, k::BIGINT AS repair_job_key
    FROM lineitem JOIN keyed ON id = l_orderkey * 10 + l_linenumber"""

# A group's loads: orders, jobs of which short ones are rejected, breakdowns that stop at a code of three or more.
LOADED = f"""(
    SELECT 'PL_ORDER' AS pipeline_id, 1 AS place, (SELECT count(*) FROM orders) AS n_read,
           (SELECT count(DISTINCT o_orderkey) FROM orders) AS n_kept, 0 AS n_bad
    UNION ALL
    SELECT 'PL_JOB', 2, (SELECT count(*) FROM lineitem), count(*), count(*) FILTER (WHERE labor_hours < 2)
    FROM ({_job_slice('true', 'B1')})
    UNION ALL
    SELECT 'PL_BREAKDOWN', 3, count(*), count(DISTINCT event_id), count(DISTINCT event_id) FILTER (WHERE event_id % 7 + 1 >= 3)
    FROM events WHERE event_type = 'error')"""
GROUP_RUN = f"""
    SELECT CASE pipeline_id WHEN 'PL_ORDER' THEN 'service_order' WHEN 'PL_JOB' THEN 'repair_job' ELSE 'breakdown' END AS table_name,
           CASE WHEN place = 3 THEN 0 ELSE n_kept - n_bad END AS row_count FROM {LOADED}
    UNION ALL SELECT 'dealer', 0"""
LOAD_AUDIT = f"""
    SELECT pipeline_id, CASE WHEN place = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS run_status, n_read AS rows_read,
           CASE WHEN place = 3 THEN 0 ELSE n_kept - n_bad END::BIGINT AS rows_inserted, 0::BIGINT AS rows_updated,
           n_bad::BIGINT AS rows_rejected, (n_read - n_kept)::BIGINT AS rows_duplicated,
           CASE WHEN place = 3 THEN 'DataQualityError' END AS error_code
    FROM {LOADED}"""
WORKFLOW_COMPLETED = f"""
    SELECT 'nightly' AS workflow_name, 'B1' AS batch_id, 'MANUAL' AS trigger_type, 'FAILED' AS run_status, count(*) AS total_pipelines,
           count(*) FILTER (WHERE place < 3) AS successful_pipelines, 1::BIGINT AS failed_pipelines,
           count(*) FILTER (WHERE place < 3 AND n_bad > 0) AS warning_pipelines, sum(n_read)::BIGINT AS total_rows_read,
           (sum(n_kept - n_bad) FILTER (WHERE place < 3))::BIGINT AS total_rows_inserted, sum(n_bad)::BIGINT AS total_rows_rejected
    FROM {LOADED}"""
STREAM_SILVER = f"""
    SELECT usage_id, vin, usage_date, ts::VARCHAR AS ts, event_id, distance_km, business_key_hash, record_hash
    FROM ({silver('vehicle_daily_usage', first=['ts'])})"""

ORACLES: dict[str, str] = {
    **{f"silver_{name}": silver_query(name) for name in BRONZE},
    "dim_date": DIM_DATE,
    **{name: gold(name) for name in GOLD},
    "gold_row_counts": gold_row_counts(),
    "hash_business_key": f"SELECT l_orderkey, l_linenumber, {sha(LINE[:1] + ['l_linenumber'])} AS business_key_hash FROM lineitem",
    "hash_record": f"SELECT l_orderkey, l_linenumber, {sha(LINE)} AS record_hash FROM lineitem",
    "surrogate_key": SURROGATE_KEY,
    "first_existing": FIRST_EXISTING,
    "derive_if_absent": DERIVE_IF_ABSENT,
    "lineage_columns": LINEAGE_COLUMNS,
    "align_schema": ALIGN_SCHEMA,
    "align_blank_misfits": f"SELECT p_partkey, try_cast(size_text AS INTEGER) AS size_text FROM {SIZES}",
    "align_misfits": f"SELECT p_partkey, size_text FROM {SIZES} WHERE try_cast(size_text AS INTEGER) IS NULL",
    "dedupe_latest": f"""SELECT {shown(LINE)} FROM (SELECT *, {ranked(LINE, list(q.LINE_KEY), ['l_shipdate'])} AS rn FROM lineitem)
                         WHERE rn = 1""",
    "dedupe_unordered": f"""SELECT {shown(EVENT)} FROM (SELECT *, {ranked(EVENT, ['user_id', 'event_type'])} AS rn FROM events)
                            WHERE rn = 1""",
    "dedupe_counts": """SELECT count(*) AS rows_read, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_kept,
                               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rows_duplicated FROM lineitem""",
    "repeated_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "merge_scd1": merged(ACTION),
    "merge_measured": merged(ACTION),
    "merge_preserving": MERGE_PRESERVING,
    "merge_bucketed": merged(ACTION),
    "merge_history": MERGE_HISTORY,
    "surrogate_collisions": SURROGATE_COLLISIONS,
    "merge_actions": f"SELECT {ACTION} AS action, count(*) AS row_count FROM {PAIRS} GROUP BY 1",
    "dq_good": dq_good(True),
    "dq_good_strict": dq_good(False),
    "dq_rejected": DQ_REJECTED,
    "dq_reject_records": DQ_REJECT_RECORDS,
    "dq_results": dq_results(q.DQ_RULES),
    "dq_results_stopped": dq_results(q.STOPPING_RULES),
    "dq_result_rows": DQ_RESULT_ROWS,
    "dq_threshold": dq_results(q.THRESHOLD_RULES, thresholds=True),
    "dq_threshold_load": DQ_THRESHOLD_LOAD,
    "dq_referential": DQ_REFERENTIAL,
    "dq_referential_counts": dq_results(REFERENCE_RULES, source=REFERRING),
    "incremental_slice": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate > TIMESTAMP '{q.SLICE_LOW}' AND o_orderdate <= TIMESTAMP '{q.SLICE_HIGH}'""",
    "incremental_lag": f"SELECT {shown(EVENT)} FROM events WHERE ts > TIMESTAMP '{q.STATE_UNTIL}' - INTERVAL 6 HOURS",
    "watermark_bounds": f"""SELECT count(*) AS rows_read, max(ts)::VARCHAR AS high_watermark FROM events
                            WHERE ts > TIMESTAMP '{q.STATE_UNTIL}'""",
    "watermark_advance": WATERMARK_ADVANCE,
    "load_listing": f"SELECT * FROM {CONFIG} WHERE is_active",
    "load_group_listing": f"SELECT * FROM {CONFIG} WHERE is_active AND pipeline_group = 'Brand#2'",
    "config_report": f"""SELECT pipeline_group, execution_order, pipeline_id, source_object, target_object FROM {CONFIG}
                         WHERE {SHIPPED}""",
    "load_group_counts": f"SELECT pipeline_group, count(*) AS pipeline_count FROM {CONFIG} WHERE {SHIPPED} GROUP BY 1",
    "config_reset": f"""SELECT * FROM {CONFIG} WHERE NOT {SHIPPED}
                        UNION ALL SELECT * REPLACE ('RESET' AS pipeline_group) FROM {CONFIG} WHERE is_active""",
    "control_reset": CONTROL_RESET,
    "control_reset_load": CONTROL_RESET_LOAD,
    "run_states": f"SELECT audit_id, workflow_audit_id, run_status, rows_read, event_id FROM {RUNS}",
    "event_log": EVENT_LOG,
    "workflow_rollup": ROLLUP,
    "latest_runs": LATEST_RUNS,
    "write_full": WRITE_FULL,
    "write_append": WRITE_APPEND,
    "silver_load_merge": SILVER_LOAD_MERGE,
    "silver_load_parts": SILVER_LOAD_MERGE,
    "silver_load_rejects": SILVER_LOAD_REJECTS,
    "silver_load_results": SILVER_LOAD_RESULTS,
    "silver_load_watermark": SILVER_LOAD_WATERMARK,
    "gold_load_merge": GOLD_LOAD_MERGE,
    "gold_load_incremental": GOLD_LOAD_MERGE,
    "stream_silver": STREAM_SILVER,
    "stream_out_of_order": STREAM_SILVER,
    "group_run": GROUP_RUN,
    "load_audit": LOAD_AUDIT,
    "workflow_completed": WORKFLOW_COMPLETED,
}
