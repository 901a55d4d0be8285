"""Registered jobs: name -> (spark, sf_dir) -> DataFrame, with oracle SQL.

Every job reads the provided tables (or data Spark derives from them) in
full. The oracle SQL is written independently for DuckDB over the same
Parquet files; column names match the job's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import BLANK_PATTERN, QUOTED_TOKEN_PATTERN
from ledgerline.functions.timefmt import to_service_zone
from ledgerline.operators import errors, guard, jsonio, jsontree, keys, lifecycle, lookup, metrics, runs, validate
from ledgerline.operators.envelope import flatten_envelope
from ledgerline.plans import inputs
from ledgerline.plans.layout import spread

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Job) -> Job:
        JOBS[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _catalogue_case(col: str, field: int) -> str:
    arms = " ".join(f"WHEN {_q(r[0])} THEN {r[field] if isinstance(r[field], int) else _q(r[field])}"
                    for r in errors.ERROR_CATALOGUE)
    return f"CASE {col} {arms} END"


# --- step 1: scan, key lookup, projection -------------------------------------

@register("entity_projection", sql=inputs.ENTITIES_PART_SQL)
def entity_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.project(inputs.entities_from_part(spark, sf_dir))


@register("lookup_by_key", sql=f"""
SELECT id, name, description FROM ({inputs.ENTITIES_PART_SQL}) e
WHERE id IN (SELECT doc_id FROM documents)
""")
def lookup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inputs.document_requests(spark, sf_dir).select(F.col("request_id").alias("id"))
    return lookup.project(lookup.find_many(inputs.entities_from_part(spark, sf_dir), wanted))


@register("find_one", sql=f"""
SELECT id, name, description FROM ({inputs.ENTITIES_PART_SQL}) e WHERE id = 42
""")
def find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 for one key: the predicate is pushed into the scan."""
    return lookup.project(lookup.find(inputs.entities_from_part(spark, sf_dir), 42))


@register("lookup_hot_key", sql=f"""
SELECT request_id, r.id, e.id IS NOT NULL AS found, name, description
FROM ({inputs.HOT_REQUESTS_SQL}) r LEFT JOIN ({inputs.ENTITIES_PART_SQL}) e ON r.id = e.id
""")
def lookup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 where one key has half of the requests: it is split off by a sketch."""
    out = lookup.lookup(inputs.hot_requests(spark, sf_dir), inputs.entities_from_part(spark, sf_dir), strategy="split_hot")
    return out.select("request_id", "id", "found", "entity.name", "entity.description")


# --- step 2: lookup with typed miss, envelope, typed keys, routing -----------

def _answer(requests: DataFrame, entities: DataFrame) -> DataFrame:
    checked = validate.check_key(requests, raw="raw_id", out="id")
    kind = F.col("error_kind")
    checked = checked.withColumn(
        "error_type", F.when(kind.isNotNull(), errors.route_error_type(kind, F.lit(None))))
    return flatten_envelope(lookup.answer(checked.drop("error_kind"), entities, key="id"))


def _answer_sql(requests_sql: str, entities_sql: str) -> str:
    key_ok = "regexp_matches(raw_id, '^ *[+-]?[0-9]+ *$')"
    parsed = f"CASE WHEN {key_ok} THEN TRY_CAST(trim(raw_id) AS BIGINT) END"
    return f"""
WITH r AS (
  SELECT request_id, raw_id, {parsed} AS id FROM ({requests_sql}) q
), c AS (
  SELECT r.*,
    CASE WHEN raw_id IS NULL THEN 'BAD_REQUEST' WHEN id IS NULL THEN 'BAD_REQUEST' END AS rej_type,
    CASE WHEN raw_id IS NULL THEN 'Required parameter ''id'' (type Long) is missing.'
         WHEN id IS NULL THEN 'Parameter ''id'' (type Long) has an invalid value ''' || raw_id || '''.' END AS rej_msg
  FROM r
), j AS (
  SELECT c.*, e.id AS eid, e.name AS ename, e.description AS edesc
  FROM c LEFT JOIN ({entities_sql}) e ON c.id = e.id
), t AS (
  SELECT j.*,
    CASE WHEN rej_type IS NOT NULL THEN rej_type WHEN eid IS NULL THEN 'NOT_FOUND' END AS err_type,
    CASE WHEN rej_type IS NOT NULL THEN rej_msg WHEN eid IS NULL THEN printf('No item was found for id %d.', id) END AS custom
  FROM j
)
SELECT request_id, raw_id, id,
  CASE WHEN err_type IS NULL THEN 'SUCCESS' ELSE 'FAIL' END AS result,
  {_catalogue_case('err_type', 2)} AS error_code,
  CASE WHEN err_type IS NULL THEN NULL ELSE coalesce(custom, {_catalogue_case('err_type', 3)}) END AS message,
  CASE WHEN err_type IS NULL THEN eid END AS data_id,
  CASE WHEN err_type IS NULL THEN ename END AS data_name,
  CASE WHEN err_type IS NULL THEN edesc END AS data_description,
  CASE WHEN err_type IS NULL THEN 200 ELSE {_catalogue_case('err_type', 1)} END AS status
FROM t
"""


@register("bulk_lookup", sql=_answer_sql(inputs.DOCUMENT_REQUESTS_SQL, inputs.ENTITIES_LABELS_SQL))
def bulk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document id looked up among the labelled documents."""
    return _answer(inputs.document_requests(spark, sf_dir), inputs.entities_from_labels(spark, sf_dir))


@register("api_lookup", sql=_answer_sql(inputs.RAW_KEY_REQUESTS_SQL, inputs.ENTITIES_PART_SQL))
def api_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw request keys -> V3/V2 -> lookup -> projection -> envelope."""
    return _answer(inputs.raw_key_requests(spark, sf_dir), inputs.entities_from_part(spark, sf_dir))


@register("typed_key_check", sql=f"""
WITH r AS (
  SELECT request_id, raw_id,
    CASE WHEN regexp_matches(raw_id, '^ *[+-]?[0-9]+ *$') THEN TRY_CAST(trim(raw_id) AS BIGINT) END AS id
  FROM ({inputs.RAW_KEY_REQUESTS_SQL}) q
)
SELECT request_id, raw_id, id,
  CASE WHEN raw_id IS NULL THEN 'missing_parameter' WHEN id IS NULL THEN 'type_mismatch' END AS error_kind,
  CASE WHEN raw_id IS NULL OR id IS NULL THEN 'BAD_REQUEST' END AS error_type,
  CASE WHEN raw_id IS NULL THEN 'Required parameter ''id'' (type Long) is missing.'
       WHEN id IS NULL THEN 'Parameter ''id'' (type Long) has an invalid value ''' || raw_id || '''.' END AS message
FROM r
""")
def typed_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.check_key(inputs.raw_key_requests(spark, sf_dir), raw="raw_id", out="id")
    kind = F.col("error_kind")
    return checked.select(
        "request_id", "raw_id", "id", "error_kind",
        F.when(kind.isNotNull(), errors.route_error_type(kind, F.lit(None))).alias("error_type"),
        F.col("custom_message").alias("message"),
    )


@register("error_routing", sql=f"""
WITH e AS ({inputs.ERROR_EVENTS_SQL}),
t AS (
  SELECT e.*,
    CASE WHEN kind = 'domain' THEN domain_type
         WHEN kind IN ('type_mismatch', 'missing_parameter', 'unreadable_body', 'input_error') THEN 'BAD_REQUEST'
         WHEN kind = 'no_resource' THEN 'NOT_FOUND' ELSE 'INTERNAL_ERROR' END AS error_type,
    CASE WHEN kind = 'domain' THEN detail
         WHEN kind IN ('type_mismatch', 'missing_parameter', 'unreadable_body', 'input_error') THEN detail END AS custom
  FROM e
)
SELECT id, kind, domain_type, detail, error_type,
  {_catalogue_case('error_type', 1)} AS status,
  {_catalogue_case('error_type', 2)} AS code,
  coalesce(custom, {_catalogue_case('error_type', 3)}) AS message
FROM t
""")
def error_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.route_errors(inputs.error_events(spark, sf_dir))


def _catalogue_values_sql() -> str:
    rows = ", ".join(f"({_q(t)}, {st}, {_q(c)}, {_q(m)})" for t, st, c, m in errors.ERROR_CATALOGUE)
    return f"SELECT * FROM (VALUES {rows}) AS c(error_type, status, code, message)"


@register("error_catalogue", sql=f"""
WITH e AS ({inputs.ERROR_EVENTS_SQL}),
t AS (
  SELECT CASE WHEN kind = 'domain' THEN domain_type
              WHEN kind IN ('type_mismatch', 'missing_parameter', 'unreadable_body', 'input_error') THEN 'BAD_REQUEST'
              WHEN kind = 'no_resource' THEN 'NOT_FOUND' ELSE 'INTERNAL_ERROR' END AS error_type
  FROM e
),
n AS (SELECT error_type, count(*) AS n_errors FROM t GROUP BY error_type)
SELECT c.error_type, CAST(c.status AS INTEGER) AS status, c.code, c.message, coalesce(n.n_errors, 0) AS n_errors
FROM ({_catalogue_values_sql()}) c LEFT JOIN n ON c.error_type = n.error_type
""")
def error_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the catalogue with the number of routed errors of each type."""
    return errors.catalogue_counts(errors.route_errors(inputs.error_events(spark, sf_dir)))


# --- step 3: blank rule, quoted token ------------------------------------------

@register("blank_guard", sql=f"""
WITH c AS ({inputs.BLANK_CANDIDATES_SQL}),
v AS (
  SELECT id, name, description,
    CASE WHEN coalesce(regexp_matches(name, {_q(BLANK_PATTERN)}), true) THEN 'name_blank'
         WHEN coalesce(regexp_matches(description, {_q(BLANK_PATTERN)}), true) THEN 'description_blank' END AS rule
  FROM c
)
SELECT id, name, description, rule, rule IS NULL AS accepted,
  CASE WHEN rule IS NOT NULL THEN 'BAD_REQUEST' END AS error_type,
  CASE rule WHEN 'name_blank' THEN 'Name must not be blank.'
            WHEN 'description_blank' THEN 'Description must not be blank.' END AS message
FROM v
""")
def blank_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.apply_rules(inputs.blank_candidates(spark, sf_dir), validate.entity_rules())
    return out.withColumnRenamed("custom_message", "message")


@register("quoted_token", sql=f"""
WITH r AS ({inputs.REASON_TEXTS_SQL}),
t AS (SELECT id, reason, regexp_extract(reason, {_q(QUOTED_TOKEN_PATTERN)}, 1) AS token FROM r)
SELECT id, reason, token, 'BAD_REQUEST' AS error_type,
  CASE WHEN token <> '' THEN 'Required value ''' || token || ''' is missing.'
       ELSE {_catalogue_case("'BAD_REQUEST'", 3)} END AS message
FROM t
""")
def quoted_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.functions.text import quoted_token as token_of

    r = inputs.reason_texts(spark, sf_dir)
    message = F.coalesce(validate.missing_value_message(F.col("reason")), F.lit(errors.default_message("BAD_REQUEST")))
    return r.select(
        "id", "reason", token_of(F.col("reason")).alias("token"), F.lit("BAD_REQUEST").alias("error_type"),
        message.alias("message"),
    )


# --- step 4: lifecycle fold ------------------------------------------------------

def _fold_sql(changes_sql: str) -> str:
    return f"""
WITH c AS ({changes_sql}),
v AS (SELECT * FROM c WHERE NOT (op = 'UPDATE' AND coalesce(regexp_matches(description, {_q(BLANK_PATTERN)}), true))),
m AS (SELECT *, CASE WHEN op IN ('DELETE', 'RESTORE') THEN 'mark' ELSE 'value' END AS kind,
             CASE WHEN op IN ('DELETE', 'RESTORE') THEN op ELSE description END AS x FROM v),
l AS (SELECT *, lag(x) OVER w AS prev, lag(event_id) OVER w IS NOT NULL AS has_prev
      FROM m WINDOW w AS (PARTITION BY id, kind ORDER BY ts, event_id)),
e AS (SELECT *, CASE WHEN op = 'CREATE' THEN true
                     WHEN op = 'UPDATE' THEN NOT has_prev OR x IS DISTINCT FROM prev
                     WHEN op = 'DELETE' THEN NOT has_prev OR prev = 'RESTORE'
                     WHEN op = 'RESTORE' THEN has_prev AND prev = 'DELETE' ELSE false END AS eff FROM l)
SELECT id,
  arg_max(x, ts) FILTER (WHERE kind = 'value') AS description,
  coalesce(min(ts) FILTER (WHERE op = 'CREATE'), min(ts)) AS created_at,
  max(ts) FILTER (WHERE eff) AS updated_at,
  CASE WHEN arg_max(op, ts) FILTER (WHERE kind = 'mark' AND eff) = 'DELETE'
       THEN max(ts) FILTER (WHERE kind = 'mark' AND eff) END AS deleted_at
FROM e GROUP BY id
"""


@register("lifecycle_snapshot", sql=_fold_sql(inputs.CHANGE_LOG_SQL))
def lifecycle_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.fold(inputs.change_log(spark, sf_dir))


@register("lifecycle_burst", sql=_fold_sql(inputs.BURST_LOG_SQL))
def lifecycle_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the log on one id within one hour: slices are cut by count
    (few rows a slice here, so that small tables have several)."""
    return lifecycle.fold(inputs.burst_log(spark, sf_dir), max_slice_rows=1000)


# Rules on the state a change meets; a value's class is the number in it.
GUARD_RULES = (
    guard.Rule("not_deleted", "A deleted item cannot be changed.",
               lambda was: F.lit(was.deleted) & (F.col("op") == "UPDATE")),
    guard.Rule("small_fall", "The value may fall by one step at most.",
               lambda was: (F.col("op") == "UPDATE") & (F.col("value_class") < F.lit(was.value).cast("int") - 1)),
)
VALUE_CLASSES = 10


def _guarded(changes: DataFrame) -> DataFrame:
    step = F.least(F.substring("description", 2, 9).try_cast("int"), F.lit(VALUE_CLASSES - 1))
    return guard.guard(changes, GUARD_RULES, step, VALUE_CLASSES)


def _guard_sql(changes_sql: str) -> str:
    """Row by row: a recursion that takes one change of every id at a time."""
    return f"""
WITH RECURSIVE c AS ({changes_sql}),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS rn,
        op = 'UPDATE' AND coalesce(regexp_matches(description, {_q(BLANK_PATTERN)}), true) AS blank,
        least(TRY_CAST(substr(description, 2, 9) AS INTEGER), {VALUE_CLASSES - 1}) AS cls FROM c),
m AS (
  SELECT id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, false AS deleted, CAST(NULL AS INTEGER) AS val, 0 AS verdict
  FROM (SELECT DISTINCT id FROM c)
  UNION ALL
  SELECT id, rn, event_id,
    CASE WHEN v = 0 AND op IN ('DELETE', 'RESTORE') THEN op = 'DELETE' ELSE deleted END,
    CASE WHEN v = 0 AND op IN ('CREATE', 'UPDATE') THEN cls ELSE val END, v
  FROM (SELECT n.id, n.rn, n.event_id, n.op, n.cls, m.deleted, m.val,
          CASE WHEN blank THEN 1 WHEN op = 'UPDATE' AND deleted THEN 2 WHEN op = 'UPDATE' AND cls < val - 1 THEN 3 ELSE 0 END AS v
        FROM m JOIN n ON n.id = m.id AND n.rn = m.rn + 1)),
g AS (SELECT c.*, m.verdict FROM c JOIN m USING (event_id))
"""


@register("guard_rejects", sql=_guard_sql(inputs.BURST_LOG_SQL) + """
SELECT id, event_id, ts, op, description,
  CASE verdict WHEN 1 THEN 'not_blank' WHEN 2 THEN 'not_deleted' ELSE 'small_fall' END AS rule,
  CASE verdict WHEN 1 THEN 'Description must not be blank.' WHEN 2 THEN 'A deleted item cannot be changed.'
       ELSE 'The value may fall by one step at most.' END AS message
FROM g WHERE verdict > 0
""")
def guard_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes rejected by rules on the state they meet; a third of the log is on one id."""
    return _guarded(inputs.burst_log(spark, sf_dir)).where("rule IS NOT NULL")


@register("lifecycle_guarded", sql=_guard_sql(inputs.CHANGE_LOG_SQL) + f"""
SELECT * FROM ({_fold_sql("SELECT id, event_id, ts, op, description FROM g WHERE verdict = 0")}) f
""")
def lifecycle_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of the accepted changes."""
    return lifecycle.fold(_guarded(inputs.change_log(spark, sf_dir)).where("rule IS NULL"))


@register("lifecycle_incremental", sql=_fold_sql(inputs.CHANGE_LOG_SQL))
def lifecycle_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold the log before the cut into a stored snapshot, then apply the rest
    incrementally to it; must equal the full fold."""
    from ledgerline.session import scratch_path

    log = inputs.change_log(spark, sf_dir)
    cut = F.lit(inputs.INCREMENTAL_CUT).cast("timestamp_ntz")
    path = scratch_path(spark, "snapshot")
    lifecycle.fold(log.where(F.col("ts") < cut), resumable=True).write.parquet(path)
    return lifecycle.fold_incremental(spark.read.parquet(path), log.where(F.col("ts") >= cut)).drop("has_create")


@register("lifecycle_late", sql=_fold_sql(inputs.CHANGE_LOG_SQL))
def lifecycle_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log, where every RESTORE arrives only after the snapshot was
    stored: the affected ids are re-folded from their whole history. Must
    equal the fold of all changes."""
    from ledgerline.session import scratch_path

    log = inputs.change_log(spark, sf_dir)
    late = F.col("op") == "RESTORE"
    on_time, arrived_late = log.where(~late), log.where(late)
    path = scratch_path(spark, "snapshot")
    lifecycle.fold(on_time).write.parquet(path)
    return lifecycle.apply_late_changes(spark.read.parquet(path), on_time, arrived_late)


@register("lifecycle_rejects", sql=f"""
SELECT id, event_id, ts, op, description, 'BAD_REQUEST' AS error_type, 'Description must not be blank.' AS message
FROM ({inputs.CHANGE_LOG_SQL}) c
WHERE op = 'UPDATE' AND coalesce(regexp_matches(description, {_q(BLANK_PATTERN)}), true)
""")
def lifecycle_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.rejected_changes(inputs.change_log(spark, sf_dir))


@register("assign_keys_ties", sql="""
SELECT doc_id, row_number() OVER (ORDER BY nullif(source, 'src0') NULLS FIRST, doc_id) AS id FROM documents
""")
def assign_keys_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 over many ranges with a text leading key that repeats and is often
    null: every row gets its id."""
    docs = inputs.read_table(spark, sf_dir, "documents").select("doc_id", F.nullif("source", F.lit("src0")).alias("lead"))
    return keys.assign_ids(docs, ["lead", "doc_id"], start=0, rows_per_range=100).select("doc_id", "id")


@register("assign_keys", sql=f"""
SELECT (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY doc_id) AS id,
  doc_id, source AS name, lang AS description
FROM documents
""")
def assign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document appended to the part-entity table gets the next id in
    doc_id order. Small ranges here so the multi-range path is exercised."""
    docs = inputs.read_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("name"), F.col("lang").alias("description"))
    return keys.next_ids(docs, inputs.entities_from_part(spark, sf_dir), ["doc_id"], rows_per_range=100)


@register("kst_render", sql="""
SELECT event_id, ts, ts + INTERVAL 9 HOUR AS ts_local,
  CAST(hour(ts + INTERVAL 9 HOUR) AS INTEGER) AS local_hour
FROM events
""")
def kst_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = inputs.read_table(spark, sf_dir, "events")
    local = to_service_zone(F.col("ts"))
    return ev.select("event_id", "ts", local.alias("ts_local"), F.hour(local).alias("local_hour"))


# --- step 5: batch job, run accounting, metrics -----------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("daily_slice", sql=f"""
SELECT {", ".join(ORDER_COLUMNS)} FROM orders
WHERE o_orderdate >= DATE '{inputs.DAILY_REQUEST_DATE}' AND o_orderdate < DATE '{inputs.DAILY_REQUEST_DATE}' + INTERVAL 1 DAY
""")
def daily_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = runs.run_daily(inputs.read_table(spark, sf_dir, "orders"), "o_orderdate",
                            inputs.DAILY_REQUEST_DATE, columns=ORDER_COLUMNS)
    return result.rows


@register("daily_runs", sql=f"""
SELECT 'COMPLETED' AS status, '{inputs.DAILY_REQUEST_DATE}' AS request_date, count(*) AS write_count FROM orders
WHERE o_orderdate >= DATE '{inputs.DAILY_REQUEST_DATE}' AND o_orderdate < DATE '{inputs.DAILY_REQUEST_DATE}' + INTERVAL 1 DAY
UNION ALL SELECT 'FAILED', NULL, NULL
UNION ALL SELECT 'FAILED', 'no date', NULL
""")
def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1's run log: a run with a date, one without, one whose date is none."""
    from ledgerline.session import scratch_path

    out, log = scratch_path(spark, "daily"), scratch_path(spark, "daily-runs")
    orders = inputs.read_table(spark, sf_dir, "orders")
    for date in (inputs.DAILY_REQUEST_DATE, None, "no date"):
        runs.run_daily(orders, "o_orderdate", date, columns=ORDER_COLUMNS, out_path=out, run_log_path=log)
    return spark.read.parquet(log).select("status", "request_date", "write_count")


@register("run_durations", sql=f"""
WITH r AS ({inputs.RUN_LOG_SQL})
SELECT run_id, job_name,
  make_timestamp(start_ms * 1000) + INTERVAL 9 HOUR AS start_local,
  make_timestamp(end_ms * 1000) + INTERVAL 9 HOUR AS end_local,
  end_ms - start_ms AS total_ms,
  (end_ms - start_ms) // 3600000 AS hours,
  ((end_ms - start_ms) // 60000) % 60 AS minutes,
  ((end_ms - start_ms) // 1000) % 60 AS seconds
FROM r
""")
def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_durations(inputs.run_log(spark, sf_dir))


@register("step_status", sql=f"""
WITH s AS ({inputs.STEP_LOG_SQL})
SELECT step_id, count(*) AS n_rows, count(*) FILTER (WHERE failed) AS n_failures,
  CASE WHEN bool_or(failed) THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  coalesce(string_agg(message, chr(10) ORDER BY ts, event_id) FILTER (WHERE failed), '') AS messages
FROM s GROUP BY step_id
""")
def step_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.step_status(inputs.step_log(spark, sf_dir))


def _histogram_sql() -> str:
    les = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS {metrics.bound_name(b)}"
                    for b in sorted(metrics.DEFAULT_BOUNDS))
    return f"""
SELECT event_type, {les}, count(value) AS le_inf, count(value) AS count,
  CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) AS sum, 'ledgerline' AS application
FROM events GROUP BY event_type
"""


@register("latency_histogram", sql=_histogram_sql())
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = inputs.read_table(spark, sf_dir, "events")
    return metrics.latency_histogram(ev, "value", ["event_type"], application="ledgerline")


# --- step 6: JSON decode / rejects / encode -------------------------------------------

LEVELS = ("LOW", "MID", "HIGH")
PAYLOAD_SCHEMA = (
    jsonio.Field("k", "int", required=True),
    jsonio.Field("tags", "string_array"),
    jsonio.Field("level", "enum", values=LEVELS),
    jsonio.Field("meta", "object", fields=(jsonio.Field("source", "string"),)),
)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonio.decode(spread(inputs.json_payloads(spark, sf_dir)), "payload", PAYLOAD_SCHEMA)


def _cat(t: str) -> str:
    return (f"CASE WHEN {t} IS NULL THEN 'missing' WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'ARRAY' THEN 'array' "
            f"WHEN {t} = 'OBJECT' THEN 'object' WHEN {t} = 'VARCHAR' THEN 'string' WHEN {t} = 'BOOLEAN' THEN 'boolean' "
            f"ELSE 'number' END")


def _wrong(path: str, value: str, type_name: str, allowed: str = "") -> str:
    head = _q(f"Field '{path}' has value '")
    tail = _q(f"', which does not match the expected type ({type_name}).{allowed}")
    return f"{{'kind': 'wrong_type', 'path': {_q(path)}, 'message': {head} || {value} || {tail}}}"


def _shape(path: str) -> str:
    msg = _q(f"Required field '{path}' is missing or has the wrong shape.")
    return f"{{'kind': 'missing_field', 'path': {_q(path)}, 'message': {msg}}}"


_LEVELS_SQL = "[" + ", ".join(_q(x) for x in LEVELS) + "]"
_LEVELS_IN = "(" + ", ".join(_q(x) for x in LEVELS) + ")"
_ALLOWED_TEXT = " Allowed values: [" + ", ".join(LEVELS) + "]"

JSON_DECODE_SQL = f"""
WITH p AS ({inputs.JSON_PAYLOADS_SQL}),
v AS (SELECT id, payload, json_valid(payload) AS valid FROM p),
t AS (
  SELECT id, payload, valid,
    CASE WHEN valid THEN json_type(payload) END AS root_t,
    CASE WHEN valid THEN {_cat("json_type(payload, '$.k')")} END AS k_c,
    CASE WHEN valid THEN json_extract_string(payload, '$.k') END AS k_s,
    CASE WHEN valid THEN {_cat("json_type(payload, '$.tags')")} END AS tags_c,
    CASE WHEN valid THEN json_extract_string(payload, '$.tags') END AS tags_s,
    CASE WHEN valid THEN json_extract_string(payload, '$.tags[*]') END AS tags_l,
    CASE WHEN valid THEN list_has_any(json_type(payload, '$.tags[*]'), ['ARRAY', 'OBJECT']) END AS tags_nested,
    CASE WHEN valid THEN {_cat("json_type(payload, '$.level')")} END AS level_c,
    CASE WHEN valid THEN json_extract_string(payload, '$.level') END AS level_s,
    CASE WHEN valid THEN {_cat("json_type(payload, '$.meta')")} END AS meta_c,
    CASE WHEN valid THEN json_extract_string(payload, '$.meta') END AS meta_s,
    CASE WHEN valid THEN {_cat("json_type(payload, '$.meta.source')")} END AS src_c,
    CASE WHEN valid THEN json_extract_string(payload, '$.meta.source') END AS src_s
  FROM v
),
n AS (
  SELECT t.*,
    CASE WHEN k_c = 'number' THEN TRY_CAST(trunc(TRY_CAST(k_s AS DOUBLE)) AS INTEGER)
         WHEN k_c = 'string' THEN TRY_CAST(k_s AS INTEGER) END AS k_num,
    CASE WHEN level_c = 'number' THEN TRY_CAST(trunc(TRY_CAST(level_s AS DOUBLE)) AS INTEGER) END AS level_idx
  FROM t
),
r AS (
  SELECT n.*,
    CASE WHEN NOT valid THEN {{'kind': 'unreadable', 'path': '', 'message': {_q(jsonio.UNREADABLE_MESSAGE)}}}
         WHEN root_t <> 'OBJECT' THEN {_shape("")}
         WHEN k_c IN ('number', 'string') AND k_num IS NULL THEN {_wrong("k", "k_s", "Integer")}
         WHEN k_c IN ('boolean', 'array', 'object', 'null') THEN {_shape("k")}
         WHEN tags_c = 'array' AND tags_nested THEN {_shape("tags.?")}
         WHEN tags_c = 'object' THEN {_shape("tags")}
         WHEN (level_c = 'string' AND level_s NOT IN {_LEVELS_IN} AND level_s <> '')
           OR (level_c = 'number' AND NOT coalesce(level_idx BETWEEN 0 AND {len(LEVELS) - 1}, false))
           THEN {_wrong("level", "level_s", "Enum", _ALLOWED_TEXT)}
         WHEN level_c IN ('boolean', 'array', 'object') THEN {_shape("level")}
         WHEN meta_c = 'object' AND src_c IN ('array', 'object') THEN {_shape("meta.source")}
         WHEN meta_c IN ('array', 'boolean', 'number') OR (meta_c = 'string' AND meta_s <> '') THEN {_shape("meta")}
         WHEN k_c = 'missing' THEN {_shape("k")}
    END AS reject
  FROM n
),
d AS (
  SELECT r.*, reject IS NULL AS accepted,
    CASE WHEN reject IS NULL THEN
      CASE WHEN tags_c = 'array' THEN tags_l WHEN tags_c IN ('string', 'number', 'boolean') THEN [tags_s] END
    END AS tags_list
  FROM r
)
SELECT id, payload, accepted,
  CASE WHEN accepted THEN k_num END AS k,
  array_to_string(tags_list, '|') AS tags,
  CAST(len(tags_list) AS INTEGER) AS n_tags,
  CASE WHEN accepted THEN
    CASE WHEN level_c = 'string' AND level_s IN {_LEVELS_IN} THEN level_s
         WHEN level_c = 'number' THEN list_extract({_LEVELS_SQL}, level_idx + 1) END
  END AS level,
  CASE WHEN accepted AND meta_c = 'object' AND src_c IN ('string', 'number', 'boolean') THEN src_s END AS meta_source,
  reject.kind AS reject_kind, reject.path AS reject_path, reject.message AS message
FROM d
"""


@register("json_decode", sql=JSON_DECODE_SQL)
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _decoded(spark, sf_dir)
    r = F.col("reject")
    return d.select(
        "id", "payload", "accepted", "k",
        F.array_join("tags", "|").alias("tags"),
        F.when(F.col("tags").isNotNull(), F.size("tags")).alias("n_tags"),  # size(null) is -1 without ANSI
        "level", "meta_source",
        r["kind"].alias("reject_kind"), r["path"].alias("reject_path"), r["message"].alias("message"),
    )


@register("json_rejects", sql=f"""
SELECT id, payload, reject_kind, reject_path, message, 'BAD_REQUEST' AS error_type
FROM ({JSON_DECODE_SQL}) x WHERE NOT accepted
""")
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonio.rejects(_decoded(spark, sf_dir)).select(
        "id", "payload", "reject_kind", "reject_path", "message", "error_type")


@register("json_encode", sql="""
SELECT event_id,
  '{' || concat_ws(',',
     '"event_id":' || CAST(event_id AS VARCHAR),
     '"event_type":' || CAST(to_json(event_type) AS VARCHAR),
     '"amount":' || CAST(CAST(value / 1e9 AS DECIMAL(20,12)) AS VARCHAR),
     CASE WHEN event_id % 4 <> 0 THEN '"note":' || CAST(to_json(props) AS VARCHAR) END,
     '"meta":{"user":' || CAST(user_id AS VARCHAR) || '}') || '}' AS json
FROM events
""")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonio.encode(spread(inputs.encodable_rows(spark, sf_dir))).select("event_id", "json")


TYPED_SCHEMA = (
    jsonio.Field("event_id", "long", required=True),
    jsonio.Field("event_type", "string"),
    jsonio.Field("value", "double"),
    jsonio.Field("amount", "decimal", precision=(20, 12)),
    jsonio.Field("even", "boolean", required=True),
    jsonio.Field("note", "string"),
    jsonio.Field("meta", "object", fields=(jsonio.Field("user", "long"), jsonio.Field("tag", "string"))),
)


@register("json_typed", sql="""
SELECT event_id, event_type, value, CAST(CAST(value / 1e9 AS DECIMAL(20,12)) AS DOUBLE) AS amount,
  event_id % 2 = 0 AS even, CASE WHEN event_id % 4 <> 0 THEN props END AS note, user_id AS meta_user,
  CAST(NULL AS VARCHAR) AS meta_tag, true AS accepted
FROM events
""")
def json_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 then J1: events encoded and decoded again as long, double, decimal,
    boolean and text fields, with fields left out, are what they were."""
    rows = inputs.encodable_rows(spark, sf_dir, "value").withColumn("even", F.col("event_id") % 2 == 0)
    sent = jsonio.encode(spread(rows)).select("json")
    return jsonio.decode(sent, "json", TYPED_SCHEMA).select(
        "event_id", "event_type", "value", F.col("amount").cast("double").alias("amount"), "even", "note", "meta_user",
        "meta_tag", "accepted")


# --- step 7: streaming ingestion, chunk counts, Kafka shaping, append -----------------

def _stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads as Kafka-shaped records: key = id, offset = id, three
    topic partitions by key hash."""
    p = inputs.json_payloads(spark, sf_dir)
    return p.select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
        F.lit("ledger-events").alias("topic"),
        F.pmod(F.hash("id"), F.lit(3)).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
    )


STREAM_FILES, STREAM_BATCHES = 8, 3


def _write_files(df: DataFrame, path: str) -> int:
    """Write a stream's input as several files; returns how many of them make a third of the stream."""
    df = spread(df, STREAM_FILES)
    files = df.rdd.getNumPartitions()
    df.write.mode("append").parquet(path)
    return -(-files // STREAM_BATCHES)


def _decode_batch(batch: DataFrame) -> DataFrame:
    from ledgerline.streaming import ingest

    recs = ingest.decode_value(batch).select(F.col("key").cast("bigint").alias("id"), F.col("value").alias("payload"))
    d = jsonio.decode(recs, "payload", PAYLOAD_SCHEMA)
    return d.select("id", "accepted", "k", "level", "meta_source", F.col("reject")["kind"].alias("reject_kind"),
                    validate.verdict(F.col("accepted")).alias("verdict"))


def _run_stream(spark: SparkSession, sf_dir: str, with_counts: bool) -> tuple[str, str | None]:
    """Write the records as files, consume them as a stream through the
    idempotent batch writer; returns (output path, counts path or None)."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ingest

    src, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    counts = scratch_path(spark, "stream-counts") if with_counts else None
    ckpt = scratch_path(spark, "stream-ckpt")
    per_trigger = _write_files(_stream_records(spark, sf_dir), src)
    fn = ingest.idempotent_batch_writer(_decode_batch, out, "payloads", counts, partition_by=("verdict",))
    ingest.ingest_available(spark, ingest.file_stream(spark, src, files_per_trigger=per_trigger), fn, ckpt)
    return out, counts


@register("stream_ingest", sql=f"""
SELECT id, accepted, k, level, meta_source, reject_kind FROM ({JSON_DECODE_SQL}) x
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records consumed in micro-batches equal the batch decode of the whole
    input."""
    out, _ = _run_stream(spark, sf_dir, with_counts=False)
    return spark.read.parquet(out).select("id", "accepted", "k", "level", "meta_source", "reject_kind")


@register("chunk_counts", sql=f"""
SELECT count(*) AS read_count, count(*) AS write_count, count_if(accepted) AS accepted_count,
  count_if(NOT accepted) AS rejected_count
FROM ({JSON_DECODE_SQL}) x
""")
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4: rows read, written, accepted and rejected, summed over the
    micro-batches (where a batch ends depends on file arrival)."""
    _, counts = _run_stream(spark, sf_dir, with_counts=True)
    names = ["read_count", "write_count", "accepted_count", "rejected_count"]
    return spark.read.parquet(counts).agg(*[F.sum(c).alias(c) for c in names])


@register("kafka_shape", sql="""
SELECT CAST(p_partkey AS VARCHAR) AS key,
  '{"id":' || CAST(p_partkey AS VARCHAR) || ',"name":' || CAST(to_json(p_name) AS VARCHAR)
  || ',"description":' || CAST(to_json(p_type) AS VARCHAR) || '}' AS value
FROM part
""")
def kafka_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4: entities as (string key, JSON value); text here, bytes at the sink."""
    from ledgerline.streaming import to_kafka_records

    return to_kafka_records(inputs.entities_from_part(spark, sf_dir), "id", as_binary=False)


def _append(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """S5: guard (V1) -> identity keys (L6) -> stamp (L1) -> append. Returns
    the paths of the entity table and of the split candidates."""
    from ledgerline.session import scratch_path
    from ledgerline.sources.tables import write_append

    table, checked = scratch_path(spark, "entities"), scratch_path(spark, "candidates")
    stamp = F.current_timestamp().cast("timestamp_ntz")
    stamps = {"created_at": stamp, "updated_at": stamp, "deleted_at": F.lit(None).cast("timestamp_ntz")}
    write_append(inputs.entities_from_part(spark, sf_dir).withColumns(stamps), table)
    validate.write_split(inputs.blank_candidates(spark, sf_dir), validate.entity_rules(), checked)
    accepted = spark.read.parquet(checked).where(F.col("verdict") == "accepted").select(
        F.col("id").alias("source_id"), "name", "description")
    new = keys.next_ids(accepted, spark.read.parquet(table), ["source_id"], rows_per_range=1000)
    write_append(new.withColumns(stamps).select("id", "name", "description", *stamps), table)
    return table, checked


@register("append_entities", sql=f"""
WITH c AS ({inputs.BLANK_CANDIDATES_SQL}),
ok AS (
  SELECT * FROM c
  WHERE NOT regexp_matches(name, {_q(BLANK_PATTERN)}) AND NOT regexp_matches(description, {_q(BLANK_PATTERN)})
)
SELECT id, name, description, true AS stamped FROM ({inputs.ENTITIES_PART_SQL}) e
UNION ALL
SELECT (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY id) AS id, name, description, true AS stamped FROM ok
""")
def append_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table read back holds the old entities and the accepted new ones;
    ``stamped``: created and updated at the same time, not deleted."""
    table, _ = _append(spark, sf_dir)
    stamped = F.col("created_at").eqNullSafe(F.col("updated_at")) & F.col("created_at").isNotNull() & F.col("deleted_at").isNull()
    return spark.read.parquet(table).select("id", "name", "description", stamped.alias("stamped"))


@register("append_rejects", sql=f"""
WITH c AS ({inputs.BLANK_CANDIDATES_SQL})
SELECT id, name, description,
  CASE WHEN coalesce(regexp_matches(name, {_q(BLANK_PATTERN)}), true) THEN 'name_blank' ELSE 'description_blank' END AS rule
FROM c
WHERE coalesce(regexp_matches(name, {_q(BLANK_PATTERN)}), true) OR coalesce(regexp_matches(description, {_q(BLANK_PATTERN)}), true)
""")
def append_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates that the guard keeps out of the appended table."""
    _, checked = _append(spark, sf_dir)
    return spark.read.parquet(checked).where(F.col("verdict") == "rejected").select("id", "name", "description", "rule")


@register("step_failures", sql=f"""
WITH s AS ({inputs.STEP_LOG_SQL})
SELECT step_id, CAST(floor(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) / 3600) AS BIGINT) AS slice,
  count(*) AS n_messages, string_agg(message, chr(10) ORDER BY ts, event_id) AS text
FROM s WHERE failed AND message IS NOT NULL GROUP BY 1, 2
""")
def step_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 in its bounded form: failure messages per (step, hour)."""
    return runs.step_failure_texts(inputs.step_log(spark, sf_dir))


# --- step 8: bodies of any shape, streams that stop and fail, chunks, parts, merged states ----

_LINES_SQL = """
SELECT l_orderkey AS order_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_returnflag) - 1 AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n, * FROM lineitem
"""

NESTED_SCHEMA = (
    jsonio.Field("id", "long", required=True),
    jsonio.Field("sizes", "array", items=jsonio.Field("", "int")),
    jsonio.Field("items", "array", required=True, items=jsonio.Field("", "object", required=True, fields=(
        jsonio.Field("part", "long", required=True), jsonio.Field("qty", "int", required=True),
        jsonio.Field("price", "decimal", precision=(20, 2)), jsonio.Field("flag", "enum", values=("A", "N", "R")),
        jsonio.Field("grid", "array", items=jsonio.Field("", "array", items=jsonio.Field("", "int")))))),
)


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The payloads come out of a shuffle, so they are spread already; ``spread`` would run that shuffle once more to count its parts.
    return jsontree.decode(inputs.nested_payloads(spark, sf_dir), "payload", NESTED_SCHEMA)


@register("json_nested", sql=f"""
SELECT order_id, n AS n_sizes, pos, l_partkey AS part, CAST(l_quantity AS BIGINT) AS qty, CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS DOUBLE) AS price,
  l_returnflag AS flag, l_linenumber || ',' || l_suppkey || ';' || l_linenumber AS grid
FROM ({_LINES_SQL}) WHERE order_id % 8 = 0 OR order_id % 8 = 1 AND pos = 0
""")
def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1: arrays of ints, decimals, enums and objects two levels deep; single
    values and objects taken as arrays of one."""
    body = _nested(spark, sf_dir).select("order_id", F.col("body.sizes")[0].alias("n_sizes"), F.posexplode("body.items").alias("pos", "item"))
    return body.select("order_id", F.col("n_sizes").cast("bigint").alias("n_sizes"), F.col("pos").cast("bigint").alias("pos"), "item.part",
                       F.col("item.qty").cast("bigint").alias("qty"), F.col("item.price").cast("double").alias("price"), "item.flag",
                       F.array_join(F.transform("item.grid", lambda r: F.array_join(r.cast("array<string>"), ",")), ";").alias("grid"))


def _nested_rejects_sql() -> str:
    wrong = "Field '{}' has value '{}', which does not match the expected type ({})."
    lost = "Required field '{}' is missing or has the wrong shape."
    cases = [  # condition on the order's id, kind, path, message
        ("v = 2", "wrong_type", "items.?.qty", wrong.format("items.?.qty", "x", "Integer")),
        ("v = 3", "wrong_type", "items.?.flag", wrong.format("items.?.flag", "Q", "Enum") + " Allowed values: [A, N, R]"),
        ("v = 4", "missing_field", "items.?.part", lost.format("items.?.part")),
        ("v = 5", "mapping_error", "items.?.qty", "Field 'items.?.qty': the number 99999999999 is out of the range of Integer."),
        ("v = 6", "missing_field", "items.?.grid.?.?", lost.format("items.?.grid.?.?")),
        ("v = 7 AND order_id // 8 % 2 = 0", "wrong_type", "id", wrong.format("id", "no", "Long")),
        ("v = 7 AND order_id // 8 % 2 = 1", "wrong_type", "sizes.?", wrong.format("sizes.?", "x", "Integer")),
    ]
    orders = "(SELECT DISTINCT l_orderkey AS order_id, l_orderkey % 8 AS v FROM lineitem)"
    return " UNION ALL ".join(f"SELECT order_id, {_q(k)} AS reject_kind, {_q(p)} AS reject_path, {_q(m)} AS message, "
                              f"'BAD_REQUEST' AS error_type FROM {orders} WHERE {c}" for c, k, p, m in cases)


@register("json_nested_rejects", sql=_nested_rejects_sql())
def json_nested_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: failures of array elements, mapping errors, and of two failures the one written first."""
    return jsontree.rejects(_nested(spark, sf_dir)).select("order_id", "reject_kind", "reject_path", "message", "error_type")


@register("stream_waves", sql=f"""
SELECT id, accepted, k, level, meta_source, reject_kind FROM ({JSON_DECODE_SQL}) x
""")
def stream_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 continuous: a running stream takes a first wave of files in several
    batches, is stopped, and after a second wave has arrived goes on where it
    was: nothing lost, nothing doubled."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ingest

    src, out, ckpt = (scratch_path(spark, f"waves-{x}") for x in ("in", "out", "ckpt"))
    fn = ingest.idempotent_batch_writer(_decode_batch, out, "waves", partition_by=("verdict",))
    records = _stream_records(spark, sf_dir)
    for wave in (0, 1):
        per_trigger = _write_files(records.filter(F.pmod(F.col("offset"), F.lit(2)) == wave), src)
        ingest.catch_up(ingest.ingest_continuously(spark, ingest.file_stream(spark, src, per_trigger), fn, ckpt, every="0 seconds"))
    return spark.read.parquet(out).select("id", "accepted", "k", "level", "meta_source", "reject_kind")


@register("redelivery_audit", sql="""
SELECT 'ledger-events' AS topic, event_id % 3 AS partition, count(*) AS n_records, min(event_id // 3) AS first_offset,
  max(event_id // 3) AS last_offset, 0 AS gaps, 0 AS repeats, 1 AS redelivered_batches
FROM events GROUP BY event_id % 3
""")
def redelivery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the second of at least three batches is written, fails before its
    commit and is delivered again; the output has no gap and no repeat."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ingest

    src, out, log, ckpt = (scratch_path(spark, f"audit-{x}") for x in ("in", "out", "log", "ckpt"))
    ids = F.col("event_id")
    records = inputs.read_table(spark, sf_dir, "events").select(
        ids.cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.lit("ledger-events").alias("topic"),
        F.pmod(ids, F.lit(3)).cast("int").alias("partition"), F.expr("event_id div 3").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    per_trigger = _write_files(records, src)
    keep = ingest.idempotent_batch_writer(lambda batch: batch.select("topic", "partition", "offset"), out, "audit")
    ingest.ingest_through_failure(spark, lambda: ingest.file_stream(spark, src, per_trigger), ingest.FailOnce(keep, 1, log), ckpt)
    again = ingest.redelivered(spark.read.parquet(log)).agg(F.count(F.lit(1)).alias("redelivered_batches"))
    return ingest.audit_offsets(spark.read.parquet(out).select("topic", "partition", "offset")).crossJoin(F.broadcast(again))  # one row


@register("chunk_log", sql=f"""
SELECT chunk, count(*) AS read_count, count_if(accepted) AS write_count
FROM (SELECT accepted, (row_number() OVER (ORDER BY id) - 1) // {runs.DEFAULT_CHUNK_ROWS} AS chunk FROM ({JSON_DECODE_SQL}) x) GROUP BY chunk
""")
def chunk_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4: rows read and written by each chunk of a fixed number of rows."""
    return runs.chunk_log(_decoded(spark, sf_dir).select("id", "accepted"), ["id"], F.col("accepted"))


PART_BYTES, PART_MESSAGES = 2048, 64  # small, so that the given logs have steps of many parts


@register("step_parts", sql=f"""
WITH s AS ({inputs.STEP_LOG_SQL}),
w AS (SELECT *, greatest(strlen(message) + 1, {-(-PART_BYTES // PART_MESSAGES)}) AS weight FROM s WHERE failed AND message IS NOT NULL),
p AS (SELECT *, CAST(coalesce(sum(weight) OVER (PARTITION BY step_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS BIGINT) // {PART_BYTES} AS part FROM w)
SELECT step_id, part, count(*) AS n_messages, string_agg(message, chr(10) ORDER BY ts, event_id) AS text FROM p GROUP BY step_id, part
""")
def step_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 in parts of bounded size, cut by running bytes instead of hours."""
    return runs.step_parts(inputs.step_log(spark, sf_dir), PART_BYTES, PART_MESSAGES)


@register("latency_histogram_merged", sql=_histogram_sql())
def latency_histogram_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: states written by micro-batches, one of them delivered twice, merge
    to the histogram of one pass."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ingest

    src, out, log, ckpt = (scratch_path(spark, f"histogram-{x}") for x in ("in", "out", "log", "ckpt"))
    events = inputs.read_table(spark, sf_dir, "events").select("event_type", "value")
    per_trigger = _write_files(events, src)
    keep = ingest.idempotent_batch_writer(lambda batch: metrics.histogram_state(batch, "value", ["event_type"]), out, "latency")

    def source() -> DataFrame:
        return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", per_trigger).parquet(src)

    ingest.ingest_through_failure(spark, source, ingest.FailOnce(keep, 1, log), ckpt)
    return metrics.merge_histograms(spark.read.parquet(out), ["event_type"], application="ledgerline")
