"""Inputs for the registered jobs, derived by Spark from the provided tables.

Each builder has a DuckDB twin (``*_SQL``) that the oracle queries use as a
CTE, so both engines start from the same rows. Every derivation keeps every
source row; ``%`` only chooses among variants, it never filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import read_table


def _case(selector: Column, variants: list[Column]) -> Column:
    n = len(variants)
    sel = F.pmod(selector, F.lit(n))
    out = F.when(sel == 0, variants[0])
    for i, v in enumerate(variants[1:], start=1):
        out = out.when(sel == i, v)
    return out


def _sql_case(selector: str, variants: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(variants))
    return f"CASE ({selector}) % {len(variants)} {arms} END"


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch of a UTC wall time (TIMESTAMP_NTZ), truncated."""
    from ledgerline.functions.timefmt import utc_epoch_millis

    return utc_epoch_millis(ts)


EPOCH_MS_SQL = "date_diff('millisecond', TIMESTAMP '1970-01-01 00:00:00', {ts})"


# --- entities ---------------------------------------------------------------

def entities_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity table: part key, name and type as id, name, description."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"))


ENTITIES_PART_SQL = "SELECT p_partkey AS id, p_name AS name, p_type AS description FROM part"


def entities_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity table over the labelled documents (covers some documents only)."""
    return read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
        F.concat(F.lit("quality "), F.col("quality").cast("string"), F.lit(", toxic "),
                 F.col("toxic").cast("string")).alias("description"),
    )


ENTITIES_LABELS_SQL = (
    "SELECT doc_id AS id, 'doc-' || CAST(doc_id AS VARCHAR) AS name, "
    "'quality ' || CAST(quality AS VARCHAR) || ', toxic ' || CAST(toxic AS VARCHAR) AS description FROM labels"
)


# --- requests ---------------------------------------------------------------

def document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One well-typed request per document: request_id = id = doc_id."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("request_id"), F.col("doc_id").cast("string").alias("raw_id"))


DOCUMENT_REQUESTS_SQL = "SELECT doc_id AS request_id, CAST(doc_id AS VARCHAR) AS raw_id FROM documents"

def hot_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event; every second one asks for the same id, 7."""
    eid = F.col("event_id")
    return read_table(spark, sf_dir, "events").select(eid.alias("request_id"), F.when(eid % 2 == 0, F.lit(7)).otherwise(eid).cast("bigint").alias("id"))


HOT_REQUESTS_SQL = "SELECT event_id AS request_id, CASE WHEN event_id % 2 = 0 THEN 7 ELSE event_id END AS id FROM events"

# Raw key variants chosen by event_id % 7: plain id, -1, text, decimal form,
# missing, padded and signed, 20 digits (overflows BIGINT).
OVERFLOW_KEY = "18446744073709551616"


def raw_key_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("string")
    raw = _case(F.col("event_id"), [
        eid,
        F.lit("-1"),
        F.concat(F.lit("id-"), eid),
        F.concat(eid, F.lit(".0")),
        F.lit(None).cast("string"),
        F.concat(F.lit(" +"), eid, F.lit(" ")),
        F.lit(OVERFLOW_KEY),
    ])
    return ev.select(F.col("event_id").alias("request_id"), raw.alias("raw_id"))


RAW_KEY_REQUESTS_SQL = "SELECT event_id AS request_id, " + _sql_case("event_id", [
    "CAST(event_id AS VARCHAR)", "'-1'", "'id-' || CAST(event_id AS VARCHAR)", "CAST(event_id AS VARCHAR) || '.0'",
    "NULL", "' +' || CAST(event_id AS VARCHAR) || ' '", f"'{OVERFLOW_KEY}'",
]) + " AS raw_id FROM events"


# --- strings for the blank rule ---------------------------------------------

# Code points of the eleven test strings, in order: empty; three spaces; tab +
# newline; NBSP; ideographic space; NEL; "a"; zero-width space; VT + FS;
# line separator; space + NEL. Blank: all but NEL, "a", ZWSP and space + NEL.
BLANK_CASES = [[], [32, 32, 32], [9, 10], [160], [12288], [133], [97], [8203], [11, 28], [8232], [32, 133]]


def _py_str(cps: list[int]) -> str:
    return "".join(chr(c) for c in cps)


def _sql_str(cps: list[int]) -> str:
    return "''" if not cps else " || ".join(f"chr({c})" for c in cps)


def blank_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, description): name by event_id % 11, description by
    (event_id div 11) % 11, so every pair of cases occurs."""
    ev = read_table(spark, sf_dir, "events")
    lits = [F.lit(_py_str(c)) for c in BLANK_CASES]
    return ev.select(
        F.col("event_id").alias("id"),
        _case(F.col("event_id"), lits).alias("name"),
        _case(F.floor(F.col("event_id") / 11), lits).alias("description"),
    )


BLANK_CANDIDATES_SQL = (
    "SELECT event_id AS id, "
    + _sql_case("event_id", [_sql_str(c) for c in BLANK_CASES]) + " AS name, "
    + _sql_case("(event_id // 11)", [_sql_str(c) for c in BLANK_CASES]) + " AS description FROM events"
)


# --- reason texts -------------------------------------------------------------

def reason_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, reason) by event_id % 4: two quoted tokens; one; none; an empty
    quote pair before a token."""
    ev = read_table(spark, sf_dir, "events")
    reason = _case(F.col("event_id"), [
        F.concat(F.lit("Required values '"), F.col("event_type"), F.lit("' and 'user"),
                 F.col("user_id").cast("string"), F.lit("' are not present")),
        F.concat(F.lit("Missing value '"), F.col("props"), F.lit("' in request")),
        F.concat(F.lit("Request failed for user "), F.col("user_id").cast("string")),
        F.concat(F.lit("'' then '"), F.col("event_type"), F.lit("'")),
    ])
    return ev.select(F.col("event_id").alias("id"), reason.alias("reason"))


REASON_TEXTS_SQL = "SELECT event_id AS id, " + _sql_case("event_id", [
    "'Required values ''' || event_type || ''' and ''user' || CAST(user_id AS VARCHAR) || ''' are not present'",
    "'Missing value ''' || props || ''' in request'",
    "'Request failed for user ' || CAST(user_id AS VARCHAR)",
    "''''' then ''' || event_type || ''''",
]) + " AS reason FROM events"


# --- error kinds ----------------------------------------------------------------

ERROR_KINDS = ["domain", "type_mismatch", "missing_parameter", "unreadable_body", "input_error", "no_resource",
               "unexpected"]
DOMAIN_TYPES = ["NOT_FOUND", "BAD_REQUEST", "CONFLICT", "INTERNAL_ERROR"]


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, kind, domain_type, detail): one raised error per event. Kind by
    event_id % 7, domain type by user_id % 4, detail from props (empty when
    event_id % 5 = 0, null when value < 1)."""
    ev = read_table(spark, sf_dir, "events")
    detail = (F.when(F.col("value") < 1, F.lit(None).cast("string"))
              .when(F.pmod(F.col("event_id"), F.lit(5)) == 0, F.lit(""))
              .otherwise(F.concat(F.col("event_type"), F.lit(" "), F.col("props"))))
    return ev.select(
        F.col("event_id").alias("id"),
        _case(F.col("event_id"), [F.lit(k) for k in ERROR_KINDS]).alias("kind"),
        _case(F.col("user_id"), [F.lit(t) for t in DOMAIN_TYPES]).alias("domain_type"),
        detail.alias("detail"),
    )


ERROR_EVENTS_SQL = (
    "SELECT event_id AS id, "
    + _sql_case("event_id", [f"'{k}'" for k in ERROR_KINDS]) + " AS kind, "
    + _sql_case("user_id", [f"'{t}'" for t in DOMAIN_TYPES]) + " AS domain_type, "
    + "CASE WHEN value < 1 THEN NULL WHEN event_id % 5 = 0 THEN '' ELSE event_type || ' ' || props END AS detail "
    + "FROM events"
)


# --- change log ---------------------------------------------------------------

def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as entity changes, entity = user_id, in (ts, event_id) order.

    The first event of a user is CREATE 'd0'; afterwards error -> DELETE,
    signup -> RESTORE, purchase -> UPDATE 'd' || floor(value / 20),
    click -> UPDATE '' and view -> UPDATE '  ' (both blank, so rejected).

    The first event is found with a per-user min aggregate (partial
    aggregation, so a user holding a third of all events costs nothing
    special) joined back on the unique event_id, not with a per-user window.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    firsts = ev.groupBy("user_id").agg(F.min(F.struct("ts", "event_id"))["event_id"].alias("event_id"))
    ev = ev.join(firsts.select("event_id", F.lit(True).alias("is_first")), "event_id", "left")
    first = F.coalesce(F.col("is_first"), F.lit(False))
    et = F.col("event_type")
    op = (F.when(first, F.lit("CREATE")).when(et == "error", F.lit("DELETE"))
          .when(et == "signup", F.lit("RESTORE")).otherwise(F.lit("UPDATE")))
    desc = (F.when(first, F.lit("d0"))
            .when(et == "purchase", F.concat(F.lit("d"), F.floor(F.col("value") / 20).cast("bigint").cast("string")))
            .when(et == "click", F.lit("")).when(et == "view", F.lit("  ")))
    return ev.select(F.col("user_id").alias("id"), "event_id", "ts", op.alias("op"), desc.alias("description"))


CHANGE_LOG_SQL = """
SELECT user_id AS id, event_id, ts,
  CASE WHEN rn = 1 THEN 'CREATE' WHEN event_type = 'error' THEN 'DELETE'
       WHEN event_type = 'signup' THEN 'RESTORE' ELSE 'UPDATE' END AS op,
  CASE WHEN rn = 1 THEN 'd0'
       WHEN event_type = 'purchase' THEN 'd' || CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR)
       WHEN event_type = 'click' THEN '' WHEN event_type = 'view' THEN '  ' END AS description
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) t
"""

def burst_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``change_log`` with every third change on id 0, a microsecond apart: a
    third of the log on one id within one hour."""
    hot = F.col("event_id") % 3 == 0
    at = F.timestamp_add("MICROSECOND", F.col("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return change_log(spark, sf_dir).withColumns({"id": F.when(hot, F.lit(0)).otherwise(F.col("id")), "ts": F.when(hot, at).otherwise(F.col("ts"))})


BURST_LOG_SQL = f"""
SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE id END AS id, event_id,
  CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(event_id) ELSE ts END AS ts, op, description
FROM ({CHANGE_LOG_SQL}) l
"""

# Fixed value: where lifecycle_incremental splits the log (snapshot before, slice after).
INCREMENTAL_CUT = "2024-01-16 00:00:00"


# --- run and step logs ------------------------------------------------------------

def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event: starts at ts, lasts round(value * 600000) ms (up to
    several days, so hours exceed 24)."""
    ev = read_table(spark, sf_dir, "events")
    start = epoch_ms(F.col("ts"))
    return ev.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("job-"), F.col("event_type")).alias("job_name"),
        start.alias("start_ms"),
        (start + F.round(F.col("value") * 600000).cast("bigint")).alias("end_ms"),
    )


RUN_LOG_SQL = (
    "SELECT event_id AS run_id, 'job-' || event_type AS job_name, "
    + EPOCH_MS_SQL.format(ts="ts") + " AS start_ms, "
    + EPOCH_MS_SQL.format(ts="ts") + " + CAST(round(value * 600000) AS BIGINT) AS end_ms FROM events"
)


def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps = users; a row fails when its event is an error; the message is
    null when event_id % 3 = 0."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("step_id"), "event_id", "ts",
        (F.col("event_type") == "error").alias("failed"),
        F.when(F.pmod(F.col("event_id"), F.lit(3)) != 0,
               F.concat(F.col("event_type"), F.lit(" "), F.col("props"))).alias("message"),
    )


STEP_LOG_SQL = (
    "SELECT user_id AS step_id, event_id, ts, event_type = 'error' AS failed, "
    "CASE WHEN event_id % 3 <> 0 THEN event_type || ' ' || props END AS message FROM events"
)

# Fixed value: the date the registered daily job is run for.
DAILY_REQUEST_DATE = "1997-06-15"


# --- JSON payloads ------------------------------------------------------------------

def json_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, payload) from events.props (``{"k": n}``) by event_id % 12:
    full record; unknown property; "" for an object; scalar for an array;
    object for an array; null primitive; missing primitive; text for an int;
    unknown enum; truncated text; numeric text with a nested object; a
    fractional number with a number for the array."""
    ev = read_table(spark, sf_dir, "events")
    base = F.expr("left(props, length(props) - 1)")  # '{"k": n'
    et, uid = F.col("event_type"), F.col("user_id").cast("string")
    payload = _case(F.col("event_id"), [
        F.concat(base, F.lit(', "tags": ["'), et, F.lit('", "x"], "level": "LOW"}')),
        F.concat(base, F.lit(', "extra": true, "level": "MID"}')),
        F.concat(base, F.lit(', "meta": ""}')),
        F.concat(base, F.lit(', "tags": "'), et, F.lit('"}')),
        F.concat(base, F.lit(', "tags": {"a": 1}}')),
        F.lit('{"k": null, "level": "HIGH"}'),
        F.lit('{"level": "LOW", "tags": []}'),
        F.concat(F.lit('{"k": "'), et, F.lit('"}')),
        F.concat(base, F.lit(', "level": "ULTRA"}')),
        F.expr("left(props, length(props) - 3)"),
        F.concat(F.lit('{"k": "'), uid, F.lit('", "meta": {"source": "'), et, F.lit('"}}')),
        F.concat(F.lit('{"k": '), F.floor(F.col("value")).cast("string"), F.lit('.5, "tags": 7, "level": 2}')),
    ])
    return ev.select(F.col("event_id").alias("id"), payload.alias("payload"))


JSON_PAYLOADS_SQL = "SELECT event_id AS id, " + _sql_case("event_id", [
    """left(props, length(props) - 1) || ', "tags": ["' || event_type || '", "x"], "level": "LOW"}'""",
    """left(props, length(props) - 1) || ', "extra": true, "level": "MID"}'""",
    """left(props, length(props) - 1) || ', "meta": ""}'""",
    """left(props, length(props) - 1) || ', "tags": "' || event_type || '"}'""",
    """left(props, length(props) - 1) || ', "tags": {"a": 1}}'""",
    """'{"k": null, "level": "HIGH"}'""",
    """'{"level": "LOW", "tags": []}'""",
    """'{"k": "' || event_type || '"}'""",
    """left(props, length(props) - 1) || ', "level": "ULTRA"}'""",
    """left(props, length(props) - 3)""",
    """'{"k": "' || CAST(user_id AS VARCHAR) || '", "meta": {"source": "' || event_type || '"}}'""",
    """'{"k": ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.5, "tags": 7, "level": 2}'""",
]) + " AS payload FROM events"


def encodable_rows(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """Rows to encode: a small decimal that would print with an exponent,
    a note that is null for every fourth event, and a nested object; and the
    columns ``also`` of events."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "event_type", *also,
        (F.col("value") / F.lit(1e9)).cast("decimal(20,12)").alias("amount"),
        F.when(F.pmod(F.col("event_id"), F.lit(4)) != 0, F.col("props")).alias("note"),
        F.struct(F.col("user_id").alias("user"), F.lit(None).cast("string").alias("tag")).alias("meta"),
    )


NESTED_ITEMS = "sort_array(collect_list(struct(l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag)))"


def nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, payload): each order's line items as one JSON body, by
    order_id % 8: all items; the first item without its array; text for the
    first quantity; an unknown flag in the last item; an item without its part;
    a first quantity beyond an int; an object inside a nested array of
    numbers; two failures, in either order."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.expr(NESTED_ITEMS).alias("items"))
    variant = F.pmod(F.col("order_id"), F.lit(8))

    def item(x, i):
        qty = (F.when((i == 0) & (variant == 2), F.lit('"x"')).when((i == 0) & (variant == 5), F.lit("99999999999"))
               .otherwise(x["l_quantity"].cast("int").cast("string")))
        flag = F.when((i == F.size("items") - 1) & (variant == 3), F.lit("Q")).otherwise(x["l_returnflag"])
        price = x["l_extendedprice"].cast("decimal(20,2)").cast("string")
        return F.concat(F.lit('{"part": '), x["l_partkey"].cast("string"), F.lit(', "qty": '), qty, F.lit(', "price": "'), price,
                        F.lit('", "flag": "'), flag, F.lit('", "grid": [['), x["l_linenumber"].cast("string"), F.lit(", "),
                        x["l_suppkey"].cast("string"), F.lit("], "), x["l_linenumber"].cast("string"), F.lit("]}"))

    texts = F.transform("items", item)
    more = (F.when(variant == 4, F.array(F.lit('{"qty": 1}')))
            .when(variant == 6, F.array(F.lit('{"part": 1, "qty": 1, "grid": [[1], [{}]]}'))).otherwise(F.array().cast("array<string>")))
    body = F.when(variant == 1, texts[0]).otherwise(F.concat(F.lit("["), F.array_join(F.concat(texts, more), ", "), F.lit("]")))
    key, sizes = F.concat(F.lit('"id": '), F.col("order_id").cast("string")), F.concat(F.lit('"sizes": '), F.size("items").cast("string"))
    bad_key, bad_sizes = F.lit('"id": "no"'), F.lit('"sizes": [1, "x"]')
    head = (F.when((variant == 7) & (F.expr("order_id div 8") % 2 == 0), F.concat(bad_key, F.lit(", "), bad_sizes))
            .when(variant == 7, F.concat(bad_sizes, F.lit(", "), bad_key)).otherwise(F.concat(sizes, F.lit(", "), key)))
    return lines.select("order_id", F.concat(F.lit("{"), head, F.lit(', "items": '), body, F.lit("}")).alias("payload"))
