"""Reference SQL for every registered query, runnable by DuckDB on the same
parquet tables (registered as views under their table names).

The SQL is written the way the contract reads - a ``row_number()`` window
for versions, ``NOT EXISTS`` for anti joins - so it checks the Spark plans
(aggregate-based dedup, one-pass reports) rather than repeating them.
"""

from __future__ import annotations

from stratum.functions import text as X
from stratum.operators.checks import VALIDATION_CASES
from stratum.operators.contracts import CONTRACTS
from stratum.plans import catalog as C
from stratum.plans.pipeline import TABLE_CONTRACTS
from stratum.sources.tables import TABLE_NAMES

BRONZE_COLS = "order_id, customer_id, region, channel, status, CAST(amount AS DOUBLE) AS amount, currency, order_ts, ingested_at, source_rank"

ORDER_SOURCE = f"""
SELECT
  'O-' || CAST(CASE WHEN o.o_orderkey % 10 = 0 AND o.o_orderkey > 0 THEN o.o_orderkey - 1 ELSE o.o_orderkey END AS VARCHAR) AS order_id,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE 'C-' || CAST(o.o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE cr.r_name END AS region,
  CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'field'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN 'partner' ELSE 'web' END AS channel,
  CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'processing' WHEN 'O' THEN 'cancelled' END AS status,
  CASE WHEN o.o_orderkey % 29 = 0 THEN -CAST(o.o_totalprice AS DECIMAL(18,2))
       ELSE CAST(o.o_totalprice AS DECIMAL(18,2)) END AS amount,
  'USD' AS currency,
  CAST(o.o_orderdate AS TIMESTAMP) AS order_ts,
  TIMESTAMP '{C.RUN_TS}' AS ingested_at,
  CAST(o.o_orderkey AS BIGINT) AS source_rank
FROM orders o
LEFT JOIN (
  SELECT c.c_custkey, r.r_name
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
) cr ON o.o_custkey = cr.c_custkey
"""

ISSUE = (
    "CASE WHEN customer_id IS NULL THEN 'missing_customer' "
    "WHEN region IS NULL THEN 'missing_region' "
    "WHEN amount <= 0 THEN 'non_positive_amount' END"
)

GOLD_SELECT = """
SELECT region,
       CAST(round(sum(amount), 2) AS DOUBLE) AS gross_revenue_usd,
       CAST(count(*) AS BIGINT) AS accepted_orders,
       CAST(count_if(status = 'completed') AS BIGINT) AS completed_orders,
       CAST(count_if(status = 'processing') AS BIGINT) AS pipeline_orders,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS distinct_customers
FROM {silver} GROUP BY region
"""


def medallion_ctes(prefix: str = "", bronze_from: str | None = None) -> str:
    """CTEs ``{p}bronze, {p}reasoned, {p}silver, {p}rejected, {p}gold``."""
    p = prefix
    bronze = f"{p}bronze AS ({ORDER_SOURCE})" if bronze_from is None else f"{p}bronze AS ({bronze_from})"
    return f"""{bronze},
{p}ranked AS (
  SELECT *, {ISSUE} AS quality_issue,
         row_number() OVER (PARTITION BY order_id ORDER BY order_ts DESC NULLS LAST, source_rank DESC) AS row_rank
  FROM {p}bronze),
{p}reasoned AS (
  SELECT *, row_rank = 1 AS is_latest,
         COALESCE(quality_issue, CASE WHEN row_rank > 1 THEN 'stale_duplicate' END) AS rejection_reason
  FROM {p}ranked),
{p}silver AS (SELECT * FROM {p}reasoned WHERE rejection_reason IS NULL),
{p}rejected AS (SELECT * FROM {p}reasoned WHERE rejection_reason IS NOT NULL),
{p}gold AS ({GOLD_SELECT.format(silver=p + 'silver')})"""


def with_medallion(body: str) -> str:
    return f"WITH {medallion_ctes()}\n{body}"


EARLIER = f"SELECT * FROM bronze WHERE order_ts < TIMESTAMP '{C.EARLIER_LOAD_BEFORE}'"

EXPECTATIONS = """
expectations AS (
  SELECT 'customer_present' AS name, 'silver' AS layer,
         CAST(count_if(NOT (customer_id IS NULL)) AS BIGINT) AS passed,
         CAST(count_if(customer_id IS NULL) AS BIGINT) AS failed,
         'customer_id must be present before rows graduate into silver.' AS rule FROM reasoned
  UNION ALL
  SELECT 'region_present', 'silver', CAST(count_if(NOT (region IS NULL)) AS BIGINT),
         CAST(count_if(region IS NULL) AS BIGINT),
         'region is required for downstream territory KPIs.' FROM reasoned
  UNION ALL
  SELECT 'positive_amount', 'silver', CAST(count_if(NOT (amount <= 0)) AS BIGINT),
         CAST(count_if(amount <= 0) AS BIGINT),
         'non-positive revenue is isolated into rejected quarantine rows.' FROM reasoned
  UNION ALL
  SELECT 'latest_order_record', 'silver', CAST(count_if(rejection_reason IS NULL) AS BIGINT),
         CAST(count_if(row_rank > 1) AS BIGINT),
         'only the latest duplicate order version can move into silver.' FROM reasoned
)"""

PASS_RATE = (
    "CASE WHEN count(*) > 0 THEN CAST((count_if(rejection_reason IS NULL) * 20000 + count(*)) "
    "// (count(*) * 2) AS DOUBLE) / 100.0 END"
)

UPSERTED = f"""
earlier_published AS (
  SELECT *, TIMESTAMP '{C.PREVIOUS_RUN_TS}' AS loaded_at FROM e_gold WHERE region <> '{C.NEW_REGION}'),
today AS (SELECT * FROM gold WHERE region <> '{C.CLOSED_REGION}'),
upserted AS (
  SELECT * FROM earlier_published t WHERE NOT EXISTS (SELECT 1 FROM today s WHERE s.region = t.region)
  UNION ALL
  SELECT *, TIMESTAMP '{C.RUN_TS}' AS loaded_at FROM today
)"""


def _term_scan() -> str:
    parts = []
    for term in C.BANNED_TERMS:
        t = term.lower().replace("'", "''")
        parts.append(
            f"SELECT 'documents' AS source, doc_id AS record_id, CAST(NULL AS BIGINT) AS turn, '{t}' AS term "
            f"FROM documents WHERE contains(lower(text), '{t}')"
        )
        parts.append(
            f"SELECT 'conversations' AS source, conv_id AS record_id, turn, '{t}' AS term "
            f"FROM conversations WHERE contains(lower(text), '{t}')"
        )
    return "\nUNION ALL\n".join(parts)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _link_audit() -> str:
    """Links cut out and resolved apart from the engine's patterns: hosts and
    paths by splitting, dot segments by a recursive walk over the segments."""
    machine = " OR ".join(f"contains(link, {_sql_str(m)})" for m in X.MACHINE_PATH_MARKERS)
    external = " OR ".join(f"starts_with(lower(link), {_sql_str(e)})" for e in X.EXTERNAL_PREFIXES)
    return rf"""
WITH RECURSIVE sites AS (
  SELECT page_id, html, split_part(split_part(split_part(url, '://', 2), '#', 1), '?', 1) AS rest FROM pages),
placed AS (
  SELECT page_id, html, lower(split_part(rest, '/', 1)) AS host, substr(rest, length(split_part(rest, '/', 1)) + 1) AS page_path
  FROM sites),
cut AS (
  SELECT page_id, host, page_path,
         unnest(list_transform(string_split_regex(html, '[hH][rR][eE][fF]\s*=\s*')[2:],
           lambda x: CASE WHEN x[1] IN (chr(34), chr(39)) THEN split_part(x[2:], x[1], 1)
                          ELSE regexp_extract(x, '^[^\s>]*') END)) AS link
  FROM placed),
numbered AS (SELECT row_number() OVER () AS n, page_id, host, page_path, trim(link) AS link FROM cut),
kinds AS (
  SELECT *, CASE WHEN {machine} THEN 'machine_path'
                 WHEN {external} THEN 'external'
                 WHEN starts_with(link, '#') THEN 'anchor'
                 WHEN starts_with(link, '/') THEN 'route'
                 ELSE 'local' END AS kind,
         split_part(split_part(link, '#', 1), '?', 1) AS path
  FROM numbered),
steps AS (
  SELECT n, list_filter(string_split(CASE WHEN kind = 'route' THEN path WHEN path = '' THEN page_path
      ELSE regexp_replace('/' || page_path, '[^/]*$', '') || path END, '/'), lambda s: s NOT IN ('', '.')) AS ahead,
    []::VARCHAR[] AS kept, FALSE AS escapes
  FROM kinds WHERE kind IN ('route', 'local')),
walk AS (
  SELECT * FROM steps
  UNION ALL
  SELECT n, ahead[2:], CASE WHEN ahead[1] <> '..' THEN list_append(kept, ahead[1]) ELSE kept[:len(kept) - 1] END,
    escapes OR (ahead[1] = '..' AND len(kept) = 0)
  FROM walk WHERE len(ahead) > 0),
ends AS (SELECT n, '/' || array_to_string(kept, '/') AS target, escapes FROM walk WHERE len(ahead) = 0),
known AS (SELECT DISTINCT host, '/' || trim(page_path, '/') AS known FROM placed)
SELECT k.page_id, k.link, CASE WHEN e.escapes THEN 'escape' ELSE k.kind END AS link_kind,
       k.kind = 'machine_path' OR coalesce(e.escapes, FALSE) OR (k.kind IN ('route', 'local') AND p.known IS NULL) AS broken
FROM kinds k LEFT JOIN ends e ON e.n = k.n LEFT JOIN known p ON p.host = k.host AND p.known = e.target
"""


def _url_policy() -> str:
    p = _sql_str(X.URL_PATTERN)
    allowed = " OR ".join(
        f"host = {_sql_str(d)} OR ends_with(host, {_sql_str('.' + d)})" for d in C.ALLOWED_PAGE_DOMAINS
    )
    return f"""
WITH parts AS (
  SELECT page_id, url,
         lower(regexp_extract(url, {p}, 1)) AS scheme,
         regexp_extract(url, {p}, 3) AS userinfo,
         regexp_replace(lower(regexp_extract(url, {p}, 4)), '\\.$', '') AS host,
         regexp_extract(url, {p}, 6) AS port
  FROM (SELECT page_id, CASE WHEN page_id % 50 <> 7 THEN url END AS url FROM pages))
SELECT page_id, url, host,
       CASE WHEN scheme <> 'https' THEN 'not_https'
            WHEN userinfo <> '' THEN 'userinfo'
            WHEN coalesce(host, '') = '' THEN 'missing_host'
            WHEN port <> '' THEN 'port'
            WHEN NOT ({allowed}) THEN 'host_not_allowed' END AS violation
FROM parts
"""


def _json_contract() -> str:
    ((key, (lo, hi)),) = C.EVENT_PROPS.bounds.items()
    return f"""
SELECT event_id, event_type, violation FROM (
  SELECT event_id, event_type,
         CASE WHEN NOT json_valid(props) OR json_type(props) <> 'OBJECT' THEN 'malformed_json'
              WHEN NOT list_contains(json_keys(props), '{key}') THEN 'missing_key:{key}'
              WHEN TRY_CAST(json_extract_string(props, '$.{key}') AS BIGINT) IS NULL
                OR TRY_CAST(json_extract_string(props, '$.{key}') AS BIGINT) < {lo}
                OR TRY_CAST(json_extract_string(props, '$.{key}') AS BIGINT) > {hi}
                THEN 'out_of_range:{key}' END AS violation
  FROM events)
WHERE violation IS NOT NULL
"""


def _order_document_contract() -> str:
    return """
WITH lines AS (
  SELECT l_orderkey, count(*) AS n, count_if(l_discount <= 0) AS undiscounted FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, violation FROM (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN 'missing_key:head.status'
         WHEN floor(o_totalprice) < 0 OR floor(o_totalprice) > 400000 THEN 'out_of_range:head.total'
         WHEN coalesce(n, 0) < 3 THEN 'short_list:lines'
         WHEN undiscounted > 0 THEN 'item_without:lines.discount' END AS violation
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey)
WHERE violation IS NOT NULL"""


def _contract(table: str, layers: dict[str, str], more: str = "") -> str:
    """Declared contract rows with NOT NULL violations counted on the data
    (the declared types are the expected Spark types).  Bronze rows lack the
    columns that staging adds."""
    added = {"quality_issue", "row_rank", "rejection_reason"}
    rows = []
    for layer, source in layers.items():
        for name, declared, nullable in CONTRACTS[table]:
            found = "missing" if source == "bronze" and name in added else declared
            counted = not nullable and found != "missing"
            nulls = f"CAST(count_if({name} IS NULL) AS BIGINT)" if counted else "CAST(count_if(FALSE) AS BIGINT)"
            rows.append(
                f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS column_name, "
                f"'{declared}' AS declared_type, '{found}' AS actual_type, {str(nullable).upper()} AS nullable, "
                f"{str(found == declared).upper()} AS type_ok, {nulls} AS null_violations FROM {source}"
            )
    ctes = f"WITH {medallion_ctes()}" + (f",\n{more}" if more else "")
    return ctes + "\n" + "\nUNION ALL\n".join(rows)


def _validation_cases() -> str:
    extra = (
        "(count(*) - (count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END))"
        " + count_if(NOT is_latest))"
    )
    exprs = ["count_if(customer_id IS NULL)", "count_if(region IS NULL)", "count_if(amount <= 0)", extra]
    rows = []
    for layer, source in (("silver", "silver"), ("bronze", "reasoned")):
        for (case_id, focus, assertion), expr in zip(VALIDATION_CASES, exprs):
            rows.append(
                f"SELECT '{layer}' AS layer, {_sql_str(case_id)} AS case_id, {_sql_str(focus)} AS focus, "
                f"{_sql_str(assertion)} AS assertion, CAST({expr} AS BIGINT) AS violations, 'pass' AS expected_status, "
                f"CASE WHEN {expr} = 0 THEN 'pass' ELSE 'fail' END AS status FROM {source}"
            )
    return with_medallion("\nUNION ALL\n".join(rows))


def _case_list() -> str:
    extra = "(count(*) - (count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END)) + count_if(NOT is_latest))"
    exprs = [extra, "count_if(amount <= 0)", "count_if(region IS NULL)", "count_if(customer_id IS NULL)"]
    exprs.append(f"count_if({C.CASE_LIST[-1].violation})")
    return with_medallion(
        "\nUNION ALL\n".join(
            f"SELECT {_sql_str(c.case_id)} AS case_id, {_sql_str(c.focus)} AS focus, {_sql_str(c.assertion)} AS assertion, "
            f"CAST({expr} AS BIGINT) AS violations, '{c.expected_status}' AS expected_status, "
            f"CASE WHEN {expr} = 0 THEN 'pass' ELSE 'fail' END AS status FROM silver"
            for c, expr in zip(C.CASE_LIST, exprs)
        )
    )


def _content_reconciliation() -> str:
    """Both differences of the multisets bronze and its damaged copy."""
    cols = "order_id, customer_id, region, CAST(amount AS DOUBLE) AS amount, order_ts, source_rank"
    sides = "\nUNION ALL\n".join(
        f"SELECT *, '{side}' AS side FROM (SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b})"
        for side, a, b in (("lost", "whole", "damaged"), ("foreign", "damaged", "whole"))
    )
    return f"""
WITH bronze AS ({ORDER_SOURCE}), whole AS (SELECT {cols} FROM bronze),
changed AS (
  SELECT CASE WHEN source_rank % 977 = 11 THEN 'X' || order_id ELSE order_id END AS order_id, customer_id, region,
         CAST(amount + CASE WHEN source_rank % 991 = 5 THEN 1 ELSE 0 END AS DOUBLE) AS amount, order_ts, source_rank
  FROM bronze WHERE source_rank % 997 <> 3),
damaged AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE source_rank % 983 = 7),
sides AS ({sides})
SELECT *, CAST(count(*) AS BIGINT) AS copies, 'damaged' AS layer FROM sides GROUP BY ALL"""


def _reconciliation() -> str:
    bronze, rejected = (f"(SELECT CAST(count(*) AS BIGINT) FROM {t})" for t in ("bronze", "rejected"))
    rows = []
    for layer in ("silver", "bronze"):
        one = f"(SELECT CAST(count(*) AS BIGINT) FROM {layer})"
        keys = f"(SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT order_id FROM {layer}))"
        checks = [
            ("bronze_equals_silver_plus_rejected", bronze, f"{one} + {rejected}"),
            ("gold_accepted_equals_silver", one, "(SELECT CAST(sum(accepted_orders) AS BIGINT) FROM gold)"),
            ("one_silver_row_per_key", one, keys),
            ("silver_keys_are_in_bronze", one, f"(SELECT CAST(count(*) AS BIGINT) FROM {layer} l "
             "WHERE EXISTS (SELECT 1 FROM bronze b WHERE b.order_id IS NOT DISTINCT FROM l.order_id))"),
        ]
        for name, expected, actual in checks:
            rows.append(
                f"SELECT '{layer}' AS layer, '{name}' AS check_name, {expected} AS expected, {actual} AS actual, "
                f"{expected} = {actual} AS ok"
            )
    return with_medallion("\nUNION ALL\n".join(rows))


def _source_preview() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    sel = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT {sel} FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 2)"


LINEITEM_COLS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
LINEITEM_STAGED = """
WITH ranked AS (
  SELECT *,
         CASE WHEN l_quantity > 45 THEN 'bulk_quantity'
              WHEN l_discount < 0 OR l_discount > 0.08 THEN 'discount_out_of_range' END AS quality_issue,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC, l_partkey DESC,
                                     l_suppkey DESC, l_quantity DESC) AS row_rank
  FROM lineitem),
reasoned AS (
  SELECT *, COALESCE(quality_issue, CASE WHEN row_rank > 1 THEN 'stale_duplicate' END) AS rejection_reason
  FROM ranked)
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gold_region_kpis"] = with_medallion("SELECT * FROM gold")
    q["bronze_orders"] = with_medallion(f"SELECT {BRONZE_COLS} FROM bronze")
    q["silver_orders"] = with_medallion(
        f"SELECT {BRONZE_COLS}, quality_issue, CAST(1 AS INTEGER) AS row_rank, "
        "CAST(NULL AS VARCHAR) AS rejection_reason FROM silver"
    )
    q["rejected_orders"] = with_medallion(
        f"SELECT {BRONZE_COLS}, quality_issue, is_latest, rejection_reason FROM rejected"
    )
    q["expectations_report"] = f"WITH {medallion_ctes()},\n{EXPECTATIONS}\nSELECT * FROM expectations"
    q["run_metrics"] = with_medallion(
        "SELECT CAST(count(*) AS BIGINT) AS source_rows, CAST(count(*) AS BIGINT) AS bronze_rows, "
        "CAST(count_if(rejection_reason IS NULL) AS BIGINT) AS silver_rows, "
        "CAST(count_if(rejection_reason IS NOT NULL) AS BIGINT) AS rejected_rows, "
        "(SELECT CAST(count(*) AS BIGINT) FROM gold) AS gold_rows, "
        "CAST((CASE WHEN count(*) > 0 THEN 1 ELSE 0 END) + (CASE WHEN count_if(rejection_reason IS NULL) > 0 THEN 1 ELSE 0 END)"
        " + (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM gold) AS BIGINT) AS tables, "
        f"{PASS_RATE} AS quality_pass_rate_pct FROM reasoned"
    )
    q["rejection_reasons"] = with_medallion(
        "SELECT DISTINCT rejection_reason FROM rejected ORDER BY rejection_reason"
    )
    q["rejected_preview"] = with_medallion(
        "SELECT order_id, customer_id, region, CAST(amount AS DOUBLE) AS amount, rejection_reason "
        "FROM rejected ORDER BY order_id NULLS FIRST, source_rank LIMIT 10"
    )
    q["bronze_preview"] = with_medallion(
        f"SELECT {BRONZE_COLS} FROM bronze ORDER BY order_id NULLS FIRST, source_rank LIMIT 5"
    )
    q["silver_preview"] = with_medallion(
        "SELECT order_id, customer_id, region, status, CAST(amount AS DOUBLE) AS amount, currency "
        "FROM silver ORDER BY order_id NULLS FIRST LIMIT 5"
    )
    q["gold_preview"] = with_medallion("SELECT * FROM gold ORDER BY region NULLS FIRST LIMIT 10")
    q["pipeline_summary"] = (
        f"WITH {medallion_ctes()},\n{EXPECTATIONS}\n"
        "SELECT CAST(count(*) AS BIGINT) AS bronze_rows, "
        "CAST(count_if(rejection_reason IS NULL) AS BIGINT) AS silver_rows, "
        "(SELECT CAST(count(*) AS BIGINT) FROM gold) AS gold_rows, "
        "CAST(count_if(rejection_reason IS NOT NULL) AS BIGINT) AS rejected_rows, "
        "(SELECT CAST(count(*) AS BIGINT) FROM expectations) AS total_expectations, "
        "(SELECT CAST(count_if(failed = 0) AS BIGINT) FROM expectations) AS expectations_met, "
        f"{PASS_RATE} AS quality_pass_rate_pct, (SELECT string_agg(concat_ws('|', coalesce(region, ''), "
        "CAST(round(gross_revenue_usd * 100) AS BIGINT), accepted_orders, completed_orders, pipeline_orders, distinct_customers), "
        "';' ORDER BY region) FROM gold) AS gold_kpis FROM reasoned"
    )
    upsert_ctes = f"WITH {medallion_ctes()},\n{medallion_ctes('e_', EARLIER)},\n{UPSERTED}\n"
    q["gold_upsert"] = upsert_ctes + "SELECT * FROM upserted"
    q["gold_bounded_read"] = upsert_ctes + (
        "SELECT region, gross_revenue_usd, accepted_orders, completed_orders, pipeline_orders, "
        f"distinct_customers, loaded_at FROM upserted ORDER BY region NULLS FIRST LIMIT {C.BOUNDED_READ_LIMIT}"
    )
    q["masked_orders"] = with_medallion(
        "SELECT order_id, newest_issue, valid_older_versions FROM ("
        "SELECT order_id, max(CASE WHEN is_latest THEN quality_issue END) AS newest_issue, "
        "CAST(count_if(NOT is_latest AND quality_issue IS NULL) AS BIGINT) AS valid_older_versions "
        "FROM reasoned GROUP BY order_id) WHERE newest_issue IS NOT NULL AND valid_older_versions > 0"
    )
    q["order_version_ranks"] = with_medallion(
        "SELECT order_id, order_ts, source_rank, CAST(row_rank AS INTEGER) AS row_rank FROM ranked"
    )
    q["rejection_impact"] = with_medallion(
        "SELECT region, rejection_reason, CAST(count(*) AS BIGINT) AS rejected_rows, "
        "CAST(sum(amount) AS DOUBLE) AS rejected_amount_usd FROM rejected GROUP BY region, rejection_reason"
    )
    q["layer_reconciliation"] = _reconciliation()
    q["validation_cases"] = _validation_cases()
    q["gold_contract"] = _contract(
        "gold_region_kpis",
        {"gold": "gold", "bronze": "every_gold"},
        f"every_gold AS ({GOLD_SELECT.format(silver='bronze')})",
    )
    q["silver_contract"] = _contract("silver_orders", {"silver": "silver", "bronze": "bronze"})
    q["snapshot_diff"] = (
        f"WITH {medallion_ctes()},\n{medallion_ctes('e_', EARLIER)}\n"
        """
SELECT COALESCE(n.order_id, o.order_id) AS order_id,
       CASE WHEN o._p IS NULL THEN 'added'
            WHEN n._p IS NULL THEN 'removed'
            WHEN (o.customer_id, o.region, o.channel, o.status, o.amount, o.currency, o.order_ts, o.source_rank)
                 IS DISTINCT FROM
                 (n.customer_id, n.region, n.channel, n.status, n.amount, n.currency, n.order_ts, n.source_rank)
            THEN 'changed' END AS change
FROM (SELECT *, TRUE AS _p FROM e_silver) o
FULL OUTER JOIN (SELECT *, TRUE AS _p FROM silver) n ON o.order_id IS NOT DISTINCT FROM n.order_id
WHERE o._p IS NULL OR n._p IS NULL
   OR (o.customer_id, o.region, o.channel, o.status, o.amount, o.currency, o.order_ts, o.source_rank)
      IS DISTINCT FROM
      (n.customer_id, n.region, n.channel, n.status, n.amount, n.currency, n.order_ts, n.source_rank)
"""
    )
    q["source_inventory"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS source, TRUE AS present, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
        for t in TABLE_NAMES
    )
    q["source_preview"] = _source_preview()
    q["lineitem_latest"] = (
        LINEITEM_STAGED + f"SELECT {LINEITEM_COLS} FROM reasoned WHERE rejection_reason IS NULL"
    )
    q["lineitem_rejections"] = (
        LINEITEM_STAGED
        + "SELECT rejection_reason, CAST(count(*) AS BIGINT) AS rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity "
        "FROM reasoned GROUP BY rejection_reason"
    )
    q["customer_balance_gate"] = """
SELECT c_mktsegment,
       CAST(count_if(NOT COALESCE(c_acctbal <= 0, FALSE)) AS BIGINT) AS accepted_customers,
       CAST(count_if(COALESCE(c_acctbal <= 0, FALSE)) AS BIGINT) AS rejected_customers,
       CAST(sum(CASE WHEN NOT COALESCE(c_acctbal <= 0, FALSE) THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE)
         AS accepted_balance
FROM customer GROUP BY c_mktsegment
"""
    q["document_label_gate"] = """
SELECT lang, rejection_reason, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars
FROM (
  SELECT d.lang, d.n_chars,
         CASE WHEN l.doc_id IS NULL THEN 'missing_label'
              WHEN l.toxic = 1 THEN 'toxic'
              WHEN l.quality = 0 THEN 'low_quality' END AS rejection_reason
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
GROUP BY lang, rejection_reason
"""
    q["orders_without_lines"] = """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""
    allowed = ", ".join(_sql_str(t) for t in C.ALLOWED_EVENT_TYPES)
    q["daily_event_counts"] = (
        "SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS events "
        f"FROM events WHERE event_type IN ({allowed}) GROUP BY CAST(ts AS DATE), event_type"
    )
    q["banned_term_scan"] = _term_scan()
    q["phrase_scan"] = (
        "WITH w AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark), "
        "terms AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM w) "
        "SELECT doc_id, term FROM documents JOIN terms ON contains(lower(text), term)"
    )
    q["link_audit"] = _link_audit()
    q["json_contract"] = _json_contract()
    q["order_document_contract"] = _order_document_contract()
    q["url_policy"] = _url_policy()
    q["case_list"] = _case_list()
    q["content_reconciliation"] = _content_reconciliation()
    q["contract_quarantine"] = (
        f"WITH bronze AS ({ORDER_SOURCE}), ranked AS (SELECT *, row_number() OVER "
        "(PARTITION BY order_id ORDER BY order_ts DESC NULLS LAST, source_rank DESC) AS row_rank FROM bronze), "
        "labelled AS (SELECT CASE WHEN amount <= 0 THEN 'non_positive_amount' WHEN row_rank > 1 THEN 'stale_duplicate' "
        "WHEN customer_id IS NULL OR region IS NULL THEN 'contract_violation' END AS rejection_reason FROM ranked) "
        "SELECT CASE WHEN rejection_reason IS NULL THEN 'silver' ELSE 'rejected' END AS layer, rejection_reason, "
        'CAST(count(*) AS BIGINT) AS "rows" FROM labelled GROUP BY rejection_reason'
    )
    q["gold_from_changes"] = (
        f"WITH {medallion_ctes()},\n{medallion_ctes('e_', EARLIER)}\n"
        "SELECT *, 'now' AS layer FROM gold UNION ALL SELECT *, 'earlier' AS layer FROM e_gold"
    )
    q["approx_region_customers"] = with_medallion("SELECT region, distinct_customers AS customers, TRUE AS within_bound FROM gold")
    q["published_tables"] = with_medallion(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS version, CAST(count(*) AS BIGINT) AS \"rows\", "
            f"{_sql_str(TABLE_CONTRACTS[t])} AS contract FROM {source}"
            for t, source in (("bronze", "bronze"), ("staged", "reasoned"), ("gold", "gold"))
        )
    )
    late = f"o_orderdate >= TIMESTAMP '{C.UPSERT_SINCE}'"
    q["bucketed_upsert"] = (
        f"SELECT o_orderkey, CASE WHEN {late} THEN 'U' ELSE o_orderstatus END AS o_orderstatus, "
        f"CAST(CAST(o_totalprice + CASE WHEN {late} THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS DOUBLE) AS price FROM orders "
        "UNION ALL SELECT -1 - o_orderkey, 'N', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) FROM orders "
        f"WHERE o_orderkey < {C.UPSERT_KEYS_BELOW}"
    )
    q["csv_arrival_orders"] = (
        f"WITH bronze AS ({ORDER_SOURCE}) SELECT row_number() OVER (ORDER BY source_rank) - 1 AS source_rank, order_id, region, "
        "CASE WHEN source_rank % 5 = 0 THEN 'desk \"' || (source_rank % 7) || '\",' || chr(10) || 'floor 2' ELSE channel END AS channel, "
        "CAST(amount AS DOUBLE) AS amount FROM bronze"
    )
    q["csv_record_counts"] = (
        "SELECT 'orders' AS source, TRUE AS present, CAST(count(*) AS BIGINT) AS row_count FROM orders "
        "UNION ALL SELECT 'absent', FALSE, CAST(0 AS BIGINT)"
    )
    return q
