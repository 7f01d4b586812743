"""The registered queries once more, as plain SQL for DuckDB; written independently of the operators."""

from __future__ import annotations

YEAR = 1998

# The three derived ledgers, as common table expressions over ``orders``.
BASE = """
base as (
  select o_orderkey k, o_custkey ck, o_orderdate::date d, lower(substr(o_orderpriority, 3)) cat,
    lpad(o_orderkey::varchar, greatest(7, length(o_orderkey::varchar))::int, '0') ktext,
    ' c' || lpad(o_custkey::varchar, greatest(6, length(o_custkey::varchar))::int, '0') cust,
    (o_totalprice::decimal(18,2) * case when o_orderkey % 97 = 0 then 20 else 1 end)::decimal(18,2) net
  from orders
)"""

# DuckDB divides decimals as doubles, so the unit price is rounded half up in whole cents.
SALES = """
priced as (
  select *, ((((net * 200)::hugeint + k % 10 + 1) // (2 * (k % 10 + 1)))::decimal(18,0) * 0.01)::decimal(18,2)
    unit_price
  from base
),
sales_src as (
  select case when k % 11 = 0 then '  TXN-' || ktext || ' ' else 'TXN-' || ktext end transaction_id,
    cust customer_id,
    'P' || lpad((ck % 50 + 1)::varchar, 3, '0') product_code,
    case when k % 53 = 17 then null else ' ' || cat end product_category,
    strftime(d, '%Y-%m-%d') transaction_date,
    (k % 10 + 1)::int quantity,
    unit_price,
    (net * 1.2)::decimal(18,2) gross_revenue,
    case when k % 59 = 19 then null else net end net_revenue,
    ((net * 1.2)::decimal(18,2) - net)::decimal(18,2) tax_amount,
    case when k % 4 = 1 then strftime(d, '%Y-%m-%d') end service_start_date,
    case when k % 4 = 1 then strftime(d + 365, '%Y-%m-%d') end service_end_date,
    'SYSTEM_A' source_system,
    strftime(d + (k % 28)::int, '%Y-%m-%d') || ' 09:00:00' last_modified_date
  from priced
  union all
  select 'TXN-' || ktext, cust, 'P' || lpad((ck % 50 + 1)::varchar, 3, '0'), cat,
    strftime(d, '%Y-%m-%d'), (k % 10 + 1)::int, unit_price,
    (net * 1.2)::decimal(18,2), (net - 1.00)::decimal(18,2),
    ((net * 1.2)::decimal(18,2) - net)::decimal(18,2), null, null, 'SYSTEM_B',
    strftime(d - 1, '%Y-%m-%d') || ' 09:00:00'
  from priced where k % 50 = 0
)"""

GL = """
gl_amounts as (
  select k, ktext, 'REVENUE' account_type,
    strftime(d + (case when k % 41 = 5 then 9 else k % 4 end)::int, '%Y-%m-%d') posting_date,
    (net * case when k % 50 = 3 then 1.03 else 1 end)::decimal(18,2) net_amount, 'JNL-' || ktext journal_id
  from base where k % 33 <> 7
  union all
  select k, ktext, 'VAT', strftime(d, '%Y-%m-%d'), (net * 0.2)::decimal(18,2), 'JNV-' || ktext
  from base where k % 9 = 2
  union all
  select k, ktext, 'REVENUE', strftime(d + (k % 4)::int, '%Y-%m-%d'), 0.01::decimal(18,2), 'JN2-' || ktext
  from base where k % 7 = 1
  union all
  select k, ktext, 'REVENUE', strftime(d + 4, '%Y-%m-%d'), 5.00::decimal(18,2), 'JN3-' || ktext
  from base where k % 61 = 10
),
gl_src as (
  select 'GL-' || substr(journal_id, 3) posting_id, journal_id, 'TXN-' || ktext source_reference,
    account_type, posting_date, (net_amount * 1.2)::decimal(18,2) debit_amount, net_amount,
    ((net_amount * 1.2)::decimal(18,2) - net_amount)::decimal(18,2) tax_posted,
    case when k % 10 = 0 then 'manual' else 'auto_post' end posted_by
  from gl_amounts
)"""

BANK = """
bank_src as (
  select 'BNK-' || ktext settlement_id, 'TXN-' || ktext reference_id,
    strftime(d + (1 + k % 5)::int, '%Y-%m-%d') settlement_date,
    (net - case when k % 53 = 4 then 1.25 when k % 50 = 3 and k % 4 = 1 then 0
                when k % 50 = 3 then -(net * 0.03)::decimal(18,2) else 0 end)::decimal(18,2) settled_amount,
    (net * 0.01)::decimal(18,2) fee_deducted,
    case k % 3 when 0 then 'CARD' when 1 then 'BACS' else 'CHAPS' end payment_method
  from base where k % 45 <> 8
  union all
  select 'BN2-' || ktext, 'TXN-' || ktext, strftime(d + 6, '%Y-%m-%d'), 2.50::decimal(18,2),
    0.03::decimal(18,2), 'BACS'
  from base where k % 71 = 12
)"""

TIDY = """
tidy as (
  select trim(transaction_id, ' ') transaction_id, trim(upper(customer_id), ' ') customer_id, product_code,
    trim(upper(product_category), ' ') product_category, transaction_date::date transaction_date,
    quantity, unit_price, coalesce(gross_revenue, 0)::decimal(18,2) gross_revenue,
    coalesce(net_revenue, 0)::decimal(18,2) net_revenue, coalesce(tax_amount, 0)::decimal(18,2) tax_amount,
    service_start_date, service_end_date, source_system, last_modified_date
  from sales_src
)"""

SALES_CLEAN = f"""
sales_clean as (
  select * from tidy where year(transaction_date) = {YEAR}
  qualify row_number() over (
    partition by transaction_id order by last_modified_date desc nulls last, net_revenue desc) = 1
)"""

GL_CLEAN = f"""
gl_clean as (
  select trim(source_reference, ' ') source_reference, posting_date::date posting_date,
    sum(net_amount) gl_net_amount, sum(debit_amount) gl_gross_amount, sum(tax_posted) gl_tax_amount,
    count(journal_id) journal_count
  from gl_src where account_type = 'REVENUE' and year(posting_date::date) = {YEAR}
  group by all
)"""

BANK_CLEAN = f"""
bank_clean as (
  select trim(reference_id, ' ') reference_id, settlement_date::date settlement_date,
    sum(settled_amount) bank_settled_amount, sum(fee_deducted) bank_fees, count(*) settlement_count
  from bank_src where year(settlement_date::date) = {YEAR}
  group by all
)"""

RECONCILED = """
variances as (
  select transaction_id, customer_id, transaction_date, product_category, net_revenue source_net,
    gross_revenue source_gross, gl_net_amount, gl_gross_amount, posting_date, bank_settled_amount,
    settlement_date,
    coalesce(net_revenue, 0) - coalesce(gl_net_amount, 0) v1,
    coalesce(gl_net_amount, 0) - coalesce(bank_settled_amount, 0) v2,
    date_diff('day', transaction_date, posting_date) days_to_post,
    date_diff('day', posting_date, settlement_date) days_to_settle
  from sales_clean
  left join gl_clean on transaction_id = source_reference
  left join bank_clean on transaction_id = reference_id
),
reconciled as (
  select * exclude (v1, v2), v1 source_vs_gl_variance, v2 gl_vs_bank_variance,
    case when gl_net_amount is null then 'MISSING_IN_GL'
         when bank_settled_amount is null then 'MISSING_IN_BANK'
         when abs(v1) > 0.01 and abs(v2) > 0.01 then 'MULTI_SYSTEM_VARIANCE'
         when abs(v1) > 0.01 then 'GL_VARIANCE'
         when abs(v2) > 0.01 then 'BANK_VARIANCE'
         when days_to_post > 5 then 'TIMING_DIFFERENCE'
         else 'MATCHED' end reconciliation_status
  from variances
)"""

# ``+ 0.0`` turns a rounded minus zero into zero.
SCORED = """
stats as (
  select product_category, sum(source_net)::double / count(source_net) mean_val,
    stddev_samp(source_net::double) std_val
  from reconciled group by product_category
),
zscored as (
  select r.*, mean_val, std_val,
    case when std_val is null then null
         else round((source_net::double - mean_val) / case when std_val = 0 then 1 else std_val end, 3)
              + 0.0 end z_score
  from reconciled r join stats s on r.product_category = s.product_category
),
scored as (
  select *, case when abs(z_score) > 2.0 then 'ANOMALY' else 'NORMAL' end anomaly_flag,
    case when abs(z_score) > 4.0 then 'HIGH' when abs(z_score) > 2.0 then 'MEDIUM' else 'NONE' end
      anomaly_priority
  from zscored
)"""

SUMMARY = """
months as (
  select strftime(transaction_date, '%Y-%m') period, count(*) total_transactions,
    sum(source_net) total_source_revenue,
    sum(case when reconciliation_status = 'MATCHED' then source_net else 0 end) matched_revenue,
    sum(case when reconciliation_status <> 'MATCHED' then abs(source_vs_gl_variance) else 0 end)
      total_unreconciled,
    count(*) filter (anomaly_flag = 'ANOMALY') anomalies_detected
  from scored group by 1
),
summary as (
  select *, round(100.0::double * matched_revenue::double / nullif(total_source_revenue::double, 0), 2)
    reconciliation_rate_pct
  from months
),
rated as (
  select *, case when reconciliation_rate_pct >= 99 then 'GREEN'
                 when reconciliation_rate_pct >= 95 then 'AMBER' else 'RED' end rag_status
  from summary
)"""

TO_SALES = [BASE, SALES]
TO_GL = [BASE, GL]
TO_BANK = [BASE, BANK]
TO_TIDY = [*TO_SALES, TIDY]
TO_RECONCILED = [*TO_TIDY, GL, BANK, SALES_CLEAN, GL_CLEAN, BANK_CLEAN, RECONCILED]
TO_SCORED = [*TO_RECONCILED, SCORED]
TO_SUMMARY = [*TO_SCORED, SUMMARY]


def _with(parts: list[str], select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select.strip()


def _day(*names: str) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d') {n}" for n in names)


def _num(*names: str) -> str:
    return ", ".join(f"{n}::double {n}" for n in names)


ROW_KEY = "transaction_id, " + _day("posting_date", "settlement_date")
JOINED = (
    "transaction_id, customer_id, product_category, "
    + _day("transaction_date", "posting_date", "settlement_date") + ", "
    + _num("source_net", "source_gross", "gl_net_amount", "gl_gross_amount", "bank_settled_amount")
)
VARIANCES = _num("source_vs_gl_variance", "gl_vs_bank_variance")
RECONCILED_ROW = f"{JOINED}, {VARIANCES}, days_to_post, days_to_settle, reconciliation_status"
STATISTICS = "round(mean_val, 3) mean_val, round(std_val, 3) std_val"
SCORED_ROW = f"{RECONCILED_ROW}, {STATISTICS}, z_score, anomaly_flag, anomaly_priority"
SUMMARY_ROW = (
    "period, total_transactions, "
    + _num("total_source_revenue", "matched_revenue", "total_unreconciled")
    + ", anomalies_detected, reconciliation_rate_pct, rag_status"
)
SCORED_SELECT = f"select {SCORED_ROW} from scored"
SCORED_ROWS = _with(TO_SCORED, SCORED_SELECT)
SUMMARY_ROWS = _with(TO_SUMMARY, f"select {SUMMARY_ROW} from rated order by period")

NUMBERED = _with(
    TO_TIDY,
    f"""
    select transaction_id, last_modified_date, net_revenue::double net_revenue, source_system,
      row_number() over (partition by transaction_id
        order by last_modified_date desc nulls last, net_revenue desc, source_system desc) rn
    from tidy where year(transaction_date) = {YEAR}
    """,
)
AUDIT = _with(
    [BASE, SALES, GL, BANK],
    """
    select 'sales' source, count(*) row_count, 14::bigint column_count from sales_src
    union all select 'gl', count(*), 9 from gl_src
    union all select 'bank', count(*), 6 from bank_src
    """,
)

# The job's options.
TO_CLEAN = [*TO_TIDY, GL, BANK, SALES_CLEAN, GL_CLEAN, BANK_CLEAN]
PER_REFERENCE = """
gl_once as (
  select source_reference, min(posting_date) posting_date, sum(gl_net_amount) gl_net_amount,
    sum(gl_gross_amount) gl_gross_amount, sum(gl_tax_amount) gl_tax_amount, sum(journal_count) journal_count
  from gl_clean group by source_reference
),
bank_once as (
  select reference_id, min(settlement_date) settlement_date, sum(bank_settled_amount) bank_settled_amount,
    sum(bank_fees) bank_fees, sum(settlement_count) settlement_count
  from bank_clean group by reference_id
)"""
BY_REFERENCE = RECONCILED.replace("join gl_clean", "join gl_once").replace("join bank_clean", "join bank_once")
SCORED_WITH_NULL = SCORED.replace(
    "r.product_category = s.product_category", "r.product_category is not distinct from s.product_category"
)


def with_grace(clean: str) -> str:
    """A year and the January after it."""
    for column in ("posting_date", "settlement_date"):
        clean = clean.replace(
            f"year({column}::date) = {YEAR}",
            f"{column}::date >= date '{YEAR}-01-01' and {column}::date < date '{YEAR + 1}-02-01'",
        )
    return clean


DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_NUMBERS = LINE_COLUMNS[:8]
LINE_KEYS = (
    "with keys as (select l_orderkey, l_linenumber, count(*) n from lineitem group by all) "
)


def _null_report() -> str:
    joined = "with joined as (select * from documents left join labels using (doc_id))\n"
    rows = [
        f"select '{c}' column_name, count(*) - count({c}) null_count, "
        f"round(100.0::double * (count(*) - count({c})) / count(*), 2) null_pct from joined"
        for c in DOCUMENT_COLUMNS
    ]
    return joined + "\nunion all ".join(rows)


def _profile() -> str:
    return "\nunion all ".join(
        f"select '{c}' column_name, count({c}) count, round(avg({c}::double), 3) mean, "
        f"round(stddev_samp({c}::double), 3) stddev, min({c})::double + 0.0 min, max({c})::double + 0.0 max from lineitem"
        for c in LINE_NUMBERS
    )


def _full_report() -> str:
    def row(section: str, column: str, metric: str, value: str, source: str = "lineitem") -> str:
        return (
            f"select 'lineitem' table_name, '{section}' section, '{column}' column_name, "
            f"'{metric}' metric, ({value})::double \"value\" from {source}"
        )

    rows = [
        row("table", "*", "total_rows", "count(*)"),
        f"select 'lineitem', 'table', '*', 'column_count', {len(LINE_COLUMNS)}::double",
    ]
    for c in LINE_COLUMNS:
        rows.append(row("nulls", c, "null_count", f"count(*) - count({c})"))
        rows.append(row("nulls", c, "null_pct", f"round(100.0 * (count(*) - count({c})) / count(*), 2)"))
    for c in LINE_NUMBERS:
        rows.append(row("numeric", c, "count", f"count({c})"))
        rows.append(row("numeric", c, "mean", f"round(avg({c}::double), 3)"))
        rows.append(row("numeric", c, "stddev", f"round(stddev_samp({c}::double), 3)"))
        rows.append(row("numeric", c, "min", f"round(min({c})::double, 3) + 0.0"))
        rows.append(row("numeric", c, "max", f"round(max({c})::double, 3) + 0.0"))
    key = "l_orderkey,l_linenumber"
    rows.append(row("duplicates", key, "total_rows", "sum(n)", "keys"))
    rows.append(row("duplicates", key, "distinct_keys", "count(*)", "keys"))
    rows.append(row("duplicates", key, "duplicate_row_count", "sum(n) - count(*)", "keys"))
    return LINE_KEYS + "\nunion all ".join(rows)


def _scorecard() -> str:
    def row(column: str, check: str, rows: str, percent: bool) -> str:
        pct = f"round(100.0::double * ({rows}) / count(*), 2)" if percent else "null::double"
        return (
            f"select 'Sales' table_name, '{column}' column_name, '{check}' \"check\", "
            f"({rows})::bigint \"rows\", {pct} pct from sales_src"
        )

    def nulls(c: str) -> str:
        return row(c, "nulls", f"count(*) - count({c})", True)

    distinct = "count(distinct transaction_id) + max(case when transaction_id is null then 1 else 0 end)"
    return _with(
        TO_SALES,
        "\nunion all ".join(
            [
                row("*", "rows", "count(*)", False),
                nulls("transaction_id"),
                nulls("net_revenue"),
                nulls("transaction_date"),
                row("transaction_date", "unparsable",
                    "count(*) filter (transaction_date is not null and try_cast(transaction_date as date) is null)",
                    True),
                row("net_revenue", "unparsable",
                    "count(*) filter (net_revenue is not null and try_cast(net_revenue as decimal(18,2)) is null)",
                    True),
                row("transaction_id", "duplicates", f"count(*) - ({distinct})", False),
            ]
        ),
    )


def _balance(condition: str) -> str:
    return (
        "select c_custkey, c_name, c_nationkey::bigint c_nationkey, c_acctbal, c_mktsegment "
        f"from customer where {condition}"
    )


ORACLE: dict[str, str] = {
    "scan_parquet": "select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from orders",
    "scan_projection": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders",
    "ingest_audit": AUDIT,
    "period_filter": _with(
        TO_SALES,
        "select transaction_id, transaction_date, source_system from sales_src "
        f"where year(transaction_date::date) = {YEAR}",
    ),
    "period_filter_spellings": (
        "select o_orderkey, case when o_orderkey % 5 = 0 then ' ' else '' end || "
        "case when o_orderkey % 3 = 0 then year(o_orderdate) || '-' || month(o_orderdate) || '-' || "
        "day(o_orderdate) else strftime(o_orderdate, '%Y-%m-%d') end \"day\" "
        f"from orders where year(o_orderdate) = {YEAR}"
    ),
    "account_filter": _with(
        TO_GL,
        "select posting_id, source_reference, account_type, net_amount::double net_amount from gl_src "
        "where account_type = 'REVENUE'",
    ),
    "scalar_string_clean": _with(
        TO_SALES,
        "select trim(transaction_id, ' ') transaction_id, trim(upper(customer_id), ' ') customer_id, "
        "trim(upper(product_category), ' ') product_category, source_system from sales_src",
    ),
    "scalar_dates": _with(
        TO_SALES,
        """
        select transaction_id, source_system, strftime(transaction_date::date, '%Y-%m-%d') transaction_date,
          strftime(service_end_date::date, '%Y-%m-%d') service_end_date,
          strftime(transaction_date::date, '%Y-%m') period, year(transaction_date::date)::bigint sale_year,
          date_diff('day', transaction_date::date, service_end_date::date) service_days
        from sales_src
        """,
    ),
    "scalar_money": _with(
        TO_SALES,
        """
        select transaction_id, source_system, coalesce(net_revenue, 0)::double net_revenue,
          coalesce(gross_revenue, 0)::double gross_revenue,
          abs(coalesce(net_revenue, 0) - coalesce(gross_revenue, 0))::double markup
        from sales_src
        """,
    ),
    "row_number_rank": NUMBERED,
    "row_number_large_groups": NUMBERED,
    "dedup_latest": _with(
        TO_TIDY,
        """
        select transaction_id, last_modified_date, net_revenue::double net_revenue, source_system from tidy
        qualify row_number() over (
          partition by transaction_id order by last_modified_date desc nulls last, net_revenue desc) = 1
        """,
    ),
    "distinct_rows": _with(
        TO_SALES,
        f"select distinct transaction_id, {_num('net_revenue', 'gross_revenue', 'tax_amount')}, "
        "transaction_date from sales_src",
    ),
    "cleanse_sales": _with(
        [*TO_TIDY, SALES_CLEAN],
        "select transaction_id, customer_id, product_code, product_category, "
        f"{_day('transaction_date')}, quantity::bigint quantity, "
        f"{_num('unit_price', 'gross_revenue', 'net_revenue', 'tax_amount')}, service_start_date, "
        "service_end_date, source_system, last_modified_date from sales_clean",
    ),
    "gl_rollup": _with(
        TO_GL,
        """
        select source_reference, posting_date, sum(net_amount)::double gl_net_amount,
          sum(debit_amount)::double gl_gross_amount, sum(tax_posted)::double gl_tax_amount,
          count(journal_id) journal_count
        from gl_src group by source_reference, posting_date
        """,
    ),
    "cleanse_gl": _with(
        [*TO_GL, GL_CLEAN],
        f"select source_reference, {_day('posting_date')}, "
        f"{_num('gl_net_amount', 'gl_gross_amount', 'gl_tax_amount')}, journal_count from gl_clean",
    ),
    "bank_rollup": _with(
        TO_BANK,
        """
        select reference_id, settlement_date, sum(settled_amount)::double bank_settled_amount,
          sum(fee_deducted)::double bank_fees, count(*) settlement_count
        from bank_src group by reference_id, settlement_date
        """,
    ),
    "cleanse_bank": _with(
        [*TO_BANK, BANK_CLEAN],
        f"select reference_id, {_day('settlement_date')}, {_num('bank_settled_amount', 'bank_fees')}, "
        "settlement_count from bank_clean",
    ),
    "left_join_gl": _with(
        [*TO_TIDY, GL, SALES_CLEAN, GL_CLEAN],
        f"select transaction_id, {_day('transaction_date', 'posting_date')}, "
        f"{_num('net_revenue', 'gl_net_amount', 'gl_gross_amount', 'gl_tax_amount')}, journal_count "
        "from sales_clean left join gl_clean on transaction_id = source_reference",
    ),
    "three_way_join": _with(TO_RECONCILED, f"select {JOINED} from variances"),
    "recon_variance": _with(TO_RECONCILED, f"select {ROW_KEY}, {VARIANCES} from reconciled"),
    "recon_lags": _with(
        TO_RECONCILED, f"select {ROW_KEY}, days_to_post, days_to_settle from reconciled"
    ),
    "recon_status": _with(TO_RECONCILED, f"select {ROW_KEY}, reconciliation_status from reconciled"),
    "three_way_reconciliation": _with(TO_RECONCILED, f"select {RECONCILED_ROW} from reconciled"),
    "status_counts": _with(
        TO_RECONCILED,
        "select reconciliation_status, count(*) row_count from reconciled group by reconciliation_status",
    ),
    "category_stats": _with(TO_SCORED, f"select product_category, {STATISTICS} from stats"),
    "zscore": _with(
        TO_SCORED,
        f"select product_category, {ROW_KEY}, source_net::double source_net, {STATISTICS}, z_score "
        "from zscored",
    ),
    "anomaly_flag": _with(TO_SCORED, f"select {ROW_KEY}, z_score, anomaly_flag from scored"),
    "anomaly_priority": _with(TO_SCORED, f"select {ROW_KEY}, z_score, anomaly_priority from scored"),
    "detect_anomalies": SCORED_ROWS,
    "conditional_sum": _with(
        TO_RECONCILED,
        """
        select strftime(transaction_date, '%Y-%m') period,
          sum(case when reconciliation_status = 'MATCHED' then source_net else 0 end)::double
            matched_revenue,
          sum(case when reconciliation_status <> 'MATCHED' then abs(source_vs_gl_variance) else 0 end)::double
            total_unreconciled
        from reconciled group by 1
        """,
    ),
    "conditional_count": _with(TO_SUMMARY, "select period, anomalies_detected from months"),
    "rag_rating": _with(TO_SUMMARY, "select period, reconciliation_rate_pct, rag_status from rated"),
    "monthly_summary": SUMMARY_ROWS,
    "pipeline_reconciled": SCORED_ROWS,
    "pipeline_summary": SUMMARY_ROWS,
    "pipeline_reference_grain": _with([*TO_CLEAN, PER_REFERENCE, BY_REFERENCE, SCORED], SCORED_SELECT),
    "pipeline_null_category": _with([*TO_RECONCILED, SCORED_WITH_NULL], SCORED_SELECT),
    "pipeline_grace_days": _with(
        [*TO_TIDY, GL, BANK, SALES_CLEAN, with_grace(GL_CLEAN), with_grace(BANK_CLEAN), RECONCILED, SCORED],
        SCORED_SELECT,
    ),
    "job_transactions": SCORED_ROWS,
    "job_summary": SUMMARY_ROWS,
    "job_audit": AUDIT,
    "null_report": _null_report(),
    "null_report_blanks": (
        "with noted as (select o_orderkey, case o_orderkey % 4 when 0 then '  ' when 1 then null "
        "else o_orderpriority end note from orders) "
        "select 'o_orderkey' column_name, count(*) - count(o_orderkey) null_count, "
        "round(100.0::double * (count(*) - count(o_orderkey)) / count(*), 2) null_pct from noted union all "
        "select 'note', count(*) filter (note is null or trim(note, ' ') = ''), "
        "round(100.0::double * count(*) filter (note is null or trim(note, ' ') = '') / count(*), 2) from noted"
    ),
    "duplicate_report": LINE_KEYS + (
        "select l_orderkey, l_linenumber::bigint l_linenumber, n row_count from keys where n > 1 "
        "order by n desc, l_orderkey, l_linenumber"
    ),
    "duplicate_summary": LINE_KEYS + (
        "select sum(n)::bigint total_rows, count(*) distinct_keys, "
        "(sum(n) - count(*))::bigint duplicate_row_count from keys"
    ),
    "value_range_min": _balance("c_acctbal < 0"),
    "value_range_max": _balance("c_acctbal > 9000"),
    "value_range_both": _balance("c_acctbal < 0 or c_acctbal > 9000"),
    "value_range_none": _balance("false"),
    "date_range_check": (
        "select * replace (l_linenumber::bigint as l_linenumber, "
        "strftime(l_shipdate, '%Y-%m-%d') as l_shipdate) from lineitem "
        "where l_shipdate::date < date '1996-01-01' or l_shipdate::date > date '2000-12-31'"
    ),
    "numeric_profile": _profile(),
    "quality_scorecard": _scorecard(),
    "null_gate": (
        "select 'l_orderkey' column_name, count(*) - count(l_orderkey) null_count, "
        "round(100.0::double * (count(*) - count(l_orderkey)) / count(*), 2) null_pct from lineitem union all "
        "select 'l_linenumber', count(*) - count(l_linenumber), "
        "round(100.0::double * (count(*) - count(l_linenumber)) / count(*), 2) from lineitem"
    ),
    "full_quality_report": _full_report(),
    "sink_roundtrip_parquet": SCORED_ROWS,
    "sink_roundtrip_csv": SUMMARY_ROWS,
}
