"""DuckDB SQL for every registered query, written apart from the Spark plans."""

from __future__ import annotations

from tillmark.plans.catalog import CHECKED_CONTRACT, METRIC_CONTRACT

ORDER_LINES = """
order_lines AS (
  SELECT l.*, o_custkey, o_orderdate, n_name, p_name, p_retailprice,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT),
                   strftime(l_shipdate, '%Y%m%d')) AS ref,
         l_returnflag = 'R' AS back,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS signed
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""


def _sales(quantity: str = "signed") -> str:
    return f"""
sales AS (
  SELECT *, NOT IsCancellation AND Quantity > 0 AND UnitPrice > 0 AS sold,
         strftime(InvoiceDate, '%Y-%m') AS ym FROM (
    SELECT ref AS SourceRowId, (CASE WHEN back THEN 'C' ELSE '' END) || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
      CAST(l_partkey AS VARCHAR) AS StockCode, p_name AS Description, {quantity} AS Quantity,
      o_orderdate AS InvoiceDate,
      CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(p_retailprice AS DECIMAL(18,4)) END
        AS UnitPrice,
      CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
      n_name AS Country, back AS IsCancellation, o_custkey % 5 = 0 AS UnknownCustomer,
      l_partkey % 97 = 0 AS ZeroPrice, CAST({quantity} * UnitPrice AS DECIMAL(20,4)) AS LineAmount
    FROM order_lines))"""


MIXED = "CASE WHEN l_partkey % 89 = 0 THEN CAST(l_quantity AS INT) ELSE signed END"

RAW = """
raw AS (
  SELECT ref AS SourceRowId,
    CASE WHEN l_orderkey % 1009 = 0 THEN '' ELSE (CASE WHEN NOT back THEN '' WHEN l_orderkey % 2 = 0 THEN 'C'
      ELSE 'c' END) || CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
    ' ' || CAST(l_partkey AS VARCHAR) AS StockCode,
    CASE WHEN l_partkey % 50 = 0 THEN '  ' ELSE p_name END AS Description,
    CASE WHEN l_orderkey % 503 = 0 THEN 'two' WHEN l_orderkey % 499 = 0 THEN '1.5'
      WHEN l_orderkey % 491 = 0 THEN NULL ELSE CAST(signed AS VARCHAR) || '.0' END AS Quantity,
    o_orderdate AS InvoiceDate,
    CASE WHEN l_partkey % 193 = 0 THEN '-1' WHEN l_partkey % 191 = 0 THEN 'n/a' WHEN l_partkey % 97 = 0 THEN '0'
      WHEN l_partkey % 89 = 0 THEN '2.345' WHEN l_partkey % 83 = 0 THEN '2.355' WHEN l_partkey % 79 = 0 THEN '0.004'
      ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS UnitPrice,
    CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 7 = 0 THEN 'A-' || CAST(o_custkey AS VARCHAR)
      ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS CustomerID,
    n_name || ' ' AS Country
  FROM order_lines)"""

READ = """
r AS (
  SELECT SourceRowId, trim(InvoiceNo) AS InvoiceNo, trim(StockCode) AS StockCode,
    nullif(trim(Description), '') AS Description, InvoiceDate, trim(Country) AS Country,
    TRY_CAST(Quantity AS DECIMAL(18,6)) AS q, TRY_CAST(UnitPrice AS DECIMAL(18,4)) AS p,
    regexp_replace(CustomerID, '\\.0$', '') AS CustomerID,
    CAST(TRY_CAST(UnitPrice AS DECIMAL(18,4)) * 10000 AS BIGINT) AS n
  FROM raw),
read AS (
  SELECT *, n // 100 + CASE WHEN n % 100 > 50 OR (n % 100 = 50 AND (n // 100) % 2 = 1) THEN 1 ELSE 0 END AS cents,
    CASE WHEN q IS NULL THEN 'quantity_invalid' WHEN q <> floor(q) THEN 'quantity_not_integral' END AS quantity_issue,
    CASE WHEN p IS NULL THEN 'unit_price_invalid' WHEN p < 0 THEN 'unit_price_negative' END AS price_issue,
    CASE WHEN InvoiceNo = '' OR StockCode = '' OR Country = '' THEN 'required_source_field_missing'
      ELSE coalesce(quantity_issue, price_issue) END AS reject_code
  FROM r)"""

SHEET_ROWS = """
sheet_rows AS (
  SELECT * EXCLUDE (SourceRowId), SourceRowId AS LineRef, CASE WHEN InvoiceDate < DATE '1998-01-01' THEN 'Before 1998' ELSE 'From 1998' END AS SourceSheet,
    row_number() OVER (ORDER BY InvoiceDate >= DATE '1998-01-01', SourceRowId) AS row_id
  FROM read)"""

LONG_NUMBERS = """
long_numbers AS (SELECT ref AS LineRef, l_orderkey AS k, l_partkey AS p FROM order_lines)"""

CONTRACT_TEXT = """
text_rows AS (
  SELECT ref AS LineRef,
    CASE WHEN l_partkey % 251 = 0 THEN ' ' WHEN l_partkey % 61 = 0 THEN 'D' || CAST(l_orderkey AS VARCHAR) ELSE ref END
      AS SourceRowId,
    CASE WHEN l_orderkey % 1009 = 0 THEN '' ELSE (CASE WHEN back THEN 'C' ELSE '' END) || CAST(l_orderkey AS VARCHAR)
      END AS InvoiceNo,
    CAST(l_partkey AS VARCHAR) AS StockCode,
    CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_name END AS Description,
    CASE WHEN l_partkey % 167 = 0 THEN 0 ELSE signed END AS units,
    CASE WHEN l_orderkey % 503 = 0 THEN 'two' WHEN l_orderkey % 499 = 0 THEN '1.5' WHEN l_orderkey % 491 = 0 THEN NULL
      WHEN l_orderkey % 487 = 0 THEN '0' || CAST(abs(units) AS VARCHAR) ELSE CAST(units AS VARCHAR) END AS Quantity,
    CASE WHEN l_orderkey % 479 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS InvoiceDate,
    CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(p_retailprice AS DECIMAL(18,4)) END AS price,
    CASE WHEN l_partkey % 193 = 0 THEN '-1.00' WHEN l_partkey % 191 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END
      AS UnitPrice,
    CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS CustomerID,
    n_name AS Country,
    CASE WHEN l_partkey % 181 = 0 THEN 'maybe' WHEN back THEN 'true' ELSE 'false' END AS IsCancellation,
    CASE WHEN o_custkey % 5 = 0 THEN 'true' ELSE 'false' END AS UnknownCustomer,
    CASE WHEN l_partkey % 97 = 0 THEN 'true' ELSE 'false' END AS ZeroPrice,
    CAST(CAST(units * price AS DECIMAL(20,4)) + CASE WHEN l_partkey % 173 = 0 THEN 1 ELSE 0 END AS VARCHAR)
      AS LineAmount
  FROM order_lines)"""

MEASURES = """
  coalesce(sum(LineAmount) FILTER (WHERE sold), 0)::DOUBLE AS gross_sales,
  coalesce(sum(abs(LineAmount)) FILTER (WHERE IsCancellation), 0)::DOUBLE AS cancelled_sales,
  coalesce(sum(LineAmount), 0)::DOUBLE AS net_sales,
  count(DISTINCT InvoiceNo) FILTER (WHERE sold) AS order_count,
  coalesce(sum(Quantity) FILTER (WHERE sold), 0)::BIGINT AS units_sold,
  count(DISTINCT CustomerID) FILTER (WHERE sold AND trim(CustomerID) <> '') AS active_customers,
  count(DISTINCT InvoiceNo) FILTER (WHERE IsCancellation) AS cancelled_invoice_count,
  count(DISTINCT nullif(trim(InvoiceNo), '')) AS all_invoice_count,
  gross_sales / nullif(order_count, 0) AS average_order_value,
  cancelled_invoice_count::DOUBLE / nullif(all_invoice_count, 0)::DOUBLE AS cancellation_rate"""

# Every slice with its changes against the calendar month before and the year before.
SLICES = f"""
months AS (SELECT ym, sum(LineAmount) AS net FROM sales GROUP BY ym),
grouped AS (
  SELECT 'all' AS slice_id, NULL AS slice_value, {MEASURES} FROM sales
  UNION ALL SELECT 'country', Country, {MEASURES} FROM sales GROUP BY Country
  UNION ALL SELECT 'month', ym, {MEASURES} FROM sales GROUP BY ym),
slices AS (
  SELECT g.*, (cur.net - prev.net)::DOUBLE / nullif(prev.net, 0)::DOUBLE AS sales_mom_pct,
         (cur.net - old.net)::DOUBLE / nullif(old.net, 0)::DOUBLE AS sales_yoy_pct
  FROM grouped g LEFT JOIN months cur ON g.slice_id = 'month' AND cur.ym = g.slice_value
  LEFT JOIN months prev ON prev.ym = strftime(CAST(cur.ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
  LEFT JOIN months old ON old.ym = strftime(CAST(cur.ym || '-01' AS DATE) - INTERVAL 1 YEAR, '%Y-%m'))"""

REPORTED = (
    "gross_sales", "cancelled_sales", "net_sales", "order_count", "units_sold", "active_customers",
    "average_order_value", "cancellation_rate", "sales_mom_pct", "sales_yoy_pct",
)

# The sums as decimals; through text, a ratio becomes the decimal that it shows.
EXACT_SLICES = SLICES.replace(MEASURES, MEASURES.replace("0)::DOUBLE AS", "0) AS"))
LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT slice_id, slice_value, '{name}' AS metric_id, CAST(CAST({name} AS VARCHAR) AS DECIMAL(28,10)) AS value FROM slices" for name in REPORTED
) + ")"

COMPARED = """
left_side AS (SELECT slice_id, slice_value, metric_id, CAST(value AS DECIMAL(28,10)) AS v FROM long),
right_side AS (
  SELECT slice_id, slice_value, metric_id, CASE WHEN slice_value IS NOT DISTINCT FROM 'NATION_5' THEN NULL ELSE
    v + CASE WHEN slice_value IN ('NATION_4', 'NATION_8') THEN 0.005 WHEN slice_value = 'NATION_6' THEN 0.01
             WHEN slice_value LIKE '%-06' THEN 0.5 ELSE 0 END END AS w
  FROM left_side WHERE slice_value IS DISTINCT FROM 'NATION_3'),
compared AS (
  SELECT a.slice_id, a.slice_value, a.metric_id, v, w, b.metric_id IS NOT NULL AS in_right,
    abs(v - w) AS difference,
    CASE WHEN a.metric_id IN ('cancellation_rate', 'sales_mom_pct', 'sales_yoy_pct') THEN 0.0001 ELSE 0.01 END AS tolerance
  FROM left_side a LEFT JOIN right_side b ON a.slice_id = b.slice_id AND a.metric_id = b.metric_id
    AND a.slice_value IS NOT DISTINCT FROM b.slice_value)"""


def _status(tolerance: str) -> str:
    return (f"CASE WHEN v IS NULL AND w IS NULL THEN 'both-null' WHEN v IS NULL OR w IS NULL THEN 'null-mismatch' "
            f"WHEN difference <= {tolerance} THEN 'passed' ELSE 'failed' END")


BRIDGE = """
bridge(UserPrincipalName, Country, IsActive) AS (VALUES
  ('manager.a@example.invalid', 'NATION_2', true), ('manager.b@example.invalid', 'NATION_7', true),
  ('manager.b@example.invalid', 'NATION_11', true), ('former.c@example.invalid', 'NATION_3', false)),
users(UserPrincipalName) AS (VALUES ('manager.a@example.invalid'), ('manager.b@example.invalid'),
  ('former.c@example.invalid'), ('unmapped.d@example.invalid')),
scope AS (
  SELECT b.UserPrincipalName, count(DISTINCT s.Country) AS visible_country_count,
    string_agg(DISTINCT s.Country, '|' ORDER BY s.Country) AS visible_countries, sum(LineAmount) AS net_sales
  FROM bridge b JOIN sales s USING (Country) WHERE IsActive GROUP BY 1)"""
MINE = "(SELECT Country FROM bridge WHERE IsActive AND UserPrincipalName = 'manager.b@example.invalid')"

EXPORT = """
export AS (
  SELECT SourceRowId, InvoiceNo, StockCode, coalesce(Description, '') AS Description,
    CAST(Quantity AS VARCHAR) AS Quantity, strftime(InvoiceDate, '%Y-%m-%dT%H:%M:%S') AS InvoiceDate,
    regexp_replace(CAST(UnitPrice AS VARCHAR), '(\\.\\d\\d\\d*?)0*$', '\\1') AS UnitPrice,
    coalesce(CustomerID, '') AS CustomerID, Country, CAST(IsCancellation AS VARCHAR) AS IsCancellation,
    CAST(UnknownCustomer AS VARCHAR) AS UnknownCustomer, CAST(ZeroPrice AS VARCHAR) AS ZeroPrice,
    regexp_replace(CAST(LineAmount AS VARCHAR), '(\\.\\d\\d\\d*?)0*$', '\\1') AS LineAmount
  FROM sales)"""
FACT = ("SourceRowId", "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
        "Country", "IsCancellation", "UnknownCustomer", "ZeroPrice", "LineAmount")
FACT_SELECT = ("SourceRowId, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice::DOUBLE AS UnitPrice, "
               "CustomerID, Country, IsCancellation, UnknownCustomer, ZeroPrice, LineAmount::DOUBLE AS LineAmount")

GAP = """
gap AS (SELECT * FROM sales WHERE ym <> '1996-05'),
gap_months AS (SELECT ym, sum(LineAmount) AS net FROM gap GROUP BY ym)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


S = _with(ORDER_LINES, _sales())
SM = _with(ORDER_LINES, _sales(MIXED))


# ---- findings ------------------------------------------------------------------

def _valid(column: dict) -> str:
    name, kind = column["name"], column["type"]
    text = f"trim({name})"
    return {
        "string": "true",
        "integer": f"regexp_full_match({text}, '0|-?[1-9][0-9]*')",
        "number": f"TRY_CAST({text} AS DECIMAL(38,18)) IS NOT NULL",
        "boolean": f"lower({text}) IN ('true','false','1','0','yes','no')",
        "datetime": f"try_strptime({text}, '%Y-%m-%dT%H:%M:%S') IS NOT NULL",
    }[kind]


def _finding(code: str, scope: str, test: str) -> str:
    return f"SELECT '{code}' AS code, '{scope}' AS scope, LineRef AS row FROM text_rows WHERE {test}"


def _column_findings() -> list[str]:
    found = []
    for column in CHECKED_CONTRACT["columns"]:
        name = column["name"]
        if name == "Channel":
            continue
        filled = f"coalesce(trim({name}), '') <> ''"
        valid = _valid(column)
        number = f"TRY_CAST(trim({name}) AS DECIMAL(38,18))"
        if not column["nullable"]:
            found.append(_finding("null_not_allowed", name, f"NOT ({filled})"))
        if column["type"] != "string":
            found.append(_finding("invalid_type", name, f"{filled} AND NOT ({valid})"))
        if "allowed_values" in column:
            words = ", ".join(f"'{word}'" for word in column["allowed_values"])
            found.append(_finding("not_allowed", name, f"{filled} AND {name} NOT IN ({words})"))
        if "min" in column:
            found.append(_finding("below_minimum", name, f"{filled} AND {valid} AND {number} < {column['min']}"))
        if "max" in column:
            found.append(_finding("above_maximum", name, f"{filled} AND {valid} AND {number} > {column['max']}"))
    return found


Q_OK = "regexp_full_match(trim(Quantity), '0|-?[1-9][0-9]*')"
P_OK = "TRY_CAST(UnitPrice AS DECIMAL(18,6)) IS NOT NULL"
BOTH_OK = f"coalesce({Q_OK} AND {P_OK}, false)"
AMOUNT = "CAST(LineAmount AS DECIMAL(18,4))"
Q_NUM, P_NUM = "TRY_CAST(Quantity AS DECIMAL(18,6))", "TRY_CAST(UnitPrice AS DECIMAL(18,6))"
MISMATCHES = [
    _finding("formula_mismatch", "line_amount_reconciliation",
             f"{BOTH_OK} AND abs({AMOUNT} - {Q_NUM} * {P_NUM}) > 0.0001"),
    _finding("formula_mismatch", "price_from_amount",
             f"{BOTH_OK} AND {Q_NUM} <> 0 AND abs({P_NUM} - {AMOUNT} / {Q_NUM}) > 0.001"),
]
FORMULA_ERRORS = [_finding("formula_evaluation_error", "price_from_amount", f"{BOTH_OK} AND {Q_NUM} = 0")]


def _duplicates(code: str) -> str:
    return (f"SELECT '{code}' AS code, 'SourceRowId' AS scope, row FROM (SELECT LineRef AS row, "
            f"row_number() OVER (PARTITION BY SourceRowId ORDER BY LineRef) AS nth FROM text_rows "
            f"WHERE trim(SourceRowId) <> '') WHERE nth > 1")


DUPLICATES = [_duplicates("duplicate_primary_key"), _duplicates("duplicate_unique_value")]
TABLE_FINDINGS = [
    "SELECT 'missing_required_column' AS code, 'Channel' AS scope, NULL AS row",
    "SELECT 'above_maximum_rows', 'expectations.max_rows', NULL FROM (SELECT count(*) AS n FROM text_rows) WHERE n > 5000",
]
ALL_FINDINGS = _column_findings() + MISMATCHES + FORMULA_ERRORS + DUPLICATES + TABLE_FINDINGS
TEXT = _with(ORDER_LINES, CONTRACT_TEXT)


def _only(*codes: str) -> str:
    picked = [sql for sql in ALL_FINDINGS if any(f"SELECT '{code}'" in sql for code in codes)]
    return TEXT + " " + " UNION ALL ".join(picked)


ISSUES = TEXT + ", issues AS (" + " UNION ALL ".join(ALL_FINDINGS) + ")"


# ---- metric contract ------------------------------------------------------------

METRIC_VALUES = TEXT + """,
base AS (
  SELECT count(DISTINCT nullif(trim(SourceRowId), ''))::DOUBLE AS line_count,
    count(DISTINCT nullif(trim(InvoiceNo), ''))::DOUBLE AS invoice_count,
    sum(CAST(LineAmount AS DECIMAL(28,8)))::DOUBLE AS net_sales,
    sum(CAST(LineAmount AS DECIMAL(28,8)))::DOUBLE / count(LineAmount)::DOUBLE AS average_line,
    CASE WHEN count(Quantity) = count(TRY_CAST(Quantity AS DECIMAL(28,8))) THEN
      sum(TRY_CAST(Quantity AS DECIMAL(28,8)))::DOUBLE / count(Quantity)::DOUBLE END AS average_quantity
  FROM text_rows),
metric_values(metric_id, actual, issue) AS (
  SELECT 'line_count', line_count, NULL FROM base UNION ALL SELECT 'invoice_count', invoice_count, NULL FROM base
  UNION ALL SELECT 'net_sales', net_sales, NULL FROM base UNION ALL SELECT 'average_line', average_line, NULL FROM base
  UNION ALL SELECT 'average_quantity', average_quantity,
    CASE WHEN average_quantity IS NULL THEN 'invalid_metric_input' END FROM base
  UNION ALL SELECT 'net_per_invoice', net_sales / invoice_count, NULL FROM base
  UNION ALL SELECT 'invoice_value_share', net_sales / invoice_count / net_sales, NULL FROM base
  UNION ALL SELECT 'quantity_per_line', average_quantity / line_count,
    CASE WHEN average_quantity IS NULL THEN 'unresolved_metric_dependency' END FROM base)"""
EXPECTED = "expected(metric_id, expected, tolerance) AS (VALUES " + ", ".join(
    f"('{m['id']}', {m['expected']}::DOUBLE, {m['tolerance']}::DOUBLE)" for m in METRIC_CONTRACT
) + ")"


# ---- queries --------------------------------------------------------------------

def _ranked(field: str) -> str:
    return f"{S} SELECT {field}, sum(LineAmount)::DOUBLE AS net_sales FROM sales GROUP BY {field}"


def _cards(page: str, names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{page}' AS page, '{name}' AS metric_id, {name}::DOUBLE AS value FROM c_{page[0]}" for name in names)


def _top(order: str, label: str) -> str:
    return (f"SELECT row_number() OVER (ORDER BY net {order}, StockCode) AS position, StockCode, "
            f"net::DOUBLE AS net_sales, '{label}' AS list FROM (SELECT StockCode, sum(LineAmount) AS net "
            f"FROM sales GROUP BY 1 ORDER BY net {order}, StockCode LIMIT 5)")


def _money(name: str) -> str:
    return f"coalesce(CASE WHEN {name} < 0 THEN '-' ELSE '' END || '£' || format('{{:,.2f}}', abs({name})), '--') AS {name}"


def _percent(name: str) -> str:
    return f"coalesce(printf('%.2f', {name} * 100) || '%', '--') AS {name}"


def _count(name: str) -> str:
    return f"CAST({name} AS VARCHAR) AS {name}"


MONTH_SLICE = f"""{S}, m AS (SELECT {MEASURES} FROM sales WHERE ym = '1996-11'),
c AS (SELECT coalesce(sum(LineAmount) FILTER (WHERE ym = '1996-11'), 0) AS cur,
  coalesce(sum(LineAmount) FILTER (WHERE ym = '1996-10'), 0) AS prev,
  coalesce(sum(LineAmount) FILTER (WHERE ym = '1995-11'), 0) AS old FROM sales)
SELECT m.*, (cur - prev)::DOUBLE / nullif(prev, 0)::DOUBLE AS sales_mom_pct,
  (cur - old)::DOUBLE / nullif(old, 0)::DOUBLE AS sales_yoy_pct FROM m, c"""

PROFILE_COLUMNS = {"SourceRowId": "SourceRowId", "Invoice": "InvoiceNo", "StockCode": "StockCode",
                   "Description": "Description", "Quantity": "Quantity", "InvoiceDate": "CAST(InvoiceDate AS VARCHAR)", "Price": "UnitPrice",
                   "Customer ID": "CustomerID", "Country": "Country"}

NATION = "('NATION_2', 'NATION_7')"

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_contract_csv": f"{S},{EXPORT} SELECT count(*) AS row_count, 13::BIGINT AS column_count, "
        f"sum({' + '.join(f'length({name})' for name in FACT)})::BIGINT AS text_length FROM export",
    "typed_fact_from_text": f"{S} SELECT {FACT_SELECT.replace('Quantity,', 'Quantity::BIGINT AS Quantity,')} FROM sales",
    "guarded_table_write": f"{S} SELECT 'raw_table_not_empty_use_replace' AS second_write, count(*) AS row_count FROM sales "
        "UNION ALL SELECT 'replaced', count(*) FROM sales WHERE IsCancellation",
    "ingest_with_rejects": f"{_with(ORDER_LINES, RAW, READ)} SELECT 'observed' AS outcome, '' AS reject_code, count(*) AS row_count FROM read "
        "UNION ALL SELECT CASE WHEN reject_code IS NULL THEN 'loaded' ELSE 'rejected' END, '', count(*) FROM read GROUP BY 1 "
        "UNION ALL SELECT 'rejected_as', reject_code, count(*) FROM read WHERE reject_code IS NOT NULL GROUP BY 2",
    "export_extract": f"{S},{EXPORT} SELECT * REPLACE (nullif(CustomerID, '') AS CustomerID, nullif(Description, '') AS Description) FROM export",
    "extract_fingerprint": f"{S},{EXPORT}, hashed AS (SELECT sha256("
        + " || ".join(f"length({name}) || ':' || {name}" for name in FACT)
        + ") AS h FROM export), words AS (SELECT "
        + ", ".join(f"CAST('0x' || substr(h, {start}, 13) AS BIGINT) AS w{i}" for i, start in enumerate((1, 14, 27, 40, 53)))
        + " FROM hashed) SELECT count(*) AS row_count, 13::BIGINT AS column_count, concat_ws('.', "
        + ", ".join(f"CAST(sum(w{i}) AS VARCHAR)" for i in range(5)) + ") AS digest_sum, concat_ws('.', "
        + ", ".join(f"CAST(bit_xor(w{i}) AS VARCHAR)" for i in range(5)) + ") AS digest_xor FROM words",
    "evidence_sink": f"{S}, checks(check_name, observed_value) AS (SELECT 'source_row_count', count(*) FROM sales UNION ALL "
        "SELECT 'duplicate_source_row_id', count(*) FROM (SELECT 1 FROM sales GROUP BY SourceRowId HAVING count(*) > 1) "
        "UNION ALL SELECT 'required_field_missing', count(*) FROM sales WHERE coalesce(trim(InvoiceNo), '') = '' OR coalesce(trim(Country), '') = '' "
        "OR coalesce(trim(StockCode), '') = '' OR Quantity IS NULL OR InvoiceDate IS NULL OR UnitPrice IS NULL "
        "UNION ALL SELECT 'zero_price_line', count(*) FROM sales WHERE ZeroPrice UNION ALL SELECT 'unknown_customer_line', count(*) FROM sales "
        "WHERE UnknownCustomer UNION ALL SELECT 'cancellation_prefix_mismatch', count(*) FROM sales WHERE (InvoiceNo LIKE 'C%') <> IsCancellation) "
        "SELECT * FROM checks UNION ALL SELECT 'anomaly report: ' || CASE WHEN sum(observed_value) FILTER (WHERE check_name IN "
        "('duplicate_source_row_id', 'required_field_missing', 'cancellation_prefix_mismatch')) > 0 THEN 'failed' ELSE 'passed' END, count(*) FROM checks",
    "append_sheets": f"{_with(ORDER_LINES, RAW)} SELECT SourceRowId, CASE WHEN InvoiceDate < DATE '1998-01-01' THEN 'Before 1998' "
        "ELSE 'From 1998' END AS SourceSheet, InvoiceNo, UnitPrice, CustomerID FROM raw",
    "source_row_ids": f"{_with(ORDER_LINES, RAW, READ, SHEET_ROWS)} SELECT row_id AS SourceRowId, SourceSheet, LineRef, InvoiceNo, "
        "CASE WHEN quantity_issue IS NULL THEN q::BIGINT END AS Quantity, reject_code FROM sheet_rows",
    "sheet_file_row_ids": f"{_with(ORDER_LINES, RAW, READ, SHEET_ROWS)} SELECT row_id AS SourceRowId, SourceSheet, InvoiceNo, StockCode, "
        "(length(Description) + CASE WHEN length(Description) % 4 = 0 THEN 2 ELSE 0 END)::INT AS description_length, "
        "cents / 100.0::DOUBLE AS UnitPrice, reject_code FROM sheet_rows",
    # normalisation
    "map_source_columns": f"{_with(ORDER_LINES, RAW)} SELECT * FROM raw",
    "clean_text": f"{_with(ORDER_LINES, RAW)} SELECT SourceRowId, trim(StockCode) AS StockCode, "
        "nullif(trim(Description), '') AS Description, trim(Country) AS Country FROM raw",
    "parse_quantity": f"{_with(ORDER_LINES, RAW, READ)} SELECT SourceRowId, q::DOUBLE AS quantity_read, quantity_issue FROM read",
    "parse_unit_price": f"{_with(ORDER_LINES, RAW, READ)} SELECT SourceRowId, cents / 100.0::DOUBLE AS UnitPrice, p = 0 AS ZeroPrice, "
        "price_issue FROM read",
    "canonical_customer_id": f"{_with(ORDER_LINES, RAW, READ)} SELECT SourceRowId, CustomerID FROM read",
    "parse_invoice_date": f"{_with(ORDER_LINES)} SELECT ref AS SourceRowId, CASE WHEN l_orderkey % 479 <> 0 AND l_orderkey % 467 <> 0 "
        "AND l_orderkey % 463 <> 0 THEN o_orderdate END AS parsed, CASE WHEN l_orderkey % 479 = 0 OR l_orderkey % 467 = 0 "
        "THEN 'invoice_date_invalid' WHEN l_orderkey % 463 = 0 THEN 'required_source_field_missing' END AS date_issue FROM order_lines",
    "classify_lines": f"{_with(ORDER_LINES, RAW, READ)} SELECT SourceRowId, InvoiceNo, StockCode, Description, q::BIGINT AS Quantity, InvoiceDate, "
        "cents / 100.0::DOUBLE AS UnitPrice, CustomerID, Country, upper(InvoiceNo) LIKE 'C%' AS IsCancellation, "
        "CustomerID IS NULL AS UnknownCustomer, p = 0 AS ZeroPrice FROM read WHERE reject_code IS NULL",
    "reject_code": f"{_with(ORDER_LINES, RAW, READ)} SELECT SourceRowId, reject_code FROM read",
    "standardized_fact": f"{_with(ORDER_LINES, RAW, READ)} SELECT SourceRowId, InvoiceNo, StockCode, Description, q::BIGINT AS Quantity, InvoiceDate, "
        "cents / 100.0::DOUBLE AS UnitPrice, CustomerID, Country, upper(InvoiceNo) LIKE 'C%' AS IsCancellation, "
        "CustomerID IS NULL AS UnknownCustomer, p = 0 AS ZeroPrice, q::BIGINT * cents / 100.0::DOUBLE AS LineAmount "
        "FROM read WHERE reject_code IS NULL",
    "model_fact": f"{S} SELECT {FACT_SELECT}, strftime(InvoiceDate, '%Y-%m-%d') AS InvoiceDateDate, "
        "coalesce(CustomerID, 'UNKNOWN') AS CustomerKey FROM sales",
    "year_month_key": f"{S} SELECT ym AS YearMonth, count(*) AS line_count FROM sales GROUP BY 1",
    "month_offsets": f"{S} SELECT DISTINCT ym AS YearMonth, strftime(InvoiceDate - INTERVAL 1 MONTH, '%Y-%m') AS PreviousMonth, "
        "strftime(InvoiceDate - INTERVAL 1 YEAR, '%Y-%m') AS PriorYearMonth FROM (SELECT ym, date_trunc('month', InvoiceDate) AS InvoiceDate FROM sales)",
    "decimal_text": f"{S} SELECT SourceRowId, regexp_replace(CAST(LineAmount AS VARCHAR), '(\\.\\d\\d\\d*?)0*$', '\\1') AS amount_text, "
        "regexp_replace(CAST(CAST(LineAmount * CAST(0.125 AS DECIMAL(3,3)) AS DECIMAL(24,6)) AS VARCHAR), '(\\.\\d\\d\\d*?)0*$', '\\1') AS eighth_text, "
        "CASE WHEN CustomerID IS NULL THEN '0.00' ELSE regexp_replace(CAST(UnitPrice AS VARCHAR), '(\\.\\d\\d\\d*?)0*$', '\\1') END AS price_text FROM sales",
    "format_measure": f"{S},{SLICES} SELECT slice_id, slice_value, "
        + ", ".join([_money(n) for n in ("gross_sales", "cancelled_sales", "net_sales", "average_order_value")]
                    + [_count(n) for n in ("order_count", "units_sold", "active_customers")]
                    + [_percent(n) for n in ("cancellation_rate", "sales_mom_pct", "sales_yoy_pct")]) + " FROM slices",
    # filters and slices
    "completed_lines": f"{S} SELECT SourceRowId, InvoiceNo, LineAmount::DOUBLE AS LineAmount FROM sales WHERE sold",
    "cancelled_lines": f"{S} SELECT SourceRowId, InvoiceNo, LineAmount::DOUBLE AS LineAmount FROM sales WHERE IsCancellation",
    "slice_metrics_country": f"{S} SELECT {MEASURES}, NULL::DOUBLE AS sales_mom_pct, NULL::DOUBLE AS sales_yoy_pct FROM sales WHERE Country = 'NATION_2'",
    "slice_metrics_month": MONTH_SLICE,
    "slicer_filter": f"{S} SELECT SourceRowId, InvoiceDate, Country, LineAmount::DOUBLE AS LineAmount FROM sales "
        f"WHERE ym IN ('1996-11', '1997-02', '1998-07') AND Country IN {NATION}",
    "slicer_values": f"{S} SELECT DISTINCT 'YearMonth' AS field, ym AS member FROM sales UNION ALL SELECT DISTINCT 'Country', Country FROM sales "
        "UNION ALL SELECT DISTINCT 'StockCode', StockCode FROM sales UNION ALL SELECT DISTINCT 'CustomerID', CustomerID FROM sales",
    "cross_filter": f"{S} SELECT ym AS YearMonth, sum(LineAmount)::DOUBLE AS net_sales FROM sales WHERE CustomerID IS NULL "
        "AND Country IN ('NATION_2', 'NATION_7', 'NATION_11') GROUP BY 1",
    # joins and security
    "star_denormalize": f"{S}, products AS (SELECT StockCode, max(Description) AS d FROM sales GROUP BY 1) "
        "SELECT SourceRowId, year(InvoiceDate)::INT AS Year, month(InvoiceDate)::INT AS MonthNumber, monthname(InvoiceDate) AS MonthName, "
        "ym AS YearMonth, d AS ProductDescription, coalesce(CustomerID, 'UNKNOWN') AS CustomerKey, UnknownCustomer AS IsUnknownCustomer, "
        "Country, true AS CountryKnown, LineAmount::DOUBLE AS LineAmount FROM sales JOIN products USING (StockCode)",
    "rls_visible_countries": f"{S},{BRIDGE} SELECT DISTINCT Country FROM sales WHERE Country IN {MINE}",
    "rls_fact": f"{S},{BRIDGE} SELECT SourceRowId, Country, LineAmount::DOUBLE AS LineAmount FROM sales WHERE Country IN {MINE}",
    "rls_scope_summary": f"{S},{BRIDGE} SELECT UserPrincipalName, visible_country_count, visible_countries, net_sales::DOUBLE AS net_sales "
        "FROM users LEFT JOIN scope USING (UserPrincipalName)",
    "referential_integrity": f"{S} SELECT 'DimDate' AS relationship, count(DISTINCT CAST(InvoiceDate AS DATE)) AS orphan_keys, count(*) AS orphan_lines "
        "FROM sales WHERE month(InvoiceDate) = 2 UNION ALL SELECT 'DimProduct', count(DISTINCT StockCode), count(*) FROM sales "
        "WHERE CAST(StockCode AS BIGINT) % 10 = 3 UNION ALL SELECT 'DimCustomer', 1, count(*) FROM sales WHERE CustomerID IS NULL",
    "key_uniqueness": f"{S} SELECT 'DimProduct' AS dimension, count(DISTINCT StockCode) AS duplicate_keys, 0::BIGINT AS null_keys FROM sales "
        "WHERE CAST(StockCode AS BIGINT) % 10 = 3 UNION ALL SELECT 'DimCustomer', 0, 1",
    # measures
    "metric_gross_sales": f"{S} SELECT sum(LineAmount)::DOUBLE AS gross_sales FROM sales WHERE sold",
    "metric_cancelled_sales": f"{SM} SELECT sum(abs(LineAmount))::DOUBLE AS cancelled_sales FROM sales WHERE IsCancellation",
    "metric_net_sales": f"{SM} SELECT sum(LineAmount)::DOUBLE AS net_sales FROM sales",
    "metric_units_sold": f"{S} SELECT sum(Quantity)::BIGINT AS units_sold FROM sales WHERE sold",
    "metric_order_count": f"{S} SELECT count(DISTINCT InvoiceNo) AS order_count FROM sales WHERE sold",
    "metric_active_customers": f"{S} SELECT count(DISTINCT CustomerID) AS active_customers FROM sales WHERE sold AND trim(CustomerID) <> ''",
    "metric_cancelled_invoices": f"{S} SELECT count(DISTINCT InvoiceNo) AS cancelled_invoice_count FROM sales WHERE IsCancellation",
    "metric_all_invoices": f"{S} SELECT count(DISTINCT nullif(trim(InvoiceNo), '')) AS all_invoice_count FROM sales",
    "metric_average_order_value": f"{S} SELECT Country, coalesce(sum(LineAmount) FILTER (WHERE sold), 0)::DOUBLE "
        "/ nullif(count(DISTINCT InvoiceNo) FILTER (WHERE sold), 0)::DOUBLE AS average_order_value FROM sales GROUP BY 1",
    "metric_cancellation_rate": f"{S} SELECT Country, count(DISTINCT InvoiceNo) FILTER (WHERE IsCancellation)::DOUBLE "
        "/ count(DISTINCT InvoiceNo)::DOUBLE AS cancellation_rate FROM sales GROUP BY 1",
    "base_metrics_all": f"{S} SELECT {MEASURES} FROM sales",
    "base_metrics_mixed_signs": f"{SM} SELECT {MEASURES} FROM sales",
    "metrics_all_slices": f"{S},{SLICES} SELECT * FROM slices",
    "country_baseline": f"{S} SELECT Country, {MEASURES} FROM sales GROUP BY Country",
    "aux_metrics": f"{S} SELECT sum(LineAmount) FILTER (WHERE CustomerID IS NULL)::DOUBLE AS unknown_customer_sales, "
        "count(DISTINCT StockCode) AS product_count, count(DISTINCT Country) AS country_count FROM sales",
    "contract_metrics": f"{METRIC_VALUES} SELECT metric_id, actual, issue FROM metric_values",
    "metric_snapshot_check": f"{METRIC_VALUES},{EXPECTED} SELECT metric_id, actual, "
        "CASE WHEN abs(actual - expected) <= tolerance THEN 'passed' WHEN actual IS NOT NULL THEN 'failed' END AS status, "
        "coalesce(issue, CASE WHEN abs(actual - expected) > tolerance THEN 'metric_mismatch' END) AS issue "
        "FROM metric_values JOIN expected USING (metric_id)",
    "dim_date": f"{S} SELECT DISTINCT strftime(InvoiceDate, '%Y-%m-%d') AS Date, year(InvoiceDate)::INT AS Year, "
        "month(InvoiceDate)::INT AS MonthNumber, monthname(InvoiceDate) AS MonthName, ym AS YearMonth FROM sales",
    "dim_product": f"{S} SELECT StockCode, max(Description) AS Description FROM sales GROUP BY 1",
    "dim_customer": f"{S} SELECT coalesce(CustomerID, 'UNKNOWN') AS CustomerKey, max(CustomerID) AS CustomerID, "
        "bool_or(UnknownCustomer) AS IsUnknownCustomer FROM sales GROUP BY 1",
    "dim_country": f"{S} SELECT DISTINCT Country FROM sales",
    "table_profile": f"{_with(ORDER_LINES, RAW)} " + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{'timestamp_ntz' if name == 'InvoiceDate' else 'string'}' AS data_type, count(*) AS row_count, "
        f"count(*) - count({source}) AS null_count, count(DISTINCT {source}) AS distinct_count, "
        f"min(length({source}))::INT AS min_length, max(length({source}))::INT AS max_length FROM raw"
        for name, source in PROFILE_COLUMNS.items()),
    # time comparison
    "sales_mom_pct": f"{S},{GAP} SELECT a.ym AS YearMonth, a.net::DOUBLE AS net_sales, "
        "(a.net - b.net)::DOUBLE / nullif(b.net, 0)::DOUBLE AS sales_mom_pct FROM gap_months a LEFT JOIN gap_months b "
        "ON b.ym = strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')",
    "sales_yoy_pct": f"{S},{GAP}, by_country AS (SELECT Country, ym, sum(LineAmount) AS net FROM gap GROUP BY ALL) "
        "SELECT a.Country, a.ym AS YearMonth, a.net::DOUBLE AS net_sales, "
        "(a.net - b.net)::DOUBLE / nullif(b.net, 0)::DOUBLE AS sales_yoy_pct FROM by_country a LEFT JOIN by_country b "
        "ON b.Country = a.Country AND b.ym = strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 1 YEAR, '%Y-%m')",
    "period_net_sales": f"{S} SELECT coalesce(sum(LineAmount), 0)::DOUBLE AS net_sales FROM sales WHERE ym = '1996-11' AND Country = 'NATION_2'",
    "single_period_policy": f"""{S},{GAP}, n AS (SELECT max(net) FILTER (WHERE ym = '1997-03') AS mar, max(net) FILTER (WHERE ym = '1997-04') AS apr,
  max(net) FILTER (WHERE ym = '1997-02') AS feb, max(net) FILTER (WHERE ym = '1996-03') AS mar96,
  max(net) FILTER (WHERE ym = '1996-06') AS jun, max(net) FILTER (WHERE ym = '1995-06') AS jun95 FROM gap_months)
SELECT 1::BIGINT AS months_in_scope, mar::DOUBLE AS net_sales, (mar - feb)::DOUBLE / feb::DOUBLE AS sales_mom_pct,
  (mar - mar96)::DOUBLE / mar96::DOUBLE AS sales_yoy_pct, 'one month' AS scope FROM n
UNION ALL SELECT 2, (mar + apr)::DOUBLE, NULL, NULL, 'two months' FROM n
UNION ALL SELECT 1, jun::DOUBLE, NULL, (jun - jun95)::DOUBLE / jun95::DOUBLE, 'after the gap' FROM n
UNION ALL SELECT 0, NULL, NULL, NULL, 'absent month'""",
    # ranked lists and pages
    "monthly_net_sales": f"{S} SELECT ym AS YearMonth, sum(LineAmount)::DOUBLE AS net_sales FROM sales GROUP BY 1",
    "net_sales_by_country": _ranked("Country"),
    "net_sales_by_product": _ranked("StockCode"),
    "net_sales_by_customer": _ranked("CustomerID"),
    "top_n_members": f"{S} {_top('DESC', 'top')} UNION ALL {_top('ASC', 'bottom')}",
    "page_cards": f"""{S}, c_E AS (SELECT {MEASURES} FROM sales WHERE Country IN {NATION}),
c_P AS (SELECT m.*, (cur - prev)::DOUBLE / nullif(prev, 0)::DOUBLE AS sales_mom_pct, (cur - old)::DOUBLE / nullif(old, 0)::DOUBLE AS sales_yoy_pct
  FROM (SELECT {MEASURES} FROM sales WHERE Country = 'NATION_2' AND ym = '1996-11') m,
  (SELECT coalesce(sum(LineAmount) FILTER (WHERE ym = '1996-11'), 0) AS cur, coalesce(sum(LineAmount) FILTER (WHERE ym = '1996-10'), 0) AS prev,
   coalesce(sum(LineAmount) FILTER (WHERE ym = '1995-11'), 0) AS old FROM sales WHERE Country = 'NATION_2') p),
c_C AS (SELECT {MEASURES} FROM sales WHERE ym IN ('1996-11', '1996-12')) """
        + " UNION ALL ".join([
            _cards("Executive Overview", ("net_sales", "order_count", "units_sold", "active_customers", "average_order_value", "cancellation_rate")),
            _cards("Product & Trend Analysis", ("net_sales", "units_sold", "cancelled_sales", "sales_mom_pct", "sales_yoy_pct")),
            _cards("Customer & Country Analysis", ("net_sales", "order_count", "active_customers", "average_order_value", "cancelled_sales", "cancellation_rate")),
        ]),
    "product_cancellation_matrix": f"{S} SELECT StockCode, sum(LineAmount)::DOUBLE AS net_sales, "
        "coalesce(sum(abs(LineAmount)) FILTER (WHERE IsCancellation), 0)::DOUBLE AS cancelled_sales, "
        "count(*) FILTER (WHERE IsCancellation) AS cancelled_lines FROM sales GROUP BY 1",
    "schema_sample": f"{_with(ORDER_LINES, RAW)} SELECT SourceRowId, InvoiceNo AS Invoice, StockCode, Description, Quantity, InvoiceDate, "
        "UnitPrice AS Price, CustomerID AS \"Customer ID\", Country FROM raw ORDER BY SourceRowId LIMIT 100",
    # data quality
    "dq_null_not_allowed": _only("null_not_allowed"),
    "dq_invalid_type": _only("invalid_type"),
    "dq_not_allowed": _only("not_allowed"),
    "dq_range": _only("below_minimum", "above_maximum"),
    "dq_formula_mismatch": _only("formula_mismatch"),
    "dq_formula_error": _only("formula_evaluation_error"),
    "dq_duplicate_primary_key": _only("duplicate_primary_key"),
    "dq_duplicate_unique_value": _only("duplicate_unique_value"),
    "dq_missing_required_column": "SELECT 'missing_required_column' AS code, scope FROM (VALUES ('Country'), ('Channel')) AS t(scope)",
    "dq_file_issue_list": f"{ISSUES}, numbered AS (SELECT LineRef, row_number() OVER (ORDER BY LineRef) + 1 AS n FROM text_rows) "
        "SELECT code, scope, n AS row FROM issues LEFT JOIN numbered ON LineRef = row",
    "csv_read_errors": f"{TEXT}, numbered AS (SELECT CAST(StockCode AS INT) AS p, row_number() OVER (ORDER BY LineRef) + 1 AS n FROM text_rows) "
        "SELECT 'ragged_row' AS code, n AS row, CASE WHEN p % 71 = 0 THEN 'too_many_cells' ELSE 'too_few_cells' END AS problem FROM numbered WHERE p % 71 = 0 OR p % 73 = 0",
    "dq_long_numbers": f"{_with(ORDER_LINES, LONG_NUMBERS)} SELECT 'above_maximum' AS code, 'Serial' AS scope, LineRef AS row FROM long_numbers "
        "WHERE k % 2 = 1 AND (k > 3000 OR (k = 3000 AND p > 0)) UNION ALL SELECT 'below_minimum', 'Serial', LineRef FROM long_numbers "
        "WHERE k % 2 = 0 AND (k > 3000 OR (k = 3000 AND p > 0)) UNION ALL SELECT 'below_minimum', 'Share', LineRef FROM long_numbers WHERE p % 30 < 10 "
        "UNION ALL SELECT 'formula_mismatch', 'amount', LineRef FROM long_numbers WHERE k % 17 = 0 "
        "UNION ALL SELECT 'formula_evaluation_error', 'no_value', LineRef FROM long_numbers",
    "dq_row_count_bounds": "SELECT 'above_maximum_rows' AS code, 'expectations.max_rows' AS scope FROM (SELECT count(*) AS n FROM lineitem) "
        "WHERE n > 5000 UNION ALL SELECT 'below_minimum_rows', 'expectations.min_rows'",
    "dq_issue_list": f"{ISSUES} SELECT code, scope, row FROM issues",
    "dq_issue_counts": f"{ISSUES} SELECT code, scope, count(*) AS issue_count FROM issues GROUP BY ALL",
    "dq_summary": f"{ISSUES} SELECT 'failed' AS status, (SELECT count(*) FROM text_rows) AS row_count, 13::BIGINT AS column_count, "
        "count(*) AS issue_count FROM issues",
    "anomaly_report": f"{S} SELECT 'source_row_count' AS check_name, count(*) AS observed_value FROM sales UNION ALL "
        "SELECT 'duplicate_source_row_id', count(*) FROM (SELECT 1 FROM order_lines GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) "
        "UNION ALL SELECT 'required_field_missing', count(*) FROM sales WHERE coalesce(trim(InvoiceNo), '') = '' OR coalesce(trim(Country), '') = '' "
        "OR coalesce(trim(StockCode), '') = '' OR Quantity IS NULL OR InvoiceDate IS NULL OR UnitPrice IS NULL "
        "UNION ALL SELECT 'zero_price_line', count(*) FROM sales WHERE ZeroPrice UNION ALL SELECT 'unknown_customer_line', count(*) FROM sales "
        "WHERE UnknownCustomer UNION ALL SELECT 'cancellation_prefix_mismatch', count(*) FROM sales WHERE (InvoiceNo LIKE 'C%') <> IsCancellation",
    "cancellation_prefix_mismatch": f"{S} SELECT SourceRowId, InvoiceNo, IsCancellation AND Quantity < -3 AS IsCancellation FROM sales "
        "WHERE InvoiceNo LIKE 'C%' AND Quantity >= -3",
    "negative_quantity_mismatch": f"{SM} SELECT SourceRowId, Quantity, IsCancellation FROM sales WHERE (Quantity < 0) <> IsCancellation",
    "repeated_source_rows": f"{S} SELECT StockCode, Quantity, UnitPrice::DOUBLE AS UnitPrice, CustomerID, Country, count(*) AS copies FROM sales "
        "GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1",
    "product_display": f"{TEXT} SELECT StockCode, coalesce(nullif(trim(max(Description)), ''), 'Unknown Product Description') AS ProductDisplay FROM text_rows GROUP BY 1",
    "description_length_guard": f"{S} SELECT count(*) AS row_count, max(length(Description))::INT AS max_length, "
        "max(length(Description)) <= 512 AS passed FROM sales",
    "date_range_guard": f"{S} SELECT SourceRowId, InvoiceDate FROM sales WHERE CAST(InvoiceDate AS DATE) < DATE '1995-03-01' "
        "OR CAST(InvoiceDate AS DATE) > DATE '2001-06-30'",
    # reconciliation
    "reconcile_join": f"{S},{EXACT_SLICES},{LONG},{COMPARED} SELECT slice_id, slice_value, metric_id, true AS in_left, in_right, "
        "v::DOUBLE AS left_value, w::DOUBLE AS right_value FROM compared",
    "reconcile_metrics": f"{S},{EXACT_SLICES},{LONG},{COMPARED} SELECT slice_id, slice_value, metric_id, difference::DOUBLE AS difference, "
        f"tolerance::DOUBLE AS tolerance, {_status('tolerance')} AS status FROM compared",
    "reconcile_slices": f"{S},{EXACT_SLICES},{LONG},{COMPARED}, judged AS (SELECT *, {_status('tolerance')} IN ('passed', 'both-null') AS good FROM compared) "
        "SELECT slice_id, slice_value, count(*) AS metric_count, count(*) FILTER (WHERE NOT good) AS failed_count, "
        "CASE WHEN bool_and(good) THEN 'passed' ELSE 'failed' END AS status FROM judged GROUP BY 1, 2",
    "reconciliation_gate": f"{S},{EXACT_SLICES},{LONG},{COMPARED}, bad AS (SELECT slice_id, slice_value, metric_id FROM compared "
        f"WHERE {_status('tolerance')} NOT IN ('passed', 'both-null')) "
        "SELECT slice_id, slice_value, metric_id, 'baseline_metric_failed' AS code FROM bad "
        "UNION ALL SELECT slice_id, slice_value, 'profit', 'baseline_metric_failed' FROM slices "
        "UNION ALL SELECT DISTINCT slice_id, slice_value, NULL, 'baseline_slice_failed' FROM bad "
        "UNION ALL SELECT NULL, NULL, NULL, 'baseline_reconciliation_failed' WHERE EXISTS (SELECT 1 FROM bad)",
    "measure_vs_baseline": f"{S},{EXACT_SLICES},{LONG},{COMPARED} SELECT slice_id, slice_value, metric_id, difference::DOUBLE AS difference, "
        f"{_status('0.0001')} AS status FROM compared",
    "rls_scenario_check": f"{S},{BRIDGE}, base AS (SELECT Country, sum(LineAmount) AS net FROM sales GROUP BY 1) "
        "SELECT UserPrincipalName, expected_country, visible_country_count, visible_countries, net::DOUBLE AS expected_net_sales, "
        "net_sales::DOUBLE AS net_sales, CASE WHEN expected_country IS NULL THEN visible_country_count IS NULL ELSE "
        "visible_country_count = 1 AND visible_countries = expected_country AND abs(net_sales - net) < 0.01 END AS passed "
        "FROM (SELECT UserPrincipalName, CASE WHEN UserPrincipalName LIKE 'manager.a%' THEN 'NATION_2' WHEN UserPrincipalName LIKE 'manager.b%' "
        "THEN 'NATION_7' END AS expected_country FROM users) u LEFT JOIN base ON Country = expected_country LEFT JOIN scope USING (UserPrincipalName)",
}
