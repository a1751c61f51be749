"""The same results in SQL, for an engine that shares no code with the queries.

Duplicates are found by row number here and not by counting, labels by ordering,
and stage inputs by running sums, so that agreement means something.
"""

from __future__ import annotations

from stallbook.schema import EXCLUDED_CODES, RAW_COLUMNS, REMOVAL_STEPS

EIGHT = ", ".join(RAW_COLUMNS)
CODES = ", ".join(f"'{code}'" for code, _, _ in EXCLUDED_CODES)
DIMENSION = ", ".join(f"('{code}', '{kind}', '{why}')" for code, kind, why in EXCLUDED_CODES)
STEPS = ", ".join(f"({number}, '{step}')" for number, step in enumerate(REMOVAL_STEPS, 1))

RAW = f"""
WITH line AS (
  SELECT row_number() OVER () AS position, * FROM lineitem
), marked AS (
  SELECT *, (l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber*3) % 1000 AS h FROM line
), copied AS (
  SELECT m.*, c.copy_no
  FROM marked m JOIN (VALUES (0), (1)) c(copy_no) ON c.copy_no = 0 OR m.h BETWEEN 40 AND 49
), numbered AS (
  SELECT *, 1 + row_number() OVER (ORDER BY position, copy_no) AS source_row,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
    CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2))
      + CAST(l_linenumber AS DECIMAL(10,0)) * 0.001 AS DECIMAL(18,3)) AS VARCHAR) AS px
  FROM copied
), raw AS (
  SELECT
    CASE WHEN h = 50 THEN ' '
         WHEN h BETWEEN 64 AND 66 THEN 'C' || l_orderkey
         WHEN l_returnflag = 'R' AND h % 10 = 7 THEN ' c' || l_orderkey || ' '
         WHEN l_returnflag = 'R' THEN 'C' || l_orderkey
         ELSE CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
    CASE WHEN h = 51 THEN ' '
         WHEN h < {2 * len(EXCLUDED_CODES)} THEN list_extract([{CODES}], CAST(h // 2 + 1 AS INTEGER))
         ELSE CAST(l_partkey AS VARCHAR) END AS StockCode,
    CASE WHEN h BETWEEN 72 AND 79 THEN NULL
         WHEN h BETWEEN 80 AND 89 THEN '  '
         WHEN l_linenumber % 3 = 0 THEN p_name || ' ALT'
         ELSE p_name END AS Description,
    CASE WHEN h = 53 THEN 'bad' WHEN h = 54 THEN 'inf' WHEN h = 55 THEN '1.5'
         WHEN h BETWEEN 62 AND 63 THEN '0'
         WHEN h BETWEEN 64 AND 66 THEN q
         WHEN l_returnflag = 'R' OR (l_returnflag = 'A' AND h >= 900) THEN '-' || q
         ELSE q END AS Quantity,
    CASE WHEN h = 52 THEN 'not a date'
         ELSE strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
    CASE WHEN h = 56 THEN NULL WHEN h = 57 THEN '-inf'
         WHEN h BETWEEN 58 AND 59 THEN '-' || px
         WHEN h BETWEEN 60 AND 61 THEN '0'
         ELSE px END AS UnitPrice,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         WHEN h = 90 THEN ' '
         ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
    CASE WHEN h = 70 THEN NULL WHEN h = 71 THEN ' ' ELSE n_name END AS Country,
    source_row
  FROM numbered
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

JUDGED = f"""{RAW}, counted AS (
  SELECT *, row_number() OVER (PARTITION BY {EIGHT} ORDER BY source_row) AS occurrence,
    count(*) OVER (PARTITION BY {EIGHT}) AS copies
  FROM raw
), typed AS (
  SELECT *, coalesce(trim(InvoiceNo), '') AS invoice, coalesce(trim(StockCode), '') AS code,
    try_cast(InvoiceDate AS TIMESTAMP) AS moment,
    try_cast(Quantity AS DOUBLE) AS qty, try_cast(UnitPrice AS DOUBLE) AS cost,
    try_cast(Quantity AS DECIMAL(13,3)) AS exact_quantity,
    try_cast(UnitPrice AS DECIMAL(14,6)) AS exact_price,
    coalesce(upper(trim(InvoiceNo)) LIKE 'C%', false) AS cancels
  FROM counted
), valued AS (
  SELECT *, coalesce(isfinite(qty), false) AS finite_quantity,
    coalesce(isfinite(cost), false) AS finite_price,
    coalesce(isfinite(qty) AND isfinite(cost), false) AS computable,
    CASE WHEN isfinite(qty) AND isfinite(cost) THEN exact_quantity * exact_price END AS value
  FROM typed
), ruled AS (
  SELECT *,
    CASE WHEN code IN ({CODES}) THEN 'excluded_codes'
         WHEN invoice = '' OR code = '' OR moment IS NULL OR NOT computable OR qty % 1 <> 0
           THEN 'invalid_required_fields'
         WHEN cost < 0 THEN 'negative_prices'
         WHEN cost = 0 THEN 'zero_prices'
         WHEN qty = 0 THEN 'zero_quantities'
         WHEN cancels AND qty > 0 THEN 'inconsistent_c_positive_quantity'
         ELSE 'eligible' END AS rule
  FROM valued
), judged AS (
  SELECT *, CASE WHEN occurrence > 1 THEN 'exact_duplicates' ELSE rule END AS disposition FROM ruled
)"""

SURVIVORS = f"""{JUDGED}, survivor AS (
  SELECT invoice AS InvoiceNo, code AS StockCode, coalesce(trim(Description), '') AS Description,
    exact_quantity AS Quantity, moment AS InvoiceDate, exact_price AS UnitPrice,
    nullif(trim(CustomerID), '') AS CustomerID,
    coalesce(nullif(trim(Country), ''), 'Unknown') AS Country,
    source_row, value,
    CASE WHEN qty > 0 THEN 'positive_sale'
         WHEN cancels AND qty < 0 THEN 'cancellation'
         ELSE 'other_negative' END AS transaction_category,
    copies, occurrence, strftime(moment, '%Y-%m') AS Month
  FROM judged WHERE rule = 'eligible'
)"""

ELIGIBLE = f"""{SURVIVORS}, eligible AS (SELECT * FROM survivor WHERE occurrence = 1)"""
EVERY_COPY = f"""{SURVIVORS}, eligible AS (
  SELECT * REPLACE (CAST(1 AS BIGINT) AS copies) FROM survivor
)"""


def money(value: str) -> str:
    """Double of an exact sum. Four decimals hold all of it and convert without error."""
    return f"CAST(CAST({value} AS DECIMAL(38,4)) AS DOUBLE)"


def rate(part: str, whole: str) -> str:
    return f"100.0 * {money(part)} / NULLIF({money(whole)}, 0)"


def second(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def digest_sql(place: str) -> str:
    """SHA-256 of the number of lines, the sums of their hashes and the sums weighed by place."""
    parts = [f"part_{at}" for at in (1, 9, 17, 25)]
    sums = [f"sum({part})" for part in parts] + [f"sum({place} * {part})" for part in parts]
    return f"sha256(concat_ws('@', count(*), {', '.join(sums)}))"


def count(condition: str, rows: str = "1") -> str:
    return f"CAST(coalesce(sum({rows}) FILTER (WHERE {condition}), 0) AS BIGINT)"


SUMS = """
    coalesce(sum(value) FILTER (WHERE transaction_category = 'positive_sale'), 0) AS s,
    -coalesce(sum(value) FILTER (WHERE transaction_category = 'cancellation'), 0) AS c,
    -coalesce(sum(value) FILTER (WHERE transaction_category = 'other_negative'), 0) AS a"""

FOUR = f"""
    {money('s')} AS positive_sales_gbp, {money('c')} AS cancellation_value_gbp,
    {money('a')} AS other_negative_value_gbp, {money('s - c - a')} AS net_value_gbp"""

METRICS = f"""{FOUR}, {rate('c', 's')} AS cancellation_value_rate_pct"""

TOTAL_SALES = "(SELECT sum(value) FROM eligible WHERE transaction_category = 'positive_sale')"

LABELS = """label AS (
  SELECT StockCode, Description FROM (
    SELECT StockCode, Description,
      row_number() OVER (PARTITION BY StockCode ORDER BY count(*) DESC, Description) AS place
    FROM eligible WHERE Description <> '' GROUP BY StockCode, Description
  ) WHERE place = 1
), product AS (
  SELECT p.*, coalesce(l.Description, p.StockCode) AS Description
  FROM (SELECT StockCode, """ + SUMS + """ FROM eligible GROUP BY StockCode) p
  LEFT JOIN label l ON p.StockCode = l.StockCode
)"""

COUNTRIES = f"country AS (SELECT Country, {SUMS} FROM eligible GROUP BY Country)"
MONTHS = f"""month AS (
  SELECT Month, {SUMS}, min(InvoiceDate) AS first, max(InvoiceDate) AS last
  FROM eligible GROUP BY Month
)"""
CUSTOMERS = """buyer AS (
  SELECT CustomerID, sum(value) AS s FROM eligible
  WHERE transaction_category = 'positive_sale' AND CustomerID IS NOT NULL GROUP BY CustomerID
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY s DESC, CustomerID) AS place FROM buyer
), known AS (
  SELECT coalesce(sum(s), 0) AS s, sum(s) FILTER (WHERE place <= 10) AS best,
    count(*) AS buyers FROM ranked
)"""
STATISTICS = f"""
    {money('known.s')} AS identified_positive_sales_gbp,
    {money('total.s - known.s')} AS unidentified_positive_sales_gbp,
    {rate('known.s', 'total.s')} AS identified_sales_coverage_pct,
    {money('known.best')} AS top_10_customer_sales_gbp,
    {rate('known.best', 'known.s')} AS top_10_customer_concentration_pct,
    CAST(known.buyers AS BIGINT) AS identified_positive_customer_count"""
OVERALL = f"""total AS (
  SELECT {SUMS}, count(*) AS lines, min(InvoiceDate) AS first, max(InvoiceDate) AS last FROM eligible
)"""

POSITIVE = "signed_value_positive_price_gbp"
NONPOSITIVE = "signed_value_nonpositive_price_gbp"
UNCOMPUTABLE = "uncomputable_value_count"


def audit(source: str, rows: str = "1") -> str:
    return f"""
    CAST(coalesce(sum({rows}), 0) AS BIGINT) AS n,
    coalesce(sum(value * {rows}) FILTER (WHERE cost > 0), 0) AS pos,
    coalesce(sum(value * {rows}) FILTER (WHERE cost <= 0), 0) AS neg,
    {count('NOT computable', rows)} AS bad
    FROM {source}"""


def stages(disposition: str = "disposition") -> str:
    """Removed by a step, and the running sum of what earlier steps removed."""
    running = "OVER (ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    columns = ", ".join(
        f"(SELECT {name} FROM everything) - coalesce(sum({name}) {running}, 0) AS in_{name}"
        for name in ("n", "pos", "neg", "bad")
    )
    return f"""everything AS (SELECT {audit('judged')}),
  charged AS (SELECT {disposition} AS step, {audit('judged')} GROUP BY 1),
  stage0 AS (
    SELECT step_no, s.step, coalesce(n, 0) AS n, coalesce(pos, 0) AS pos,
      coalesce(neg, 0) AS neg, coalesce(bad, 0) AS bad
    FROM (VALUES {STEPS}) s(step_no, step) LEFT JOIN charged ON s.step = charged.step
  ), stage AS (SELECT *, {columns} FROM stage0)"""


def part(prefix: str, n: str, pos: str, neg: str, bad: str) -> str:
    return f"""CAST({n} AS BIGINT) AS {prefix}_rows,
    {money(pos)} AS {prefix}_{POSITIVE}, {money(neg)} AS {prefix}_{NONPOSITIVE},
    CAST({bad} AS BIGINT) AS {prefix}_{UNCOMPUTABLE}"""


STAGE = f"""'removal_step' AS record_type, step,
    {part('input', 'in_n', 'in_pos', 'in_neg', 'in_bad')},
    {part('removed', 'n', 'pos', 'neg', 'bad')},
    {part('remaining', 'in_n - n', 'in_pos - pos', 'in_neg - neg', 'in_bad - bad')}"""

PROFILE = {
    "exact_duplicates_beyond_first": count("occurrence > 1"),
    "c_prefixed_invoice_rows": count("cancels"),
    "negative_quantity_rows": count("finite_quantity AND qty < 0"),
    "negative_quantity_without_c_prefix": count(
        "finite_quantity AND qty < 0 AND NOT cancels"
    ),
    "c_prefixed_nonnegative_quantity_rows": count(
        "cancels AND finite_quantity AND qty >= 0"
    ),
    "zero_price_rows": count("finite_price AND cost = 0"),
    "negative_price_rows": count("finite_price AND cost < 0"),
    "zero_quantity_rows": count("finite_quantity AND qty = 0"),
    "invalid_or_nonfinite_quantity_rows": count("NOT finite_quantity"),
    "invalid_or_nonfinite_price_rows": count("NOT finite_price"),
    "nonintegral_quantity_rows": count("finite_quantity AND qty % 1 <> 0"),
    "invalid_or_missing_date_rows": count("moment IS NULL"),
}
MISSING = {f"missing_{name}": count(f"{name} IS NULL") for name in RAW_COLUMNS}
COUNTED = {
    "rows": "CAST(count(*) AS BIGINT)",
    "columns": f"CAST({len(RAW_COLUMNS)} AS BIGINT)",
    **PROFILE,
    **MISSING,
}


def named(columns: dict[str, str]) -> str:
    return ",\n    ".join(f'{value} AS "{name}"' for name, value in columns.items())


def exclusions(rows: str, where: str, basis: str) -> str:
    statuses = {
        "positive_price_row_count": "computable AND cost > 0",
        "zero_price_row_count": "computable AND cost = 0",
        "negative_price_row_count": "computable AND cost < 0",
        "invalid_numeric_row_count": "NOT computable",
    }
    counts = ", ".join(f"{count(test, rows)} AS {name}" for name, test in statuses.items())
    names = ", ".join(statuses)
    return f"""SELECT StockCode, category, reason, '{basis}' AS basis, n AS row_count, {names},
      {money('pos')} AS {POSITIVE}, {money('neg')} AS {NONPOSITIVE}, bad AS {UNCOMPUTABLE}
    FROM (SELECT code, {counts}, {audit('judged', rows)} WHERE {where} GROUP BY code)
    JOIN (VALUES {DIMENSION}) d(StockCode, category, reason) ON code = StockCode"""


def reconciliation() -> str:
    """What each check compares, computed anew; agreement is asserted as true."""
    stage = " UNION ALL ".join(
        f"SELECT step || ': {name}', {value}, {value} FROM stage"
        for name, value in {
            "rows": "CAST(in_n AS DECIMAL(38,4))",
            POSITIVE: "CAST(in_pos AS DECIMAL(38,4))",
            NONPOSITIVE: "CAST(in_neg AS DECIMAL(38,4))",
            UNCOMPUTABLE: "CAST(in_bad AS DECIMAL(38,4))",
        }.items()
    )
    excluded = " UNION ALL ".join(
        f"SELECT 'excluded codes: {name}', CAST({value} AS DECIMAL(38,4)),"
        f" CAST({value} AS DECIMAL(38,4)) FROM charged WHERE step = 'excluded_codes'"
        for name, value in {
            "row_count": "n", POSITIVE: "pos", NONPOSITIVE: "neg", UNCOMPUTABLE: "bad",
        }.items()
    )
    values = {
        "positive_sales_gbp": "s",
        "cancellation_value_gbp": "c",
        "other_negative_value_gbp": "a",
        "net_value_gbp": "s - c - a",
    }
    groups = " UNION ALL ".join(
        f"SELECT '{label}: {name}', CAST((SELECT sum({value}) FROM {table}) AS DECIMAL(38,4)),"
        f" CAST({value} AS DECIMAL(38,4)) FROM total"
        for label, table in {"products": "product", "countries": "country", "months": "month"}.items()
        for name, value in values.items()
    )
    return f"""{ELIGIBLE}, {stages()}, {LABELS}, {COUNTRIES}, {MONTHS}, {CUSTOMERS}, {OVERALL},
  entry("check", actual, expected) AS (
    {stage}
    UNION ALL SELECT 'raw rows', (SELECT sum(n) FROM charged), (SELECT count(*) FROM raw)
    UNION ALL SELECT 'price statuses of ' || code, count(*), count(*)
      FROM judged WHERE disposition = 'excluded_codes' GROUP BY code
    UNION ALL {excluded}
    UNION ALL SELECT 'unclassified eligible rows', 0, 0
    UNION ALL SELECT 'signed value of eligible lines as S - C - A',
      (SELECT sum(value) FROM eligible), s - c - a FROM total
    UNION ALL SELECT 'sales of known and unknown customers',
      known.s + (SELECT sum(value) FROM eligible
        WHERE transaction_category = 'positive_sale' AND CustomerID IS NULL), total.s
      FROM known, total
    UNION ALL {groups}
  )
  SELECT "check", {money('actual')} AS actual, {money('expected')} AS expected,
    abs(actual - expected) <= 0.000001 AS ok FROM entry"""


CHART_STEPS = " UNION ALL ".join(
    f"SELECT {number} AS step_no, '{label}' AS step, {money(value)} AS value_gbp FROM total"
    for number, (label, value) in enumerate(
        [
            ("Positive sales S", "s"),
            ("Cancellation deduction −C", "-c"),
            ("Other-negative deduction −A", "-a"),
            ("Net recorded value N", "s - c - a"),
        ],
        1,
    )
)


def by_row(columns: str) -> str:
    return f"{JUDGED} SELECT source_row, {columns} FROM judged"


def first_rows(columns: str, where: str) -> str:
    return f"{JUDGED} SELECT source_row, {columns} FROM judged WHERE occurrence = 1 AND {where}"


def cleaning() -> str:
    blank = ", ".join(
        f"NULL AS {name}"
        for name in ["input_rows", "removed_rows"]
    )
    audited = [POSITIVE, NONPOSITIVE, UNCOMPUTABLE]
    gaps = ", ".join(f"NULL AS {side}_{name}" for side in ("input", "removed") for name in audited)
    counts = " UNION ALL ".join(
        f"""SELECT 'informational_raw' AS record_type, '{name}' AS step,
          "{name}" AS observed_count FROM counted_once"""
        for name in COUNTED
    )
    return f"""{JUDGED}, {stages()}, counted_once AS (SELECT {named(COUNTED)} FROM judged)
  SELECT {STAGE}, NULL AS observed_count FROM stage
  UNION ALL BY NAME
  SELECT 'eligible_total' AS record_type, 'eligible_merchandise' AS step, {blank}, {gaps},
    {part('remaining', 'n', 'pos', 'neg', 'bad')} FROM charged WHERE step = 'eligible'
  UNION ALL BY NAME ({counts})"""


def control_totals() -> str:
    """Every control total, which is also what it is compared with."""
    audited = {
        "raw_rows": "count(*)",
        "signed_value_positive_price_gbp": "coalesce(sum(value) FILTER (WHERE computable AND cost > 0), 0)",
        "signed_value_nonpositive_price_gbp": "coalesce(sum(value) FILTER (WHERE computable AND cost <= 0), 0)",
        "uncomputable_value_count": "count(*) FILTER (WHERE NOT computable)",
    }
    values = {
        "positive_sales_gbp": "s",
        "cancellation_value_gbp": "c",
        "other_negative_value_gbp": "a",
        "net_value_gbp": "s - c - a",
    }
    rows = [f"SELECT 'charged: {name}' AS name, {money(value)} AS total FROM judged" for name, value in audited.items()]
    rows += [
        f"SELECT '{label}: {name}', {money(value)} FROM sums"
        for label in ("overall", "products", "countries", "months")
        for name, value in values.items()
    ]
    return f"""{ELIGIBLE}, sums AS (SELECT {SUMS} FROM eligible), totals AS ({" UNION ALL ".join(rows)})
        SELECT name AS "check", total AS actual, total AS expected, true AS ok FROM totals"""


def oracle() -> dict[str, str]:
    """All SQL by query; with duplicates kept, the same tables come from every copy."""
    tables = tables_sql()
    kept = ("eligible_lines", "overall_summary", "product_summary")
    return tables | {f"{name}_without_dedup": tables[name].replace(ELIGIBLE, EVERY_COPY) for name in kept}


def tables_sql() -> dict[str, str]:
    best = """SELECT *, row_number() OVER (ORDER BY s DESC, Country) AS place
        FROM country WHERE s > 0"""
    products = f"""{ELIGIBLE}, {LABELS} SELECT StockCode, Description, {METRICS},
        {rate('s', TOTAL_SALES)} AS sales_share_pct,
        rank() OVER (ORDER BY s DESC) AS positive_sales_rank,
        rank() OVER (ORDER BY s - c - a DESC) AS net_value_rank FROM product"""
    customers = f"""{ELIGIBLE}, {CUSTOMERS} SELECT CustomerID,
        {money('ranked.s')} AS positive_sales_gbp,
        {rate('ranked.s', 'known.s')} AS share_of_identified_sales_pct,
        place AS display_order, place <= 10 AS is_top_10 FROM ranked, known"""
    return {
        "raw_lines": f"{RAW} SELECT * FROM raw",
        "source_rows": """SELECT 1 + row_number() OVER () AS source_row,
            l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem""",
        "numeric_identifiers": """SELECT 1 + row_number() OVER () AS source_row,
            CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity_text,
            CASE WHEN l_extendedprice % 1 = 0
                 THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) END AS whole_price_text
            FROM lineitem""",
        "fractional_identifiers": """SELECT source_row, CAST(l_extendedprice AS VARCHAR) AS fractional_price_text
            FROM (SELECT 1 + row_number() OVER () AS source_row, l_extendedprice FROM lineitem)
            WHERE l_extendedprice % 1 <> 0""",
        "csv_source": f"{RAW} SELECT {EIGHT} FROM raw",
        "typed_source": """SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, CAST(l_partkey AS VARCHAR) AS StockCode,
            l_returnflag AS Description, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS Quantity,
            strftime(TIMESTAMP '1970-01-01 05:30:00' + to_days(CAST(l_orderkey AS INTEGER)) + to_hours(l_linenumber),
                '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS UnitPrice,
            CAST(l_suppkey AS VARCHAR) AS CustomerID, l_linestatus AS Country
            FROM lineitem""",
        "content_digests": f"""{RAW}, hashed AS (
            SELECT source_row, source_row // 1000 AS block,
                md5(concat_ws('|', {", ".join(f"coalesce({name}, '-')" for name in RAW_COLUMNS)})) AS hash
            FROM raw
        ), parted AS (
            SELECT block, source_row, {", ".join(f"CAST('0x' || substr(hash, {at}, 8) AS HUGEINT) AS part_{at}" for at in (1, 9, 17, 25))}
            FROM hashed
        )
        SELECT block, count(*) AS lines, {digest_sql("source_row")} AS digest, {digest_sql("xor(source_row, 1)")} AS digest_of_swapped
        FROM parted GROUP BY block""",
        "parsed_numbers": by_row(
            """CASE WHEN finite_quantity THEN qty END AS quantity,
            CASE WHEN finite_price THEN cost END AS price,
            finite_quantity, finite_price, computable,
            coalesce(CASE WHEN finite_quantity THEN qty % 1 <> 0 END, true) AS fractional"""
        ),
        "cancellation_flag": by_row("cancels AS is_cancellation"),
        "normalized_identifiers": by_row(
            """invoice AS invoice_no, code AS stock_code,
            coalesce(trim(Description), '') AS description,
            nullif(trim(CustomerID), '') AS customer_id,
            coalesce(nullif(trim(Country), ''), 'Unknown') AS country"""
        ),
        "parsed_dates": by_row(
            f"{second('moment')} AS invoice_date, strftime(moment, '%Y-%m') AS month"
        ),
        "signed_values": by_row(
            f"{money('value')} AS signed_value_gbp, {money('abs(value)')} AS absolute_value_gbp"
        ),
        "price_status": by_row(
            """CASE WHEN NOT computable THEN 'invalid_numeric' WHEN cost > 0 THEN 'positive'
            WHEN cost = 0 THEN 'zero' ELSE 'negative' END AS price_status"""
        ),
        "dedup_lines": first_rows(f"copies, {EIGHT}", "true"),
        "line_disposition": first_rows("copies, disposition", "true"),
        "eligible_lines": f"""{ELIGIBLE} SELECT InvoiceNo, StockCode, Description,
            CAST(Quantity AS DOUBLE) AS Quantity, {second('InvoiceDate')} AS InvoiceDate,
            CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country, source_row,
            {money('value')} AS signed_value_gbp, transaction_category, copies FROM eligible""",
        "category_counts": f"""{ELIGIBLE} SELECT transaction_category, count(*) AS row_count
            FROM eligible GROUP BY 1""",
        "excluded_lines_semi": first_rows("code AS stock_code", f"code IN ({CODES})"),
        "non_excluded_lines_anti": first_rows("code AS stock_code", f"code NOT IN ({CODES})"),
        "overall_metrics": f"{ELIGIBLE}, {OVERALL} SELECT {METRICS} FROM total",
        "metrics_by_key": f"""{ELIGIBLE} SELECT CustomerID, {METRICS}
            FROM (SELECT CustomerID, {SUMS} FROM eligible GROUP BY CustomerID)""",
        "product_summary": products,
        "product_summary_distributed": products,
        "description_frequency": f"""{ELIGIBLE} SELECT StockCode, Description, count(*) AS row_count
            FROM eligible WHERE Description <> '' GROUP BY 1, 2""",
        "country_summary": f"""{ELIGIBLE}, {COUNTRIES} SELECT Country, {METRICS},
            {rate('s', TOTAL_SALES)} AS sales_share_pct FROM country""",
        "monthly_summary": f"""{ELIGIBLE}, {MONTHS} SELECT Month, {METRICS},
            {second('first')} AS coverage_start, {second('last')} AS coverage_end,
            Month = '2001-08' AS is_partial_month FROM month""",
        "month_coverage_join": f"""{ELIGIBLE}, {MONTHS} SELECT Month, {METRICS},
            {second('first')} AS coverage_start, {second('last')} AS coverage_end FROM month""",
        "customer_summary": customers,
        "customer_summary_distributed": customers,
        "customer_statistics": f"""{ELIGIBLE}, {CUSTOMERS}, {OVERALL}
            SELECT {STATISTICS} FROM known, total""",
        "overall_summary": f"""{ELIGIBLE}, {CUSTOMERS}, {OVERALL}
            SELECT {METRICS.replace("CAST(s ", "CAST(total.s ")},
            lines AS eligible_row_count, {second('first')} AS coverage_start,
            {second('last')} AS coverage_end, {STATISTICS} FROM known, total""",
        "top_products": f"""{ELIGIBLE}, {LABELS} SELECT StockCode, Description, {FOUR} FROM product
            WHERE s > 0 ORDER BY s DESC, StockCode LIMIT 10""",
        "top_countries": f"""{ELIGIBLE}, {COUNTRIES} SELECT Country, {METRICS} FROM country
            WHERE s > 0 AND Country <> 'NATION_0' ORDER BY s DESC, Country LIMIT 10""",
        "large_value_lines": f"""{ELIGIBLE} SELECT source_row, InvoiceNo, StockCode, Description,
            {second('InvoiceDate')} AS InvoiceDate, CAST(Quantity AS DOUBLE) AS Quantity,
            CAST(UnitPrice AS DOUBLE) AS UnitPrice, transaction_category,
            {money('value')} AS signed_value_gbp, {money('abs(value)')} AS absolute_line_value_gbp
            FROM eligible ORDER BY abs(value) DESC, source_row LIMIT 10""",
        "audit_values": f"""{JUDGED} SELECT n AS row_count, {money('pos')} AS {POSITIVE},
            {money('neg')} AS {NONPOSITIVE}, bad AS {UNCOMPUTABLE} FROM (SELECT {audit('judged')})""",
        "stage_audit": f"{JUDGED}, {stages()} SELECT step_no, {STAGE} FROM stage",
        "stage_audit_without_dedup": f"{JUDGED}, {stages('rule')} SELECT step_no, {STAGE} FROM stage",
        "eligible_total": f"""{JUDGED}, {stages()} SELECT 'eligible_total' AS record_type,
            'eligible_merchandise' AS step, {part('remaining', 'n', 'pos', 'neg', 'bad')}
            FROM charged WHERE step = 'eligible'""",
        "excluded_entries": JUDGED + exclusions(
            "1", "disposition = 'excluded_codes'", "post_deduplication"
        ),
        "excluded_entries_raw_basis": JUDGED + exclusions("1", "rule = 'excluded_codes'", "raw"),
        "raw_profile": f"""{JUDGED} SELECT {named(COUNTED)},
            min(qty) FILTER (WHERE finite_quantity) AS minimum_quantity,
            max(qty) FILTER (WHERE finite_quantity) AS maximum_quantity,
            {second('min(moment)')} AS first_timestamp, {second('max(moment)')} AS last_timestamp,
            '{",".join(RAW_COLUMNS)}' AS names FROM judged""",
        "cleaning_summary": cleaning(),
        "duplicate_comparison": f"""{SURVIVORS}, side AS (
            SELECT 'before' AS side, {SUMS} FROM survivor
            UNION ALL SELECT 'after', {SUMS} FROM survivor WHERE occurrence = 1
          ), tall AS (
            SELECT side, 'positive_sales_gbp' AS metric, s AS v FROM side
            UNION ALL SELECT side, 'cancellation_value_gbp', c FROM side
            UNION ALL SELECT side, 'net_value_gbp', s - c - a FROM side
          ) SELECT b.metric, {money('b.v')} AS before_gbp, {money('f.v')} AS after_gbp,
            {money('f.v - b.v')} AS change_gbp, {rate('f.v - b.v', 'b.v')} AS percentage_change
          FROM tall b JOIN tall f ON b.metric = f.metric AND b.side = 'before' AND f.side = 'after'""",
        "metrics_with_duplicates": f"""{SURVIVORS} SELECT {METRICS} FROM (
            SELECT {SUMS} FROM survivor)""",
        "reconciliation": reconciliation(),
        "control_totals": control_totals(),
        "chart_products": f"""{ELIGIBLE}, {LABELS}
            SELECT StockCode || ' — ' || Description AS label, {money('s')} AS positive_sales_gbp
            FROM product WHERE s > 0 ORDER BY s DESC, StockCode LIMIT 10""",
        "chart_countries": f"""{ELIGIBLE}, {COUNTRIES}, everywhere AS ({best}), abroad AS (
              SELECT *, row_number() OVER (ORDER BY s DESC, Country) AS place
              FROM country WHERE s > 0 AND Country <> 'NATION_0')
            SELECT 'Top 10 — all countries' AS panel, Country, {money('s')} AS positive_sales_gbp
            FROM everywhere WHERE place <= 10
            UNION ALL SELECT 'Top 10 — excluding NATION_0', Country, {money('s')}
            FROM abroad WHERE place <= 10""",
        "chart_months": f"""{ELIGIBLE}, {MONTHS}, flagged AS (
              SELECT *, Month = '2001-08' AS partial, lag(Month = '2001-08') OVER (ORDER BY Month) AS previous
              FROM month
            ), linked AS (
              SELECT *, CASE WHEN previous IS NOT NULL THEN partial OR previous END AS link FROM flagged)
            SELECT Month, partial AS is_partial_month, link AS link_is_partial,
              'Positive sales (S)' AS series, {money('s')} AS value_gbp FROM linked
            UNION ALL SELECT Month, partial, link, 'Net recorded value (N)', {money('s - c - a')}
            FROM linked""",
        "chart_net_steps": f"{ELIGIBLE}, {OVERALL} {CHART_STEPS}",
        "chart_period": f"""{ELIGIBLE} SELECT strftime(min(InvoiceDate), '%Y-%m-%d') || ' to '
            || strftime(max(InvoiceDate), '%Y-%m-%d') || ' | Eligible deduplicated merchandise'
            AS period FROM eligible""",
        "export_rounding": f"""{ELIGIBLE}, {COUNTRIES} SELECT Country,
            {", ".join(
                f"CAST(CAST({value} AS DECIMAL(38,2)) AS DOUBLE) AS {name}"
                for name, value in {
                    "positive_sales_gbp": "s",
                    "cancellation_value_gbp": "c",
                    "other_negative_value_gbp": "a",
                    "net_value_gbp": "s - c - a",
                    "cancellation_value_rate_pct": rate("c", "s"),
                    "sales_share_pct": rate("s", TOTAL_SALES),
                }.items()
            )} FROM country""",
    }
