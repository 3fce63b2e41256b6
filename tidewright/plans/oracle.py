"""The same results as plain SQL over the whole tables, written without the rewrites of the Spark side.

Joins that fan out are written as joins, OR conditions as OR, NOT IN as NOT IN.
"""

_YEAR_COLUMNS = ", ".join(
    f"CAST(SUM(CASE WHEN y = {y} THEN q END) AS BIGINT) AS y{y}" for y in (1995, 1996, 1997, 1998, 1999)
)
_SALES = """
    SELECT p_brand, year(o_orderdate) AS y, SUM(l_quantity) AS q
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE year(o_orderdate) BETWEEN 1995 AND 1999
    GROUP BY p_brand, year(o_orderdate)
"""
_BRAND_CELLS = {
    f"Brand_{n}": f"CAST(SUM(CASE WHEN p_brand = 'Brand#{n}' THEN q END) AS BIGINT)" for n in range(1, 11)
}
_BY_YEAR = (
    f"SELECT y AS \"year\", {', '.join(f'{cell} AS {name}' for name, cell in _BRAND_CELLS.items())} "
    f"FROM ({_SALES}) GROUP BY y"
)
_JSON_CELLS = " || ".join(f"coalesce(',\"{name}\":' || {name}, '')" for name in _BRAND_CELLS)
_XML_CELLS = " || ".join(f"coalesce('<{name}>' || {name} || '</{name}>', '')" for name in _BRAND_CELLS)

# Movies of the orders, copies and several of one Id among them, as the Spark side builds them.
_MOVIES = """
    WITH per_order AS (
        SELECT l_orderkey, min(l_shipdate) AS shipped
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
    ), genre_rows AS (
        SELECT DISTINCT l_orderkey, CAST(p_size AS BIGINT) AS id,
               CASE WHEN p_size = 1 THEN '' ELSE p_type END AS name
        FROM lineitem JOIN part ON l_partkey = p_partkey
    ), genre_lists AS (
        SELECT l_orderkey,
               string_agg(id || ':' || name, ',' ORDER BY id, name) AS genres,
               string_agg(CAST(id AS VARCHAR), ',' ORDER BY id, name) AS ids,
               min(id) AS first_id
        FROM genre_rows GROUP BY l_orderkey
    ), once AS (
        SELECT o_orderkey AS "Id", o_totalprice AS budget,
               CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(shipped AS DATE)) AS INTEGER) AS runtime,
               o_orderpriority AS lang, CAST(o_orderdate AS DATE) AS created, o_orderstatus AS created_by,
               'Order ' || o_orderkey AS title, genres, ids, first_id
        FROM orders LEFT JOIN per_order p ON o_orderkey = p.l_orderkey
        LEFT JOIN genre_lists g ON o_orderkey = g.l_orderkey
    ), movies AS (
        SELECT * FROM once UNION ALL SELECT * FROM once WHERE "Id" % 10 = 0
        UNION ALL SELECT * REPLACE (-1 - runtime AS runtime, title || ' again' AS title) FROM once WHERE "Id" % 7 = 0
    )
"""
_UNTYPED = """
    SELECT *, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN TIMESTAMP '1850-06-01' ELSE ts END AS changed FROM events
"""
_FLOORED = "CASE WHEN budget < 100000 THEN 100000 ELSE budget END"
_DAY_TOTALS = """
    SELECT o_orderkey AS "OrderId", CAST(o_orderdate AS DATE) AS "OrderDate",
           CAST(SUM(l_quantity) AS BIGINT) AS "OrderTotal", o_custkey AS "CustomerId"
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN {days}
    GROUP BY o_orderkey, CAST(o_orderdate AS DATE), o_custkey
"""


def _average_gap(unit: str, name: str) -> str:
    gap = f"date_diff('{unit}', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"
    return f"""
        SELECT n_nationkey, CAST(trunc(CAST(SUM({gap}) AS DOUBLE) / COUNT({gap})) AS BIGINT) AS {name}_whole,
               CAST(SUM({gap}) AS DOUBLE) / COUNT({gap}) AS {name}
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        RIGHT JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_nationkey
    """


_DECIMALS = {"o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax"}
_DAYS = {"o_orderdate", "l_shipdate"}
_TEXTS = {"o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus"}


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def _typed(column: str) -> str:
    kind = "DECIMAL(18,2)" if column in _DECIMALS else "DATE" if column in _DAYS else None
    return f"CAST({column} AS {kind}) AS {column}" if kind else column


def _object(columns: list[str]) -> str:
    """A JSON object without its last bracket."""
    quote = {c: "\"" if c in _TEXTS | _DAYS else "" for c in columns}
    return "'{' || " + " || ',' || ".join(f"'\"{c}\":{quote[c]}' || {c} || '{quote[c]}'" for c in columns)


def _nested(parent: list[str], child: list[str], condition: str = "o_orderdate IS NOT NULL") -> str:
    """pieces(d, seq, text): the brackets, orders and lines of the JSON array of each date, numbered in order."""
    kids = [c for c in child if c != "l_orderkey"]
    order = ", ".join(child)
    return f"""
        WITH o AS (SELECT {", ".join(map(_typed, dict.fromkeys(["o_orderkey", *parent])))}, CAST(o_orderdate AS DATE) AS d
                   FROM orders WHERE {condition}),
        l AS (SELECT {", ".join(map(_typed, ["l_orderkey", *kids]))} FROM lineitem),
        p AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY o_orderkey) AS i FROM o
              WHERE o_orderkey IN (SELECT l_orderkey FROM l)),
        c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS j FROM l JOIN p ON l_orderkey = o_orderkey),
        every AS (
            SELECT DISTINCT d, 0 AS s, NULL AS k, 0 AS kind, NULL AS j, '[' AS text FROM p
            UNION ALL SELECT d, 1, o_orderkey, 0, NULL, CASE WHEN i > 1 THEN ',' ELSE '' END || {_object(parent)} || ',"lines":[' FROM p
            UNION ALL SELECT d, 1, o_orderkey, 1, j, CASE WHEN j > 1 THEN ',' ELSE '' END || {_object(child)} || '}}' FROM c
            UNION ALL SELECT d, 1, o_orderkey, 2, NULL, ']}}' FROM p
            UNION ALL SELECT DISTINCT d, 2, NULL, 0, NULL, ']' FROM p),
        pieces AS (SELECT d, row_number() OVER (ORDER BY d, s, k, kind, j) AS seq, text FROM every)
    """


ORACLE = {
    "q01_contact_lookup": """
        SELECT c_name AS full_name, c_mktsegment AS segment, coalesce(s_name, n_name) AS company,
               coalesce(s_suppkey, CAST(n_nationkey AS BIGINT)) AS company_key
        FROM customer
        LEFT JOIN supplier ON s_suppkey = c_custkey OR s_nationkey = c_custkey
        LEFT JOIN nation ON n_nationkey = c_custkey OR n_regionkey = c_custkey
        WHERE c_custkey <> 1
    """,
    "q02_same_phone": """
        SELECT o_orderkey, o_custkey, l_partkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate = o_orderdate
    """,
    "q03_lapsed_customers": """
        SELECT c_name FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY c_name HAVING max(o_orderdate) <= '2000-12-31'
    """,
    "q04_item_qty_year": """
        SELECT l_partkey, SUM(l_quantity) AS total_quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE CAST(o_orderdate AS DATE) BETWEEN '1996-01-01' AND '1996-12-31' GROUP BY l_partkey
    """,
    "q04_item_qty_fanout": """
        SELECT t.l_partkey, SUM(l.l_quantity) AS total_quantity
        FROM orders JOIN lineitem t ON t.l_orderkey = o_orderkey JOIN lineitem l ON l.l_orderkey = o_orderkey
        WHERE CAST(o_orderdate AS DATE) BETWEEN '1996-01-01' AND '1996-12-31' GROUP BY t.l_partkey
    """,
    "q05_long_comment": "SELECT p_partkey, p_name FROM part WHERE length(rtrim(p_name)) >= 10",
    "q06_items_not_sold": """
        SELECT DISTINCT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE CAST(o_orderdate AS DATE) BETWEEN '1998-01-01' AND '1998-12-31' AND l_partkey NOT IN (
            SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey
            WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_0' OR n_name = 'NATION_1'))
    """,
    "q07_avg_days": _average_gap("day", "avg_days"),
    "q08_avg_months": _average_gap("month", "avg_months"),
    "q09_bought_gt_sold": """
        WITH sold AS (SELECT l_partkey, count(l_orderkey) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
             bought AS (SELECT l_partkey, count(l_orderkey) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
        SELECT DISTINCT l.l_partkey FROM lineitem l
        JOIN sold s ON l.l_partkey = s.l_partkey JOIN bought b ON l.l_partkey = b.l_partkey
        WHERE CAST(l_shipdate AS DATE) BETWEEN '1998-01-01' AND '1998-12-31' AND b.n > s.n
    """,
    "q10_few_mugs": """
        WITH few AS (
            SELECT o_custkey FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
            WHERE p_name ILIKE '%ring%' AND year(o_orderdate) = 1999 GROUP BY o_custkey HAVING count(p_partkey) <= 2)
        SELECT c_name, c_mktsegment, n_name
        FROM customer JOIN few ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
    """,
    "q11_updated_since": "SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 2000",
    "q12_order_detail": """
        SELECT p_name, s_name, c_name, c_mktsegment, n_name, r_name, l_quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE CAST(l_shipdate AS DATE) = '1998-07-01'
    """,
    "q13_group_stock": """
        WITH sold AS (SELECT l_partkey, SUM(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
             bought AS (SELECT l_partkey, SUM(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
        SELECT p_brand, CAST(SUM(b.q) AS BIGINT) AS total_purchased, CAST(SUM(s.q) AS BIGINT) AS total_sold,
               CAST(SUM(b.q - s.q) AS BIGINT) AS remaining_stock
        FROM part JOIN sold s ON p_partkey = s.l_partkey JOIN bought b ON p_partkey = b.l_partkey GROUP BY p_brand
    """,
    "q13_group_stock_fanout": """
        WITH sold AS (
            SELECT t.l_partkey, SUM(l.l_quantity) AS q FROM lineitem t JOIN lineitem l ON t.l_partkey = l.l_partkey
            WHERE l.l_returnflag = 'N' GROUP BY 1),
        bought AS (
            SELECT t.l_partkey, SUM(l.l_quantity) AS q FROM lineitem t JOIN lineitem l ON t.l_partkey = l.l_partkey
            WHERE l.l_returnflag <> 'N' GROUP BY 1)
        SELECT p_brand, CAST(SUM(b.q) AS BIGINT) AS total_purchased, CAST(SUM(s.q) AS BIGINT) AS total_sold,
               CAST(SUM(b.q - s.q) AS BIGINT) AS remaining_stock
        FROM part JOIN sold s ON p_partkey = s.l_partkey JOIN bought b ON p_partkey = b.l_partkey GROUP BY p_brand
    """,
    "q14_top_delivery": """
        WITH counts AS (SELECT o_custkey, count(o_orderkey) AS n FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1)
        SELECT c_name, coalesce(CAST(max(n) AS VARCHAR), 'No sales') AS most_orders
        FROM customer LEFT JOIN counts ON c_custkey = o_custkey GROUP BY c_name
    """,
    "q15_multi_attempt": """
        SELECT user_id FROM events GROUP BY user_id
        HAVING count(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95 THEN 1 END) >= 1
    """,
    "q15_second_attempt": """
        SELECT event_id, CASE WHEN value < 1 THEN '{left open}' ELSE 'no answer to ' || event_type END AS comment
        FROM events WHERE value < 20
    """,
    "q16_made_in": "SELECT event_id FROM events WHERE json_extract_string(props, '$.k') = '69'",
    "q17_qty_by_country": """
        SELECT json_extract_string(props, '$.k') AS k, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM events WHERE CAST(ts AS DATE) BETWEEN '2024-01-08' AND '2024-01-21' GROUP BY 1
    """,
    "q17_qty_by_country_fanout": """
        SELECT json_extract_string(a.props, '$.k') AS k, CAST(SUM(CAST(b.value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM (SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN '2024-01-08' AND '2024-01-21') a
        JOIN (SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN '2024-01-08' AND '2024-01-21') b ON a.user_id = b.user_id
        GROUP BY 1
    """,
    "q18_pivot_year": f"SELECT p_brand, {_YEAR_COLUMNS} FROM ({_SALES}) GROUP BY p_brand",
    "q19_pivot_group": f"SELECT CAST(\"year\" AS INTEGER) AS \"year\", * EXCLUDE (\"year\") FROM ({_BY_YEAR})",
    "q20_order_total": """
        SELECT o_orderkey, CAST(coalesce((SELECT SUM(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey), 0) AS BIGINT)
            AS total_quantity
        FROM orders
    """,
    "q21_load_day": _DAY_TOTALS.format(days="'1996-01-05' AND '1996-01-06'"),
    "q22_item_migration": """
        SELECT CAST(p_partkey AS INTEGER) AS "StockItemID", p_name AS "StockItemName", p_size AS "SupplierID",
               CAST(NULL AS INTEGER) AS "ColorID", p_size % 7 AS "UnitPackageID", p_size % 5 AS "OuterPackageID",
               p_brand AS "Brand", p_type AS "Size", p_size AS "LeadTimeDays", 1 AS "QuantityPerOuter",
               0 AS "IsChillerStock", CAST(NULL AS VARCHAR) AS "Barcode", CAST(p_size AS DOUBLE) AS "TaxRate",
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS "UnitPrice",
               CAST(NULL AS DOUBLE) AS "RecommendedRetailPrice", p_size / 8 AS "TypicalWeightPerUnit",
               CAST(NULL AS VARCHAR) AS "MarketingComments", CAST(NULL AS VARCHAR) AS "InternalComments",
               CASE WHEN p_size > 3 THEN p_type END AS "CountryOfManufacture",
               CASE WHEN p_size % 2 = 0 THEN p_brand END AS "Range",
               CASE WHEN p_size % 3 = 0 THEN p_size || ' days' END AS "ShelfLife"
        FROM part
    """,
    "q23_reload_week": _DAY_TOTALS.format(days="'1996-01-05' AND '1996-01-12'"),
    "q24_backfill": """
        SELECT 'item' AS target,
               (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY p_partkey) AS id, p_name AS name,
               p_size AS supplier, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
               CASE WHEN p_size <> 1 THEN '{"CountryOfManufacture":"' || p_type || '"}' END AS custom_fields,
               CAST(NULL AS DATE) AS order_date
        FROM part
        UNION ALL
        SELECT 'purchase order', NULL, 'order ' || p_partkey, p_size, NULL, NULL,
               CASE WHEN p_size % 5 <> 0 THEN CAST('2020-03-01' AS DATE) + p_size END
        FROM part
    """,
    "q25_json_export": f"""
        WITH y AS ({_BY_YEAR}), n AS (SELECT *, row_number() OVER (ORDER BY "year") AS seq FROM y)
        SELECT seq, CASE WHEN seq > 1 THEN ',' ELSE '' END || '{{"year":' || "year" || {_JSON_CELLS} || '}}' AS json FROM n
        UNION ALL SELECT 0, '['
        UNION ALL SELECT count(*) + 1, ']' FROM n
    """,
    "q25_json_lines": f"""SELECT '{{"year":' || "year" || {_JSON_CELLS} || '}}' AS json FROM ({_BY_YEAR})""",
    "q26_xml_export": f"""
        SELECT row_number() OVER (ORDER BY "year") AS seq, '<year>' || "year" || '</year>' || {_XML_CELLS} AS xml
        FROM ({_BY_YEAR})
    """,
    "q27_json_per_date": _nested(_ORDER_COLUMNS, _LINE_COLUMNS)
    + ' SELECT d AS "OrderDate", seq, text FROM pieces',
    "q28_customer_documents": _nested(
        _ORDER_COLUMNS,
        _LINE_COLUMNS,
        "CAST(o_orderdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_custkey = 7)",
    )
    + """
        , own AS (SELECT CAST(o_orderdate AS DATE) AS day, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id
                  FROM orders WHERE o_custkey = 7 AND o_orderdate IS NOT NULL)
        SELECT id AS "ID", day AS "InvoiceDate", seq, text AS "InvoiceValue" FROM own JOIN pieces ON d = day
    """,
    "j01_fanout_sum": """
        SELECT a.l_partkey, SUM(b.l_quantity) AS total_quantity
        FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey GROUP BY a.l_partkey
    """,
    "j02_bridge_sum": """
        SELECT p_brand, CAST(SUM(l_quantity) AS BIGINT) AS quantity
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    """,
    "j03_line_delays": """
        SELECT l_orderkey, l_linenumber,
               CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days,
               CAST(date_diff('month', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS months
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "m01_raw_to_bronze": _MOVIES
    + """
        SELECT "Id", budget AS "Budget", runtime AS "RunTime", lang AS "OriginalLanguage",
               CAST(created AS VARCHAR) AS "CreatedDate", title AS "Title", genres, 'movie.json' AS datasource,
               'new' AS status, CAST('2022-01-01' AS DATE) AS p_ingestdate
        FROM movies
    """,
    "m02_movie_projection": _MOVIES
    + f"""
        SELECT "Id", {_FLOORED} AS "Budget", runtime AS "RunTime", title AS "Title", created AS "ReleaseDate",
               created AS "p_CreatedDate", created_by AS "CreatedBy", ids AS "Genres_Id",
               first_id AS first_genre, 1 AS "Language_Id"
        FROM movies
    """,
    "m03_clean": _MOVIES
    + f"""
        SELECT "Id", {_FLOORED} AS "Budget", runtime AS "RunTime", created AS "p_CreatedDate"
        FROM (SELECT DISTINCT * FROM movies) WHERE runtime >= 0
    """,
    "m04_quarantine": _MOVIES
    + f"""
        SELECT "Id", {_FLOORED} AS "Budget", runtime AS "RunTime", created AS "p_CreatedDate"
        FROM (SELECT DISTINCT * FROM movies) WHERE runtime < 0
    """,
    "m05_genres": """
        SELECT DISTINCT CAST(p_size AS BIGINT) AS "Id", p_type AS name
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE p_size <> 1
    """,
    "m06_language": 'SELECT DISTINCT 1 AS "Id", o_orderpriority AS "OriginalLanguage" FROM orders',
    "m07_status_merge": _MOVIES
    + """
        SELECT "Id", CASE WHEN runtime >= 0 THEN 'loaded' WHEN runtime < 0 THEN 'quarantined' ELSE 'new' END AS status
        FROM movies
    """,
    "m07_value_merge": _MOVIES
    + """
        SELECT "Id", CASE WHEN runtime >= 0 THEN 'loaded' WHEN runtime < 0 THEN 'quarantined' ELSE 'new' END AS status
        FROM movies
    """,
    "m08_repair": _MOVIES
    + f"""
        SELECT "Id", CASE WHEN runtime >= 0 THEN {_FLOORED} ELSE budget END AS "Budget", abs(runtime) AS "RunTime",
               created AS "p_CreatedDate", 1 AS "Language_Id"
        FROM (SELECT DISTINCT * FROM movies) WHERE runtime IS NOT NULL
    """,
    "m08_repair_status": _MOVIES
    + """
        SELECT CASE WHEN runtime IS NULL THEN 'new' ELSE 'loaded' END AS status, count(*) AS n
        FROM movies GROUP BY 1
    """,
    "m09_dedupe_by_key": """
        SELECT * EXCLUDE (l_shipdate, rn), CAST(l_shipdate AS DATE) AS l_shipdate FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
                l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
            FROM lineitem) WHERE rn = 1
    """,
    "m10_split_default": _MOVIES
    + """
        SELECT "Id", runtime AS "RunTime", CASE WHEN runtime >= 0 THEN 'clean' ELSE 'rest' END AS stream FROM movies
    """,
    "m11_rank_key": """
        SELECT CAST("Id" AS INTEGER) AS "Id", min(lang) AS lang
        FROM (SELECT lang, rank() OVER (PARTITION BY lang ORDER BY lang) AS "Id" FROM documents) GROUP BY "Id"
    """,
    "m11_rank_rows": """
        SELECT DISTINCT CAST(rank() OVER (PARTITION BY lang ORDER BY lang) AS INTEGER) AS "Id", lang FROM documents
    """,
    "m12_status_join": _MOVIES
    + """
        SELECT a."Id", a.runtime AS "RunTime", a.status, 'movie.json' AS datasource
        FROM (SELECT "Id", CASE WHEN runtime >= 0 THEN 'loaded' ELSE 'quarantined' END AS status, min(runtime) AS runtime
              FROM movies GROUP BY 1, 2) a
        JOIN movies b ON a."Id" = b."Id"
    """,
    "m13_second_drop": _MOVIES
    + """
        SELECT "Id", runtime AS "RunTime",
               CASE WHEN runtime IS NULL THEN 'new' WHEN "Id" % 5 = 0 AND runtime < 0 THEN 'quarantined' ELSE 'loaded' END AS status,
               CAST('2022-01-01' AS DATE) AS p_ingestdate
        FROM movies
        UNION ALL
        SELECT "Id", runtime, CASE WHEN runtime IS NULL THEN 'new' WHEN runtime < 0 THEN 'quarantined' ELSE 'loaded' END,
               CAST('2022-01-02' AS DATE)
        FROM movies WHERE "Id" % 5 = 0
    """,
    "m14_file_merge": _MOVIES
    + """
        SELECT "Id", runtime AS "RunTime", CASE WHEN hit AND "Id" % 3 = 0 THEN 'quarantined' ELSE 'new' END AS status,
               max(CASE WHEN hit AND "Id" % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY strftime(created, '%Y-%m')) = 1 AS rewritten
        FROM (SELECT *, strftime(created, '%Y-%m') IN ('1996-03', '1997-03') AS hit FROM movies)
    """,
    "m15_repair_twice": _MOVIES
    + f"""
        SELECT "Id", CASE WHEN runtime >= 0 THEN {_FLOORED} ELSE budget END AS "Budget", abs(runtime) AS "RunTime",
               created AS "p_CreatedDate", CASE WHEN runtime >= 0 THEN 0 WHEN runtime < 0 THEN 1 ELSE 2 END AS run
        FROM (SELECT DISTINCT * FROM movies)
    """,
    "m16_ledger": _MOVIES
    + """
        , d AS (SELECT DISTINCT * FROM movies)
        SELECT '20220101000000000' AS p_load, 'silver' AS step, 1 AS run, 'done' AS state, count(*) AS silver_rows FROM d WHERE runtime >= 0
        UNION ALL SELECT '20220101000000000', 'repair', 1, 'done', count(*) FROM d WHERE runtime < 0
        UNION ALL SELECT '20220102000000000', 'silver', 1, 'pending', 0
    """,
    "s01_multi_line_documents": _MOVIES + """SELECT "Id", runtime AS "RunTime", 'about ' || title AS "Extra" FROM movies""",
    "s04_one_large_array": _MOVIES
    + """
        SELECT "Id", runtime AS "RunTime", '"}],[{ \\ ' || title || ' {"movie": [{' AS "Title",
               CAST(CASE WHEN genres IS NOT NULL THEN len(string_split(ids, ',')) END AS INTEGER) AS genres
        FROM movies
    """,
    "s02_catalog_flow": _MOVIES
    + """
        SELECT "Id", 'bronze' AS found FROM movies WHERE runtime IS NULL
        UNION ALL SELECT "Id", 'silver' FROM (SELECT DISTINCT * FROM movies) WHERE runtime IS NOT NULL
    """,
    "s03_parquet_drift": "SELECT * FROM part",
    "s05_nested_drift": _MOVIES
    + """
        SELECT "Id", runtime AS "RunTime", round(CASE WHEN "Id" % 3 = 1 THEN CAST(budget AS FLOAT) ELSE budget END, -2) AS budget, genres,
               CASE WHEN genres IS NULL THEN NULL WHEN "Id" % 3 = 2 THEN
                   array_to_string(list_transform(string_split(genres, ','), lambda g: upper(string_split(g, ':')[2])), ',') ELSE '' END AS loud,
               CASE WHEN "Id" % 3 = 2 THEN 'new' END AS note
        FROM movies WHERE runtime >= 0
    """,
    "i01_cutoff_extract": """
        SELECT event_id, user_id, event_type, value FROM events
        WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'
    """,
    "i02_staged_upsert": f"""
        SELECT user_id, event_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY changed DESC NULLS LAST, event_id DESC) AS rn
            FROM ({_UNTYPED}) WHERE changed <= TIMESTAMP '2024-01-20' OR changed IS NULL) WHERE rn = 1
    """,
    "i04_lineage": f"""
        SELECT key AS lineage_key, 'Event key' AS table_name, cutoff, TIMESTAMP '2024-01-20' AS last,
               CASE WHEN key = 2 THEN (SELECT CAST(count(*) AS INTEGER) FROM ({_UNTYPED})
                    WHERE changed > TIMESTAMP '2024-01-10' AND changed <= TIMESTAMP '2024-01-20') END AS staged
        FROM (VALUES (1::BIGINT, TIMESTAMP '2024-01-10'), (2::BIGINT, TIMESTAMP '2024-01-20')) t(key, cutoff)
    """,
    "i05_side_by_side": """
        SELECT 'orders' AS name, 'loaded' AS state, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS total,
               CAST(max(o_orderdate) AS DATE) AS latest, 2024 AS cutoff_year
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders WHERE o_orderdate <= TIMESTAMP '2024-01-20') WHERE rn = 1
        UNION ALL
        SELECT 'lineitem', 'loaded', count(*), CAST(sum(l_orderkey) AS BIGINT), CAST(max(l_shipdate) AS DATE), 2024
        FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
              FROM lineitem WHERE l_shipdate <= TIMESTAMP '2024-01-20') WHERE rn = 1
        UNION ALL
        SELECT 'events', 'loaded', count(*), CAST(sum(event_id) AS BIGINT), CAST(max(ts) AS DATE), 2024
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events WHERE ts <= TIMESTAMP '2024-01-20') WHERE rn = 1
        UNION ALL SELECT 'broken', 'failed', NULL, NULL, NULL, NULL
    """,
    "i03_date_dimension": """
        SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS iso_week,
               CAST(isodow(d) AS INTEGER) AS iso_weekday
        FROM (SELECT unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS d
              FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) <> 1998))
    """,
    "o01_table_checks": """
        SELECT 'not_null' AS rule, 'l_orderkey' AS columns, count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
        UNION ALL SELECT 'not_null', 'l_partkey', count(*) FILTER (l_partkey IS NULL) FROM lineitem
        UNION ALL SELECT 'not_null', 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem
        UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber',
            (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
        UNION ALL SELECT 'reference', 'l_orderkey', count(*) FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
        UNION ALL SELECT 'reference', 'l_partkey', count(*) FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
        UNION ALL SELECT 'reference', 'o_orderkey', count(*) FROM orders
            WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE o_orderkey = l_orderkey)
    """,
    "o02_tagged_rows": """
        WITH l AS (SELECT CASE WHEN k % 29 = 0 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey, l_linenumber,
                          CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS l_partkey,
                          l_quantity + unnest(CASE WHEN k % 11 = 0 THEN [0, 5] ELSE [0] END) AS l_quantity
                   FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem))
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, concat_ws(' ',
            CASE WHEN l_partkey IS NULL THEN 'not_null:l_partkey' END,
            CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey NULLS FIRST, l_quantity) > 1
                 THEN 'unique:l_orderkey,l_linenumber' END,
            CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM orders) THEN 'reference:l_orderkey' END,
            CASE WHEN l_partkey NOT IN (SELECT p_partkey FROM part) THEN 'reference:l_partkey' END) AS broken
        FROM l
    """,
    "j04_hot_part": """
        SELECT l_orderkey, l_linenumber, part, p_name, p_brand
        FROM (SELECT *, CAST(CASE WHEN l_linenumber % 3 = 1 THEN 1 WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS BIGINT) AS part
              FROM lineitem)
        LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 <> 3) ON part = p_partkey
    """,
    "q29_names_in_any_case": """
        SELECT upper(c_mktsegment) AS segment, count(*) AS n_orders, count(DISTINCT lower(a.c_name)) AS customers, max(b.c_nationkey) AS nation
        FROM customer a JOIN (SELECT lower(c_name) AS name, c_nationkey FROM customer WHERE c_custkey % 3 <> 0) b ON lower(a.c_name) = b.name
        JOIN orders ON o_custkey = a.c_custkey WHERE lower(c_mktsegment) <> 'machinery' GROUP BY 1
    """,
    "f01_people_dedupe": """
        SELECT DISTINCT upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS first,
               upper(left(c_name, 1)) || lower(substr(c_name, 2)) AS last, c_custkey || '@example.org' AS email,
               '000-000-' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS phone, 'Nation ' || c_nationkey AS address
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "f02_chunk_split": """
        SELECT doc_id, CAST(i // size AS INTEGER) AS chunk, CAST(length(text) AS INTEGER) AS characters FROM (
            SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () // 7 AS size
            FROM documents) WHERE i < 7 * size
    """,
    "f03_chunk_keep": """
        SELECT doc_id, CAST(least(i // size, 6) AS INTEGER) AS chunk, CAST(length(text) AS INTEGER) AS characters FROM (
            SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () // 7 AS size
            FROM documents)
    """,
}
