"""DuckDB twins of the stand-in views in ``fixtures`` (for oracle SQL only).

``with_views(body, [...])`` prefixes a query with the CTEs it names, so an
oracle string runs against the bare driver tables.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "ticks": """
SELECT CASE WHEN user_id % 2 = 0 THEN 'STOCKA' ELSE 'STOCKB' END AS symbol,
       epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS time,
       CASE WHEN event_type = 'purchase' THEN 0.0 ELSE value + 100 END AS bid,
       CASE WHEN event_type = 'purchase' THEN 0.0 ELSE CAST(event_id % 10 + 1 AS DOUBLE) END AS bidsz,
       CASE WHEN event_type = 'purchase' THEN 0.0
            ELSE value + 100 + CAST(event_id % 5 + 1 AS DOUBLE) * CAST(0.1 AS DOUBLE) END AS ask,
       CASE WHEN event_type = 'purchase' THEN 0.0 ELSE CAST(event_id % 7 + 1 AS DOUBLE) END AS asksz,
       CASE WHEN event_type = 'purchase' THEN value + 100 ELSE 0.0 END AS trdpx,
       CASE WHEN event_type = 'purchase' THEN CAST(event_id % 4 + 1 AS DOUBLE) ELSE 0.0 END AS trdsz,
       CASE WHEN event_type = 'purchase' THEN (CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE -1.0 END)
            ELSE 0.0 END AS trdsd
FROM events""",
    "returns_panel": """
SELECT date, uspn, weight, price,
       price / lag(price) OVER (PARTITION BY uspn ORDER BY date) - 1 AS ret
FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS uspn,
             CAST(count(*) AS DOUBLE) AS weight, avg(o_totalprice) AS price
      FROM orders GROUP BY 1, 2)""",
    "macro_series": """
SELECT 'GDP' AS series, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date, sum(o_totalprice) AS value
FROM orders GROUP BY 2
UNION ALL
SELECT 'CPIAUCSL', CAST(date_trunc('month', l_shipdate) AS DATE), sum(l_extendedprice) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'BAA10YM', CAST(date_trunc('month', l_shipdate) AS DATE), avg(l_discount) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'DGS3MO', CAST(o_orderdate AS DATE), avg(o_totalprice) FROM orders GROUP BY 2
UNION ALL
SELECT 'DGS10', CAST(l_shipdate AS DATE), avg(l_tax) + 0.01 FROM lineitem GROUP BY 2""",
    "transactions": """
SELECT event_id AS row_id, user_id AS account, ts, event_type AS merchant_category,
       CAST(floor(value / 25) * 25 AS DOUBLE) AS amount,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) // 10 AS BIGINT) AS balance,
       1000.0 - value AS available,
       event_type = 'error' AS is_fraud
FROM events""",
    "reg_table": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice AS label,
       l_quantity, l_discount, l_tax, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, l_returnflag
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "dataset_family": """
SELECT l_suppkey AS dataset_id, l_quantity AS x, l_extendedprice AS y, l_orderkey, l_linenumber, l_partkey
FROM lineitem""",
    "points": """
SELECT vec_id AS id,
       list_transform(range(0, 16), lambda i: [CAST(embedding[i * 4 + 1] AS DOUBLE), CAST(embedding[i * 4 + 2] AS DOUBLE),
                                          CAST(embedding[i * 4 + 3] AS DOUBLE), abs(CAST(embedding[i * 4 + 4] AS DOUBLE))]) AS points,
       label,
       (['cubic', 'orthorhombic', 'tetragonal', 'monoclinic', 'triclinic', 'hexagonal', 'trigonal',
         'trivial*', 'TI*', 'SM*'])[label + 1] AS category
FROM embeddings""",
    "scores": """
SELECT doc_id, (doc_id * 7919) % 100 / 100.0 AS p1, quality AS target,
       CAST((row_number() OVER (ORDER BY doc_id) - 1) // 32 AS BIGINT) AS batch
FROM labels""",
    "docs_lines": """
SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents""",
    "docs_labeled": """
SELECT d.doc_id AS id, d.text, CAST(l.quality AS DOUBLE) AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "page_items": """
SELECT page_id, unnest(generate_series(1, len(h))) AS pos, unnest(h) AS href, unnest(n) AS name
FROM (SELECT page_id,
             regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS h,
             regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS n
      FROM pages)
WHERE len(h) > 0""",
    "materials": """
SELECT p_partkey AS material_id, p_name, p_brand, p_type, p_size, p_retailprice,
       EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R'
               AND l_quantity > 45) AS has_band
FROM part""",
    "nan_nulls": """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer""",
}


def with_views(body: str, names: list[str] | tuple[str, ...] = (),
               extra: list[tuple[str, str]] | tuple = ()) -> str:
    """``WITH v1 AS (...), ... <body>``; ``extra`` adds (name, sql) CTEs after the views."""
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in names] + [f"{n} AS ({q}\n)" for n, q in extra]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
