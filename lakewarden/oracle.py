"""DuckDB SQL giving the expected result of each registered query, written independently of it."""

from __future__ import annotations

from lakewarden.functions.registration import ACCESS_DENIED_TEXT, ALREADY_REGISTERED_MESSAGE, NO_MESSAGE

_SALES = """
sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "SalesOrderNumber",
         CAST(l_linenumber AS VARCHAR) AS "SalesOrderLineNumber",
         strftime(o_orderdate, '%Y-%m-%d') AS "OrderDate",
         c_name AS "CustomerName",
         lower(replace(c_name, '#', '.')) || '@example.com' AS "Email",
         p_name AS "Item",
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS "Quantity",
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS "UnitPrice",
         CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS "Tax",
         CAST(year(o_orderdate) AS BIGINT) AS order_year
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
)"""

_SALES_ROWS = f"WITH {_SALES} SELECT * EXCLUDE (order_year) FROM sales"

# Bytes and lines of the order files: nine fields, eight commas and a newline per row.
_SALES_FILES = f"""
WITH {_SALES}
SELECT order_year,
       CAST(sum(strlen(concat_ws(',', "SalesOrderNumber", "SalesOrderLineNumber", "OrderDate", "CustomerName",
                                 "Email", "Item", "Quantity", "UnitPrice", "Tax")) + 1) AS BIGINT) AS n_bytes,
       count(*) AS n_lines
FROM sales
GROUP BY order_year"""

_INVENTORY = r"""
addresses AS (
  SELECT page_id, url, html,
         regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS raw
  FROM pages
),
entries AS (
  SELECT rtrim(raw, '/') AS path, raw LIKE '%/' AS is_dir, CAST(strlen(html) AS BIGINT) AS length
  FROM addresses
),
folders AS (
  SELECT path FROM entries WHERE is_dir
  UNION
  SELECT array_to_string(string_split(path, '/')[1:i], '/')
  FROM entries, unnest(range(1, len(string_split(path, '/')))) AS levels(i)
),
inventory AS (
  SELECT path, is_dir, length FROM entries WHERE NOT is_dir
  UNION ALL
  SELECT path, true, CAST(0 AS BIGINT) FROM folders
),
above AS (
  SELECT array_to_string(string_split(path, '/')[1:i], '/') AS dir, path, is_dir, length
  FROM inventory, unnest(range(1, len(string_split(path, '/')))) AS levels(i)
)"""

_CATALOG = """
catalog AS (
  SELECT 'gold_dev' AS catalog_name,
         lower(replace(p_brand, '#', '')) AS schema_name,
         'part_' || p_partkey AS name,
         CASE WHEN p_partkey % 5 < 3 THEN 'MANAGED' ELSE 'EXTERNAL' END AS table_type,
         CASE WHEN p_partkey % 11 = 0 THEN 'CSV' ELSE 'DELTA' END AS data_source_format,
         'abfss://gold@acct.dfs.core.windows.net/' || lower(replace(p_brand, '#', '')) || '/part_' || p_partkey
           AS storage_location
  FROM part
),
sources AS (
  SELECT *, 'uc_' || catalog_name || '_' || schema_name || '_' || name AS target FROM catalog
),
registered AS (
  SELECT CASE WHEN p_size <= 15 THEN 'uc_gold_dev_' || lower(replace(p_brand, '#', '')) || '_part_' || p_partkey
              WHEN p_size <= 25 THEN 'uc_gold_dev_' || lower(replace(p_brand, '#', '')) || '_old_part_' || p_partkey
              WHEN p_size <= 30 THEN 'uc_silver_dev_' || lower(replace(p_brand, '#', '')) || '_part_' || p_partkey
              WHEN p_size <= 35 THEN 'ucla_part_' || p_partkey
              ELSE 'archive_part_' || p_partkey END AS target
  FROM part
),
targets AS (
  SELECT target FROM registered
  WHERE starts_with(target, 'uc_gold_dev_') AND split_part(target, '_', 4) IN (SELECT schema_name FROM catalog)
)"""

_PLAN = f"""
{_CATALOG},
routed AS (
  SELECT s.*, coalesce(s.target, t.target) AS name_in_plan,
         CASE WHEN s.target IS NULL THEN 'delete'
              WHEN t.target IS NULL AND s.table_type = 'MANAGED' AND s.data_source_format = 'DELTA' THEN 'create'
              ELSE 'skip' END AS operation,
         CASE WHEN s.target IS NULL THEN 'gone'
              WHEN t.target IS NOT NULL THEN 'exists'
              WHEN s.table_type <> 'MANAGED' THEN 'type:' || s.table_type
              WHEN s.data_source_format <> 'DELTA' THEN 'format:' || s.data_source_format
              ELSE 'new' END AS reason,
         'https://acct.dfs.core.windows.net/gold' AS https,
         s.schema_name || '/' || s.name AS below
  FROM sources s FULL JOIN targets t ON s.target = t.target
)"""

_ATTEMPTS = f"""
recorded AS (
  SELECT 'uc_' || user_id || '_' || json_extract_string(props, '$.k') AS target, event_id AS attempt, event_type,
         CASE event_type WHEN 'view' THEN 201 WHEN 'click' THEN 400 WHEN 'error' THEN 403
                         WHEN 'purchase' THEN 429 ELSE 500 END AS http_status,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS kind
  FROM events
),
classified AS (
  SELECT target, attempt, http_status,
         CASE WHEN http_status = 201 THEN target END AS registered_name,
         CASE WHEN http_status <> 400 THEN '{NO_MESSAGE}'
              WHEN kind = 0 THEN '{ALREADY_REGISTERED_MESSAGE}'
              WHEN kind = 1 THEN '{ACCESS_DENIED_TEXT} was refused'
              ELSE 'Target path not found' END AS message,
         CASE WHEN http_status = 201 THEN 'created'
              WHEN http_status = 429 THEN 'throttled'
              WHEN http_status = 403 THEN 'denied'
              WHEN http_status = 400 AND kind = 0 THEN 'skipped'
              WHEN http_status = 400 AND kind = 1 THEN 'denied'
              ELSE 'failed' END AS outcome
  FROM recorded
)"""

ORACLE: dict[str, str] = {
    "csv_declared_roundtrip": _SALES_ROWS,
    "csv_inferred": """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
               o_orderstatus = 'O' AS is_open
        FROM orders""",
    "ingest_many_files": f"WITH {_SALES} SELECT order_year, count(*) AS n_rows FROM sales GROUP BY order_year",
    "ingest_rerun": f"""
        WITH {_SALES}
        SELECT * EXCLUDE (order_year) FROM sales
        UNION ALL BY NAME
        SELECT c_name AS "CustomerName", c_mktsegment AS "Item" FROM customer""",
    "load_csv_append": "SELECT o_orderkey, o_orderpriority, o_orderstatus = 'O' AS is_open FROM orders",
    "replace_registered": "SELECT c_custkey AS id, c_mktsegment AS label FROM customer",
    "copy_partitioned": """
        SELECT l_orderkey, l_linenumber, l_quantity, year(l_shipdate) || '/l_returnflag=' || l_returnflag AS folder
        FROM lineitem""",
    "copy_mixed_columns": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority
        FROM orders""",
    "copy_objects": _SALES_FILES,
    "inventory_live": f"""
        WITH {_INVENTORY}, placed AS (
          SELECT rtrim(raw, '/') || CASE WHEN raw LIKE '%/' THEN '/only_' || page_id
                   ELSE '/' || CASE WHEN page_id % 3 = 0 THEN '_' ELSE '' END || 'page_' || page_id END AS path,
                 raw LIKE '%/' AS is_dir,
                 CASE WHEN raw LIKE '%/' OR page_id % 7 = 0 THEN 0 ELSE strlen(html) END AS length
          FROM addresses
        )
        SELECT path, is_dir, CAST(length AS BIGINT) AS length FROM placed
        UNION ALL
        SELECT DISTINCT array_to_string(string_split(path, '/')[1:i], '/'), true, 0
        FROM placed, unnest(range(1, len(string_split(path, '/')))) AS levels(i)""",
    "dir_size_folder": f"""
        WITH {_INVENTORY}, first AS (SELECT min(split_part(path, '/', 1)) AS dir FROM inventory)
        SELECT dir, CAST(sum(length) AS BIGINT) AS bytes, round_even(sum(length) / 1048576.0, 2) AS size
        FROM inventory, first
        WHERE NOT is_dir AND starts_with(path, dir || '/')
        GROUP BY dir""",
    "empty_folders_below": f"""
        WITH {_INVENTORY}, kept AS (SELECT DISTINCT dir AS path FROM above WHERE NOT is_dir)
        SELECT path, len(string_split(path, '/')) AS depth, true AS empty_folder
        FROM folders ANTI JOIN kept USING (path)
        WHERE starts_with(path, (SELECT min(split_part(path, '/', 1)) || '/' FROM inventory))""",
    "exists_probe_few": f"""
        WITH {_INVENTORY}, requests AS (
          SELECT page_id, rtrim(raw, '/') AS path FROM addresses
          UNION ALL
          SELECT page_id, rtrim(raw, '/') || '/index.html' FROM addresses
        )
        SELECT page_id, path, path IN (SELECT path FROM inventory) AS exists FROM requests""",
    "schema_selection": f"""
        WITH {_CATALOG}
        SELECT 'silver_dev' AS catalog_name, schema_name, name FROM catalog
        WHERE right(schema_name, 1) IN ('1', '3')""",
    "sync_ownership": f"""
        WITH {_CATALOG}, owned AS (
          SELECT lower(replace(p_brand, '#', '')) AS brand, p_partkey, p_size, p_size BETWEEN 16 AND 25 AS outdated FROM part
        ), known AS (
          SELECT 'uc_gold_dev_' || brand || '_part_' || p_partkey AS target FROM owned WHERE p_size <= 15
        )
        SELECT s.target,
               CASE WHEN k.target IS NULL AND s.table_type = 'MANAGED' AND s.data_source_format = 'DELTA'
                    THEN 'create' ELSE 'skip' END AS operation,
               CASE WHEN k.target IS NOT NULL THEN 'exists'
                    WHEN s.table_type <> 'MANAGED' THEN 'type:' || s.table_type
                    WHEN s.data_source_format <> 'DELTA' THEN 'format:' || s.data_source_format
                    ELSE 'new' END AS reason
        FROM sources s LEFT JOIN known k ON s.target = k.target
        UNION ALL
        SELECT 'uc_gold_dev_' || brand || '_old_part_' || p_partkey,
               CASE p_partkey % 3 WHEN 0 THEN 'delete' ELSE 'skip' END,
               CASE p_partkey % 3 WHEN 0 THEN 'gone' ELSE 'unknown owner' END
        FROM owned WHERE outdated AND p_partkey % 3 <> 1""",
    "sync_conflicts": f"""
        WITH {_CATALOG}, doubled AS (
          SELECT target, schema_name, table_type, data_source_format FROM sources
          UNION ALL
          SELECT target, schema_name || '_part', table_type, data_source_format FROM sources
        ), claimed AS (
          SELECT DISTINCT target FROM registered WHERE starts_with(target, 'uc_gold_dev_')
        )
        SELECT d.target, schema_name,
               CASE WHEN c.target IS NOT NULL THEN 'skip' ELSE 'conflict' END AS operation,
               CASE WHEN c.target IS NOT NULL THEN 'exists' ELSE 'ambiguous name' END AS reason
        FROM doubled d LEFT JOIN claimed c ON d.target = c.target
        UNION ALL
        SELECT target, NULL, 'delete', 'gone' FROM claimed ANTI JOIN sources USING (target)""",
    "sync_outcomes": """
        WITH brands AS (SELECT DISTINCT lower(replace(p_brand, '#', '')) AS brand FROM part)
        SELECT 'first' AS run, count(*) AS created, 0 AS skipped, 0 AS failed, 0 AS deleted FROM brands
        UNION ALL
        SELECT 'second', 0, count(*) FILTER (brand NOT LIKE 'brand2%'), 0, count(*) FILTER (brand LIKE 'brand2%')
        FROM brands""",
    "append_twice": "SELECT o_orderkey, o_orderstatus FROM orders",
    "overwrite_last_wins": "SELECT c_custkey AS id, c_mktsegment AS label FROM customer",
    "preview_top5": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5",
    "copy_dataset": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem",
    "binary_scan": _SALES_FILES,
    "path_parse": f"""
        WITH {_INVENTORY}, storage AS (
          SELECT page_id, raw, url LIKE 'https:%' AS bare,
                 CASE WHEN url LIKE 'https:%' THEN 'abfss://' ELSE 'abfss://web@' END || raw AS path,
                 split_part(raw, '/', 1) AS host
          FROM addresses
        ), named AS (
          SELECT *, substr(raw, strlen(host) + 2) AS rest FROM storage
        )
        SELECT page_id,
               CASE WHEN NOT bare THEN 'web' END AS container,
               CASE WHEN NOT bare THEN rest END AS directory,
               CASE WHEN NOT bare THEN 'abfss://web@' || host || '/' END AS url,
               CASE WHEN NOT bare THEN host END AS account,
               CASE WHEN NOT bare THEN rest END AS subpath,
               CASE WHEN NOT bare THEN 'https://' || host || '/web' END AS https,
               replace(path, '/', '|') AS components
        FROM named""",
    "path_build": f"""
        WITH {_INVENTORY}, based AS (
          SELECT page_id, raw,
                 'abfss://' || split_part(raw, '/', 2) || '@' || split_part(raw, '.', 1)
                   || '.dfs.core.windows.net' AS base
          FROM addresses
        )
        SELECT page_id, base, base || '/' || raw AS path FROM based""",
    "path_levels": f"""
        WITH {_INVENTORY}, parts AS (SELECT path, is_dir, string_split(path, '/') AS p FROM inventory)
        SELECT path, is_dir, p[1] AS "L0", p[2] AS "L1", p[3] AS "L2" FROM parts""",
    "inventory_export": f"WITH {_INVENTORY} SELECT path, is_dir, length FROM inventory",
    "inventory_listing": f"""
        SELECT 'order_year=' || order_year AS dir, n_bytes AS bytes FROM ({_SALES_FILES})""",
    "dir_size_top": f"""
        WITH {_INVENTORY}
        SELECT split_part(path, '/', 1) AS dir,
               CAST(coalesce(sum(length) FILTER (WHERE NOT is_dir), 0) AS BIGINT) AS bytes
        FROM inventory GROUP BY 1""",
    "dir_size_root": f"""
        WITH {_INVENTORY}
        SELECT '' AS dir, CAST(sum(length) AS BIGINT) AS bytes,
               round_even(sum(length) / 1073741824.0, 2) AS size
        FROM inventory WHERE NOT is_dir""",
    "dir_size_all": f"""
        WITH {_INVENTORY}, known AS (
          SELECT path AS dir, CAST(0 AS BIGINT) AS length FROM folders
          UNION ALL
          SELECT dir, length FROM above WHERE NOT is_dir
        ), totals AS (
          SELECT dir, CAST(sum(length) AS BIGINT) AS bytes FROM known GROUP BY dir
        )
        SELECT dir, bytes, round_even(bytes / 1048576.0, 2) AS size FROM totals""",
    "max_depth": f"""
        WITH {_INVENTORY}
        SELECT max(len(string_split(path, '/'))) AS max_depth FROM inventory""",
    "level_stats": f"""
        WITH {_INVENTORY}, members AS (
          SELECT path AS dir, length FROM inventory WHERE is_dir
          UNION ALL
          SELECT dir, length FROM above
        )
        SELECT dir, len(string_split(dir, '/')) - 1 AS level, count(*) AS rows, max(length) AS max_length
        FROM members GROUP BY dir""",
    "level_values": f"""
        WITH {_INVENTORY}, parts AS (SELECT string_split(path, '/') AS p FROM inventory)
        SELECT DISTINCT i - 1 AS level, p[i] AS value FROM parts, unnest(range(1, len(p) + 1)) AS levels(i)""",
    "folder_flags": f"""
        WITH {_INVENTORY}, kept AS (SELECT DISTINCT dir FROM above WHERE NOT is_dir)
        SELECT path, len(string_split(path, '/')) AS depth, dir IS NULL AS empty_folder
        FROM folders LEFT JOIN kept ON path = dir""",
    "empty_folders": f"""
        WITH {_INVENTORY}, kept AS (SELECT DISTINCT dir AS path FROM above WHERE NOT is_dir)
        SELECT path, len(string_split(path, '/')) AS depth, true AS empty_folder
        FROM folders ANTI JOIN kept USING (path)
        ORDER BY depth DESC, path""",
    "exists_probe": f"""
        WITH {_INVENTORY}, requests AS (
          SELECT page_id, rtrim(raw, '/') AS path FROM addresses
          UNION ALL
          SELECT page_id, rtrim(raw, '/') || '/index.html' FROM addresses
        )
        SELECT page_id, path, path IN (SELECT path FROM inventory) AS exists FROM requests""",
    "catalog_snapshot": f"WITH {_CATALOG} SELECT * FROM catalog",
    "union_schemas": f"WITH {_CATALOG} SELECT schema_name, name, table_type FROM catalog",
    "targets_in_folder": f"WITH {_INVENTORY} SELECT path AS target FROM inventory WHERE path NOT LIKE '%/%'",
    "sync_semi": f"WITH {_CATALOG} SELECT target FROM targets SEMI JOIN sources USING (target)",
    "sync_deletions": f"WITH {_CATALOG} SELECT target FROM targets ANTI JOIN sources USING (target)",
    "sync_creations": f"WITH {_CATALOG} SELECT target FROM sources ANTI JOIN targets USING (target)",
    "sync_diff": f"""
        WITH {_CATALOG}
        SELECT coalesce(s.target, t.target) AS target,
               CASE WHEN s.target IS NULL THEN 'delete' WHEN t.target IS NULL THEN 'create' ELSE 'skip' END
                 AS operation
        FROM sources s FULL JOIN targets t ON s.target = t.target""",
    "sync_plan": f"""
        WITH {_PLAN}
        SELECT name_in_plan AS target, operation, reason,
               CASE WHEN operation <> 'delete' THEN https END AS location,
               CASE WHEN operation <> 'delete' THEN below END AS subpath,
               CASE WHEN operation = 'create' THEN
                 '{{"path":"Tables","name":"' || name_in_plan || '","target":{{"adlsGen2":{{"location":"' || https
                 || '","subpath":"' || below || '","connectionId":"connection-1"}}}}}}' END AS payload
        FROM routed""",
    "sync_report": f"WITH {_PLAN} SELECT operation, count(*) AS n FROM routed GROUP BY operation",
    "attempt_classes": f"WITH {_ATTEMPTS} SELECT * FROM classified",
    "attempt_outcomes": f"WITH {_ATTEMPTS} SELECT outcome, count(*) AS n FROM classified GROUP BY outcome",
    "removal_outcomes": """
        SELECT CASE event_type WHEN 'view' THEN 'deleted' WHEN 'click' THEN 'already_absent'
                               WHEN 'purchase' THEN 'throttled' ELSE 'failed' END AS outcome,
               count(*) AS n
        FROM events GROUP BY 1""",
    "run_counters": f"""
        WITH {_ATTEMPTS}, settled AS (
          SELECT target, arg_min(outcome, attempt) FILTER (outcome IN ('created', 'skipped')) AS outcome
          FROM classified GROUP BY target
        )
        SELECT count(*) FILTER (outcome = 'created') AS created,
               count(*) FILTER (outcome = 'skipped') AS skipped,
               count(*) FILTER (outcome IS NULL)
                 + (SELECT count(*) FROM events WHERE event_type NOT IN ('view', 'click')) AS failed,
               (SELECT count(*) FROM events WHERE event_type = 'view') AS deleted
        FROM settled""",
    "register_roundtrip": """
        SELECT 'uc_gold_dev_' || lower(replace(p_brand, '#', '')) || '_part' AS target, count(*) AS n_rows
        FROM part
        WHERE lower(replace(p_brand, '#', '')) NOT LIKE 'brand2%'
        GROUP BY 1""",
}
