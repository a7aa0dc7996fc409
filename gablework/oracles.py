"""DuckDB SQL that gives the same rows as the query of the same name.

Queries without an entry fit models or projections, which SQL cannot express.
"""

from __future__ import annotations

_DOCUMENTS = """
  SELECT d.*, l.quality, l.toxic,
         CASE WHEN l.quality = 1 THEN 'high' WHEN l.quality = 0 THEN 'low' END AS grade
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
_PRICED = "SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net FROM lineitem"
_LINEITEM_KEY = "l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey"


def _hash(key: str, seed: int, modulus: int) -> str:
    return f"(CAST('0x' || substr(md5({key} || '|{seed}'), 1, 8) AS BIGINT) % {modulus})"


def _look_along(function: str, frame: str) -> str:
    fills = ", ".join(
        f"{function}({c} IGNORE NULLS) OVER (ORDER BY doc_id ROWS BETWEEN {frame}) AS {c}"
        for c in ("quality", "toxic", "grade")
    )
    return f"SELECT doc_id, lang, {fills} FROM ({_DOCUMENTS})"


def _missing_counts() -> str:
    columns = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic", "grade")
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing, count(*) AS n_rows FROM docs"
        for c in columns
    )


def _chi_squared(feature: str) -> str:
    return f"""
    SELECT '{feature}' AS feature,
           round(sum((cells.n - r.n * c.n / t.n) * (cells.n - r.n * c.n / t.n) / (r.n * c.n / t.n)), 4) AS statistic,
           CAST((any_value(r.k) - 1) * (any_value(c.k) - 1) AS BIGINT) AS degrees_of_freedom
    FROM (SELECT *, count(*) OVER () AS k FROM (SELECT {feature} AS v, count(*)::DOUBLE AS n FROM binned GROUP BY 1)) r
    JOIN (SELECT *, count(*) OVER () AS k FROM (SELECT decile, count(*)::DOUBLE AS n FROM binned GROUP BY 1)) c ON TRUE
    JOIN (SELECT count(*)::DOUBLE AS n FROM binned) t ON TRUE
    JOIN LATERAL (
      SELECT coalesce(max(x.n), 0) AS n FROM (
        SELECT {feature} AS v, decile, count(*)::DOUBLE AS n FROM binned GROUP BY 1, 2) x
      WHERE x.v = r.v AND x.decile = c.decile) cells ON TRUE
    """


_FEATURES = {
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "l_tax": "l_tax",
    "line_number": "l_linenumber",
    "unit_price": "l_extendedprice / l_quantity",
    "ship_year": "year(l_shipdate)",
    "ship_month": "month(l_shipdate)",
    "is_returned": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "is_open": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
}


def _f_tests() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, corr({value}, net) AS r, count(*) AS n FROM priced"
        for name, value in _FEATURES.items()
    )


def _buckets(count: int, column: str) -> str:
    shares = ", ".join(str(i / count) for i in range(1, count))
    return f"list_distinct(quantile_disc({column}, [{shares}]))"


ORACLES: dict[str, str] = {
    "csv_scan": """
        SELECT o_orderkey AS Id, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS order_day, nullif(o_orderpriority, '5-LOW') AS o_orderpriority
        FROM orders""",
    "csv_scan_named": "SELECT c_custkey AS Id, c_acctbal AS Balance FROM customer",
    "csv_scan_dirty": """
        SELECT p_partkey AS part, CASE WHEN p_size > 1 THEN p_size::DOUBLE END AS size,
               CASE WHEN p_size > 1 THEN p_size > 40 END AS plus, (p_partkey + 10000)::DOUBLE AS stock,
               round(p_retailprice * 100, 2) AS price
        FROM part""",
    "csv_scan_semicolon": "SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier",
    "csv_scan_quoted": "SELECT doc_id, text FROM documents",
    "csv_scan_many": "SELECT c_custkey, c_nationkey::BIGINT AS c_nationkey FROM customer",
    "parse_number_text": """
        SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END AS balance,
               c_mktsegment = 'MACHINERY' AS plus
        FROM customer""",
    "table_shape": f"""
        WITH docs AS ({_DOCUMENTS})
        SELECT count(*) AS n_rows, 8::INTEGER AS n_columns,
               ((count(text) < 0.8 * count(*))::INTEGER + (count(lang) < 0.8 * count(*))::INTEGER
                + (count(source) < 0.8 * count(*))::INTEGER + (count(n_chars) < 0.8 * count(*))::INTEGER
                + (count(quality) < 0.8 * count(*))::INTEGER + (count(toxic) < 0.8 * count(*))::INTEGER
                + (count(grade) < 0.8 * count(*))::INTEGER)::INTEGER AS n_dropped
        FROM docs""",
    "drop_sparse_cols": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "drop_cols": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "conform_schema": """
        SELECT o_orderkey AS pedido, o_custkey::INTEGER AS cliente, o_orderstatus AS estado,
               o_totalprice::FLOAT::DOUBLE AS importe
        FROM orders""",
    "select_numeric": f"SELECT doc_id, n_chars, quality, toxic FROM ({_DOCUMENTS})",
    "select_strings": "SELECT p_name, p_brand, p_type FROM part",
    "derive_cols": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               round(l_quantity + l_extendedprice + l_tax, 6) AS total,
               round(l_quantity + l_linenumber * 0.5, 6) AS half_weighted,
               round((l_discount + l_tax) / 2, 6) AS midpoint, l_extendedprice AS price
        FROM lineitem""",
    "preview_topk": """
        SELECT p_partkey, p_brand, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5""",
    "null_profile": f"""
        WITH docs AS ({_DOCUMENTS})
        SELECT column_name, round(n_missing / n_rows * 100, 6) AS pct_missing
        FROM ({_missing_counts()}) WHERE n_missing > 0 ORDER BY pct_missing, column_name""",
    "null_counts_top5": f"""
        WITH docs AS ({_DOCUMENTS})
        SELECT column_name, n_missing FROM ({_missing_counts()}) ORDER BY n_missing DESC, column_name LIMIT 5""",
    "group_mean_sorted": """
        SELECT p_brand, round(avg(p_retailprice), 6) AS mean_p_retailprice
        FROM part GROUP BY p_brand ORDER BY avg(p_retailprice), p_brand""",
    "rmse_baseline": f"""
        WITH rows AS (SELECT net, {_hash(_LINEITEM_KEY, 666, 1000000)} < 700000 AS is_train FROM ({_PRICED})),
             guess AS (SELECT avg(net) AS mean FROM rows WHERE is_train)
        SELECT count(*) AS n, round(sqrt(avg((net - mean) * (net - mean))), 4) AS rmse
        FROM rows JOIN guess ON TRUE WHERE NOT is_train""",
    "rmse_by_group": f"""
        SELECT year(l_shipdate)::INTEGER AS ship_year, count(*) AS n,
               round(sqrt(avg((net - l_extendedprice) * (net - l_extendedprice))), 4) AS rmse
        FROM ({_PRICED}) GROUP BY 1""",
    "histogram": """
        WITH ends AS (
               SELECT floor(min(l_extendedprice) / 2500) * 2500 AS lo, max(l_extendedprice) AS hi FROM lineitem),
             bins AS (
               SELECT unnest(range(0, greatest(1, ceil((hi - lo) / 2500 - 1e-7))::BIGINT)) AS bin, lo FROM ends),
             counts AS (
               SELECT greatest(ceil((l_extendedprice - lo) / 2500 - 1e-7) - 1, 0)::BIGINT AS bin, count(*) AS n
               FROM lineitem JOIN ends ON TRUE GROUP BY 1)
        SELECT bin, round(lo + bin * 2500, 6) AS lower, round(lo + (bin + 1) * 2500, 6) AS upper,
               coalesce(n, 0) AS n
        FROM bins LEFT JOIN counts USING (bin)""",
    "histogram_rounded": """
        WITH seen AS (
               SELECT min(l_quantity) AS low, max(l_quantity) AS high,
                      (max(l_quantity) - min(l_quantity)) / ceil(log2(count(*)) + 1) AS raw FROM lineitem),
             powers AS (SELECT *, pow(10, floor(log10(raw))) AS p FROM seen),
             widths AS (
               SELECT *, CASE WHEN NOT 2 * p - raw < 1.5 * (raw - p) THEN p
                              WHEN NOT 5 * p - raw < 2.75 * (raw - 2 * p) THEN 2 * p
                              WHEN NOT 10 * p - raw < 1.5 * (raw - 5 * p) THEN 5 * p ELSE 10 * p END AS w
               FROM powers),
             ends AS (
               SELECT w, floor(low / w + 1e-7) * w AS lo,
                      (ceil(high / w - 1e-7) - floor(low / w + 1e-7))::BIGINT AS k FROM widths),
             bins AS (SELECT unnest(range(0, k)) AS bin, lo, w FROM ends),
             counts AS (
               SELECT greatest(ceil((l_quantity - lo) / w - 1e-7) - 1, 0)::BIGINT AS bin, count(*) AS n
               FROM lineitem JOIN ends ON TRUE GROUP BY 1)
        SELECT bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper, coalesce(n, 0) AS n
        FROM bins LEFT JOIN counts USING (bin)""",
    "attach_target": """
        SELECT o_orderkey, f.o_custkey, t.o_totalprice
        FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P') f
        FULL JOIN (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW') t
        USING (o_orderkey)""",
    "stack_datasets": """
        SELECT o_orderkey, o_custkey, o_totalprice, 'first' AS source, 0::INTEGER AS source_rank,
               NULL::VARCHAR AS o_orderpriority
        FROM orders WHERE year(o_orderdate) < 1998
        UNION ALL
        SELECT o_orderkey, o_custkey, NULL, 'second', 1, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998""",
    "fill_zero": f"""
        SELECT doc_id, lang, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic, grade
        FROM ({_DOCUMENTS})""",
    "fill_mean": f"""
        SELECT doc_id, lang, round(coalesce(quality, avg(quality) OVER ()), 6) AS quality,
               round(coalesce(toxic, avg(toxic) OVER ()), 6) AS toxic, grade
        FROM ({_DOCUMENTS})""",
    "fill_median": """
        WITH partly AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total FROM orders)
        SELECT o_orderkey, round(coalesce(total, (SELECT median(total) FROM partly)), 4) AS o_totalprice FROM partly""",
    "fill_literal": f"""
        SELECT doc_id, lang, quality, toxic, coalesce(grade, 'None') AS grade FROM ({_DOCUMENTS})""",
    "ffill": _look_along("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW"),
    "bfill": _look_along("first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING"),
    "encode_mapping": """
        SELECT o_orderkey, o_orderpriority,
               CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                                    WHEN '4-NOT SPECIFIED' THEN 4 END::INTEGER AS priority_code
        FROM orders""",
    "encode_mapping_int": """
        SELECT p_partkey, p_size, CASE WHEN p_size BETWEEN 1 AND 25 THEN 2 * p_size END::INTEGER AS size_code FROM part""",
    "encode_target_order_large": """
        WITH ranked AS (
          SELECT o_custkey, row_number() OVER (ORDER BY avg(o_orderkey), o_custkey)::INTEGER AS customer_code
          FROM orders GROUP BY o_custkey)
        SELECT o_orderkey, o_custkey, customer_code FROM orders JOIN ranked USING (o_custkey)""",
    "encode_target_order": """
        WITH ranked AS (
          SELECT p_brand, row_number() OVER (ORDER BY avg(p_retailprice), p_brand)::INTEGER AS brand_code
          FROM part GROUP BY p_brand)
        SELECT p_partkey, p_brand, p_retailprice, brand_code FROM part JOIN ranked USING (p_brand)""",
    "complete_gate": f"""
        SELECT doc_id, coalesce(lang, 'None') AS lang, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
               coalesce(grade, 'None') AS grade
        FROM ({_DOCUMENTS})""",
    "csv_scan_readr": """
        WITH t AS (
          SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS placed FROM orders)
        SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS open,
               date_diff('day', DATE '1990-01-01', o_orderdate::DATE)::INTEGER AS days,
               CASE WHEN o_orderkey % 2 = 0 THEN floor(epoch(placed) % 86400 / 60) * 60 ELSE epoch(placed) % 86400 END::DOUBLE AS seconds,
               CASE WHEN o_orderkey % 3 = 0 THEN epoch(placed) ELSE epoch(date_trunc('day', placed)) END::BIGINT AS moment,
               strftime(o_orderdate, '%Y-%m') AS month
        FROM t""",
    "hash_split": f"""
        SELECT o_orderkey,
               CASE WHEN {_hash("o_orderkey", 666, 1000000)} < 700000 THEN 'train' ELSE 'test' END AS part
        FROM orders""",
    "hash_kfold": f"""
        SELECT o_orderkey, {_hash("o_orderkey", 667, 3)}::INTEGER AS fold FROM orders""",
    "assemble": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS f0, l_extendedprice AS f1,
               l_discount AS f2, l_tax AS f3
        FROM lineitem""",
    "quantile_bucket": f"""
        WITH cuts AS (SELECT {_buckets(20, "l_extendedprice")} AS edges FROM lineitem)
        SELECT (SELECT count(*) FROM unnest(edges) u(e) WHERE e <= l_extendedprice)::INTEGER AS bucket,
               count(*) AS n, min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest
        FROM lineitem JOIN cuts ON TRUE GROUP BY 1""",
    "standardize": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS l_quantity,
               round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER (), 6)
                 AS l_extendedprice,
               round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 6) AS l_discount,
               round((l_tax - avg(l_tax) OVER ()) / stddev_samp(l_tax) OVER (), 6) AS l_tax
        FROM lineitem""",
    "minmax_scale": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               round((l_quantity - min(l_quantity) OVER ())
                 / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity,
               round((l_extendedprice - min(l_extendedprice) OVER ())
                 / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS l_extendedprice,
               round((l_discount - min(l_discount) OVER ())
                 / (max(l_discount) OVER () - min(l_discount) OVER ()), 6) AS l_discount,
               round((l_tax - min(l_tax) OVER ()) / (max(l_tax) OVER () - min(l_tax) OVER ()), 6) AS l_tax
        FROM lineitem""",
    "chi2_stat": f"""
        WITH priced AS ({_PRICED}),
             cuts AS (SELECT {_buckets(10, "net")} AS edges FROM priced),
             binned AS (
               SELECT l_quantity, l_discount, l_tax, l_linenumber,
                      (SELECT count(*) FROM unnest(edges) u(e) WHERE e <= net) AS decile
               FROM priced JOIN cuts ON TRUE)
        {" UNION ALL ".join(_chi_squared(f) for f in ("l_quantity", "l_discount", "l_tax", "l_linenumber"))}""",
    "select_features": f"""
        WITH priced AS ({_PRICED}),
             tests AS (SELECT feature, r * r / (1 - r * r) * (n - 2) AS f FROM ({_f_tests()}))
        SELECT feature, round(log10(f), 8) AS log10_f, row_number() OVER (ORDER BY f DESC) <= 5 AS kept FROM tests""",
    "clean_chain": """
        WITH stacked AS (
               SELECT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS source_rank, d.doc_id, source, n_chars, quality, toxic,
                      CASE WHEN quality = 1 THEN 'high' WHEN quality = 0 THEN 'low' END AS grade
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
             sources AS (
               SELECT source, row_number() OVER (ORDER BY avg(n_chars), source) AS source_code
               FROM stacked GROUP BY source),
             filled AS (
               SELECT source_rank, doc_id, source, n_chars, coalesce(toxic, 0) AS toxic,
                      coalesce(quality, avg(quality) OVER ()) AS quality,
                      coalesce(last_value(grade IGNORE NULLS) OVER (
                        ORDER BY source_rank, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'None') AS grade
               FROM stacked)
        SELECT source_rank::INTEGER AS source_rank, doc_id, n_chars::DOUBLE AS length, toxic::INTEGER AS toxic,
               round(quality, 6) AS quality,
               CASE grade WHEN 'None' THEN 0 WHEN 'low' THEN 1 ELSE 2 END::INTEGER AS grade_code,
               source_code::INTEGER AS source_code, round(n_chars::DOUBLE * 0.5 + toxic * 100, 6)::DOUBLE AS weight
        FROM filled JOIN sources USING (source)""",
}
