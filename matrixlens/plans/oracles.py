"""DuckDB SQL for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

# ---- sources -----------------------------------------------------------------------------

DOCS = """docs AS (SELECT d.doc_id AS _pos, 'doc_' || d.doc_id AS _index, d.lang, d.source, d.n_chars, l.quality, l.toxic
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
EVENTS = """ev AS (SELECT event_id AS _pos, event_type, value, CASE WHEN value < 5 THEN NULL ELSE value END AS partial,
 props FROM events)"""
EMB = """emb AS (SELECT vec_id AS row_pos, generate_subscripts(embedding, 1) - 1 AS col_pos,
 CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""
TRADE = """stored AS (SELECT l_suppkey AS row_pos, l_partkey AS col_pos, sum(l_quantity) AS quantity,
 sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1, 2),
trade AS (SELECT s.s_suppkey AS row_pos, p.p_partkey AS col_pos, 'part_' || p.p_partkey AS feature, s.s_acctbal, s.s_nationkey,
 p.p_type, p.p_brand, coalesce(c.quantity, 0) AS quantity, coalesce(c.revenue, 0) AS revenue
 FROM supplier s CROSS JOIN part p LEFT JOIN stored c ON c.row_pos = s.s_suppkey AND c.col_pos = p.p_partkey)"""
LEAD_SUPPLIER = """edges AS (SELECT l.l_suppkey AS i, m.j, CAST(count(*) AS DOUBLE) AS value FROM lineitem l
 JOIN (SELECT l_partkey, min(l_suppkey) AS j FROM lineitem GROUP BY 1) m ON l.l_partkey = m.l_partkey GROUP BY 1, 2),
pairs AS (SELECT a.s_suppkey AS i, b.s_suppkey AS j, a.s_acctbal AS i_bal, b.s_acctbal AS j_bal, coalesce(e.value, 0) AS value
 FROM supplier a CROSS JOIN supplier b LEFT JOIN edges e ON e.i = a.s_suppkey AND e.j = b.s_suppkey)"""

LEAD_PART = """edges AS (SELECT l.l_partkey AS i, m.j, CAST(count(*) AS DOUBLE) AS value FROM lineitem l
 JOIN (SELECT l_orderkey, min(l_partkey) AS j FROM lineitem GROUP BY 1) m ON l.l_orderkey = m.l_orderkey GROUP BY 1, 2),
pairs AS (SELECT a.p_partkey AS row_pos, coalesce(e.value, 0) AS value
 FROM part a CROSS JOIN part b LEFT JOIN edges e ON e.i = a.p_partkey AND e.j = b.p_partkey)"""

# ---- statistics --------------------------------------------------------------------------

# Decimals of means are chosen so that exact ties, which summation order may tip, do not occur.
_CELL_STATS = """count(x) AS "count", round(avg(x), 5) AS mean, round(stddev_pop(x), 4) AS std, round(min(x), 6) AS "min",
 round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75,
 round(max(x), 6) AS "max\""""


def _numeric(source: str, columns: dict[str, str]) -> list[str]:
    return [
        f"""SELECT '{name}' AS "column", {_CELL_STATS}, count(*) - count(x) AS nan_count, CAST(NULL AS BIGINT) AS "unique",
 CAST(NULL AS VARCHAR) AS top, CAST(0 AS BIGINT) AS freq, TRUE AS is_numeric
 FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {source})"""
        for name, expr in columns.items()
    ]


def _categorical(source: str, columns: dict[str, str]) -> list[str]:
    nothing = ", ".join(f'CAST(NULL AS DOUBLE) AS "{c}"' for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return [
        f"""SELECT '{name}' AS "column", (SELECT count(CAST({expr} AS VARCHAR)) FROM {source}) AS "count", {nothing},
 (SELECT count(*) - count(CAST({expr} AS VARCHAR)) FROM {source}) AS nan_count, count(*) AS "unique",
 first(v ORDER BY n DESC, v) AS top, coalesce(max(n), 0) AS freq, FALSE AS is_numeric
 FROM (SELECT CAST({expr} AS VARCHAR) AS v, count(*) AS n FROM {source} WHERE ({expr}) IS NOT NULL GROUP BY 1)"""
        for name, expr in columns.items()
    ]


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _union(parts: list[str], *ctes: str) -> str:
    return (f"WITH {', '.join(ctes)} " if ctes else "") + " UNION ALL ".join(parts)


def _cells(ctes: str, source: str, x: str, where: str = "TRUE", by: str = "", nan_count: bool = False) -> str:
    keys = f"{by}, " if by else ""
    missing = ", count(*) - count(x) AS nan_count" if nan_count else ""
    inner = f"SELECT {keys}{x} AS x FROM {source} WHERE {where}"
    return f"WITH {ctes} SELECT {keys}{_CELL_STATS}{missing} FROM ({inner}) {f'GROUP BY {by}' if by else ''}"


def _mean_digits(digits: int, sql: str) -> str:
    return sql.replace("round(avg(x), 5)", f"round(avg(x), {digits})")


def _feature_rows(ctes: str, source: str, x: str, where: str) -> str:
    return f"""WITH {ctes} SELECT feature AS "column", {_CELL_STATS}, count(*) - count(x) AS nan_count,
 CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(0 AS BIGINT) AS freq, TRUE AS is_numeric
 FROM (SELECT feature, {x} AS x FROM {source} WHERE {where}) GROUP BY feature"""


def _counts(source: str, columns: dict[str, str], ctes: str) -> str:
    return _union(
        [
            f"""SELECT '{name}' AS "column", CAST({expr} AS VARCHAR) AS value, count(*) AS "count" FROM {source} GROUP BY 2"""
            for name, expr in columns.items()
        ],
        ctes,
    )


_FEATURES = "(feature GLOB 'part_1?' OR feature = 'part_7' OR feature GLOB 'part_2[0-4]')"
_RANKED_BY_PATTERN = "SELECT {name} AS name, min(pattern_no) AS pattern_no, min({pos}) AS position FROM ({hits}) GROUP BY 1"


def _matched(table: str, name: str, pos: str, patterns: list[str]) -> str:
    hits = " UNION ALL ".join(
        f"SELECT {name}, {pos}, CAST({i} AS INTEGER) AS pattern_no FROM {table} WHERE {name} GLOB '{p}'"
        for i, p in enumerate(patterns)
    )
    return _RANKED_BY_PATTERN.format(name=name, pos=pos, hits=hits)


def _summary_row(section: str, key: str, kind: str, dtype: str, rows: str, cols: str, value: str = "NULL") -> str:
    shape = f"'(' || ({rows}) || ', ' || ({cols}) || ')'" if rows != "NULL" and cols != "NULL" else "'NA'"
    return (
        f"SELECT {section} AS section, CAST({key} AS VARCHAR) AS key, {kind} AS type, CAST({dtype} AS VARCHAR) AS dtype, "
        f"CAST(({rows}) AS BIGINT) AS n_rows, CAST(({cols}) AS BIGINT) AS n_cols, {shape} AS shape, CAST({value} AS VARCHAR) AS value"
    )


def _uns_rows() -> list[tuple[str, ...]]:
    return [
        ("'uns'", "'nation'", "'table'", "NULL", "SELECT count(*) FROM nation", "2"),
        ("'uns'", "'region'", "'table'", "NULL", "SELECT count(*) FROM region", "1"),
        ("'uns'", "'currency'", "'value'", "'string'", "NULL", "NULL"),
    ]


def _summary() -> str:
    n_obs, n_vars = "SELECT count(*) FROM supplier", "SELECT count(*) FROM part"
    rows: list[tuple[str, ...]] = [("'obs'", "NULL", "'table'", "NULL", n_obs, "2")]
    rows += [("'obs'", f"'{c}'", "'column'", f"'{t}'", "NULL", "NULL") for c, t in (("s_nationkey", "int"), ("s_acctbal", "double"))]
    rows.append(("'var'", "NULL", "'table'", "NULL", n_vars, "5"))
    rows += [
        ("'var'", f"'{c}'", "'column'", f"'{t}'", "NULL", "NULL")
        for c, t in (("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double"))
    ]
    rows += [
        ("'X'", "NULL", "'sparse matrix'", "'double'", n_obs, n_vars),
        ("'obsm'", "'profile'", "'dense matrix'", "'double'", n_obs, "2"),
        ("'varm'", "'size_price'", "'dense matrix'", "'double'", n_vars, "2"),
        ("'obsp'", "'lead_supplier'", "'sparse matrix'", "'double'", n_obs, n_obs),
        ("'varp'", "'lead_part'", "'sparse matrix'", "'double'", n_vars, n_vars),
        *_uns_rows(),
        ("'layers'", "'revenue'", "'sparse matrix'", "'double'", n_obs, n_vars),
        ("'raw'", "NULL", "'presence'", "NULL", "NULL", "NULL", "'false'"),
    ]
    return " UNION ALL ".join(_summary_row(*r) for r in rows)


def _section_listing() -> str:
    listed = " UNION ALL ".join(_summary_row(*r) for r in _uns_rows())
    return f"SELECT section, key, type, dtype, n_rows, n_cols, shape FROM ({listed})"


_DAYS = """days AS (SELECT make_date(CAST(1990 + i // 360 AS BIGINT), CAST(1 + i // 30 % 12 AS BIGINT), CAST(1 + i % 28 AS BIGINT)) AS day
 FROM range(0, 3600, 3) t(i) UNION ALL SELECT DATE '1996-01-01')"""
_RETURNS = """kept AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IS DISTINCT FROM 3),
grid AS (SELECT s_suppkey, c AS col_pos, coalesce(n, 0) AS value FROM kept CROSS JOIN range(12) t(c) LEFT JOIN (
 SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) ON l_suppkey = s_suppkey AND l_linenumber = c)"""
_BALANCES = """grid AS (SELECT r AS row_pos, coalesce(n, 0) AS value FROM range(60) a(r) CROSS JOIN range(12) b(c) LEFT JOIN (
 SELECT s_nationkey * 2 AS i, CAST(floor((s_acctbal + 1000) / 1000) AS BIGINT) AS j, count(*) AS n FROM supplier GROUP BY 1, 2) ON i = r AND j = c)"""
_LINES = """grid AS (SELECT s_suppkey AS row_pos, p_partkey AS col_pos, coalesce(n, 0) AS value FROM supplier CROSS JOIN part LEFT JOIN (
 SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2) ON l_suppkey = s_suppkey AND l_partkey = p_partkey
 WHERE s_suppkey < 30 AND p_partkey >= 5 AND p_partkey < 25)"""
_MANY = """asked AS (SELECT i, unnest([0, 1, 2, 3, 4]) AS k FROM range(1000) t(i)),
patterns AS (SELECT CAST(5 * i + k AS INTEGER) AS pattern_no, CASE k WHEN 0 THEN 'part_' || i || '7*' WHEN 1 THEN 'part_?' || i % 100
 WHEN 2 THEN 'part_' || 3 * i WHEN 3 THEN 'none_' || i || '*' ELSE '*' || lpad(CAST(i AS VARCHAR), 3, '0') || '4' END AS pattern FROM asked)"""


def oracles() -> dict[str, str]:
    docs = f"WITH {DOCS} SELECT * FROM docs WHERE "
    return {
        "filter_eq": docs + "quality = 1",
        "filter_ne": docs + "quality IS DISTINCT FROM 1",
        "filter_gt": docs + "n_chars > 2000",
        "filter_ge": docs + "quality >= 0.5",
        "filter_lt": docs + "quality < 1",
        "filter_le": docs + "n_chars <= 2000.5",
        "filter_isin": docs + "lang IN ('de', 'fr')",
        "filter_notin": docs + "NOT coalesce(quality IN (1), FALSE)",
        "filter_nan_guard": f"WITH {EVENTS} SELECT _pos, value FROM ev WHERE partial > 50",
        "filter_index": "SELECT vec_id AS _pos, 'vec_' || vec_id AS _index, label FROM embeddings WHERE 'vec_' || vec_id IN ('vec_3', 'vec_17', 'vec_x')",
        "filter_type_mismatch": "SELECT doc_id AS _pos, FALSE AS equal, TRUE AS unequal FROM documents",
        "filter_long_list": "SELECT doc_id AS _pos, n_chars FROM documents WHERE NOT n_chars < 2000",
        "describe_numeric": _mean_digits(4, _union(_numeric("lineitem", _same("l_quantity", "l_extendedprice", "l_discount", "l_tax")))),
        "describe_categorical": _union(_categorical("lineitem", _same("l_returnflag", "l_linestatus", "l_shipdate"))),
        "describe_mixed": _union(
            _numeric("docs", _same("n_chars", "quality", "toxic")) + _categorical("docs", _same("lang", "source")), DOCS
        ),
        "describe_all_missing": _union(
            _numeric("gone", _same("quality", "n_chars")) + _categorical("gone", {"good_lang": "CASE WHEN quality = 1 THEN lang END"}),
            DOCS,
            "gone AS (SELECT * FROM docs WHERE quality IS NULL)",
        ),
        "describe_with_nan": _union(_numeric("ev", _same("value", "partial")), EVENTS),
        "describe_filtered": _union(
            _numeric("bought", _same("value")) + _categorical("bought", _same("event_type")),
            "bought AS (SELECT * FROM events WHERE event_type = 'purchase')",
        ),
        "value_counts": _counts(
            "docs",
            {"lang": "lang", "source": "source", "grade": "CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END"},
            DOCS,
        ),
        "value_counts_filtered": _counts(
            "kept", _same("lang", "source"), f"{DOCS}, kept AS (SELECT * FROM docs WHERE quality = 1)"
        ),
        "matrix_describe_all": _cells(EMB, "emb", "value"),
        "matrix_describe_by_feature": _cells(EMB, "emb", "value", by="col_pos", nan_count=True),
        "matrix_describe_by_obs": _cells(EMB, "emb", "value", by="row_pos", nan_count=True),
        "matrix_describe_sparse": _cells(TRADE, "trade", "quantity"),
        "matrix_describe_sparse_by_feature": _cells(TRADE, "trade", "quantity", by="col_pos", nan_count=True),
        "matrix_describe_sparse_by_obs": _cells(TRADE, "trade", "quantity", by="row_pos", nan_count=True),
        "layer_describe_features": _mean_digits(2, _feature_rows(TRADE, "trade", "revenue", _FEATURES)),
        "features_of_dense": _feature_rows(
            f"{EMB}, named AS (SELECT *, 'dim_' || col_pos AS feature FROM emb)", "named", "value",
            "feature GLOB 'dim_6*' OR feature = 'dim_0'",
        ),
        "stored_tiles": _feature_rows(
            f"{EMB}, named AS (SELECT *, 'dim_' || col_pos AS feature FROM emb)", "named", "value",
            "feature GLOB 'dim_6*' OR feature = 'dim_0'",
        ),
        "describe_numeric_sketched": " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS "count", count(*) - count({c}) AS nan_count, round(avg({c}), 2) AS mean,
 round(stddev_pop({c}), 2) AS std, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
 TRUE AS p25_near, TRUE AS p50_near, TRUE AS p75_near FROM lineitem"""
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ),
        "matrix_sketched_by_feature": "SELECT DISTINCT l_partkey AS col_pos, TRUE AS p25_near, TRUE AS p50_near, TRUE AS p75_near FROM lineitem",
        "stored_names": f"WITH {DOCS} SELECT _pos, _index, lang, source, n_chars, quality, toxic FROM docs WHERE _index IN ('doc_3', 'doc_17', 'doc_150', 'doc_42')",
        "stored_names_of_table": "SELECT 'doc_' || doc_id AS name, min(doc_id) AS position FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1",
        "stored_name_positions": """SELECT p_name AS name, min(p_partkey) AS position FROM part
 WHERE regexp_full_match(p_name, '(red|small|hot) (plate|ring|rod|widget)') GROUP BY 1""",
        "obs_filter_matrix": _cells(TRADE, "trade", "quantity", "s_acctbal > 4000"),
        "var_filter_matrix": _cells(TRADE, "trade", "quantity", "p_type = 'PROMO'", by="col_pos", nan_count=True),
        "var_filter_dense": _cells(EMB, "emb", "value", "col_pos IN (SELECT col_pos FROM emb GROUP BY 1 HAVING avg(value) > 0)"),
        "both_axes": _mean_digits(2, _cells(TRADE, "trade", "revenue", "s_nationkey < 12 AND p_brand IN ('Brand#2', 'Brand#17')")),
        "obs_filter_pairwise": _cells(LEAD_SUPPLIER, "pairs", "value", "i_bal > 4000 AND j_bal > 4000"),
        "obs_filter_var_table": _union(_numeric("part", _same("p_size")) + _categorical("part", _same("p_type"))),
        "obsm_describe": _cells(
            """n AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), cells AS (
 SELECT s_nationkey, s_acctbal AS value FROM supplier UNION ALL
 SELECT s_nationkey, coalesce(n, 0) FROM supplier LEFT JOIN n ON s_suppkey = l_suppkey)""",
            "cells", "value", "s_nationkey IS DISTINCT FROM 3",
        ),
        "varm_describe": _cells(
            """cells AS (SELECT CAST(0 AS BIGINT) AS col_pos, CAST(p_size AS DOUBLE) AS value FROM part
 UNION ALL SELECT 1, p_retailprice FROM part)""",
            "cells", "value", by="col_pos", nan_count=True,
        ),
        "obsp_describe": _cells(LEAD_SUPPLIER, "pairs", "value"),
        "varp_describe": _cells(LEAD_PART, "pairs", "value", by="row_pos", nan_count=True),
        "uns_describe": _union(_numeric("nation", _same("n_nationkey", "n_regionkey"))),
        "glob_columns": "SELECT 'part_' || p_partkey AS _index, p_brand, p_type, p_size FROM part",
        "glob_features": _matched(
            "(SELECT 'part_' || p_partkey AS f, p_partkey AS pos FROM part)", "f", "pos",
            ["part_1?", "part_7", "part_*[05]", "nothing_*", "part_1*"],
        ),
        "glob_order_dedup": _matched("part", "p_name", "p_partkey", ["*bolt", "small *", "red bolt", "[!a-p]* ring"]),
        "glob_unmatched": """SELECT pattern_no, pattern FROM (VALUES (0, '*bolt'), (1, 'xyz*'), (2, 'small ?ing'), (3, 'small ring'),
 (4, 'abc')) t(pattern_no, pattern) WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_name GLOB pattern)""",
        "name_to_position_first": "SELECT p_name AS name, min(p_partkey) AS position FROM part GROUP BY 1",
        "view_table_slice": f"WITH {DOCS} SELECT _index, lang, n_chars FROM docs ORDER BY _pos LIMIT 15 OFFSET 10",
        "view_filtered_slice": f"""WITH {DOCS} SELECT _index, lang, source, n_chars, quality, toxic FROM docs
 WHERE NOT coalesce(quality IN (1), FALSE) ORDER BY _pos LIMIT 10 OFFSET 2""",
        "view_deep_slice": """WITH kept AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS r, count(*) OVER () AS n
 FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F')
 SELECT o_orderkey AS _pos, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM kept WHERE r >= n - n // 3""",
        "view_strided": f"WITH {DOCS} SELECT _index, lang FROM docs WHERE _pos >= 3 AND (_pos - 3) % 7 = 0",
        "view_strided_filtered": f"""WITH {DOCS}, kept AS (SELECT *, row_number() OVER (ORDER BY _pos DESC) - 1 AS r FROM docs
 WHERE lang IS DISTINCT FROM 'en') SELECT _index, lang FROM kept WHERE r % 5 = 0""",
        "view_negative_bounds": f"""WITH {DOCS}, n AS (SELECT count(*) AS n FROM docs)
 SELECT _index, source FROM docs, n WHERE _pos >= n - 30 AND _pos < n - 10""",
        "view_matrix_block": f"""WITH {EMB} SELECT row_pos, CAST(col_pos - 60 AS BIGINT) AS col_no, round(value, 6) AS value FROM emb
 WHERE row_pos >= 5 AND row_pos < 15 AND col_pos >= 60 AND col_pos < 70""",
        "view_sparse_block": f"""WITH {TRADE} SELECT row_pos, CAST(col_pos - 10 AS BIGINT) AS col_no, round(CAST(quantity AS DOUBLE), 6) AS value
 FROM trade WHERE row_pos < 20 AND col_pos >= 10 AND col_pos < 40""",
        "view_matrix_features": f"""WITH {EMB} SELECT row_pos, CAST(CASE col_pos WHEN 1 THEN 4 ELSE col_pos - 60 END AS BIGINT) AS col_no,
 round(value, 6) AS value FROM emb WHERE row_pos < 10 AND (col_pos >= 60 OR col_pos = 1)""",
        "view_sparse_features": f"""WITH {TRADE}, kept AS (SELECT row_pos, round(revenue, 6) AS value, col_pos,
 CASE WHEN feature GLOB 'part_1?' THEN 0 WHEN feature = 'part_7' THEN 1 ELSE 2 END AS pattern_no FROM trade WHERE {_FEATURES})
 SELECT row_pos, row_number() OVER (PARTITION BY row_pos ORDER BY pattern_no, col_pos) - 1 AS col_no, value FROM kept""",
        "view_filtered_dataset": f"""WITH {TRADE}, ranked AS (SELECT row_pos, CAST(quantity AS DOUBLE) AS value,
 dense_rank() OVER (ORDER BY row_pos) - 1 AS r, dense_rank() OVER (ORDER BY col_pos) - 1 AS c
 FROM trade WHERE s_acctbal > 4000 AND p_type = 'PROMO')
 SELECT row_pos, c - 2 AS col_no, round(value, 6) AS value FROM ranked WHERE r >= 3 AND r < 13 AND c >= 2 AND c < 12""",
        "view_shapes": f"""WITH {DOCS} SELECT '(' || count(*) || ', 5)' AS full_shape, '(' || least(count(*), 50) || ', 2)' AS slice_shape
 FROM docs WHERE quality = 1""",
        "document_entries": "SELECT event_type AS key, 'BIGINT' AS type FROM events GROUP BY 1",
        "nested_key": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
        "section_listing": _section_listing(),
        "summary": _summary(),
        "csv_rows": "SELECT CAST(n_nationkey AS BIGINT) AS _pos, concat_ws(',', n_name, n_nationkey, n_regionkey) AS line FROM nation",
        "csv_block": f"""WITH {TRADE} SELECT row_pos, string_agg(CAST(CAST(quantity AS DOUBLE) AS VARCHAR), ',' ORDER BY col_pos) AS line
 FROM trade WHERE col_pos < 8 GROUP BY row_pos""",
        "matrix_to_columns": """SELECT vec_id AS row_pos, round(CAST(embedding[4] AS DOUBLE), 6) AS dim_3,
 round(CAST(embedding[42] AS DOUBLE), 6) AS dim_41 FROM embeddings""",
        "view_column_list": f"""WITH {EMB} SELECT row_pos, CAST(CASE col_pos WHEN 9 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS BIGINT) AS col_no,
 round(value, 6) AS value FROM emb WHERE col_pos IN (9, 2, 33)""",
        "named_cells": f"""WITH {TRADE} SELECT 'part_' || col_pos AS feature, count(*) AS n, round(max(revenue), 4) AS largest
 FROM stored GROUP BY 1""",
        "distributed_quartiles": _mean_digits(2, f"""SELECT l_linestatus, {_CELL_STATS}, count(*) - count(x) AS nan_count
 FROM (SELECT l_linestatus, l_extendedprice AS x FROM lineitem) GROUP BY 1"""),
        "positions_by_order": "SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS _pos FROM customer",
        "stored_dataset": _mean_digits(2, _cells(TRADE, "trade", "revenue", by="row_pos", nan_count=True)),
        "filter_long_dates": f"""WITH {_DAYS} SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem
 WHERE CAST(l_shipdate AS DATE) IN (SELECT day FROM days)""",
        "filter_long_notin_missing": f"""WITH {EVENTS} SELECT _pos, partial FROM ev
 WHERE partial IS NOT NULL AND partial NOT IN (SELECT i / 100.0::DOUBLE FROM range(3000) t(i))""",
        "filter_decimal": """SELECT * FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(14, 2)) AS price FROM lineitem)
 WHERE price > 20000.005 AND price <= 40000""",
        "sparse_obsm_filtered": f"""WITH {_RETURNS} SELECT col_pos, count(*) AS "count", round(avg(value), 4) AS mean, CAST(max(value) AS DOUBLE) AS "max",
 count(*) AS viewed, CAST(sum(value) AS DOUBLE) AS total FROM grid GROUP BY 1""",
        "sparse_uns_by_row": f"""WITH {_BALANCES} SELECT row_pos, count(*) AS "count", round(avg(value), 5) AS mean,
 round(quantile_cont(CAST(value AS DOUBLE), 0.75), 6) AS p75, CAST(max(value) AS DOUBLE) AS "max" FROM grid GROUP BY 1""",
        "view_integer_layer": f"""WITH {_LINES} SELECT row_pos, max(value) FILTER (col_pos = 8) AS third,
 string_agg(CAST(value AS VARCHAR), ',' ORDER BY col_pos) AS line FROM grid GROUP BY 1""",
        "obs_filter_most_rows": _mean_digits(4, _cells(TRADE, "trade", "quantity", "s_acctbal > -500 AND s_nationkey IS DISTINCT FROM 7")),
        "glob_many": f"""WITH {_MANY} SELECT f AS name, min(pattern_no) AS pattern_no, min(p_partkey) AS position
 FROM (SELECT 'part_' || p_partkey AS f, p_partkey FROM part) JOIN patterns ON f GLOB pattern GROUP BY 1""",
        "refusals": """SELECT * FROM (VALUES ('no observation left', TRUE), ('no variable left', TRUE), ('no row left in a view', TRUE),
 ('some rows left', (SELECT count(*) FROM documents) = 0), ('incomplete filter', TRUE), ('unknown column', TRUE), ('unknown operator', TRUE),
 ('list for one value', TRUE), ('text for a number', TRUE), ('order of texts', TRUE), ('no feature asked for', TRUE)) t("case", raised)""",
        "last_modified": "SELECT TRUE AS of_manifest, TRUE AS in_time, count(*) AS n_rows FROM documents",
        "locate": "SELECT * FROM (VALUES ('docs', 'dataset'), ('events', 'dataset')) t(name, kind)",
    }
