"""DuckDB SQL of the queries in ``registry_scale``."""

_TAIL = ("t AS (SELECT CASE WHEN l_quantity <= 4 THEN 'q' || CAST(l_quantity AS INT) WHEN l_quantity < 50 THEN code END AS mixed, "
         "* FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS code, * FROM lineitem))")


def _long(*columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, l_extendedprice AS y FROM t"
                              for c in columns)


def _draw(keys: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}|' || concat_ws('|', {keys})), 1, 15))::BIGINT)"


def _poisson(u: str, mean: float, terms: int = 12) -> str:
    """How many cumulated Poisson probabilities a draw reaches."""
    total, term, parts = f"exp(-{mean})", f"exp(-{mean})", []
    for k in range(1, terms):
        parts.append(f"({u} / 1152921504606846976.0 >= {total})::INT")
        term = f"{term} * {mean} / {k}"
        total = f"{total} + {term}"
    return "(" + " + ".join(parts) + ")"


_ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_SKEWED = ("f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 7 WHEN l_quantity = 9 THEN NULL "
           "WHEN l_quantity > 40 THEN -l_partkey ELSE l_partkey END AS p_partkey FROM lineitem)")
_HASH = "CAST('0x'||substr(md5(CAST({} AS varchar)),1,8) AS bigint)"
_ONE = (f"d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice AS y, {_HASH.format('l_orderkey')} % 5 "
        f"AS fold, {_HASH.format('l_partkey')} >= 3435973836 AS held FROM lineitem)")
_MOMENTS = ("avg(y) AS my, avg(l_quantity) AS mx, stddev_pop(y) AS sy, covar_pop(y, l_quantity) / var_pop(l_quantity) AS b")
_RIDGE = "my + b / (1 + v / sy) * (l_quantity - mx)"
_BEST = (f"{_ONE}, s AS (SELECT k AS h, {_MOMENTS} FROM d JOIN range(5) r(k) ON fold <> k WHERE NOT held GROUP BY k), "
         "p AS (SELECT unnest([0.1, 0.3, 0.5])::DOUBLE AS v), "
         f"e AS (SELECT v, h, sqrt(avg(pow(y - ({_RIDGE}), 2))) AS rmse FROM d JOIN s ON fold = h CROSS JOIN p WHERE NOT held "
         "GROUP BY v, h), best AS (SELECT v FROM e GROUP BY v ORDER BY avg(rmse), v LIMIT 1)")

_XS = [f"x{i:02d}" for i in range(24)]
_WIDE = ("w AS (SELECT row_number() OVER () AS r, 3.5::DOUBLE AS x_same, " + ", ".join(
    f"CASE WHEN l_linenumber <> {1 + i % 7} THEN l_quantity * {i % 5 + 1} + l_discount * {10 * i} + l_tax * {i * i} + 1e6 END "
    f"AS x{i:02d}" for i in range(24)) + " FROM lineitem)")


def _corr(fill: bool, digits: int) -> str:
    value = "coalesce({0}, 0.0)" if fill else "{0}"
    long = " UNION ALL ".join(f"SELECT r, '{x}' AS f, {value.format(x)} AS v FROM w" for x in [*_XS, "x_same"])
    none = "a.f = 'x_same' OR b.f = 'x_same'"
    return (f"WITH {_WIDE}, l AS ({long}) SELECT a.f AS feature_a, b.f AS feature_b, CASE WHEN {none} THEN NULL ELSE "
            f"round(covar_pop(a.v, b.v) / (stddev_pop(CASE WHEN b.v IS NOT NULL THEN a.v END) * "
            f"stddev_pop(CASE WHEN a.v IS NOT NULL THEN b.v END)), {digits}) + 0.0 END AS corr "
            "FROM l a JOIN l b USING (r) GROUP BY a.f, b.f")


_LINE = "CASE WHEN o_orderkey % 97 = 0 THEN {0} WHEN o_orderkey % 89 = 0 THEN {1} WHEN o_orderkey % 83 = 0 THEN {2} END"
_BROKEN = "(o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0)"

ORACLE_SQL = {
    "cv_tree_depths": (
        f"WITH d AS (SELECT l_linestatus = 'F' AS x, l_extendedprice AS y, {_HASH.format('l_orderkey')} % 5 AS fold FROM lineitem), "
        "m AS (SELECT k, x, avg(y) AS m FROM d JOIN range(5) r(k) ON fold <> k GROUP BY k, x), "
        "e AS (SELECT k, sqrt(avg(pow(y - m, 2))) AS e FROM d JOIN m ON fold = k AND d.x = m.x GROUP BY k) "
        "SELECT 'maxDepth' AS param, unnest([1, 3, 6])::INT AS value, (SELECT round(avg(e), 4) FROM e) AS avg_rmse, "
        "unnest([TRUE, FALSE, FALSE]) AS is_best"),
    "corr_matrix_wide": _corr(True, 7),
    "corr_matrix_pairwise": _corr(False, 6),
    "ingest_incremental": "SELECT * REPLACE (CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice * 2.0 ELSE o_totalprice END "
                          "AS o_totalprice) FROM orders",
    "ingest_manifest": (
        "SELECT 1::BIGINT AS batch, FALSE AS removed, 3::BIGINT AS files, count(*) FILTER (o_orderkey % 4 < 3) AS n_rows FROM orders "
        "UNION ALL SELECT 2, FALSE, 2, count(*) FILTER (o_orderkey % 4 IN (1, 3)) FROM orders UNION ALL SELECT 2, TRUE, 1, 0"),
    "csv_quarantine": (
        "SELECT " + _LINE.format("concat_ws(',', o_orderkey, o_custkey, 'n/a', o_orderpriority)", "concat_ws(',', o_orderkey, o_custkey)",
                                 "concat_ws(',', o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'more')") + " AS record, "
        + _LINE.format("'o_totalprice is no double'", "'too few fields'", "'too many fields'") + f" AS reason FROM orders WHERE {_BROKEN} "
        f"UNION ALL SELECT CAST(count(*) AS VARCHAR), 'accepted' FROM orders WHERE NOT {_BROKEN}"),
    "csv_accepted": f"SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE NOT {_BROKEN}",
    "frequent_values_tail": (
        f"WITH {_TAIL} SELECT feature, value, round(count(*) * 1.0 / (SELECT count(*) FROM t), 9) + 0.0 AS frequency "
        f"FROM ({_long('mixed', 'code')}) WHERE value IS NOT NULL GROUP BY feature, value "
        "HAVING count(*) > 0.01 * (SELECT count(*) FROM t)"),
    "mode_values_tail": (
        f"WITH {_TAIL} SELECT feature, value FROM (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY "
        "count(*) DESC, try_cast(value AS DOUBLE) NULLS FIRST, value) AS rn FROM "
        f"({_long('mixed', 'code', 'l_orderkey', 'l_partkey')}) WHERE value IS NOT NULL GROUP BY feature, value) WHERE rn = 1"),
    "heavy_label_sums": (
        f"WITH {_TAIL}, g AS (SELECT mixed, count(*) > 0.01 * (SELECT count(*) FROM t) AS many FROM t WHERE mixed IS NOT NULL "
        "GROUP BY mixed) SELECT CASE WHEN t.mixed IS NULL THEN 'null' WHEN many THEN 'value' ELSE 'rest' END AS kind, "
        "CASE WHEN many THEN t.mixed END AS value, count(*) AS n, count(l_extendedprice) AS label_n, "
        "round(sum(l_extendedprice), 2) + 0.0 AS label_sum FROM t LEFT JOIN g ON t.mixed = g.mixed GROUP BY 1, 2"),
    "quantiles_sketched": (
        "WITH x AS (SELECT 'l_quantity' AS feature, l_quantity AS x FROM lineitem UNION ALL SELECT 'l_extendedprice', "
        "l_extendedprice FROM lineitem UNION ALL SELECT 'l_orderkey', nullif(l_orderkey, 1) FROM lineitem UNION ALL "
        "SELECT 'l_partkey', l_partkey FROM lineitem), q AS (SELECT feature, count(x) AS n, "
        "quantile_disc(x, [0.25, 0.5, 0.75]) AS q FROM x GROUP BY feature) "
        "SELECT feature, unnest([0.25, 0.5, 0.75])::DOUBLE AS p, n, unnest(q)::DOUBLE AS exact, TRUE AS within FROM q"),
    "string_index_unlimited": (
        f"WITH {_TAIL}, i AS (SELECT feature, value, (row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) - 1)"
        f"::DOUBLE AS idx FROM ({_long('mixed', 'l_orderkey')}) WHERE value IS NOT NULL GROUP BY feature, value), "
        "k AS (SELECT count(*)::DOUBLE AS k FROM i WHERE feature = 'mixed') "
        "SELECT code, coalesce(a.idx, k) AS mixed_index, b.idx AS l_orderkey_index FROM k, t "
        "LEFT JOIN i a ON a.feature = 'mixed' AND a.value = mixed "
        "LEFT JOIN i b ON b.feature = 'l_orderkey' AND b.value = CAST(l_orderkey AS VARCHAR)"),
    "one_hot_unlimited": (
        f"WITH {_TAIL}, i AS (SELECT l_orderkey, row_number() OVER (ORDER BY count(*) DESC, CAST(l_orderkey AS VARCHAR)) - 1 AS idx "
        "FROM t WHERE l_orderkey % 2 = 0 GROUP BY l_orderkey), k AS (SELECT count(*) AS k FROM i) "
        "SELECT code, k + 1 AS width, coalesce(idx, k) AS slot FROM k, t LEFT JOIN i USING (l_orderkey)"),
    "split_join_inner": (f"WITH {_SKEWED} SELECT p_partkey, l_orderkey, l_linenumber, p_brand, p_type FROM f "
                         "JOIN part USING (p_partkey)"),
    "split_join_left": (f"WITH {_SKEWED} SELECT p_partkey, l_orderkey, l_linenumber, p_brand, p_type FROM f "
                        "LEFT JOIN part USING (p_partkey)"),
    "random_split": f"SELECT *, {_draw('o_orderkey', 42)} < round(0.8 * 1152921504606846976) AS is_train FROM orders",
    "sample_with_replacement": (f"SELECT lineitem.* FROM lineitem, range(1, 12) r(k) "
                                f"WHERE k <= {_poisson(_draw(_ROW, 42), 0.01)}"),
    "sample_without_replacement": f"SELECT * FROM lineitem WHERE {_draw(_ROW, 42)} < round(0.1 * 1152921504606846976)",
    "sample_stratified": (f"SELECT {_ROW}, l_returnflag FROM lineitem, range(1, 12) r(k) WHERE k <= CASE l_returnflag "
                          f"WHEN 'A' THEN {_poisson(_draw(_ROW, 7), 0.5)} WHEN 'R' THEN {_poisson(_draw(_ROW, 7), 1.5)} ELSE 0 END"),
    "model_comparison_ridge": (
        f"WITH {_BEST}, m AS (SELECT {_MOMENTS} FROM d WHERE NOT held), "
        f"r AS (SELECT y, {_RIDGE} AS yh, v FROM d, m, best WHERE held) "
        "SELECT 'Linear_Regression' AS model, round(sqrt(avg(pow(y - yh, 2))), 4) + 0.0 AS rmse, round(avg(abs(y - yh)), 4) + 0.0 "
        "AS mae, round(1 - sum(pow(y - yh, 2)) / (var_pop(y) * count(*)), 7) + 0.0 AS r2, 'regParam' AS best_param, "
        "any_value(v) AS best_value FROM r"),
    "train_and_predict_ridge": (
        f"WITH {_BEST}, m AS (SELECT {_MOMENTS} FROM d) SELECT l_orderkey, l_linenumber, l_partkey, "
        f"round({_RIDGE}, 4) + 0.0 AS prediction FROM d, m, best"),
}
