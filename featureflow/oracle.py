"""DuckDB oracle SQL for every registered query that has a SQL form.

Tables are the driver's pre-registered views.  Column names and types match
the Spark results (month()/day() are cast to INTEGER because DuckDB returns
BIGINT; ratios are DOUBLE; floats are rounded as on the Spark side).
"""

from featureflow.oracle_scale import ORACLE_SQL as SCALE_SQL

BASE = ("base AS (SELECT l_orderkey,l_linenumber,l_partkey,l_quantity,l_extendedprice,l_discount,l_tax,"
        "l_returnflag,l_linestatus,l_shipdate,p_brand,p_type,p_size,p_retailprice "
        "FROM lineitem JOIN part ON l_partkey=p_partkey)")
FREQ = ("freq AS (SELECT p_brand FROM base GROUP BY p_brand "
        "HAVING count(*)*1.0/(SELECT count(*) FROM base) > 0.04), "
        "agg AS (SELECT base.*, CASE WHEN p_brand IN (SELECT p_brand FROM freq) THEN p_brand ELSE 'Other' END "
        "AS brand_agg FROM base)")

# static TPCH preset rows: lineitem JOIN part with NULLs and sentinels put in, returnflag 'A' excluded, "None" read as NULL
STATIC = """li AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 18) AS l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, CASE WHEN l_linenumber = 4 THEN 'None' ELSE l_linestatus END AS l_linestatus,
  CASE WHEN l_linenumber <> 3 OR l_quantity <= 40 THEN l_shipdate END AS l_shipdate FROM lineitem),
pa AS (SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS p_type,
  CASE WHEN p_partkey % 7 = 0 THEN 'None' WHEN p_partkey % 13 <> 0 THEN p_brand END AS p_brand, p_retailprice FROM part),
s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, p_retailprice AS retail_price, l_extendedprice AS y,
  month(l_shipdate) AS mo, day(l_shipdate) AS dd, isodow(l_shipdate) AS dw, nullif(l_returnflag, 'None') AS rf,
  nullif(l_linestatus, 'None') AS ls, nullif(p_type, 'None') AS it, nullif(p_brand, 'None') AS br
  FROM li JOIN pa ON l_partkey = p_partkey WHERE l_returnflag <> 'A')"""

_NUMBERS = ["l_quantity", "l_discount", "l_tax", "retail_price"]
_CATS = {"ship_month": "mo", "ship_day": "dd", "ship_dow": "dw", "l_returnflag": "rf", "l_linestatus": "ls",
         "item_type": "it", "brand": "br"}
_NOMINAL = "('l_returnflag','l_linestatus','item_type','brand')"


def _learned(learn: str) -> str:
    """What the rows in ``learn`` teach: medians, modes, filled rows, frequent values, buckets, labels and means."""
    medians = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _NUMBERS)
    modes = ", ".join(f"(SELECT {c} FROM l WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}"
                      for c in _CATS.values())
    filled = ", ".join(f"coalesce(s.{c}, med.{c}) AS {c}" for c in _NUMBERS) + ", " + ", ".join(
        f"coalesce(s.{c}, modes.{c}) AS {c}" for c in _CATS.values())
    long = " UNION ALL ".join(f"SELECT '{n}' AS feature, CAST({c} AS VARCHAR) AS value, y FROM f WHERE {learn}"
                              for n, c in _CATS.items())
    return f"""{STATIC},
l AS (SELECT * FROM s WHERE {learn}),
med AS (SELECT {medians} FROM l),
modes AS (SELECT {modes}),
f AS (SELECT l_orderkey, l_linenumber, y, {filled} FROM s, med, modes),
cnt AS (SELECT feature, value, count(*) AS n, sum(y) AS sy, count(y) AS ny FROM ({long}) GROUP BY feature, value),
freq AS (SELECT feature, value FROM cnt WHERE feature IN {_NOMINAL} AND n > 0.031 * (SELECT count(*) FROM l)),
kinds AS (SELECT feature, CASE WHEN count(*) + 1 <= 4 THEN 'binary' ELSE 'mean' END AS kind FROM freq GROUP BY feature),
bucket AS (SELECT c.feature, CASE WHEN q.value IS NOT NULL THEN c.value ELSE 'Other' END AS value,
           sum(c.n) AS n, sum(c.sy) AS sy, sum(c.ny) AS ny
           FROM cnt c LEFT JOIN freq q ON c.feature = q.feature AND c.value = q.value
           WHERE c.feature IN {_NOMINAL} GROUP BY 1, 2),
labels AS (SELECT b.feature, b.value, row_number() OVER (PARTITION BY b.feature ORDER BY b.n DESC, b.value) - 1 AS idx
           FROM bucket b JOIN kinds k ON b.feature = k.feature AND k.kind = 'binary'),
means AS (SELECT b.feature, b.value, b.sy / b.ny AS m FROM bucket b JOIN kinds k ON b.feature = k.feature AND k.kind = 'mean'
          UNION ALL
          SELECT k.feature, 'Other', (SELECT sum(y) / count(y) FROM l) FROM kinds k
          WHERE k.kind = 'mean' AND NOT EXISTS (SELECT 1 FROM bucket b WHERE b.feature = k.feature AND b.value = 'Other'))"""


_NONE = "CAST(NULL AS VARCHAR)"
FIT_PARAMS = f"WITH {_learned('TRUE')}\n" + "\nUNION ALL ".join(
    [f"SELECT '{c}' AS feature, 'median' AS stat, {_NONE} AS value, CAST({c} AS DOUBLE) AS num FROM med" for c in _NUMBERS]
    + [f"SELECT '{n}', 'mode', CAST({c} AS VARCHAR), NULL FROM modes" for n, c in _CATS.items()]
    + ["SELECT feature, 'frequent', value, NULL FROM freq", "SELECT feature, 'kind', kind, NULL FROM kinds",
       "SELECT feature, 'label', value, CAST(idx AS DOUBLE) FROM labels",
       "SELECT feature, 'mean', value, round(m, 6) FROM means"])

_ML = "CASE WHEN mo = 2 THEN 28 WHEN mo IN (4,6,9,11) THEN 30 ELSE 31 END"


def _ang(v, p):
    return f"(CAST({v} AS DOUBLE) / {p} * (2*pi()))"


# 32 bits of md5, below 0.8 * 2**32
_TRAIN = "(CAST('0x'||substr(md5(CAST(l_orderkey AS varchar)),1,8) AS bigint) < 3435973836)"


def _apply_sql(learn: str = "TRUE", extra: str = "") -> str:
    """Parameters learned from the rows in ``learn``, applied to every static row: NULLs filled, rare and unseen
    values in the "Other" bucket, one-hot slots (the last one for no label) or means with their fallback."""
    def bucketed(feature, c):
        return f"CASE WHEN {c} IN (SELECT value FROM freq WHERE feature = '{feature}') THEN {c} ELSE 'Other' END"

    def slots(feature, c):
        return (f"(SELECT {c}, list_transform(range(0, k + 1), lambda i: CAST(i = idx AS DOUBLE)) AS v FROM (SELECT DISTINCT "
                f"b.{c}, k, coalesce(idx, k) AS idx FROM b CROSS JOIN (SELECT count(*) AS k FROM labels WHERE feature = '{feature}') "
                f"LEFT JOIN labels ON feature = '{feature}' AND value = b.{c}))")

    def mean(feature, c):
        return f"(SELECT any_value(m) FROM means WHERE feature = '{feature}' AND value = {c})"

    return f"""
WITH {_learned(learn)},
b AS (SELECT * REPLACE ({bucketed('l_returnflag', 'rf')} AS rf, {bucketed('l_linestatus', 'ls')} AS ls,
      {bucketed('item_type', 'it')} AS it, {bucketed('brand', 'br')} AS br) FROM f),
r AS {slots('l_returnflag', 'rf')},
t AS {slots('l_linestatus', 'ls')},
i AS (SELECT DISTINCT it, {mean('item_type', 'it')} AS m FROM b),
n AS (SELECT DISTINCT br, {mean('brand', 'br')} AS m FROM b)
SELECT l_orderkey, l_linenumber, list_transform(
  list_concat([l_quantity, l_discount, l_tax, retail_price], r.v, t.v, [i.m, n.m,
  sin({_ang('mo', '12.0')}), sin({_ang('dd', _ML)}), sin({_ang('dw', '7.0')}),
  cos({_ang('mo', '12.0')}), cos({_ang('dd', _ML)}), cos({_ang('dw', '7.0')})]), lambda x: round(x, 6) + 0.0) AS features{extra}
FROM b JOIN r USING (rf) JOIN t USING (ls) JOIN i USING (it) JOIN n USING (br)
"""


APPLY_PARAMS = _apply_sql()
SPLIT_FIT_APPLY = _apply_sql(_TRAIN, f", {_TRAIN} AS is_train")

_FOLD = "CAST('0x'||substr(md5(CAST(l_orderkey AS varchar)),1,8) AS bigint) % 5"
# ridge on one standardised feature, penalty v on the scale of the label's deviation
_RIDGE = "my + b / (1 + v / sy) * (l_quantity - mx)"
_MOMENTS = ("avg(l_extendedprice) AS my, avg(l_quantity) AS mx, stddev_pop(l_extendedprice) AS sy, "
            "covar_pop(l_extendedprice, l_quantity) / var_pop(l_quantity) AS b")
_TWO_MEANS = ("SELECT l_orderkey,l_linenumber,l_partkey, round(avg(l_extendedprice) OVER "
              "(PARTITION BY l_linestatus = 'F'),4)+0.0 AS prediction FROM lineitem")

ORACLE_SQL = {
    # sources / sinks: the round trip equals the source table
    "scan_project_drop": "SELECT l_orderkey,l_linenumber,l_quantity,l_extendedprice FROM lineitem",
    "parquet_roundtrip": "SELECT * FROM orders",
    "csv_roundtrip": "SELECT * FROM part",
    "schema_roundtrip": "SELECT * FROM part",
    "ingest_cache": "SELECT * FROM part",
    "validate_dataset": "SELECT * FROM orders",
    "repartition_invariant": "SELECT * FROM orders",
    # projections / predicates
    "rename_inner_join": ("SELECT l_orderkey,l_linenumber,p_brand AS brand,p_type AS item_type "
                          "FROM lineitem JOIN part ON l_partkey=p_partkey"),
    "filter_not_equal_drop_null": "SELECT o_orderkey,o_totalprice FROM orders WHERE nullif(o_orderstatus,'F') <> 'P'",
    "try_cast_dropna": ("SELECT o_orderkey, try_cast(substr(o_orderpriority,1,1) AS int) AS prio FROM orders "
                        "WHERE try_cast(CASE WHEN o_orderpriority='5-LOW' THEN 'NA' ELSE substr(o_orderpriority,1,1) END "
                        "AS int) IS NOT NULL"),
    "output_projection": "SELECT * EXCLUDE (o_orderpriority) FROM orders",
    "sentinel_to_null": "SELECT o_orderkey, nullif(o_orderpriority,'4-NOT SPECIFIED') AS prio FROM orders",
    "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "dataset_shape": "SELECT count(*) AS n_rows, CAST(11 AS int) AS n_columns FROM lineitem",
    "hhmm_to_minutes": "SELECT event_id, CAST(hour(ts)*60+minute(ts) AS int) AS ts_minutes FROM events",
    "cyclic_encode": (
        "SELECT l_orderkey,l_linenumber,l_partkey, "
        "round(cos(CAST(month(l_shipdate) AS DOUBLE)/12*(2*pi())),9)+0.0 AS month_cos, "
        "round(sin(CAST(month(l_shipdate) AS DOUBLE)/12*(2*pi())),9)+0.0 AS month_sin, "
        "round(cos(CAST(day(l_shipdate) AS DOUBLE)/CASE WHEN month(l_shipdate)=2 THEN 28 "
        "WHEN month(l_shipdate) IN (4,6,9,11) THEN 30 ELSE 31 END*(2*pi())),9)+0.0 AS dom_cos FROM lineitem"),
    # nulls
    "null_counts": ("SELECT count(CASE WHEN nullif(l_quantity,18) IS NULL THEN 1 END) AS l_quantity, "
                    "count(CASE WHEN nullif(l_returnflag,'R') IS NULL THEN 1 END) AS l_returnflag FROM lineitem"),
    "null_percentages": (
        "SELECT 'l_quantity' AS feature, round(CAST(count(CASE WHEN nullif(l_quantity,18) IS NULL THEN 1 END) AS DOUBLE)"
        "*100.0/count(*),4) AS pct FROM lineitem UNION ALL SELECT 'l_returnflag', "
        "round(CAST(count(CASE WHEN nullif(l_returnflag,'R') IS NULL THEN 1 END) AS DOUBLE)*100.0/count(*),4) FROM lineitem"),
    "impute_median": ("SELECT l_orderkey,l_linenumber,l_partkey, coalesce(nullif(l_quantity,18),"
                      "(SELECT quantile_disc(nullif(l_quantity,18),0.5) FROM lineitem)) AS l_quantity FROM lineitem"),
    "impute_mode": ("SELECT o_orderkey, coalesce(nullif(o_orderpriority,'5-LOW'),(SELECT o_orderpriority FROM "
                    "(SELECT o_orderpriority,count(*) AS c FROM orders WHERE o_orderpriority<>'5-LOW' "
                    "GROUP BY o_orderpriority ORDER BY c DESC,o_orderpriority LIMIT 1) m)) AS prio FROM orders"),
    "quantiles": ("SELECT quantile_disc(l_quantity,0.5) AS q50_quantity, quantile_disc(l_extendedprice,0.5) "
                  "AS q50_price FROM lineitem"),
    # aggregates
    "value_proportions": (f"WITH {BASE} SELECT p_type, count(*) AS count, "
                          "round(CAST(count(*) AS DOUBLE)*100.0/(SELECT count(*) FROM base),2) AS proportion "
                          "FROM base GROUP BY p_type"),
    "mode_values": (f"WITH {BASE} SELECT feature,value FROM (SELECT feature,value,row_number() OVER "
                    "(PARTITION BY feature ORDER BY c DESC,value) AS rn FROM (SELECT 'p_brand' AS feature,"
                    "p_brand AS value,count(*) AS c FROM base GROUP BY p_brand UNION ALL SELECT 'p_type',p_type,"
                    "count(*) FROM base GROUP BY p_type) a) b WHERE rn=1"),
    "top_k_categories": f"WITH {BASE} SELECT p_brand,count(*) AS count FROM base GROUP BY p_brand ORDER BY count DESC,p_brand LIMIT 15",
    "top_k_semi_join_mean": (f"WITH {BASE} SELECT p_brand, round(avg(l_extendedprice),6)+0.0 AS avg_target FROM base "
                             "WHERE p_brand IN (SELECT p_brand FROM (SELECT p_brand,count(*) AS c FROM base "
                             "GROUP BY p_brand ORDER BY c DESC,p_brand LIMIT 20) t) GROUP BY p_brand"),
    "top_k_semi_join": (f"WITH {BASE} SELECT l_orderkey,l_linenumber,l_partkey,p_brand FROM base WHERE p_brand IN "
                        "(SELECT p_brand FROM (SELECT p_brand,count(*) AS c FROM base GROUP BY p_brand "
                        "ORDER BY c DESC,p_brand LIMIT 20) t)"),
    "profile_histograms": (
        "WITH d AS (SELECT l_quantity AS q, l_discount AS di, nullif(l_tax,0.0) AS tx FROM lineitem), "
        "r AS (SELECT min(q) AS qlo, max(q) AS qhi, min(tx) AS tlo, max(tx) AS thi FROM d) "
        "SELECT 'l_quantity' AS feature, least(30, CAST(floor((q-qlo)/((qhi-qlo)/30.0)) AS int)+1) AS bin, count(*) AS n "
        "FROM d, r WHERE q IS NOT NULL GROUP BY 1, 2 "
        "UNION ALL SELECT 'l_discount', least(30, CAST(floor((di-0.0)/((0.05-0.0)/30.0)) AS int)+1), count(*) "
        "FROM d WHERE di BETWEEN 0.0 AND 0.05 GROUP BY 1, 2 "
        "UNION ALL SELECT 'l_tax', least(30, CAST(floor((tx-tlo)/((thi-tlo)/30.0)) AS int)+1), count(*) "
        "FROM d, r WHERE tx IS NOT NULL GROUP BY 1, 2"),
    "profile_proportions": (
        "SELECT 'l_returnflag' AS feature, l_returnflag AS value, count(*) AS count, "
        "round(CAST(count(*) AS DOUBLE)*100.0/(SELECT count(*) FROM lineitem),2) AS proportion FROM lineitem GROUP BY 2 "
        "UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), "
        "round(CAST(count(*) AS DOUBLE)*100.0/(SELECT count(*) FROM lineitem),2) FROM lineitem GROUP BY 2"),
    "profile_top_categories": (
        f"WITH {BASE}, c AS (SELECT 'p_brand' AS feature, p_brand AS value, count(*) AS n FROM base GROUP BY 2 "
        "UNION ALL SELECT 'p_type', p_type, count(*) FROM base GROUP BY 2) "
        "SELECT feature, value, n FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn "
        "FROM c) WHERE rn <= 5"),
    "profile_mean_target": (
        f"WITH {BASE}, c AS (SELECT 'p_brand' AS feature, p_brand AS value, count(*) AS n, avg(l_extendedprice) AS m "
        "FROM base GROUP BY 2 UNION ALL SELECT 'p_type', p_type, count(*), avg(l_extendedprice) FROM base GROUP BY 2 "
        "UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), avg(l_extendedprice) FROM base GROUP BY 2) "
        "SELECT feature, value, n, round(m,6)+0.0 AS avg_target FROM (SELECT *, row_number() OVER "
        "(PARTITION BY feature ORDER BY n DESC, value) AS rn FROM c) WHERE feature <> 'p_brand' OR rn <= 10"),
    "mean_target_by_feature": f"WITH {BASE} SELECT p_type, round(avg(l_extendedprice),6)+0.0 AS avg_target FROM base GROUP BY p_type",
    "global_mean": "SELECT round(avg(l_extendedprice),6)+0.0 AS global_mean FROM lineitem",
    "frequent_values": (f"WITH {BASE} SELECT p_brand, round(count(*)*1.0/(SELECT count(*) FROM base),9)+0.0 AS frequency "
                        "FROM base GROUP BY p_brand HAVING count(*)*1.0/(SELECT count(*) FROM base) > 0.04"),
    "distinct_values": "SELECT DISTINCT p_type AS k FROM part",
    "summary_stats": ("SELECT 'l_quantity' AS feature, count(l_quantity) AS n, round(avg(l_quantity),6)+0.0 AS mean, "
                      "round(stddev_samp(l_quantity),6)+0.0 AS stddev, CAST(min(l_quantity) AS DOUBLE) AS mn, "
                      "CAST(quantile_disc(l_quantity,0.25) AS DOUBLE) AS p25, CAST(quantile_disc(l_quantity,0.5) AS DOUBLE) AS p50, "
                      "CAST(quantile_disc(l_quantity,0.75) AS DOUBLE) AS p75, CAST(max(l_quantity) AS DOUBLE) AS mx FROM lineitem"),
    "corr_matrix": (
        "WITH d AS (SELECT l_quantity AS a, l_extendedprice AS b, coalesce(nullif(l_discount,0.0),0.0) AS c FROM lineitem), "
        "m AS (SELECT corr(a,a) aa, corr(a,b) ab, corr(a,c) ac, corr(b,b) bb, corr(b,c) bc, corr(c,c) cc FROM d) "
        "SELECT * FROM (VALUES ('l_quantity','l_quantity'),('l_quantity','l_extendedprice'),('l_quantity','l_discount'),"
        "('l_extendedprice','l_quantity'),('l_extendedprice','l_extendedprice'),('l_extendedprice','l_discount'),"
        "('l_discount','l_quantity'),('l_discount','l_extendedprice'),('l_discount','l_discount')) v(feature_a, feature_b), "
        "LATERAL (SELECT round(CASE WHEN v.feature_a=v.feature_b THEN (CASE v.feature_a WHEN 'l_quantity' THEN aa "
        "WHEN 'l_extendedprice' THEN bb ELSE cc END) WHEN 'l_quantity' IN (v.feature_a, v.feature_b) AND "
        "'l_extendedprice' IN (v.feature_a, v.feature_b) THEN ab WHEN 'l_quantity' IN (v.feature_a, v.feature_b) "
        "THEN ac ELSE bc END, 9)+0.0 AS corr FROM m)"),
    "histogram_30": ("SELECT least(30,CAST(floor((l_quantity-(SELECT min(l_quantity) FROM lineitem))/"
                     "(((SELECT max(l_quantity) FROM lineitem)-(SELECT min(l_quantity) FROM lineitem))/30.0)) AS int)+1) AS bin, "
                     "count(*) AS n FROM lineitem GROUP BY 1"),
    "histogram_clipped": ("SELECT least(30,CAST(floor((l_extendedprice-0)/(50000.0/30)) AS int)+1) AS bin, count(*) AS n "
                          "FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 50000 GROUP BY 1"),
    "union_all_fallback": ("SELECT p_type AS k, round(avg(p_retailprice),6)+0.0 AS mean_enc FROM part GROUP BY p_type "
                           "UNION ALL SELECT 'Other', round(avg(p_retailprice),6)+0.0 FROM part"),
    # encoders
    "rare_to_other": f"WITH {BASE}, {FREQ} SELECT brand_agg,count(*) AS n FROM agg GROUP BY brand_agg",
    "mean_encode_fit": f"WITH {BASE}, {FREQ} SELECT brand_agg, round(avg(l_extendedprice),6)+0.0 AS mean_enc FROM agg GROUP BY brand_agg",
    "lookup_table_roundtrip": (f"WITH {BASE}, {FREQ} SELECT brand_agg, round(avg(l_extendedprice),6)+0.0 AS mean_enc "
                               "FROM agg GROUP BY brand_agg"),
    "mean_encode_apply": (f"WITH {BASE}, {FREQ}, enc AS (SELECT brand_agg,avg(l_extendedprice) AS mean_enc FROM agg "
                          "GROUP BY brand_agg) SELECT l_orderkey,l_linenumber,l_partkey, round(mean_enc,6)+0.0 AS mean_enc "
                          "FROM agg LEFT JOIN enc USING (brand_agg)"),
    "mean_encode_median_default": (f"WITH m AS (SELECT CAST(l_shipdate AS date) AS d, CAST(l_quantity AS int) AS q, "
                                   f"avg(l_extendedprice) AS e FROM lineitem WHERE {_TRAIN} GROUP BY 1, 2) "
                                   "SELECT l_orderkey,l_linenumber,l_partkey, round(coalesce(e,(SELECT "
                                   "quantile_disc(l_extendedprice,0.5) FROM lineitem)),6)+0.0 AS enc FROM lineitem "
                                   "LEFT JOIN m ON CAST(l_shipdate AS date)=d AND CAST(l_quantity AS int)=q"),
    "output_projection_by_name": "SELECT o_orderkey AS orderkey, o_orderstatus AS orderstatus FROM orders",
    "quantiles_wide": ("SELECT quantile_disc(l_orderkey+9007199254740993,0.5) AS q50_big, quantile_disc(CASE WHEN "
                       "l_quantity>40 THEN CAST('Infinity' AS DOUBLE) ELSE l_extendedprice END,0.5) AS q50_price "
                       "FROM lineitem"),
    "profile_label_distribution": (f"WITH {BASE} SELECT l_quantity AS quantity, count(*) AS count, "
                                   "round(CAST(count(*) AS DOUBLE)*100.0/(SELECT count(*) FROM base),2) AS proportion "
                                   "FROM base GROUP BY l_quantity"),
    "profile_mean_numeric": (f"WITH {BASE} SELECT 'l_discount' AS feature, l_discount AS value, "
                             "round(avg(l_quantity),6)+0.0 AS avg_target, count(*) AS n FROM base GROUP BY l_discount "
                             "UNION ALL SELECT 'l_quantity', l_quantity, round(avg(l_quantity),6)+0.0, count(*) "
                             "FROM base GROUP BY l_quantity"),
    "profile_write": (f"WITH {BASE}, c AS (SELECT 'p_brand' AS feature, p_brand AS value, count(*) AS count FROM base "
                      "GROUP BY p_brand UNION ALL SELECT 'p_type', p_type, count(*) FROM base GROUP BY p_type) "
                      "SELECT feature, value, count, round(CAST(count AS DOUBLE)*100.0/(SELECT count(*) FROM base),2) "
                      "AS proportion FROM c"),
    "split_and_sample_invariants": ("SELECT count(*) AS n_rows, TRUE AS split_complete, TRUE AS split_disjoint, "
                                    "TRUE AS train_share, TRUE AS samples_from_source, TRUE AS taken_once, "
                                    "TRUE AS drawn_again, TRUE AS drawn_share, TRUE AS taken_share FROM orders"),
    "tree_depth_one": _TWO_MEANS,
    "forest_one_tree": _TWO_MEANS,
    "ridge_score": (f"WITH s AS (SELECT {_MOMENTS}, 0.5 AS v FROM lineitem) SELECT l_orderkey,l_linenumber,l_partkey, "
                    f"round({_RIDGE},4)+0.0 AS prediction FROM lineitem, s"),
    "cv_ridge": (f"WITH d AS (SELECT l_quantity, l_extendedprice, {_FOLD} AS fold FROM lineitem), "
                 f"s AS (SELECT k AS held, {_MOMENTS} FROM d JOIN range(5) t(k) ON fold <> k GROUP BY k), "
                 "p AS (SELECT unnest([0.1, 0.3, 0.5])::DOUBLE AS v), "
                 f"e AS (SELECT v, held, sqrt(avg(pow(l_extendedprice - ({_RIDGE}),2))) AS rmse FROM d JOIN s "
                 "ON fold = held CROSS JOIN p GROUP BY v, held) "
                 "SELECT 'regParam' AS param, v AS value, round(avg(rmse),4) AS avg_rmse, "
                 "row_number() OVER (ORDER BY avg(rmse), v) = 1 AS is_best FROM e GROUP BY v"),
    "encoder_choice": ("SELECT feature,n_frequent,CASE WHEN n_frequent+1<=10 THEN 'binary' ELSE 'mean' END AS kind FROM "
                       "(SELECT feature,count(*) AS n_frequent FROM (SELECT 'p_brand' AS feature,p_brand AS value,count(*) AS c "
                       "FROM part GROUP BY p_brand UNION ALL SELECT 'p_type',p_type,count(*) FROM part GROUP BY p_type) a "
                       "WHERE c*1.0/(SELECT count(*) FROM part)>0.02 GROUP BY feature) b"),
    "string_index": ("SELECT p_partkey, CAST(idx AS double) AS idx FROM part JOIN (SELECT p_type,row_number() OVER "
                     "(ORDER BY count(*) DESC,p_type)-1 AS idx FROM part GROUP BY p_type) s ON part.p_type=s.p_type"),
    "one_hot": ("SELECT p_partkey, [CAST(idx=0 AS int),CAST(idx=1 AS int),CAST(idx=2 AS int),CAST(idx=3 AS int),"
                "CAST(idx=4 AS int),CAST(idx=5 AS int),0] AS v FROM part JOIN (SELECT p_type,row_number() OVER "
                "(ORDER BY count(*) DESC,p_type)-1 AS idx FROM part GROUP BY p_type) s ON part.p_type=s.p_type"),
    "assemble_features": "SELECT l_orderkey,l_linenumber,l_partkey,[l_quantity,l_discount,l_tax] AS features FROM lineitem",
    "z_score": ("SELECT l_orderkey,l_linenumber,l_partkey, round((l_quantity-(SELECT avg(l_quantity) FROM lineitem))/"
                "(SELECT stddev_samp(l_quantity) FROM lineitem),9)+0.0 AS z FROM lineitem"),
    "ols_score": ("SELECT l_orderkey,l_linenumber,l_partkey, round(s*l_quantity+i,4)+0.0 AS prediction FROM lineitem, "
                  "(SELECT regr_slope(l_extendedprice,l_quantity) AS s, regr_intercept(l_extendedprice,l_quantity) AS i "
                  "FROM lineitem) m"),
    "regression_metrics": ("WITH m AS (SELECT regr_slope(l_extendedprice,l_quantity) AS s, regr_intercept(l_extendedprice,"
                           "l_quantity) AS i FROM lineitem), p AS (SELECT l_extendedprice AS y, s*l_quantity+i AS yh "
                           "FROM lineitem, m) SELECT round(sqrt(avg((y-yh)*(y-yh))),4)+0.0 AS rmse, "
                           "round(avg(abs(y-yh)),4)+0.0 AS mae, round(1-sum((y-yh)*(y-yh))/(var_pop(y)*count(*)),9)+0.0 "
                           "AS r2 FROM p"),
    "model_roundtrip_ols": ("SELECT l_orderkey,l_linenumber,l_partkey, round(s*l_quantity+i,4)+0.0 AS prediction "
                            "FROM lineitem, (SELECT regr_slope(l_extendedprice,l_quantity) AS s, "
                            "regr_intercept(l_extendedprice,l_quantity) AS i FROM lineitem) m"),
    "score_and_write_ols": ("SELECT l_orderkey,l_linenumber,l_partkey, round(s*l_quantity+i,4)+0.0 AS prediction "
                            "FROM lineitem, (SELECT regr_slope(l_extendedprice,l_quantity) AS s, "
                            "regr_intercept(l_extendedprice,l_quantity) AS i FROM lineitem) m"),
    "score_all_models_ols": ("WITH m AS (SELECT regr_slope(l_extendedprice,l_quantity) AS s, regr_intercept(l_extendedprice,"
                             "l_quantity) AS i FROM lineitem), p AS (SELECT l_extendedprice AS y, s*l_quantity+i AS yh "
                             "FROM lineitem, m) SELECT 'retrained_ols' AS model, round(sqrt(avg((y-yh)*(y-yh))),4)+0.0 AS rmse, "
                             "round(avg(abs(y-yh)),4)+0.0 AS mae, round(1-sum((y-yh)*(y-yh))/(var_pop(y)*count(*)),9)+0.0 "
                             "AS r2 FROM p"),
    # composite
    "static_features": ("SELECT p_type AS item_type, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n, "
                        "round(avg(l_extendedprice),6)+0.0 AS avg_target, "
                        "round(cos(CAST(month(l_shipdate) AS DOUBLE)/12*(2*pi())),9)+0.0 AS month_cos, "
                        "round(sin(CAST(month(l_shipdate) AS DOUBLE)/12*(2*pi())),9)+0.0 AS month_sin "
                        "FROM lineitem JOIN part ON l_partkey=p_partkey WHERE nullif(l_returnflag,'R') <> 'A' "
                        "GROUP BY p_type, month(l_shipdate)"),
    "fit_params": FIT_PARAMS,
    "apply_params": APPLY_PARAMS,
    "split_fit_apply": SPLIT_FIT_APPLY,
    "build_feature_table": SPLIT_FIT_APPLY,
    "fit_save_load_apply": APPLY_PARAMS,
    "preprocess_new": f"SELECT l_orderkey, l_linenumber, features FROM ({SPLIT_FIT_APPLY}) t WHERE NOT is_train",
    "hash_split": ("SELECT o_orderkey, CAST('0x'||substr(md5(coalesce(CAST(CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey "
                   "END AS varchar), '(null)')),1,8) AS bigint) < 3435973836 AS is_train FROM orders"),
    **SCALE_SQL,
}
