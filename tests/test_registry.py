"""Every registered query against its DuckDB oracle on sf0.001 (fast), and a
row-count smoke for the rows-only ones."""
import collections
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FAMILIES = {"Linear_Regression", "Decision_Tree", "Random_Forest"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0) if not math.isnan(v) else "NaN"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_against_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, rows) == _digest(ocols, cur.fetchall())


@pytest.fixture(scope="module")
def facts(spark, sf):
    return sorted((r[0], r[1]) for r in spark.read.parquet(f"{sf}/lineitem.parquet").join(
        spark.read.parquet(f"{sf}/part.parquet"), F.col("l_partkey") == F.col("p_partkey"))
        .filter("l_returnflag <> 'A'").select("l_orderkey", "l_linenumber").collect())


def test_models_predict_every_row(spark, sf, facts):
    """One prediction per row of the feature table, nearer to the label than its mean is."""
    for name in ("tree_score", "forest_score"):
        rows = E.queries()[name](spark, sf).toPandas()
        assert sorted(zip(rows.l_orderkey, rows.l_linenumber)) == facts
        spread = ((rows.l_extendedprice - rows.l_extendedprice.mean()) ** 2).sum()
        assert ((rows.l_extendedprice - rows.prediction) ** 2).sum() < spread
    for name in ("model_roundtrip", "score_and_write"):
        rows = E.queries()[name](spark, sf).toPandas()
        assert sorted(zip(rows.l_orderkey, rows.l_linenumber)) == facts and rows.prediction.notna().all()


def test_grid_search_and_selection(spark, sf):
    cv = E.queries()["cv_linear"](spark, sf).collect()
    best = min(cv, key=lambda r: r.avg_rmse)
    assert [r.value for r in cv] == [0.1, 0.3, 0.5] and [r.value for r in cv if r.is_best] == [best.value]
    kept, = E.queries()["retrain_best"](spark, sf).collect()
    assert kept.value == best.value and 0 < kept.r2 < 1
    scored = {r.model: r for r in E.queries()["score_all_models"](spark, sf).collect()}
    assert set(scored) == {f"retrained_{f}" for f in FAMILIES}
    assert all(0 < r.mae <= r.rmse and r.r2 < 1 for r in scored.values())


def test_whole_selection_and_prediction(spark, sf, facts):
    found = {r.model: r for r in E.queries()["model_comparison"](spark, sf).collect()}
    # features say little about this label: no family does much worse than its mean on rows it has not seen
    assert set(found) == FAMILIES and all(0 < r.mae <= r.rmse for r in found.values())
    assert max(r.r2 for r in found.values()) > -0.05
    assert found["Decision_Tree"].best_value in (5, 10, 20) and found["Random_Forest"].best_value in (10, 50, 100)
    rows = E.queries()["train_and_predict"](spark, sf).toPandas()
    assert set(zip(rows.l_orderkey, rows.l_linenumber)) < set(facts) and rows.prediction.notna().all()
    spread = ((rows.l_extendedprice - rows.l_extendedprice.mean()) ** 2).sum()
    assert ((rows.l_extendedprice - rows.prediction) ** 2).sum() < 1.05 * spread


def test_samples_hold_only_rows_of_their_input(spark, sf):
    for name, table in (("random_split", "orders"), ("sample_with_replacement", "lineitem"),
                        ("sample_without_replacement", "lineitem")):
        whole = collections.Counter(map(tuple, spark.read.parquet(f"{sf}/{table}.parquet").collect()))
        drawn = E.queries()[name](spark, sf).drop("is_train")
        rows = collections.Counter(map(tuple, drawn.collect()))
        assert rows and set(rows) <= set(whole)
        if name == "random_split":
            assert rows == whole
        if name == "sample_without_replacement":
            assert all(n <= whole[r] for r, n in rows.items())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["item_type", "month", "n", "avg_target", "month_cos", "month_sin"]
