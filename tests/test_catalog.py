"""Every registered query against its oracle at the smallest scale, and the driver contract."""

import os
import sys

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import canonical, family, sort_key  # noqa: E402
from provisio.plans.proxy import BASE  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, FOLDER)
    got = sorted((tuple(canonical(v) for v in r) for r in df.select(*[f"`{c}`" for c in sorted(df.columns)]).collect()), key=sort_key)
    found = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    kinds = {d[0]: family(str(d[1])) for d in found.description}
    assert {c: family(t) for c, t in df.dtypes} == kinds
    order = [names.index(c) for c in sorted(names)]
    want = sorted((tuple(canonical(r[i]) for i in order) for r in found.fetchall()), key=sort_key)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_explanations_cover_every_feature(spark):
    from provisio.plans.catalog.training import X

    drops = entry.queries()["xpl01_permutation_importance"](spark, FOLDER).collect()
    assert sorted(r["feature"] for r in drops) == sorted(X)
    curves = entry.queries()["xpl03_partial_dependence"](spark, FOLDER).groupBy("feature").count().collect()
    assert sorted(r["feature"] for r in curves) == sorted(X) and {r["count"] for r in curves} == {40}


def test_search_uses_three_folds(spark, monkeypatch):
    from provisio.operators import models as MD

    asked, oof = [], MD.oof_predict
    monkeypatch.setattr(MD, "oof_predict", lambda *a, **k: asked.append(a[3]) or oof(*a, **k))
    assert entry.queries()["mod11_random_search"](spark, FOLDER).count() == 4 and asked == [3] * 4
