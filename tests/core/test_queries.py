"""Each library query against its SQL on the smallest tables, and a clean shape for those without SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import selection
from tallyforge.plans import catalog
from tallyforge.plans.fixtures import TABLES, load, with_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    out = []
    for r in frame[cols].astype(object).where(frame[cols].notna(), None).itertuples(index=False):
        out.append(tuple("null" if v is None else f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r))
    return cols, sorted(out)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name]).df()
        assert rows(got) == rows(want)
    else:
        assert len(got.columns)


@pytest.mark.parametrize("size", [40, 10_000])
def test_a_table_is_numbered_in_parts(spark, size):
    """Places are those of one sort of the whole table, and no task sorts more than a part of it."""
    given = [(i * 37 % 101 - 50, i, f"t{i}") for i in range(900)] + [(7, -i, "hot") for i in range(1, 200)]
    numbered = selection.number_rows(spark.createDataFrame(given, "a long, b long, t string").repartition(5), ["a", "b"], "at", size)
    parts = numbered.withColumn("_p", F.spark_partition_id()).collect()
    assert sorted((r["at"], r.a, r.b, r.t) for r in parts) == [(k, *r) for k, r in enumerate(sorted(given), 1)]
    largest = max(sum(r._p == p for r in parts) for p in {r._p for r in parts})
    assert largest == 1099 if size > 1099 else largest < 320  # 208 rows share a value


def test_meta_is_numbered_without_bringing_it_to_one_task(spark, duck, monkeypatch):
    monkeypatch.setattr(selection.number_rows, "__defaults__", ("line", 500))
    got = load(spark, SF, "meta").withColumn("_p", F.spark_partition_id()).toPandas()
    assert got.groupby("_p").size().max() < 1500
    want = duck.sql(with_tables("meta") + " SELECT line, source_row_id, block, weight FROM meta").df()
    assert rows(got[["line", "source_row_id", "block", "weight"]]) == rows(want)


def test_alignment_numbers_meta_once_for_both_sides(spark):
    plan = catalog.QUERIES["jon_01_align"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.count("Join Inner") == 1
