"""Tables beyond a million orders, where cases share a case_id, squares outgrow an int and ranges hold many rows."""

import shutil
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from casegrid.operators import pages
from casegrid.plans.projection import frame

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def shared(tmp_path_factory):
    """Every case three times, with other dates and keys of which lpad leaves the same six digits."""
    out = tmp_path_factory.mktemp("shared")
    for table in SMALL.glob("*.parquet"):
        if table.stem not in ("orders", "lineitem"):
            shutil.copy(table, out)
    for table, key, day in (("orders", "o_orderkey", ", o_orderdate + to_days(cast(9 * (1 + j) as int)) as o_orderdate"), ("lineitem", "l_orderkey", "")):
        source = f"'{SMALL}/{table}.parquet'"
        again = f"select t.* replace (({key} + 100000) * 10 + j as {key}{day}) from {source} t cross join range(2) g(j)"
        duckdb.sql(f"copy (select * replace ({key} + 100000 as {key}) from {source} union all {again}) to '{out}/{table}.parquet' (format parquet)")
    return str(out)


def rows(found):
    return Counter(tuple(round(x, 9) if isinstance(x, float) else tuple(x) if isinstance(x, list) else x for x in r) for r in found)


def same(spark, name, folder):
    db = duckdb.connect()
    for table in Path(folder).glob("*.parquet"):
        db.sql(f"create view {table.stem} as select * from '{table}'")
    told, wanted = rows(entry.queries()[name](spark, folder).collect()), rows(db.sql(entry.oracle_sql()[name]).fetchall())
    assert told == wanted


FUSED = ["run_pair_diff", "error_census_by_field", "determinism_digest", "artefact_violations", "fusion_reconcile", "final_consistency", "fusion_field_select"]
PROVED = ["five_gates", "promotion_gates", "decision_diff", "perturbation_stability", "leak_audit_trusted", "answer_keys_of_two"]


@pytest.mark.parametrize("name", FUSED + PROVED)
def test_cases_that_share_an_id(spark, shared, name):
    same(spark, name, shared)


def test_second_ledger_joins_nothing(spark, shared):
    assert "Join Inner" not in frame(spark, shared, "native").agg(F.count("value"))._jdf.queryExecution().optimizedPlan().toString()


def test_paces_of_large_batches(spark, tmp_path):
    columns = "cast(i as bigint) as o_orderkey, cast(0 as bigint) as o_custkey"
    duckdb.sql(f"copy (select {columns} from range(47000) g(i)) to '{tmp_path}/orders.parquet' (format parquet)")
    same(spark, "recent_pace", str(tmp_path))


def test_ranges_that_hold_many_prices(spark, tmp_path):
    price = "case when i % 3 = 0 then 925.0 when i % 3 = 1 then 900.0 + (i % 50) * 0.7 else 1e3 end"
    duckdb.sql(f"copy (select cast(i as bigint) as p_partkey, cast(i % 20 as int) as p_size, cast({price} as double) as p_retailprice from range(3000) g(i)) to '{tmp_path}/part.parquet' (format parquet)")
    same(spark, "x_range_join", str(tmp_path))
    plan = entry.queries()["x_range_join"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no range is dealt to each bucket, to meet each price there


def test_findings_on_lines_of_one_number(spark):
    texts = [("a", 6, "FINDING: APPROVED"), ("a", 6, "DENIED"), ("b", 6, "FINDING: DENIED"), ("b", 6, "FINDING: who knows"), ("c", 5, "FINDING: who knows"), ("c", 6, "DENIED"), ("d", 6, "FINDING: who knows")]
    lines = spark.createDataFrame([(c, 1, n, t) for c, n, t in texts], "case_id string, page int, line_no int, text string")
    assert {r["case_id"]: r["finding"] for r in pages.findings(lines).collect()} == {"a": "DENIED", "b": "DENIED", "c": "DENIED", "d": None}
