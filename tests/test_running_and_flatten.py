"""Running sums, moving frames, flattening and table layouts."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater import catalog_more as M
from tidewater.functions.flatten import flatten, flatten_json
from tidewater.operators.running import moving_sums, running_sums
from tidewater.plans import dims
from tidewater.session import scratch_dir
from tidewater.sources import fixtures as fx
from tidewater.sources import sinks

SCHEMA = "g string, at int, id int, v decimal(10,2), _pos_ int"
RNG = random.Random(4)
ROWS = [(RNG.choice(["hot", "hot", "a", "b", None]), RNG.choice([None, *range(50)]), i, RNG.choice([None, Decimal(i) / 4]), i) for i in range(600)]


def _groups():
    out = {}
    for r in sorted(ROWS, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def test_running_sums_equal_plain_python_and_no_group_is_one_task(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(7)
    out = running_sums(df, "g", ["at", "id"], {"s": "v", "n": "_pos_"})
    want = {}
    for rows in _groups().values():
        s, n = None, 0
        for r in rows:
            s = s if r[3] is None else (s or 0) + r[3]
            n += r[4]
            want[r[2]] = (s, n)
    assert {r.id: (r.s, r.n) for r in out.collect()} == want
    assert running_sums(df.limit(0), "g", ["at", "id"], {"s": "v"}).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("rows, block", [(1, 5), (3, 3), (4, 7), (50, 10), (7, 65_536)])
def test_moving_sums_cross_the_borders_of_blocks(spark, rows, block):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    got = {r.id: (r.s, r.n) for r in moving_sums(df, "g", ["at", "id"], rows, {"s": "v"}, {"n": "v"}, block_rows=block).collect()}
    want = {}
    for group in _groups().values():
        for i, r in enumerate(group):
            frame = [x[3] for x in group[max(0, i - rows + 1):i + 1] if x[3] is not None]
            want[r[2]] = (sum(frame) if frame else None, len(frame))
    assert got == want


LINES = ['{"id": 1, "a": {"b": {"c": 1}, "c": "x"}, "a_c": "clash", "items": [{"k": 1, "tags": ["p", "q"]}, {"k": 2}], "other": [7]}',
         '{"id": 2, "items": [], "a": null}', '{"id": 3, "items": [{"k": 2.5, "deep": {"z": [[1, 2], [3]]}}]}', "{broken", "", "[1]"]


def test_json_is_flattened_by_the_type_of_its_own_lines(spark):
    flat = flatten_json(spark.createDataFrame([(x,) for x in LINES], "value string"))
    assert not [f for f in flat.schema.fields if f.dataType.typeName() in ("struct", "array", "map", "variant")]
    rows = [r.asDict() for r in flat.collect()]
    first = sorted((r for r in rows if r["id"] == 1), key=lambda r: (r["items_index"], r["items_deep_z_index"] or 0))
    assert [(float(r["items_k"]), r["items_tags"], r["other"]) for r in first] == [(1, "p", 7), (1, "q", 7), (2, None, None)]
    assert {first[0]["a_c"], first[0]["a_c_2"]} == {"x", "clash"} and first[0]["a_b_c"] == 1
    second = [r for r in rows if r["id"] == 2]
    assert len(second) == 1 and second[0]["items_k"] is None and second[0]["items_index"] is None
    deep = [v for r in rows if r["id"] == 3 for c, v in r.items() if c.startswith("items_deep_z") and "index" not in c]
    assert sorted(deep) == [1, 2, 3]


def test_flatten_of_typed_rows(spark):
    df = spark.sql("select 1 as id, named_struct('x', array(1, 2), 'y', map('k', 5)) as s union all select 2, null")
    got = sorted((r.id, r.s_x, r.s_y_key, r.s_y_value) for r in flatten(df).collect() if r.s_x is not None)
    assert got == [(1, 1, "k", 5), (1, 2, None, None)]
    assert flatten(df).filter("id = 2").count() == 1
    plain = spark.range(3)
    assert flatten(plain).columns == ["id"]


def test_a_quarter_prunes_folders_and_buckets_meet_without_a_shuffle(spark):
    root = scratch_dir(spark, "t_pruned")
    with sinks.catalog_tables(spark, "fact", "items") as (fact, items):
        M.write_pruned(spark, SF_SMALL, root, fact, items)
        calendar = dims.dim_date(fx.stg_transactions(spark, SF_SMALL)).filter("year = 1995 and quarter = 2")
        sinks.replace_table(calendar, f"{root}/calendar")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = M.pruned_join(spark, fact, items, sinks.read_replaced(spark, f"{root}/calendar").filter("quarter = 2"))
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "dynamicpruning" in plan and "SortMergeJoin" in plan
            assert "hashpartitioning(transaction_id" not in plan  # only the few months of the calendar are shuffled
            assert joined.select("transaction_date").distinct().filter("quarter(transaction_date) <> 2 or year(transaction_date) <> 1995").count() == 0
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        names = [fact, items]
    assert not [t for t in names if spark.catalog.tableExists(t)]


def test_a_replaced_table_holds_the_second_state_only(spark):
    path = scratch_dir(spark, "t_replace") + "/t"
    for rows in ([(1,), (2,)], [(3,)]):
        sinks.replace_table(spark.createDataFrame(rows, "x int").select(F.col("x")), path)
    assert [r.x for r in sinks.read_replaced(spark, path).collect()] == [3]
