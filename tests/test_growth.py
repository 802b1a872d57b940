"""Queries whose work must spread as their input grows, on rows built here."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postlake import read_captures, write_captures
from postlake.functions import aliases
from postlake.plans import board_bindings, derived
from tests import builders as b


@pytest.fixture
def partitions(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "12")
    yield 12
    spark.conf.set(key, before)


def orders(spark, folder, n=600):
    key = F.col("id")
    rows = spark.range(n).select(
        key.alias("o_orderkey"), (key % 7).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "OFP")), (key % 3 + 1).cast("int")).alias("o_orderstatus"),
        (key * 10.5).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    rows.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def parts(spark, folder, n=1300):
    key = F.col("id")
    rows = spark.range(n).select(
        key.alias("p_partkey"), F.concat(F.lit("part "), key).alias("p_name"), F.lit("Brand#1").alias("p_brand"), F.lit("SMALL TIN").alias("p_type"),
        (key % 50 + 1).cast("int").alias("p_size"), (key + 900.5).alias("p_retailprice"),
    )
    rows.write.parquet(f"{folder}/part.parquet")
    return str(folder)


def staged(spark, name):
    """The newest folder that a query of this session has made."""
    found = Path(spark.conf.get("spark.checkpoint.dir"), spark.sparkContext.applicationId).glob(f"{name}-*")
    return max(found, key=lambda p: p.stat().st_mtime_ns)


def test_lines_of_a_snapshot_are_numbered_by_block(spark, tmp_path, partitions):
    out = board_bindings.snapshot_roundtrip(spark, orders(spark, tmp_path))
    rows = out.collect()
    want = {s: sorted((k for k in range(600) if k % 7 % 2 == i), key=lambda k: (k % 100, k)) for i, s in enumerate(["20260316T120000Z", "20260317T000000Z"])}
    assert {s: [r.job_id for r in sorted(rows, key=lambda r: r.place) if r.snapshot == s] for s in want} == {s: [f"k{k}" for k in keys] for s, keys in want.items()}
    assert {s: [r.place for r in sorted(rows, key=lambda r: r.place) if r.snapshot == s] for s in want} == {s: [*range(1, len(keys) + 1)] for s, keys in want.items()}
    # No window has the rows of a snapshot as its group, only counts.
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    assert len(windows) == 1 and "Aggregate [" in plan[windows[0] + 1]


def test_files_of_an_age_are_parsed_side_by_side(spark, tmp_path, partitions):
    rows = board_bindings.stream_bounded_state(spark, parts(spark, tmp_path)).collect()
    want = [(f"K{k}", k // 400 % 3 != 0) for k in range(1300) if k % 60 and 1 <= k % 37 <= 30]
    assert sorted(map(tuple, rows)) == sorted(want)
    files = [*Path(staged(spark, "bounded"), "captures").glob("*.parquet")]
    assert len(files) > 3


def test_a_run_is_written_in_one_piece(spark, tmp_path):
    rows = [b.capture("karirhub", "listing_api", {"data": []}, page=page, run=run) for run in ("r1", "r2") for page in range(1, 9)]
    captures = b.frame(spark, rows).repartition(8)
    write_captures(captures, str(tmp_path / "captures"))
    assert read_captures(spark, str(tmp_path / "captures")).select(captures.columns).exceptAll(captures).count() == 0
    for run in ("r1", "r2"):
        assert len([*Path(tmp_path, "captures", "source=karirhub", f"run_id={run}").glob("*.parquet")]) == 1


def test_batches_do_not_grow_with_the_files(spark, tmp_path, partitions):
    rows = board_bindings.stream_rejects(spark, orders(spark, tmp_path)).collect()
    assert {(r.page_no, r.reject): r.n for r in rows} == {
        **{(page, "not an object"): 1 for page in range(1, 31)}, **{(k % 2000 // 20 + 1, "missing company"): 1 for k in range(0, 600, 50)},
    }
    folder = staged(spark, "rejects")
    assert len([*Path(folder, "captures").glob("*.parquet")]) > 8
    assert 1 < len([*Path(folder, "out", "items").glob("batch=*")]) <= 4


@pytest.mark.parametrize(("read", "table"), [(derived.glints_details, "part"), (derived.kitalulus, "part"), (derived.karirhub, "orders")])
def test_captures_are_written_by_many_tasks(spark, tmp_path, partitions, read, table):
    """The texts of pages are put together after the rows are dealt, not by the few tasks that read a small table."""
    made = read(spark, (orders if table == "orders" else parts)(spark, tmp_path))
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "RepartitionByExpression" in line]
    assert dealt and not any("to_json" in line or "apolloCache" in line or "<main>" in line for line in plan[dealt[-1]:])


def test_only_what_names_a_fact_is_searched_for_facts(spark):
    """Deep parts without pagination facts are not opened; those with a fact, or with an escape that may hide one, are."""
    nest = lambda inner, n: '{"a":' * n + inner + "}" * n
    facts = '{"current_page":2,"last_page":"9"}'
    plain, hidden = nest('{"b":1}', 12), nest('{"tot\\\\u0061l":1}', 12)
    texts = [f'{{"x":{plain},"meta2":{facts}}}', f'{{"x":{nest(facts, 12)},"meta2":{facts}}}', f'{{"x":[{plain},{facts}],"y":{facts[:-1]},"z":1}}}}', f'{{"x":{hidden}}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, _context string")
    found = {r.n: (r._meta, r._met) for r in aliases.with_page_meta(rows).select("n", "_meta", "_met").collect()}
    assert found[0] == (facts, True) and found[1][1] is False and found[2] == (facts, True) and found[3][0] is None
