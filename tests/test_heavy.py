"""Top clients from bounds per cell equal those from counting every client."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ticketmill import operators as ops


def clients(spark, counts):
    listed = [(name, n) for name, n in counts.items()]
    frame = spark.createDataFrame(listed, "client_id STRING, n INT")
    return frame.select("client_id", F.explode(F.sequence(F.lit(1), "n")).alias("nth")).repartition(4)


def even(rng):
    return {f"c{i}": 3 for i in range(300)}


def uneven(rng):
    return {f"c{i}": max(1, 2_000 // (i + 1)) for i in range(300)}


def with_null_and_ties(rng):
    return {None: 50, "": 50, "a": 50, **{f"c{i}": rng.randrange(1, 51) for i in range(100)}}


def few(rng):
    return {None: 2, "b": 1}


@pytest.mark.parametrize("cells", [1, 7, 1 << 16])
@pytest.mark.parametrize("shape", [even, uneven, with_null_and_ties, few])
def test_top_clients_of_many(spark, tmp_path, shape, cells):
    tickets = clients(spark, shape(random.Random(5)))
    for n in (1, 4):
        found = ops.top_clients_of_many(tickets, str(tmp_path / f"cells{n}"), n, cells)
        assert rows(found) == rows(ops.top_clients(tickets, n))


def test_no_tickets(spark, tmp_path):
    tickets = clients(spark, {"a": 1}).limit(0)
    assert rows(ops.top_clients_of_many(tickets, str(tmp_path / "cells"))) == []


def test_only_candidates_are_counted(spark, tmp_path):
    """A third of the tickets is one client's; nearly all of 50,000 clients with one ticket are left out."""
    light = spark.range(50_000).select(F.concat(F.lit("l"), F.col("id")).alias("client_id"))
    heavy = spark.range(30_000).select(
        F.when(F.col("id") < 25_000, F.lit("hot")).otherwise(F.concat(F.lit("h"), F.col("id") % 20)).alias("client_id")
    )
    tickets = light.union(heavy)
    candidates = ops.candidate_tickets(tickets, str(tmp_path / "cells"))
    assert candidates.select("client_id").distinct().count() < 100
    plan = candidates.groupBy("client_id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Exchange hashpartitioning(client_id") and "SortMergeJoin" not in plan
    assert rows(ops.top_clients_of_many(tickets, str(tmp_path / "again"))) == rows(ops.top_clients(tickets))
