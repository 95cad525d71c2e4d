import pytest
from conftest import rows

from ticketmill.operators import enrich_tickets, enrich_tickets_from_table, team_table
from ticketmill.schema import TEAM_BY_REQUEST_TYPE
from ticketmill.streaming import start_enriched_table, wait_for
from ticketmill.streaming.queries import ONCE

TYPES = [
    ("incident_technique", "Equipe Infrastructure"),
    ("demande_information", "Support Client N1"),
    ("demande_evolution", "Equipe Produit"),
    ("maintenance", "Equipe Operations"),
    ("facturation", "Service Comptabilite"),
    ("autre", "Support General"),
    ("Facturation", "Support General"),
    ("facturation ", "Support General"),
    ("", "Support General"),
    (None, "Support General"),
]


@pytest.fixture
def typed(spark):
    return spark.createDataFrame([(kind,) for kind, _ in TYPES], "request_type STRING")


def test_literal_mapping(typed):
    found = enrich_tickets(typed).select("request_type", "assigned_team")
    assert rows(found) == TYPES


def test_other_mapping(typed):
    found = enrich_tickets(typed, {"autre": "Equipe Autre"}, default="Personne")
    assert {row.assigned_team for row in found.collect()} == {"Equipe Autre", "Personne"}
    nobody = enrich_tickets(typed, {}, default="Personne")
    assert {row.assigned_team for row in nobody.collect()} == {"Personne"}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_mapping_table(spark, typed, threshold):
    """The planner chooses the join; its result is the same."""
    doubled = [*TEAM_BY_REQUEST_TYPE.items(), ("maintenance", "Z"), (None, "nobody")]
    teams = spark.createDataFrame(doubled, "request_type STRING, assigned_team STRING")
    found = enrich_tickets_from_table(typed, teams)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
        joined = rows(found.select("request_type", "assigned_team"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert sorted(joined, key=str) == sorted(TYPES, key=str)


def test_mapping_as_table(spark):
    assert dict(rows(team_table(spark))) == TEAM_BY_REQUEST_TYPE


def test_empty_mapping_table(spark, typed):
    teams = spark.createDataFrame([], "request_type STRING, assigned_team STRING")
    found = enrich_tickets_from_table(typed, teams)
    assert {row.assigned_team for row in found.collect()} == {"Support General"}


def test_one_processing_time(typed):
    assert enrich_tickets(typed).select("processing_timestamp").distinct().count() == 1


def test_mapping_table_on_a_stream(spark, typed, tmp_path):
    typed.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(typed.schema).parquet(str(tmp_path / "in"))
    enriched = enrich_tickets_from_table(stream, team_table(spark))
    wait_for(
        start_enriched_table(enriched, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ONCE)
    )
    found = spark.read.parquet(str(tmp_path / "out")).select("request_type", "assigned_team")
    assert sorted(rows(found), key=str) == sorted(TYPES, key=str)
