"""Route tickets to support teams and stamp the processing time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.functions import team_for
from ticketmill.schema import DEFAULT_TEAM, TEAM_BY_REQUEST_TYPE


def enrich_tickets(
    tickets: DataFrame,
    teams: Mapping[str, str] = TEAM_BY_REQUEST_TYPE,
    default: str = DEFAULT_TEAM,
) -> DataFrame:
    """Add ``assigned_team`` from a literal mapping: no join, no shuffle."""
    return tickets.withColumns(
        {
            "assigned_team": team_for(F.col("request_type"), teams, default),
            "processing_timestamp": F.current_timestamp(),
        }
    )


def team_table(
    spark: SparkSession, teams: Mapping[str, str] = TEAM_BY_REQUEST_TYPE
) -> DataFrame:
    """A literal mapping as a table (request_type, assigned_team)."""
    entries = [F.lit(part) for pair in teams.items() for part in pair]
    return spark.range(1).select(
        F.explode(F.create_map(*entries)).alias("request_type", "assigned_team")
    )


def enrich_tickets_from_table(
    tickets: DataFrame, teams: DataFrame, default: str = DEFAULT_TEAM
) -> DataFrame:
    """The same enrichment with the mapping as a table (request_type, assigned_team).

    The planner chooses the join from the mapping's real size; if both sides are shuffled,
    the adaptive skew join splits a hot request type. Repeated mappings of a type count
    once (the smallest team name wins), so the join never multiplies tickets.
    """
    mapping = teams.groupBy("request_type").agg(F.min("assigned_team").alias("_team"))
    return tickets.join(mapping, "request_type", "left").select(
        *tickets.columns,
        F.coalesce("_team", F.lit(default)).alias("assigned_team"),
        F.current_timestamp().alias("processing_timestamp"),
    )
