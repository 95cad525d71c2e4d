"""The clients with most tickets among very many, counting only those that can be among them.

A first pass counts tickets per cell of a hash of the client, so each task sends at most
``CELLS`` rows however many clients there are. A cell's total is an upper bound of every
count in it. The clients of the ``n`` fullest cells are counted exactly; the n-th highest
of their counts is a lower bound of the n-th highest of all. A cell with a smaller total
holds none of the wanted clients, and the others' clients are counted exactly.

So the result is that of ``top_clients``, always. The more uneven the clients, the fewer are
counted; where all are alike no cell can be left out, and all are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators.counts import COUNT, count_by_client
from ticketmill.schema import TOP_CLIENTS

CELLS = 1 << 16


def candidate_tickets(tickets: DataFrame, path: str, n: int = TOP_CLIENTS, cells: int = CELLS) -> DataFrame:
    """The clients' ids of all tickets whose client may be among the first ``n``; null is a client.

    The totals of the cells are written to ``path``. ``tickets`` is read three times, its
    client ids only, so it should be a stored table. Only one number is collected; the cells
    that are joined are at most ``cells`` rows, whatever the number of clients.
    """
    spark = tickets.sparkSession
    clients = tickets.select("client_id", F.pmod(F.xxhash64("client_id"), F.lit(cells)).alias("cell"))
    clients.groupBy("cell").agg(F.count("*").alias("total")).write.mode("overwrite").parquet(path)
    totals = spark.read.schema("cell BIGINT, total BIGINT").parquet(path)
    fullest = totals.orderBy(F.desc("total"), "cell").limit(n)
    first = count_by_client(clients.join(F.broadcast(fullest), "cell", "left_semi"))
    best = first.orderBy(F.desc(COUNT)).limit(n).agg(F.count("*"), F.min(COUNT)).first()
    # With fewer than n clients in those cells there is no bound yet, and every cell counts.
    bound = best[1] if best[0] == n else 0
    return clients.join(F.broadcast(totals.where(F.col("total") >= bound)), "cell", "left_semi").drop("cell")


def top_clients_of_many(tickets: DataFrame, path: str, n: int = TOP_CLIENTS, cells: int = CELLS) -> DataFrame:
    """As ``top_clients``: the ``n`` clients with most tickets, equal counts by client id; for tables of very many clients."""
    counts = count_by_client(candidate_tickets(tickets, path, n, cells))
    return counts.orderBy(F.desc(COUNT), "client_id").limit(n)
