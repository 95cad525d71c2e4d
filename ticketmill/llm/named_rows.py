"""Rows of documents that a list names by id and text, found without shuffling all other texts.

The names make a bitmap of a bounded size, which is broadcast. A row whose cell is empty there
isn't named and passes by. Only the others, named rows and a few false alarms, are shuffled to
meet the list, whatever its length: one plan at every size. On lists longer than the bitmap
was made for only more rows are shuffled.

Rows are carried whole in one column, so no name of theirs can clash with one used here. A
null id is a name like any other; rows that repeat an id and a text are all named by it. An
empty list names nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import written

# Fixed value: a block of Spark's bitmap functions has 4,096 bytes.
BLOCK_BITS = 32_768
CELLS_PER_NAME = 64
MIN_CELLS = 1 << 20
# 2**28 bits are 32 MB: the bound of what is broadcast.
MAX_CELLS = 1 << 28


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct; ``select("row.*")`` gives them back."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]).alias("row")


def named_apart(docs: DataFrame, named: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows that pass by, and those that met the list ``named`` (doc_id, text_hash and more; each name once).

    The first have the columns of ``docs``. The others have ``row``, doc_id, text_hash and
    ``found``, the list's entry, which is null for a false alarm.
    """
    cells = min(MAX_CELLS, max(MIN_CELLS, 1 << (CELLS_PER_NAME * named.count() - 1).bit_length()))
    cell = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(cells))
    block, bit = F.shiftright("cell", 15).cast("int"), (F.col("cell") % BLOCK_BITS).cast("int")
    bitmaps = written(
        named.select(cell.alias("cell")).groupBy(block.alias("block")).agg(F.bitmap_construct_agg(bit).alias("bits")),
        "named-cells",
    )
    rows = docs.select(
        whole_row(docs), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash")
    ).withColumn("cell", cell)
    looked_up = rows.join(F.broadcast(bitmaps), block == F.col("block"), "left")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    possible = F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))
    entry = named.select(
        F.col("doc_id").alias("named_id"), F.col("text_hash").alias("named_text"), F.struct(*named.columns).alias("found")
    )
    # One way at every size; copies of one row are a large partition that adaptive execution splits.
    met = looked_up.where(possible).join(
        entry.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("named_id")) & (F.col("text_hash") == F.col("named_text")),
        "left",
    )
    return looked_up.where(~possible).select("row.*"), met.select("row", "doc_id", "text_hash", "found")
