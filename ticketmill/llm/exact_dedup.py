"""Exact deduplication by two passes over a Bloom filter (operator 3), in DataFrame operations only.

The first pass counts, per cell of a Bloom filter with two hash functions, the documents
that fall on it; cells met twice or more make a bitmap in blocks. The second pass looks
every document up there. A document with a cell that only it has met can have no copy and
passes straight through. Only the others, copies and a few false alarms, are shuffled by
their digest and grouped. The bitmap has a fixed largest size, so it may be broadcast; on
more documents than it was made for it only lets more of them through to the grouping.

Texts are equal when they are after each run of ASCII white space became one space. A null
text counts as empty. Of equal texts the row with the smallest id stays; null ids come
last. Rows that repeat an id and a text are one group's rows like any others: all count,
and exactly one of them stays. Other columns are not read by ``exact_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import written
from ticketmill.llm.named_rows import whole_row

# A bitmap block of Spark's bitmap functions has 4,096 bytes.
BLOCK_BITS = 32_768
CELLS_PER_DOCUMENT = 16
MIN_CELLS = 1 << 20
# 2**28 bits are 32 MB: the bound of what is broadcast.
MAX_CELLS = 1 << 28
# At most this many groups can hold more than their share of the rows; they are broadcast.
HOT_GROUPS = 1_000
MIN_HOT_ROWS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space made one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def _cell(digest: Column, turn: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(turn), digest), F.lit(cells))


def _block(cell: Column) -> Column:
    return F.shiftright(cell, 15).cast("int")


def repeated_cells(digests: DataFrame, cells: int) -> DataFrame:
    """First pass: the cells met more than once, as one bitmap per block."""
    both = F.array(*[_cell(F.col("text_sha256"), turn, cells) for turn in (0, 1)])
    return (
        # a document meets each of its cells once, also if its two are the same
        digests.select(F.explode(F.array_distinct(both)).alias("cell"))
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("met"))
        .where("met > 1")
        .groupBy(_block(F.col("cell")).alias("block"))
        .agg(F.bitmap_construct_agg(F.col("cell") % BLOCK_BITS).alias("bits"))
    )


def with_possible_copies(digests: DataFrame, bitmaps: DataFrame, cells: int) -> DataFrame:
    """Second pass: adds ``possible``, false where the filter rules out any copy."""
    looked_up = digests
    for turn in (0, 1):
        cell = _cell(F.col("text_sha256"), turn, cells)
        bitmap = F.broadcast(bitmaps.select(F.col("block").alias(f"block{turn}"), F.col("bits").alias(f"bits{turn}")))
        looked_up = looked_up.withColumn(f"cell{turn}", cell).join(
            bitmap, _block(F.col(f"cell{turn}")) == F.col(f"block{turn}"), "left"
        )
    hits = []
    for turn in (0, 1):
        position = (F.col(f"cell{turn}") % BLOCK_BITS).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"bits{turn}"), F.shiftright(position, 3) + 1, F.lit(1))), 16, 10)
        hits.append(F.coalesce(F.getbit(byte.cast("int"), position % 8) == 1, F.lit(False)))
    return looked_up.select(*digests.columns, (hits[0] & hits[1]).alias("possible"))


def _sorted_out(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """doc_id, text_sha256 and ``possible`` of every row, with the bitmaps and their number of cells."""
    digests = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("text_sha256")),
        "digests",
    )
    wanted = max(MIN_CELLS, CELLS_PER_DOCUMENT * digests.count())
    cells = min(MAX_CELLS, 1 << (wanted - 1).bit_length())
    bitmaps = written(repeated_cells(digests, cells), "repeated-cells")
    return written(with_possible_copies(digests, bitmaps, cells), "possible-copies"), bitmaps, cells


def _members_and_groups(sorted_out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Possible copies by digest and id with their number of rows, and the groups they form."""
    # Equal rows of an id and a text become one with their number, so no group is gathered row by row.
    members = written(
        sorted_out.where("possible").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("rows")), "members"
    )
    groups = written(
        members.groupBy("text_sha256").agg(
            F.min("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"), F.count(F.lit(1)).alias("members")
        ),
        "groups",
    )
    return members, groups


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    sorted_out, _, _ = _sorted_out(docs, id_col, text_col)
    alone = sorted_out.where(~F.col("possible")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    members, groups = _members_and_groups(sorted_out)
    # No more than HOT_GROUPS groups can have over 1/HOT_GROUPS of all members.
    hot_rows = max(MIN_HOT_ROWS, -(-members.count() // HOT_GROUPS))
    hot = F.broadcast(groups.where(F.col("members") > hot_rows))
    spread = members.join(hot, "text_sha256")
    others = members.join(hot.select("text_sha256"), "text_sha256", "left_anti").join(
        groups.where(F.col("members") <= hot_rows), "text_sha256"
    )
    grouped = (
        spread.unionByName(others)
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return alone.unionByName(grouped)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that the filter rules out pass straight through. The others meet the row that stays
    of their group by id and digest. Where rows repeat an id and a text of which one stays,
    one of them is taken. Of a group without ids, one row is taken.
    """
    sorted_out, bitmaps, cells = _sorted_out(docs, id_col, text_col)
    _, groups = _members_and_groups(sorted_out)
    rows = docs.select(
        whole_row(docs),
        F.col(id_col).cast("long").alias("doc_id"),
        text_digest(F.col(text_col)).alias("text_sha256"),
    )
    looked_up = with_possible_copies(rows, bitmaps, cells)
    alone = looked_up.where(~F.col("possible")).select("row.*")
    stays = groups.select(F.col("text_sha256").alias("digest"), "keep_id")
    # One way at every size: a merge join of the possible copies, spread by id and digest.
    kept = (
        looked_up.where("possible")
        .join(
            stays.hint("merge"),
            (F.col("text_sha256") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("keep_id")),
        )
        .dropDuplicates(["text_sha256", "doc_id"])
        .select("row.*")
    )
    return alone.union(kept)
