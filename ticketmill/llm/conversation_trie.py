"""Prefix trie of conversations from padded turn-id matrices (operator 12).

A conversation is the sequence of its turns' ids, digests of role and text. The sequences
are laid out in sorted ranges, the shards. A shard's sequences form a matrix of dense turn
ids, padded behind their ends and ordered by numpy's lexsort. A mask tells where a column
changes from one row to the next; accumulated by OR along the columns it marks the rows
where the node of each depth starts, and ``reduceat`` over all depths at once gives every
node's numbers. Each number is a sum over the node's rows, so nothing is handed from child
to parent:

- a row adds a child to the node of depth d if it shares d turns with the row before it and goes on;
- a row adds a leaf to its nodes unless the next row begins with all of it;
- a row that isn't its node's first adds, for every turn it shares with the row before, from
  the node's own on, the characters of that turn: exactly the repeated ones.

Only the nodes of a shard's first and last row can go on in another shard. Their pieces are
recombined by one grouping over the digests of their paths; a piece learns there whether its
first row's and last row's nodes go on, which settles what the shard alone couldn't know.
All other nodes are final and pass straight through, save for the smallest member of a
parent that goes on.

Turns with equal numbers go by their digest. Digests have 128 bits and are taken as the
turns. Rows without a conversation's id belong to none and are left out; repeated rows are
turns like any others. An empty table gives no nodes, not even a root. Of the other columns
none is read.

A task holds ``BLOCK_CELLS`` matrix cells, or one conversation; a conversation's turns, some
20 bytes each, are one row. Equal and similar conversations are spread over shards like any
others. The digest of a node's ending members is one chain of hashing by definition: the
shards' packed ids of one node go, in order, through one task that holds one packet at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.common import arrow_map, written

ID_BYTES = 16
# The cells of one matrix, and the turns of one shard.
BLOCK_CELLS = 1 << 20
SHARD_TURNS = 250_000
NO_ENDS = hashlib.sha256().hexdigest()

NODE_SCHEMA = (
    "shard long, conv_id long, depth long, parent_conv_id long, parent_path binary, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, path binary, on_first boolean, on_last boolean, "
    "goes_on boolean, ends_last boolean, turn_chars long, ends binary"
)
RESULT = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


def turn_sequences(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per conversation: conv_id and ``turns``, an array of (number, id, chars) in order."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    one = F.struct(F.col(turn_col).alias("number"), digest.alias("id"), F.length(text).alias("chars"))
    return (
        turns.where(F.col(conv_col).isNotNull())
        .select(F.col(conv_col).cast("long").alias("conv_id"), one.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )


def graft_openings(sequences: DataFrame, base: Column, length: Column, most: int) -> DataFrame:
    """Conversations whose first ``length`` turns (at most ``most``) are replaced by those of the conversation ``base``."""
    openings = sequences.select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, most).alias("opening")
    )
    own = F.filter("turns", lambda _, at: at >= F.col("grafted"))
    begin = F.slice(F.coalesce("opening", F.array().cast(sequences.schema["turns"].dataType)), F.lit(1), F.col("grafted"))
    return (
        sequences.withColumn("base", base)
        .withColumn("grafted", length.cast("int"))
        .join(openings, F.col("base") == F.col("base_id"), "left")
        .select("conv_id", F.concat(begin, own).alias("turns"))
    )


def _paths(sequence: bytes) -> list[bytes]:
    """Digests of the sequence's beginnings, the empty one first."""
    chain, found = hashlib.blake2b(digest_size=ID_BYTES), []
    found.append(chain.digest())
    for at in range(0, len(sequence), ID_BYTES):
        chain.update(sequence[at : at + ID_BYTES])
        found.append(chain.digest())
    return found


def _ends_digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def trie_nodes(convs: np.ndarray, sequences: list[bytes], chars: list[np.ndarray], shard: int) -> pa.RecordBatch:
    """The nodes of one block of conversations, a range of the sorted ones: final nodes and pieces of those on its rims.

    Final nodes have no path. Pieces have one, and lack what only their neighbours know.
    """
    rows = len(convs)
    lengths = np.array([len(one) // ID_BYTES for one in sequences], dtype=np.int64)
    width = int(lengths.max()) + 1
    filled = np.arange(1, width)[None, :] <= lengths[:, None]
    ids = np.frombuffer(b"".join(sequences), dtype=">u8").reshape(-1, 2)
    # Column d holds the d-th turn's id; the root's column 0 is the same everywhere, and nothing is -1.
    matrix = np.full((rows, width), -1, dtype=np.int64)
    matrix[:, 0] = 0
    if len(ids):
        matrix[:, 1:][filled] = np.unique(ids, axis=0, return_inverse=True)[1].reshape(-1)
    turn_chars = np.zeros((rows, width), dtype=np.int64)
    if len(ids):
        turn_chars[:, 1:][filled] = np.concatenate(chars)
    order = np.lexsort((convs, *matrix.T[::-1]))
    convs, lengths, matrix, turn_chars = convs[order], lengths[order], matrix[order], turn_chars[order]
    summed = np.cumsum(turn_chars, axis=1)

    changed = np.ones((rows, width), dtype=bool)
    np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1, out=changed[1:])
    alike = np.minimum(width - changed.sum(axis=1) - 1, lengths)  # turns shared with the row before
    alike[0] = -1  # not known here

    # All depths at once, one after the other: places of the nodes' first rows and of the gaps between them.
    starts = np.flatnonzero(changed.T.ravel())
    depth, first = np.divmod(starts, rows)
    size = np.diff(starts, append=rows * width)
    is_node = depth <= lengths[first]

    depths = np.arange(width)[None, :]
    child = (alike[:, None] <= depths) & (alike[:, None] >= 0) & (depths < lengths[:, None])
    leaf = np.ones(rows, dtype=np.int64)
    leaf[:-1] = alike[1:] != lengths[:-1]
    leaf[-1] = 0  # not known here
    shared = np.take_along_axis(summed, np.maximum(alike, 0)[:, None], axis=1)
    before = np.zeros((rows, width), dtype=np.int64)
    before[:, 1:] = summed[:, :-1]
    repeated = np.where(alike[:, None] >= depths, np.maximum(shared - before, 0), 0)

    def total(cells: np.ndarray, how: np.ufunc = np.add) -> np.ndarray:
        return how.reduceat(np.ascontiguousarray(cells.T).ravel(), starts)[is_node]

    every = np.broadcast_to
    members = total(every(convs[:, None], (rows, width)), np.minimum)
    children = total(child.astype(np.int64))
    leaves = total(every(leaf[:, None], (rows, width)))
    saved = total(repeated)
    ending = total((lengths[:, None] == depths).astype(np.int64))

    parents_at = np.cumsum(is_node) - 1  # of all starts, the node's number
    parent = np.searchsorted(starts, np.maximum(depth - 1, 0) * rows + first, side="right") - 1
    parent = parents_at[parent][is_node]
    depth, first, size = depth[is_node], first[is_node], size[is_node]
    on_first, on_last = first == 0, first + size == rows
    rim = on_first | on_last

    first_paths = _paths(sequences[order[0]])
    last_paths = _paths(sequences[order[-1]])

    def path(node: int) -> bytes:
        return (first_paths if on_first[node] else last_paths)[depth[node]]

    count = len(depth)
    root = depth == 0
    paths = [path(node) if rim[node] else None for node in range(count)]
    of_parent = [paths[up] if up_depth else None for up, up_depth in zip(parent.tolist(), depth.tolist())]
    ended = [convs[at : at + n] if n else convs[:0] for at, n in zip(first.tolist(), ending.tolist())]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(count, shard), pa.int64()),
            pa.array(members, pa.int64()),
            pa.array(depth, pa.int64()),
            pa.array(members[parent], pa.int64(), mask=root | rim[parent]),
            pa.array(of_parent, pa.binary()),
            pa.array(size, pa.int64()),
            pa.array(children, pa.int64()),
            pa.array(leaves, pa.int64()),
            pa.array(saved, pa.int64()),
            pa.array(
                [None if out else _ends_digest(ids) if len(ids) else NO_ENDS for out, ids in zip(rim.tolist(), ended)],
                pa.string(),
            ),
            pa.array(paths, pa.binary()),
            pa.array(on_first),
            pa.array(on_last),
            pa.array(on_first & (depth < lengths[0])),
            pa.array(on_last & (depth == lengths[-1])),
            pa.array(turn_chars[first, depth], pa.int64()),
            pa.array([ids.tobytes() if out and len(ids) else None for out, ids in zip(rim.tolist(), ended)], pa.binary()),
        ],
        names=[field.split()[0] for field in NODE_SCHEMA.split(", ")],
    )


def _shard_nodes(block_cells: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a sorted partition, block by block; a block is closed before its matrix exceeds ``block_cells``."""
    convs, sequences, chars, widest, block, shard = [], [], [], 1, 0, 0

    def close() -> pa.RecordBatch:
        return trie_nodes(np.array(convs, dtype=np.int64), sequences, chars, (shard << 32) + block)

    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("part", "conv_id", "sequence", "chars"))
        for part, conv, sequence, own in zip(*columns):
            shard, width = part, len(sequence) // ID_BYTES + 1
            if convs and max(widest, width) * (len(convs) + 1) > block_cells:
                yield close()
                convs, sequences, chars, widest, block = [], [], [], 1, block + 1
            convs.append(conv)
            sequences.append(sequence)
            chars.append(np.array(own, dtype=np.int64))
            widest = max(widest, width)
    if convs:
        yield close()


def _chained_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the ids of packets that come in order of path and shard."""
    path, chain = None, None

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([path], pa.binary()), pa.array([chain.hexdigest()], pa.string())], names=["ended", "digest"]
        )

    for batch in batches:
        for one, packet in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            if one != path:
                if chain:
                    yield result()
                path, chain = one, hashlib.sha256()
            else:
                chain.update(b",")
            chain.update(",".join(map(str, np.frombuffer(packet, dtype=np.int64).tolist())).encode())
    if chain:
        yield result()


def _recombined(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that pieces make, with their path, and each piece's place: shard, path and smallest member."""
    spans = pieces.groupBy("path").agg(F.min("shard").alias("low"), F.max("shard").alias("high"))
    placed = pieces.join(spans.withColumnRenamed("path", "span"), F.col("path") == F.col("span"))
    settled = placed.withColumns(
        {
            # A piece that isn't its node's first has the shard's first row, and that row's node began before.
            "began": F.col("shard") > F.col("low"),
            "last_leaf": F.col("ends_last") & (F.col("shard") == F.col("high")),
        }
    )
    down = Window.partitionBy("shard", "on_first").orderBy(F.col("depth").desc())
    below = F.sum(F.when(F.col("began"), F.col("turn_chars")).otherwise(0)).over(
        down.rowsBetween(Window.unboundedPreceding, 0)
    )
    next_began = F.coalesce(F.lag("began").over(down), F.lit(False))
    any_leaf = F.max("last_leaf").over(Window.partitionBy("shard"))
    settled = settled.withColumns(
        {
            "saved_tokens": F.col("saved_tokens") + F.when(F.col("on_first") & F.col("began"), below).otherwise(0),
            "n_children": F.col("n_children") + F.when(F.col("goes_on") & ~next_began, 1).otherwise(0),
            "n_leaves": F.col("n_leaves") + F.when(F.col("on_last") & any_leaf, 1).otherwise(0),
        }
    )
    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.first(name).alias(name) for name in ("depth", "parent_path")]
    nodes = written(settled.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *same, *sums), "rim-nodes")
    members = nodes.select(F.col("path").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    packets = (
        pieces.where("ends is not null")
        .select("path", "shard", "ends")
        .repartition("path")
        .sortWithinPartitions("path", "shard")
    )
    digests = arrow_map(packets.select("path", "ends"), _chained_digests, "ended binary, digest string")
    whole = (
        nodes.join(members, F.col("parent_path") == F.col("up"), "left")
        .join(digests, F.col("path") == F.col("ended"), "left")
        .withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS)))
    )
    places = pieces.select("shard", "path").join(members, F.col("path") == F.col("up"))
    return whole.select(*RESULT), places.select("shard", "path", F.col("parent_conv_id").alias("found"))


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The nodes of conversations (conv_id, turns): the columns of ``RESULT``, one row per node, the root included."""
    turns = F.col("turns")
    packed = written(
        sequences.select(
            "conv_id",
            F.unhex(F.array_join(F.transform(turns["id"], F.hex), "")).alias("sequence"),
            turns["chars"].alias("chars"),
        ),
        "sequences",
    )
    cells = packed.agg(F.sum(F.size("chars") + 1).alias("cells")).first()["cells"] or 0
    tasks = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = (
        packed.repartitionByRange(max(tasks, -(-cells // shard_turns)), "sequence", "conv_id")
        .sortWithinPartitions("sequence", "conv_id")
        .select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "sequence", "chars")
    )
    found = written(arrow_map(shards, partial(_shard_nodes, block_cells), NODE_SCHEMA), "shard-nodes")
    pieces = found.where("path is not null")
    rims, places = _recombined(pieces)
    final = found.where("path is null")
    settled = final.where("parent_path is null").select(*RESULT)
    # A shard's few rim nodes are the parents that are looked up, so no parent gathers all its children.
    looked_up = (
        final.where("parent_path is not null")
        .select("shard", *[name for name in RESULT if name != "parent_conv_id"], "parent_path")
        .join(
            places.withColumnRenamed("shard", "place"),
            (F.col("shard") == F.col("place")) & (F.col("parent_path") == F.col("path")),
        )
        .withColumn("parent_conv_id", F.col("found"))
    )
    return settled.unionByName(looked_up.select(*RESULT)).unionByName(rims)
