"""Fill-in-middle transformation by displacement scatter (operator 11).

A text is cut at two token bounds into prefix, middle and suffix, which are put behind
marks in another order. A whole slice of texts is treated as one array of bytes: a scan
marks where tokens start and gives the cuts; at every segment's first byte a difference
array gets the change of the shift to its place in the output; its cumulative sum is the
shift of every byte, and one scatter builds all outputs. ``restore`` finds the marks in the
outputs alone and gathers the bytes back in the same way.

Tokens are runs of the letters A-Z and a-z, and single code points of anything else. The
draws come from a hash of the id, so a row's result depends on nothing but itself. Texts
pass from task to task unshuffled; memory is bounded by ``SLICE_BYTES`` or one text.

Defined results: a null text counts as empty; empty texts and texts that hold a mark stay
plain. A null id draws as an empty one. Rows that repeat an id draw alike; rows that repeat
an id and a text have equal results, one per row. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.llm.common import arrow_map

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
MARK_BYTES = 3
FORMS = np.array(["plain", "psm", "spm"])
PLAIN, PSM, SPM = range(3)
# Bytes of the texts that one call of the scatter treats together; a longer text is treated alone.
SLICE_BYTES = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("a") : ord("z") + 1] = True
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[ord(mark[1]) for mark in MARKS.values()]] = 1, 2, 3
# The order of the marks' kinds in an output of each form.
_ORDER = {PSM: [1, 2, 3], SPM: [2, 1, 3]}
_MARK = np.frombuffer("".join(MARKS.values()).encode(), dtype=np.uint8).reshape(3, MARK_BYTES)


def _marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, kind and text of every mark that lies in one text."""
    if len(data) < MARK_BYTES:
        return (np.zeros(0, dtype=np.int64),) * 3
    kinds = np.where((data[:-2] == ord("<")) & (data[2:] == ord(">")), _KIND[data[1:-1]], 0)
    at = np.flatnonzero(kinds)
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + MARK_BYTES <= offsets[row + 1]
    return at[inside], kinds[at[inside]], row[inside]


def _shifts(size: int, starts: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The shift of each of ``size`` places, from the segments' first places, ascending, and their shifts."""
    difference = np.zeros(size + 1, dtype=np.int64)
    np.add.at(difference, starts, np.diff(shifts, prepend=0))
    return np.cumsum(difference[:size])


def _sums(flags: np.ndarray) -> np.ndarray:
    """How many flags stand before each place."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums


def scatter(
    data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, plain_percent: int, spm_percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Outputs of the texts ``data[offsets[i]:offsets[i + 1]]``; ``draws`` has four columns, one row per text.

    Returns the outputs' bytes and offsets, and per text the number of tokens, the form and
    the code points of prefix and middle.
    """
    starts, ends = offsets[:-1], offsets[1:]
    first_byte = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    goes_on[starts[starts < ends]] = False
    token = first_byte & ~goes_on
    tokens, points = _sums(token), _sums(first_byte)
    places = np.append(np.flatnonzero(token), len(data))
    count = tokens[ends] - tokens[starts]
    drawn = draws[:, :2] % (count + 1)[:, None]

    def cut(at: np.ndarray) -> np.ndarray:
        return np.where(at == count, ends, places[tokens[starts] + at])

    one, two = cut(drawn.min(axis=1)), cut(drawn.max(axis=1))
    prefix, middle, suffix = one - starts, two - one, ends - two

    plain = (starts == ends) | (draws[:, 2] % 100 >= 100 - plain_percent)
    plain[_marks(data, offsets)[2]] = True
    form = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < spm_percent, SPM, PSM))

    out_offsets = np.zeros(len(offsets), dtype=np.int64)
    np.cumsum(ends - starts + np.where(plain, 0, len(MARKS) * MARK_BYTES), out=out_offsets[1:])
    begin = out_offsets[:-1]
    to_prefix = begin + MARK_BYTES + np.where(form == SPM, suffix + MARK_BYTES, 0)
    to_suffix = begin + MARK_BYTES + np.where(form == PSM, prefix + MARK_BYTES, 0)
    to_middle = begin + len(MARKS) * MARK_BYTES + prefix + suffix
    segments = np.stack([starts, one, two], axis=1)
    targets = np.where(
        plain[:, None], begin[:, None] + segments - starts[:, None], np.stack([to_prefix, to_middle, to_suffix], axis=1)
    )
    out = np.empty(out_offsets[-1], dtype=np.uint8)
    out[np.arange(len(data)) + _shifts(len(data), segments.ravel(), (targets - segments).ravel())] = data
    for mark, target in zip(_MARK, (to_prefix, to_suffix, to_middle)):
        out[(target[~plain] - MARK_BYTES)[:, None] + np.arange(MARK_BYTES)] = mark
    return out, out_offsets, count, form, points[one] - points[starts], points[two] - points[one]


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, as bytes and offsets, whose outputs are given with their forms."""
    starts, ends = offsets[:-1], offsets[1:]
    moved = np.flatnonzero(form != PLAIN)
    at, kinds, row = _marks(data, offsets)
    marked = form[row] != PLAIN
    at, kinds, row = at[marked], kinds[marked], row[marked]
    order = np.array([_ORDER.get(one, ()) for one in form[moved].tolist()], dtype=np.int64).ravel()
    if not (np.array_equal(row, np.repeat(moved, len(MARKS))) and np.array_equal(kinds, order)):
        raise ValueError("An output doesn't hold its form's marks once each, in their order")
    at = at.reshape(-1, len(MARKS))
    # Segments of an output lie behind the marks, up to the next one; of a plain text, all is its prefix.
    begin = {kind: np.where(kind == 0, starts, ends) for kind in range(len(MARKS))}
    size = {kind: np.where(kind == 0, ends - starts, 0) for kind in range(len(MARKS))}
    up_to = np.column_stack([at[:, 1:], ends[moved]]) if len(at) else at
    for kind in range(len(MARKS)):
        place = np.argmax(order.reshape(-1, len(MARKS)) == kind + 1, axis=1)[:, None]
        begin[kind][moved] = np.take_along_axis(at, place, axis=1)[:, 0] + MARK_BYTES
        size[kind][moved] = np.take_along_axis(up_to, place, axis=1)[:, 0] - begin[kind][moved]
    prefix, suffix, middle = range(len(MARKS))
    text_offsets = np.zeros(len(offsets), dtype=np.int64)
    np.cumsum(size[prefix] + size[middle] + size[suffix], out=text_offsets[1:])
    first = text_offsets[:-1]
    targets = np.stack([first, first + size[prefix], first + size[prefix] + size[middle]], axis=1)
    sources = np.stack([begin[prefix], begin[middle], begin[suffix]], axis=1)
    total = int(text_offsets[-1])
    return data[np.arange(total) + _shifts(total, targets.ravel(), (sources - targets).ravel())], text_offsets


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, null as empty, and the offsets of its rows in them."""
    texts = column.cast(pa.large_string()).fill_null("")
    _, places, content = texts.buffers()
    if not len(texts) or content is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(content, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _texts_of(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows of at most ``SLICE_BYTES`` together, or one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain) and output.

    ``plain_percent`` of the texts stay as they are; of the others ``spm_percent`` have the
    suffix first. The draws are the first four groups of eight hex digits of the SHA-256 of
    the seed, a colon and the decimal id.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            draws = np.column_stack([np.asarray(batch.column(f"draw{k}"), dtype=np.int64) for k in range(4)])
            for row, end in _slices(offsets):
                low, high = offsets[row], offsets[end]
                out, places, count, form, prefix, middle = scatter(
                    data[low:high], offsets[row : end + 1] - low, draws[row:end], plain_percent, spm_percent
                )
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, end - row),
                        pa.array(count, pa.int64()),
                        pa.array(FORMS[form].tolist(), pa.string()),
                        pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        _texts_of(out, places),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    doc_id = F.col(id_col).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"draw{k}") for k in range(4)]
    rows = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text"), *draws)
    return arrow_map(
        rows, apply, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restore(outputs: DataFrame, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """``outputs`` with ``restored``, the text that each output was made of; any other column stays."""
    codes = {name: code for code, name in enumerate(FORMS.tolist())}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column("output"))
            form = np.array([codes[one] for one in batch.column("form").to_pylist()], dtype=np.int64)
            for row, end in _slices(offsets):
                low, high = offsets[row], offsets[end]
                texts, places = gather(data[low:high], offsets[row : end + 1] - low, form[row:end])
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("output"), _texts_of(texts, places)],
                    names=["row", "output", "restored"],
                )

    others = [F.col(f"`{name}`") for name in outputs.columns if name != output_col]
    rows = outputs.select(
        F.struct(*others).alias("row"), F.col(f"`{form_col}`").alias("form"), F.col(f"`{output_col}`").alias("output")
    )
    schema = T.StructType(
        [rows.schema["row"], T.StructField("output", T.StringType()), T.StructField("restored", T.StringType())]
    )
    back = {name: F.col("row").getField(name) for name in outputs.columns} | {output_col: F.col("output")}
    return arrow_map(rows, apply, schema).select(*[back[name].alias(name) for name in outputs.columns], "restored")
