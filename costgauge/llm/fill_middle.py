"""Fill-in-the-middle texts, made per batch by a pipeline of pyarrow.compute functions.

A text is cut into units (a word with the white space before it; white space at the end is a unit of its own). Hashes of the
document's id draw where prefix and middle end, and the form: `psm` (prefix, suffix, middle), `spm` (suffix, prefix, middle) or
`plain`. A batch of texts becomes one list array of units, which is flattened with the index of each unit's text; a unit's
ordinal is its distance from its text's first unit. Units are filtered by the role that their ordinal gives, each role's are
put back into lists, joined, and the pieces joined with the marks.

A mark has no proper prefix that ends it, so that marks can only be found where they were put, and a text that holds a mark
stays plain: restored() reads the text back from the output and the form alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from costgauge.llm.batches import PIECE, pieces
from costgauge.llm.rows import packed, text_of, unpacked

MARKS = ("<P>", "<S>", "<M>")
UNIT = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
END = b"\xff"  # never a byte of UTF-8
PLAIN, PSM, SPM = "plain", "psm", "spm"
MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def checked_marks(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    """The marks, if each is found only where it was put: different, none inside another, no beginning that is an end."""
    for a in marks:
        for b in marks:
            if not a or (a != b and a in b) or any(a.endswith(b[:n]) for n in range(1, len(b))):
                raise ValueError(f"marks overlap: {a!r} {b!r}")
    if len(set(marks)) < 3:
        raise ValueError("marks must differ")
    return marks


def draws(id_value: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits: the first digits of the sha256 of seed:id; null counts as an empty id."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), text_of(id_value)), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units_of(texts: pa.Array) -> pa.Array:
    """A list of the units of each text (large_binary, not null), with one empty item after the last."""
    ended = pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + END)
    return pc.split_pattern(ended, pattern=END)


def _modulo(value: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def _rebuilt(flat: pa.Array, of_role: pa.Array, counts: pa.Array) -> pa.Array:
    """The units of one role joined for each text; `counts` says how many of them a text has."""
    ends = pc.cumulative_sum(counts).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(flat, of_role)), pa.scalar(b"", flat.type))


def transformed(texts: pa.Array, h: list[pa.Array], rate: int, spm_rate: int, marks: tuple[str, str, str]) -> list[pa.Array]:
    """The columns MADE of a batch; `h` holds the four numbers of each text."""
    texts = texts.cast(pa.large_binary())
    p_mark, s_mark, m_mark = (mark.encode() for mark in marks)
    units = units_of(texts)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    size = pc.list_value_length(units).cast(pa.int64())
    n = pc.subtract(size, 1)
    first = pc.subtract(pc.cumulative_sum(size), size)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(first, parent))

    cuts = pc.add(n, 1)
    one, two = _modulo(h[0], cuts), _modulo(h[1], cuts)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    low_of, high_of, n_of = (pc.take(bound, parent) for bound in (low, high, n))
    in_prefix = pc.less(ordinal, low_of)
    in_middle = pc.and_(pc.greater_equal(ordinal, low_of), pc.less(ordinal, high_of))
    in_suffix = pc.and_(pc.greater_equal(ordinal, high_of), pc.less(ordinal, n_of))
    prefix = _rebuilt(flat, in_prefix, low)
    middle = _rebuilt(flat, in_middle, pc.subtract(high, low))
    suffix = _rebuilt(flat, in_suffix, pc.subtract(n, high))

    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h[2], hundred), rate))
    for mark in (p_mark, s_mark, m_mark):
        plain = pc.or_(plain, pc.match_substring(texts, pattern=mark))
    is_spm = pc.less(_modulo(h[3], hundred), spm_rate)

    def joined(*parts: pa.Array | bytes) -> pa.Array:
        scalars = [pa.scalar(p, pa.large_binary()) if isinstance(p, bytes) else p for p in parts]
        return pc.binary_join_element_wise(*scalars, pa.scalar(b"", pa.large_binary()))

    psm = joined(p_mark, prefix, s_mark, suffix, m_mark, middle)
    spm = joined(s_mark, suffix, p_mark, prefix, m_mark, middle)
    output = pc.if_else(plain, texts, pc.if_else(is_spm, spm, psm))
    form = pc.if_else(plain, PLAIN, pc.if_else(is_spm, SPM, PSM))
    none = pa.scalar(None, pa.int64())

    def chars(piece: pa.Array) -> pa.Array:
        return pc.if_else(plain, none, pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64()))

    return [n, form, chars(prefix), chars(middle), output.cast(pa.large_string()).cast(pa.string())]


def transform(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: int = 50,
    spm_rate: int = 80,
    seed: int = 42,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """All columns, and n (units), form, prefix_chars and middle_chars (code points, null if plain), output.

    `rate` of 100 texts are transformed, `spm_rate` of 100 of those as spm. Defined results: a null text is empty, an empty text
    plain; a text that holds a mark is plain; a null id hashes as an empty one; rows that repeat give rows that repeat; columns
    of the table with a new column's name are replaced. No shuffle: each text is read once, whole, in batches of about PIECE bytes;
    a longer text is a batch of its own.
    """
    marks = checked_marks(marks)
    # The other columns go along as one: they may have any name and type.
    rows = packed(docs, (text_col,), _id=id_col, _text=text_col)
    ready = rows.select("_row", F.col("_text").cast("string").alias("_text"), F.array(*draws(F.col("_id"), seed)).alias("_h"))
    kinds = dict(zip(MADE, (LongType(), StringType(), LongType(), LongType(), StringType()), strict=True))
    schema = StructType([ready.schema["_row"], ready.schema["_text"], *[StructField(name, kind) for name, kind in kinds.items()]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, PIECE):
            numbers = pc.list_flatten(batch.column(2)).to_numpy().reshape(-1, 4)
            h = [pa.array(numbers[:, i]) for i in range(4)]
            made = transformed(pc.fill_null(batch.column(1), ""), h, rate, spm_rate, marks)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["_row", "_text", *MADE])

    made = ready.mapInArrow(work, schema)
    names = [c for c in docs.columns if c != text_col]
    return unpacked(made, names, {text_col: F.col("_text"), **{name: F.col(name) for name in MADE}})


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text, from the output and the form alone."""
    p_mark, s_mark, m_mark = checked_marks(marks)

    def after(mark: str) -> Column:
        return F.substring_index(output, mark, -1)

    def between(mark: str, end: str) -> Column:
        return F.substring_index(after(mark), end, 1)

    # Each mark is there once: what follows it is up to the next one in the form's order.
    psm = F.concat(between(p_mark, s_mark), after(m_mark), between(s_mark, m_mark))
    spm = F.concat(between(p_mark, m_mark), after(m_mark), between(s_mark, p_mark))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
