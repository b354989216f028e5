"""Line dedup over the corpus: hashes of lines are range-partitioned and sorted; bitmaps say which lines stay.

The text itself is never shuffled to find the repeats. Lines travel as 128-bit hashes, range-partitioned by
(hash, document), so that a line which a third of all documents share is spread over many ranges. Sorted within a range by
document and position, first occurrences stream out of a sort aggregate without another shuffle; what is left of a hash is
one row for each range, which combines to the number of documents and the first occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.llm.rows import checkpointed, line_keys, lines_of, packed, quoted, unpacked, with_key

WORD_SHIFT = 6  # 64 lines in a word


def line_hashes(docs: DataFrame, *, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row for each line whose key has at least min_chars code points: h1, h2, doc, pos, _r1, _r2."""
    source = with_key(docs.select(quoted(id_col).alias("doc"), quoted(text_col).alias("text")), F.col("doc"), F.col("text"))
    keys = line_keys(lines_of(F.col("text")))
    rows = source.select("doc", "_r1", "_r2", F.posexplode(keys).alias("pos", "key")).where(F.col("key.size") >= min_chars)
    return rows.select("key.h1", "key.h2", "doc", "pos", "_r1", "_r2")


def keep_bitmaps(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: _r1, _r2, keep array<struct<word, bits>>.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least min_chars code points in at
    least min_docs different documents (by id) lose their lines, in all documents or, with keep_first, in all places but
    the first by (document id, position). Bit i of word w stands for line 64 w + i, 1 means kept; words that lose no line
    are left out, and so are documents that lose none. _r1, _r2 identify a row by id and text: rows that repeat whole
    count once and share a bitmap. Null ids count as one id, and null text as one empty line.
    """
    keys = ["h1", "h2"]
    rows = checkpointed(line_hashes(docs, id_col=id_col, text_col=text_col, min_chars=min_chars))
    ranged = rows.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    place = F.struct("pos", "_r1", "_r2")
    in_doc = ranged.groupBy("h1", "h2", "doc").agg(F.min(place).alias("place"))
    found = in_doc.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc", "place")).alias("first")
    )
    # Stored, so that both sides of the join come straight from a shuffle and a hot key's partition can be split.
    frequent = checkpointed(found.where(F.col("n_docs") >= min_docs))
    lost = rows.join(frequent, keys)
    if keep_first:
        lost = lost.where(~F.struct("doc", place.alias("place")).eqNullSafe(F.col("first")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(F.lit(63)))
    words = lost.groupBy("_r1", "_r2", F.shiftright("pos", WORD_SHIFT).alias("word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("bits")
    )
    return words.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def with_kept_lines(
    docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Read the bitmaps against the documents: _row (all columns but the text), lines (all) and kept (those that stay)."""
    keyed = with_key(packed(docs, drop=[text_col], doc=id_col, text=text_col), F.col("doc"), F.col("text"))
    joined = keyed.join(bitmaps, ["_r1", "_r2"], "left")
    # Written out up to the last word that loses a line, the words before it that lose none are all ones.
    words = F.col("keep.word")
    dense = F.flatten(
        F.transform(
            "keep",
            lambda entry, i: F.concat(
                F.array_repeat(
                    F.lit(-1).cast("long"),
                    entry["word"] - F.when(i == 0, F.lit(0)).otherwise(F.get(words, i - 1) + 1),
                ),
                F.array(entry["bits"]),
            ),
        )
    )
    dense = F.coalesce(dense, F.array().cast("array<bigint>"))
    opened = joined.select("_row", lines_of(F.col("text")).alias("lines"), dense.alias("dense"))

    def stays(_, i: Column) -> Column:
        word = F.coalesce(F.get(F.col("dense"), F.shiftright(i, WORD_SHIFT)), F.lit(-1).cast("long"))
        bit = F.call_function("shiftrightunsigned", word, i.bitwiseAND(F.lit(63)))
        return bit.bitwiseAND(F.lit(1).cast("long")) == 1

    return opened.select("_row", "lines", F.filter("lines", stays).alias("kept"))


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = True,
) -> DataFrame:
    """The documents, all columns, each text cut to its kept lines; a document may become empty, none is dropped."""
    bitmaps = keep_bitmaps(
        docs, id_col=id_col, text_col=text_col, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first
    )
    kept = with_kept_lines(docs, bitmaps, id_col=id_col, text_col=text_col)
    cut = unpacked(kept, [c for c in docs.columns if c != text_col], {text_col: F.array_join("kept", "\n")})
    return cut.select(*[quoted(c) for c in docs.columns])
