"""Language identification by compression: the language whose dictionary makes a text smallest.

For each language, pieces of labelled texts become the raw content of a zstandard dictionary. A text is compressed whole, once
with each dictionary, and the smallest result names its language. Where two results are close, a slower level decides among the
close ones; what is still narrow is marked, and rejected on demand. Texts are compared as letters only: lower case, and one space
for whatever stands between.

A language learns from at most SAMPLE texts, chosen by hash among its different texts, and its dictionary has DICTIONARY bytes;
these, and a row for each language, are all that comes to the driver and goes to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from costgauge.llm.batches import PIECE, pieces
from costgauge.llm.rows import checkpointed, packed, text_of, unpacked

UNKNOWN = "und"
SAMPLE = 400  # texts a language
PIECES = 32  # pieces of one text
SPAN = 200  # characters of a piece
DICTIONARY = 65_536  # bytes a language
LANGUAGES = 1_000  # more is taken for an error in the labels
FAST, SLOW = 6, 12  # levels
CLOSE = 0.02  # share of the size within which the slow level decides
NARROW_BYTES, NARROW = 3, 0.005  # a lead below either is narrow
SEED = 13

_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def letters(text: str) -> bytes:
    """Lower case, ASCII characters that are no letters as one space, a space at each end; empty without any letter."""
    words = text.lower().encode().translate(_LETTERS).split()
    if not words or (all(w[0] >= 128 for w in words) and not any(c.isalpha() for c in text)):
        return b""
    return b" " + b" ".join(words) + b" "


@dataclass
class Model:
    """Dictionaries of the languages, most frequent first; ties of size go to the earlier one."""

    dictionaries: dict[str, bytes]
    _made: dict[tuple[str, int], zstandard.ZstdCompressor] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "_made": {}}

    def size(self, lang: str, level: int, text: bytes) -> int:
        """Bytes of the text compressed with a language's dictionary."""
        if (lang, level) not in self._made:
            raw = zstandard.ZstdCompressionDict(self.dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self._made[lang, level] = zstandard.ZstdCompressor(
                level=level, dict_data=raw, write_content_size=False, write_dict_id=False
            )
        return len(self._made[lang, level].compress(text))

    def classify(self, text: bytes) -> tuple[str, float, int, bool]:
        """Language, score, lead over the second in bytes, and whether the lead is narrow."""
        sizes = {lang: self.size(lang, FAST, text) for lang in self.dictionaries}
        least = min(sizes.values())
        close = [lang for lang, n in sizes.items() if n <= least * (1 + CLOSE) + NARROW_BYTES]
        if len(close) > 1:
            sizes = {lang: self.size(lang, SLOW, text) for lang in close}
        best = min(sizes, key=sizes.get)
        least = sizes[best]
        others = sorted(n for lang, n in sizes.items() if lang != best)
        lead = others[0] - least if others else least
        score = 1 / (1 + sum(2.0 ** (least - n) for n in others if n - least < 60))
        return best, score, lead, lead < NARROW_BYTES or lead < NARROW * least


def _pieces_of(text: bytes) -> list[bytes]:
    """Pieces of about SPAN characters, cut at spaces (a longer word is a piece)."""
    out, start = [], 0
    while start < len(text) - 1:
        end = text.find(b" ", min(start + SPAN, len(text) - 1))
        out.append(text[start:end])
        start = end
    return out


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Dictionaries from texts whose language is not null; texts without letters teach nothing."""
    rows = packed(labelled, labelled.columns, text=text_col, lang=lang_col).drop("_row")
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = rows.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64(F.lit(SEED), "text").alias("h"))
    single = checkpointed(hashed.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n")))
    counts = single.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"))
    languages = counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    # The first `sample` hashes are surely among those below a bound that leaves some eight times as many.
    among = (F.col("h") / float(1 << 64) + 0.5) * F.col("different") < 8 * sample
    low = single.select("lang", "h").join(F.broadcast(counts), "lang").where((F.col("different") <= 8 * sample) | among)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = low.withColumn("_place", place).where(F.col("_place") <= sample).select("lang", "h")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, PIECE):
            langs, parts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = _pieces_of(letters(text))
                step = max(1, len(own) // PIECES)  # from all over the text
                for part in own[::step][:PIECES]:
                    langs.append(lang)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["lang", "part"])

    # At most `sample` rows a language.
    texts = hashed.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))
    parts = texts.select("lang", "text").mapInArrow(cut, "lang string, part binary").distinct()
    order = F.xxhash64(F.lit(SEED), F.col("part"))
    filled = F.sum(F.octet_length("part")).over(Window.partitionBy("lang").orderBy(order, "part"))
    kept = parts.withColumn("_end", filled).where(F.col("_end") <= DICTIONARY)
    found = kept.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("_end", "part"))).alias("parts")).collect()
    content = {row.lang: b"".join(bytes(p.part) for p in row.parts) for row in found}
    # A dictionary of under 8 bytes is none.
    return Model({r.lang: content[r.lang] for r in languages if len(content.get(r.lang, b"")) >= 8})


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", reject: bool = True) -> DataFrame:
    """All columns, and lang_pred, score (0 to 1), lead (bytes), narrow for every document.

    The score is the first language's share if each byte of difference halves a language's weight. Defined results: a text that is
    null or holds no letter is UNKNOWN with score 0, and so is every text if nothing was learned; with `reject`, a text whose
    lead is narrow is UNKNOWN with its score; equal texts get equal results; columns of the table with a new column's name are
    replaced. No shuffle; each text is read once, whole.
    """
    rows = packed(docs, (text_col,), _text=text_col)
    ready = rows.select("_row", F.col("_text").cast("string").alias("_text"))
    made = {"lang_pred": StringType(), "score": DoubleType(), "lead": LongType(), "narrow": None}
    fields = [StructField(n, k) for n, k in made.items() if k]
    schema = StructType([*ready.schema.fields, *fields]).add("narrow", "boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, PIECE):
            results = []
            for text in batch.column(1):
                plain = letters(text.as_py() or "")
                results.append(model.classify(plain) if plain and model.dictionaries else (UNKNOWN, 0.0, 0, True))
            columns = zip(*results, strict=True)
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["_row", "_text", *made])

    found = ready.mapInArrow(work, schema)
    best = F.when(F.col("narrow"), F.lit(UNKNOWN)).otherwise(F.col("lang_pred")) if reject else F.col("lang_pred")
    new = {"lang_pred": best, **{n: F.col(n) for n in ("score", "lead", "narrow")}}
    names = [c for c in docs.columns if c != text_col]
    return unpacked(found, names, {text_col: F.col("_text"), **new})


def held_out(id_value: Column, parts: int = 3, part: int = 1) -> Column:
    """Whether the CRC-32 of an id as text is `part` modulo `parts`; a null id counts as empty."""
    return F.crc32(text_of(id_value).cast("binary")) % parts == part
