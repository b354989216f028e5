"""BPE encoding and decoding with a table of distinct words.

For tokenizers that drop white space and merge inside words only: a text's ids are the ids of its words, in order. So words are
counted over all documents, each distinct word is encoded once, and the ids are joined back by position. The most frequent
words (at most COMMON, each at most COMMON_CHARS long, so of a bounded size) are numbered and joined on the way through the
documents; a document then travels as word numbers, a byte or two for a word. All other words go through a shuffled join of
their own: a document lists the distinct ones it holds, and gets back the ids of each. Decoding is an array lookup in the task:
ids index the pieces of the vocabulary, which is as large as the tokenizer's file.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from costgauge.llm.batches import PIECE, pieces
from costgauge.llm.rows import packed, quoted, stored, unpacked, with_key

COMMON = 500_000
COMMON_CHARS = 64
LATER = "\u0250"
RARE = 1 << 31  # from here on, a word number is the place of a word in the document's own list


def spread(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each row, as many as its count, one row after the other."""
    until = np.cumsum(counts)
    return np.repeat(start - (until - counts), counts) + np.arange(until[-1] if len(until) else 0)


class Words:
    """Cuts texts into the words of a tokenizer file and encodes single words."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, *rest = spec["pre_tokenizer"]["pretokenizers"]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("the tokenizer does not cut texts into words")
        self.specials = [token["content"] for token in spec["added_tokens"]]
        if any(any(c.isspace() for c in special) for special in self.specials):
            raise ValueError("a special token holds white space")
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        # To cut texts, no vocabulary is needed.
        model = {"type": "BPE", "vocab": {}, "merges": []}
        bare = Tokenizer.from_str(json.dumps(spec | {"model": model, "added_tokens": []}))
        self.normalizer = bare.normalizer
        self.pattern = regex.compile(split["pattern"]["Regex"])
        ascii_ = [chr(c) for c in range(33, 127)]
        self.lowers = bool(self.normalizer) and all(self.normalizer.normalize_str(c) == c.lower() for c in ascii_)
        # Whether a run of letters is always one word.
        self.plain = all(self.pattern.findall(c * 3 + "st") == [c * 3 + "st"] for c in "adelmnrstvyz")
        self.cut = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        # A word is normal already and is merged as it is.
        spec["normalizer"], spec["pre_tokenizer"] = None, {"type": "Sequence", "pretokenizers": rest}
        spec["truncation"] = spec["padding"] = None
        self.spec, self.tokenizer = spec, None

    def words(self, chunk: str) -> list[str]:
        """The words of one chunk."""
        if self.special:
            parts = self.special.split(chunk)
            if len(parts) > 1:
                return [w for i, p in enumerate(parts) if p for w in ([p] if i % 2 else self.words(p))]
        normal = self.normalizer.normalize_str(chunk) if self.normalizer else chunk
        return self.cut_normal(normal)

    def cut_normal(self, normal: str) -> list[str]:
        # Letters this far are the same in every edition of the character tables.
        if max(normal, default="") < LATER:
            return self.pattern.findall(normal)
        return [word for word, _ in self.cut.pre_tokenize_str(normal)]

    def normal(self, chunks: pa.Array) -> pa.Array:
        """Chunks in normal form; those beyond ASCII together, as no normal form goes across a space."""
        if not self.normalizer:
            return chunks
        wide = ~pc.string_is_ascii(chunks).to_numpy(zero_copy_only=False) | (not self.lowers)
        some = chunks.filter(pa.array(wide)).to_pylist()
        changed = self.normalizer.normalize_str(" ".join(some)).split(" ") if some else []
        if len(changed) != len(some):  # some hold white space of other kinds
            changed = [self.normalizer.normalize_str(chunk) for chunk in some]
        return pc.replace_with_mask(pc.ascii_lower(chunks), pa.array(wide), pa.array(changed, chunks.type))

    def words_of(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of chunks one after the other, and how many each chunk has. A run of letters is one word."""
        n, listed = len(chunks), self.normal(chunks)
        single = pc.utf8_is_alpha(listed).to_numpy(zero_copy_only=False) & self.plain
        wide = np.flatnonzero(single & ~pc.string_is_ascii(listed).to_numpy(zero_copy_only=False))
        text = "".join(listed.take(pa.array(wide)).to_pylist())
        if max(text, default="") >= LATER:
            single[[i for i in wide.tolist() if max(listed[i].as_py()) >= LATER]] = False
        special = np.zeros(n, bool)
        for token in self.specials:
            special |= pc.match_substring(chunks, token).to_numpy(zero_copy_only=False)
        single &= ~special
        others = np.flatnonzero(~single)
        cut = [self.cut_normal(c) for c in listed.take(pa.array(others)).to_pylist()]
        for k in np.flatnonzero(special[others]).tolist():
            cut[k] = self.words(chunks[int(others[k])].as_py())
        counts = np.ones(n, np.int64)
        counts[others] = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = pa.concat_arrays([listed, pa.array(list(chain.from_iterable(cut)), chunks.type)])
        start = np.arange(n)
        start[others] = n + np.cumsum(counts[others]) - counts[others]
        return flat.take(pa.array(spread(start, counts))), counts

    def encode(self, words: list[str]) -> list[list[int]]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(json.dumps(self.spec))
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> pa.Array:
    """The piece of each id."""
    from tokenizers import Tokenizer

    pieces = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    listed: list[str | None] = [None] * (max(pieces.values(), default=-1) + 1)
    for piece, i in pieces.items():
        listed[i] = piece
    return pa.array(listed, pa.string())


class _Cut:
    """Texts of a batch cut into words: each distinct chunk between white space is cut once."""

    def __init__(self, texts: pa.Array, path: str) -> None:
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = lists.flatten().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        # Of each place in the texts: its chunk; of each text: where its places begin.
        self.chunk = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        # Of each chunk: where its words begin among all words.
        self.words, counts = _words(path).words_of(coded.dictionary)
        self.start = np.concatenate([[0], np.cumsum(counts)])

    def counts(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words, and how often each occurs."""
        coded = self.words.dictionary_encode()
        times = np.bincount(self.chunk, minlength=len(self.start) - 1)
        weights = np.repeat(times, np.diff(self.start))
        found = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weights, len(coded.dictionary))
        return coded.dictionary, found.astype(np.int64)

    def numbered(self, common: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Word numbers of all texts one after the other and where each text begins; text and word of each that has none.

        A word without a number is RARE plus its place among the distinct ones of its text, which are in an order of
        their own.
        """
        own = pc.index_in(self.words, value_set=common)
        number = own.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        length = np.diff(self.start)[self.chunk]
        word = spread(self.start[self.chunk], length)
        bounds = np.concatenate([[0], np.cumsum(length)])[self.first]
        numbers = number[word]
        odd = np.flatnonzero(numbers < 0)
        coded = self.words.dictionary_encode()
        names = pc.sort_indices(coded.dictionary).to_numpy()  # of a word: its place in the order of the words
        place = np.empty(len(names), np.int64)
        place[names] = np.arange(len(names))
        which = place[coded.indices.to_numpy(zero_copy_only=False)[word[odd]]] if len(odd) else odd
        text = np.searchsorted(bounds, odd, "right") - 1
        pairs, back = np.unique(text * max(len(names), 1) + which, return_inverse=True)
        of, at = pairs // max(len(names), 1), pairs % max(len(names), 1)
        numbers[odd] = RARE + (back - np.searchsorted(of, of, "left")[back])
        return numbers.astype(np.uint32), bounds, of, coded.dictionary.take(pa.array(names[at]))


def distinct_words(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """word, n: how often each word occurs in all texts. A task adds up what it reads before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            words, counts = _Cut(batch.column(0), path).counts()
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    found = docs.select(quoted(text_col).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def encoded_words(words: DataFrame, path: str) -> DataFrame:
    """word, n, ids: each distinct word is encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _words(path).encode(batch.column("word").to_pylist())
            column = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), column], ["word", "n", "ids"])

    return words.mapInArrow(encode, "word string, n long, ids array<int>")


def frequent_words(words: DataFrame, most: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """At most `most` of the most frequent words, the most frequent first, and their ids in one array with its bounds.

    The least frequency is read off counts by powers of 2^(1/8), so that no more than `most` words come to the driver.
    """
    known = words.where(F.char_length("word") <= COMMON_CHARS)
    step = F.floor(F.log2("n") * 8).cast("int")
    least, total = None, 0
    for row in sorted(known.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        total += row.words
        if total > most:
            break
        least = row.step
    if least is None:
        return pa.array([], pa.large_string()), np.zeros(1, np.int64), np.zeros(0, np.int32)
    taken = known.where(step >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    lists = taken.column("ids").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    return taken.column("word").combine_chunks().cast(pa.large_string()), np.concatenate([[0], np.cumsum(sizes)]), flat


def _packed(numbers: np.ndarray, rare: list[str], press: zstandard.ZstdCompressor) -> bytes:
    """Word numbers, bytes of one weight together, which compress best; and the words that have none, one on a line."""
    planes = press.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
    return struct.pack("<I", len(planes)) + planes + (press.compress("\n".join(rare).encode()) if rare else b"")


def _numbers(packed: bytes, press: zstandard.ZstdDecompressor) -> np.ndarray:
    (size,) = struct.unpack_from("<I", packed)
    raw = np.frombuffer(press.decompress(packed[4 : 4 + size]), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(raw).view("<u4").ravel()


def _rare_words(packed: bytes, press: zstandard.ZstdDecompressor) -> list[str]:
    (size,) = struct.unpack_from("<I", packed)
    return press.decompress(packed[4 + size :]).decode().split("\n") if len(packed) > 4 + size else []


def _documents(path: str, common: Broadcast, text_at: int):
    """Map documents to their packed word numbers and the words they hold that have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, press = common.value[0], zstandard.ZstdCompressor(level=3)
        for batch in pieces(batches, text_at):
            numbers, bounds, of, rare = _Cut(batch.column(text_at), path).numbered(listed)
            words, ends = rare.to_pylist(), np.searchsorted(of, np.arange(batch.num_rows + 1)).tolist()
            packed = [
                _packed(numbers[a:b], words[c:d], press)
                for a, b, c, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), ends[:-1], ends[1:], strict=True)
            ]
            kept = [i for i in range(batch.num_columns) if i != text_at]
            names = [batch.schema.names[i] for i in kept]
            arrays = [*(batch.column(i) for i in kept), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "_packed"])

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map packed documents (_r1, _r2, ..., _packed) to one row for each word without a number."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        lists = [_rare_words(p, press) for p in batch.column(batch.num_columns - 1).to_pylist()]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        rows = pa.array(np.repeat(np.arange(len(lists)), sizes))
        place = pa.array(spread(np.zeros(len(lists), np.int64), sizes), pa.int32())
        words = pa.array(list(chain.from_iterable(lists)), pa.string())
        keys = [batch.column(i).take(rows) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*keys, place, words], ["_r1", "_r2", "_j", "_word"])


def _joined(common: Broadcast, packed_at: int, rare_at: int):
    """Map packed word numbers, and the ids of the words without a number, to ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, offsets, flat = common.value
        press = zstandard.ZstdDecompressor()
        for batch in pieces(batches, packed_at, PIECE // 4):
            numbers = [_numbers(p, press) for p in batch.column(packed_at).to_pylist()]
            rare = batch.column(rare_at)
            lists = rare.flatten() if len(rare) else pa.array([], pa.list_(pa.int32()))
            sizes = pc.fill_null(pc.list_value_length(rare), 0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
            # One table for the batch: the common words, then the documents' own words one after the other.
            own = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([offsets, offsets[-1] + np.cumsum(own)])
            ids = np.concatenate([flat, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)])
            every = np.concatenate([np.zeros(0, np.uint32), *numbers]).astype(np.int64)
            counts = np.array([len(n) for n in numbers], np.int64)
            shift = np.repeat(first + len(offsets) - 1 - RARE, counts)
            at = np.where(every >= RARE, every + shift, every)
            start, length = ends[at], ends[at + 1] - ends[at]
            until = np.concatenate([[0], np.cumsum(length)])
            taken = ids[spread(start, length)]
            bounds = until[np.concatenate([[0], np.cumsum(counts)])]
            column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(taken, pa.int32()))
            kept = [i for i in range(batch.num_columns) if i not in (packed_at, rare_at)]
            names = [batch.schema.names[i] for i in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), column], [*names, "_ids"])

    return run


def encode(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids", common: int = COMMON
) -> DataFrame:
    """All columns but the text, and ids_col array<int>: as the tokenizer of `path` encodes, without added special tokens.

    Null and empty texts have no ids. Strings of special tokens in a text become their ids, as the tokenizer does it. Rows
    that repeat whole share what is joined to them, each is returned. ids_col replaces a column of that name.
    """
    words = stored(encoded_words(distinct_words(docs, text_col, path), path), "words")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(words, common))
    keyed = with_key(packed(docs, drop=[text_col], _id=id_col, _text=text_col), F.col("_id"), F.col("_text"))
    source = keyed.select("_r1", "_r2", "_row", F.col("_text").cast("string").alias("_text"))
    packed_rows = source.mapInArrow(
        _documents(path, shared, 3), StructType([*source.schema.fields[:3], StructField("_packed", BinaryType())])
    )
    # Dealt out once, by row: both what follows read the same shuffle, and the texts are cut once.
    numbers = packed_rows.repartition("_r1", "_r2")
    rare = numbers.mapInArrow(_listed, "_r1 long, _r2 long, _j int, _word string")
    given = rare.join(words.select(F.col("word").alias("_word"), "ids"), "_word")
    lists = given.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_set(F.struct("_j", "ids"))).alias("_given"))
    met = numbers.join(lists, ["_r1", "_r2"], "left").select(
        "_row", "_packed", F.coalesce(F.col("_given.ids"), F.array().cast("array<array<int>>")).alias("_rare")
    )
    fields = [met.schema["_row"], StructField("_ids", ArrayType(IntegerType()))]
    encoded = met.mapInArrow(_joined(shared, 1, 2), StructType(fields))
    return unpacked(encoded, [c for c in docs.columns if c != text_col], {ids_col: F.col("_ids")})


def decode(encoded: DataFrame, path: str, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns, and text_col: the pieces of the ids, special ones included, joined by a space.

    For tokenizers without a decoder of their own, whose pieces are joined that way. Null ids give an empty text; ids that are
    not in the vocabulary have no piece and are left out, as the tokenizer does it.
    """
    at = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in pieces(batches, at, PIECE // 4):
            ids = pc.fill_null(batch.column(at), []) if batch.column(at).null_count else batch.column(at)
            flat, sizes = ids.flatten(), ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False)
            known = (numbers >= 0) & (numbers < len(vocabulary))
            joined = vocabulary.take(pa.array(np.where(known, numbers, 0)))
            if not known.all() or joined.null_count:
                good = known & pc.is_valid(joined).to_numpy(zero_copy_only=False)
                rows = np.repeat(np.arange(len(sizes)), sizes)[good]
                sizes, joined = np.bincount(rows, minlength=len(sizes)), joined.filter(pa.array(good))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            text = pc.binary_join(pa.ListArray.from_arrays(offsets, joined), " ")
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "_decoded"])

    source = packed(encoded, _ids=ids_col)
    decoded = source.mapInArrow(run, StructType([*source.schema.fields, StructField("_decoded", StringType())]))
    return unpacked(decoded, encoded.columns, {text_col: F.col("_decoded")})


__all__ = ["COMMON", "Words", "decode", "distinct_words", "encode", "encoded_words"]
