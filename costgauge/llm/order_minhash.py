"""Near duplicates by Order MinHash, verified by banded alignment of words.

A text is a sequence of words. Its runs of K words, each labelled with its occurrence in the text, are all different. A sketch
takes the LEAST runs that come first under one random order and keeps them in text order; two texts share a sketch if they
share these runs in the same order. Texts that share a sketch are candidates. Candidates are verified: the longest row of words
common to both, in order and inside the band that the wanted similarity leaves, is found by bits, one step for each word; the
similarity is the number of words aligned over the number of all, so one edited word costs one word. Where a tenth of the words
was edited here and there, a pair shares one of 32 sketches in 0.91 of all cases; at a twentieth in 0.9999.

A text's signature holds the parities of its words, labelled with their occurrence and hashed to places, so two signatures differ
in at most as many bits as the texts in words, and candidates that differ in too many are not aligned.

Equal texts are one from the start. In a bucket of texts that share a sketch, all are compared with its first and with its last
text, which connects the copies of one text without listing their pairs. Where one pair for each text leaves a bucket in several
components, its texts are also compared with the one whose buckets are largest, the source of copies that are unlike each other.
What is then still open is settled for every pair: all pairs of an open bucket that are in different components are compared by
signature, in blocks of rows, and those whose bits allow the wanted similarity are aligned.

Joins whose sides both grow with the corpus are merge joins at every size. Texts are compressed before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from costgauge.llm.batches import PIECE, pieces
from costgauge.llm.components import raised, tops
from costgauge.llm.grams import buffer_of, mixed, word_hashes
from costgauge.llm.rows import hash128, merged, packed, quoted, ranked, stored, text_of, unpacked

K = 5
LEAST = 3
SKETCHES = 32
SIMILARITY = 0.8
WIDE = 1 << 18  # longer texts are sketched one order at a time
BLOCK_ROWS = 1024  # a larger open bucket is dealt out by pairs of blocks

_SEEDS = mixed(np.arange(1, 129, dtype=np.uint64)) | np.uint64(1)


def runs_of(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all runs of k words; a shorter text is one run."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = words[: n - k + 1].copy()
    for j in range(1, k):
        out = mixed(out * np.uint64(3) + words[j : n - k + 1 + j])
    return out


def labelled(runs: np.ndarray) -> np.ndarray:
    """Runs with their occurrence (0 for the first) mixed in; all are different."""
    n = len(runs)
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return runs
    first = np.flatnonzero(new)
    occurrence = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    out = runs.copy()
    again = occurrence > 0
    out[order[again]] = mixed(ordered[again] + mixed(occurrence[again].astype(np.uint64)))
    return out


def _ordered(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A random order of the runs for each seed."""
    out = values[None, :] * seeds[:, None]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def sketch(runs: np.ndarray, sketches: int = SKETCHES, least: int = LEAST) -> np.ndarray:
    """One hash for each order: the least runs under it, in text order."""
    if not len(runs):
        return np.zeros(0, np.uint64)
    values, least = labelled(runs), min(least, len(runs))
    step = sketches if len(values) <= WIDE else 1
    picked = np.empty((sketches, least), np.int64)
    for a in range(0, sketches, step):
        order = _ordered(values, _SEEDS[a : min(a + step, sketches)])
        rows = np.arange(len(order))
        for j in range(least):
            picked[a + rows, j] = at = order.argmin(axis=1)
            order[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
    picked.sort(axis=1)
    key = np.arange(sketches, dtype=np.uint64)
    for j in range(least):
        key = mixed(key * np.uint64(3) + values[picked[:, j]])
    return key


def signature(words: np.ndarray) -> np.ndarray:
    """For each place, whether an odd number of labelled words falls on it; 2 to 4 places a word, a power of two."""
    places = 64 << max(0, (2 * len(words) - 1).bit_length() - 6)
    at = (mixed(labelled(words)) & np.uint64(places - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=places) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def _folded(signatures: np.ndarray, size: int) -> np.ndarray:
    """Signatures (rows) as they are with `size` words."""
    return np.bitwise_xor.reduce(signatures.reshape(len(signatures), -1, size), axis=1)


def _allowed(n: np.ndarray | int, m: np.ndarray | int, similarity: float) -> np.ndarray | float:
    """Words that only one of two texts of n and m words may have. Common words cancel out, so as many bits may differ."""
    return (n + m) * (1 - similarity) / (1 + similarity) + 1e-6


def near_pairs(n: np.ndarray, signatures: list[np.ndarray], comp: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the other rows, of other components and each pair once, that its signature does not rule out.

    Rows are in order of their numbers of words n, so that what can be similar to a row follows it closely.
    """
    sizes = np.array([len(s) for s in signatures])
    ends = np.searchsorted(n, n / similarity + 1e-6, "right")
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        first, last = own[0], ends[own[-1]]
        wide = np.concatenate([
            _folded(np.stack([signatures[j] for j in range(first, last) if sizes[j] == s]), size)
            for s in np.unique(sizes[first:last])
        ]).T.copy()
        for i in own:
            others = np.arange(i + 1, ends[i])
            bits = np.bitwise_count(wide[:, others - first] ^ wide[:, [i - first]]).sum(axis=0, dtype=np.int64)
            yield i, others[(bits <= _allowed(n[i], n[others], similarity)) & (comp[others] != comp[i])]


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Share of words that can be aligned in order inside the band; 0 as soon as it must be under `similarity`.

    An aligned pair is shifted by the words left out on one side before it, which gives the band. Bit i of `open_` says that
    word i of a adds nothing to the longest alignment with the words of b so far (the bit-parallel form of the usual table).
    """
    n, m = len(a), len(b)
    needed = similarity * (n + m) / (1 + similarity)
    if not n or not m or min(n, m) < needed - 1e-9:
        return 0.0
    if len(np.intersect1d(labelled(a), labelled(b), assume_unique=True)) < needed - 1e-9:
        return 0.0
    band = int(max(n, m) - needed + 1e-9)
    # What both begin and end with is aligned in some longest alignment.
    short = min(n, m)
    unlike = np.flatnonzero(a[:short] != b[:short])
    head = int(unlike[0]) if len(unlike) else short
    unlike = np.flatnonzero(a[n - short + head :][::-1] != b[m - short + head :][::-1])
    tail = int(unlike[0]) if len(unlike) else short - head
    x, y = a[head : n - tail].tolist(), b[head : m - tail].tolist()
    places: dict[int, int] = {}
    for i, word in enumerate(x):
        places[word] = places.get(word, 0) | (1 << i)
    full, width = (1 << len(x)) - 1, (1 << (2 * band + 1)) - 1
    open_ = full
    for j, word in enumerate(y):
        here = places.get(word, 0)
        low = j - band
        here = ((here >> low) & width) << low if low > 0 else here & (width >> -low)
        if here:
            taken = open_ & here
            open_ = ((open_ + taken) | (open_ - taken)) & full
    length = head + tail + len(x) - open_.bit_count()
    return length / (n + m - length)


def _sketched(k: int, sketches: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 3, PIECE // 2):
            words, first = word_hashes(*buffer_of(batch.column("text")), marks=False)
            digests, sizes, keys = [], [], []
            for a, b in zip(first[:-1], first[1:], strict=True):
                own = words[a:b]
                place = mixed(np.arange(len(own), dtype=np.uint64))
                digests.append([int(mixed(own ^ place).sum().astype(np.int64)), int(mixed(own + place).sum().astype(np.int64))])
                runs = runs_of(own, k)
                sizes.append(len(own))
                keys.append(sketch(runs, sketches, least).astype(np.int64))
            t1, t2 = zip(*digests, strict=True) if digests else ((), ())
            counts = np.cumsum([0, *map(len, keys)])
            column = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            arrays = [pa.array(t1, pa.int64()), pa.array(t2, pa.int64()), pa.array(sizes, pa.int64()), column]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "x1", "x2")), *arrays], ["doc", "x1", "x2", "t1", "t2", "n", "keys"]
            )

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each row as a compressed body."""
    small = zstandard.ZstdCompressor(level=3)
    for batch in pieces(batches, 3, PIECE):
        bodies = [small.compress(text.as_buffer()) for text in batch.column(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bodies, pa.binary())], ["doc", "x1", "x2", "body"])


def _words(bodies: pa.Array) -> list[np.ndarray]:
    """The word hashes of each compressed text."""
    large = zstandard.ZstdDecompressor()
    texts = pa.array([large.decompress(body.as_buffer()) for body in bodies], pa.large_binary()).view(pa.large_string())
    words, first = word_hashes(*buffer_of(texts), marks=False)
    return [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def _verified(similarity: float):
    """Pairs with their similarity; those whose signatures do not allow `similarity` are left out before their texts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces((_worth(batch, similarity) for batch in batches), 4, PIECE // 4):
            sides = zip(_words(batch.column("body_a")), _words(batch.column("body_b")), strict=True)
            found = [aligned(a, b, similarity) for a, b in sides]
            kept = batch.select(["a", "b", "top_a", "top_b"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, pa.float64())], [*kept.schema.names, "similarity"])

    return run


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each compressed text with its number of words and its signature."""
    for batch in pieces(batches, 1, PIECE // 4):
        words = _words(batch.column("body"))
        found = [signature(x).view(np.int64) for x in words]
        sizes, bits = pa.array([len(x) for x in words], pa.int64()), pa.array(found, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, sizes, bits], ["node", "body", "n", "bits"])


def _signatures(bits: pa.ListArray) -> list[np.ndarray]:
    flat, at = bits.flatten().to_numpy().view(np.uint64), np.cumsum([0, *bits.value_lengths().to_pylist()])
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _worth(batch: pa.RecordBatch, similarity: float) -> pa.RecordBatch:
    """Pairs whose signatures allow the similarity."""
    n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
    differ = np.empty(batch.num_rows, np.int64)
    sides = zip(_signatures(batch.column("bits_a")), _signatures(batch.column("bits_b")), strict=True)
    for i, (x, y) in enumerate(sides):
        if len(x) != len(y):
            size = min(len(x), len(y))
            x, y = _folded(x[None, :], size)[0], _folded(y[None, :], size)[0]
        differ[i] = np.bitwise_count(x ^ y).sum()
    return batch.filter(pa.array(differ <= _allowed(n_a, n_b, similarity)))


def _met(similarity: float):
    """Pairs of a part that signatures allow; a part's rows follow each other."""

    def pairs_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.sort_by([("n", "ascending"), ("node", "ascending")])
        node, n, comp, block = (rows.column(c).to_numpy() for c in ("node", "n", "comp", "block"))
        signatures = _signatures(rows.column("bits").combine_chunks())
        across = rows.column("low")[0] != rows.column("high")[0]  # pairs inside a block are met in its own part
        out, size = [], 0

        def listed() -> pa.RecordBatch:
            a, b = np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])
            swap = node[a] > node[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            columns = node[a], node[b], comp[a], comp[b]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "top_a", "top_b"])

        for i, others in near_pairs(n, signatures, comp, similarity):
            if across:
                others = others[block[others] != block[i]]
            if len(others):
                out.append((np.full(len(others), i), others))
                size += len(others)
                if size > 50_000:
                    yield listed()
                    out, size = [], 0
        if out:
            yield listed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            part = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
            cuts = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in part])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if held and b > a and any(held[0].column(c)[0].as_py() != x[a] for c, x in zip(("key", "low", "high"), part, strict=True)):
                    yield from pairs_of(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from pairs_of(pa.Table.from_batches(held))

    return run


class _Search:
    """The texts of one table, and the links found between them so far."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, sketches: int, least: int, similarity: float):
        self.k, self.similarity, self.sketches = k, similarity, sketches
        text = text_of(quoted(text_col))
        x1, x2 = hash128(text)
        self.source = docs.select(quoted(id_col).alias("doc"), x1.alias("x1"), x2.alias("x2"), text.alias("text"))
        doc = StructField("doc", self.source.schema["doc"].dataType)
        longs = [StructField(c, LongType()) for c in ("x1", "x2", "t1", "t2", "n")]
        kind = StructType([doc, *longs, StructField("keys", ArrayType(LongType()))])
        self.rows = stored(self.source.mapInArrow(_sketched(k, sketches, least), kind), "near")
        # One node for each text, whatever its white space; its first document stands for it.
        texts = self.rows.groupBy("t1", "t2").agg(
            F.min(F.struct("doc", "x1", "x2")).alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys")
        )
        self.texts = ranked(texts, ["t1", "t2"], "node").select("node", "t1", "t2", "n", "keys", "first.*")
        self.texts = stored(self.texts, "near")

    def verified(self, pairs: DataFrame, texts: DataFrame, seen: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """New pairs (a < b, with the tops of their components), and those of them whose texts align."""
        pairs = pairs.where("a < b").select("a", "b", "top_a", "top_b").distinct()
        if seen is not None:
            pairs = pairs.join(merged(seen.select("a", "b")), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        side_a, side_b = (texts.select(*(F.col(c).alias(f"{c}_{side}") for c in texts.columns)) for side in "ab")
        both = pairs.join(merged(side_b), F.col("b") == F.col("node_b")).join(merged(side_a), F.col("a") == F.col("node_a"))
        both = both.select("a", "b", "top_a", "top_b", "body_a", "body_b", "n_a", "n_b", "bits_a", "bits_b")
        found = both.mapInArrow(_verified(self.similarity), "a long, b long, top_a long, top_b long, similarity double")
        return pairs, stored(found.where(F.col("similarity") >= self.similarity - 1e-9), "links")

    def alike(self, a: str, b: str) -> Column:
        """Whether texts of a and b words can be similar."""
        return F.least(a, b) >= self.similarity * F.greatest(a, b)

    def labels(self) -> DataFrame | None:
        """node and comp of every text that is linked with a lesser one."""
        buckets = self.texts.select("node", "n", F.explode("keys").alias("key"))
        one = F.struct("node", "n")
        ends = buckets.groupBy("key").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.count(F.lit(1)).alias("size"))
        # Stored, so that both sides of the join come straight from a shuffle and a hot bucket's partition can be split.
        ends = stored(ends.where("size > 1").withColumnRenamed("key", "_key"), "buckets")
        members = stored(buckets.join(merged(ends), F.col("key") == F.col("_key")).drop("_key"), "members")
        if members.isEmpty():
            return None
        wanted = self.texts.join(merged(members.select("node").distinct()), "node").select(
            "node", F.col("doc").alias("_doc"), F.col("x1").alias("_x1"), F.col("x2").alias("_x2")
        )
        wanted = stored(wanted, "wanted")
        same = (F.col("x1") == F.col("_x1")) & (F.col("x2") == F.col("_x2")) & F.col("doc").eqNullSafe(F.col("_doc"))
        fields = [self.source.schema[c] for c in ("doc", "x1", "x2")]
        texts = self.source.mapInArrow(_compressed, StructType(fields).add("body", "binary"))
        # Rows that repeat whole give a node its text once.
        bodies = texts.join(merged(wanted), same).groupBy("node").agg(F.first("body").alias("body"))
        texts = stored(bodies.mapInArrow(_signed, "node long, body binary, n long, bits array<long>"), "texts")
        met = members.select(
            F.explode(
                F.array(
                    F.struct(F.col("low.node").alias("a"), F.col("node").alias("b"), F.col("low.n").alias("n_a"), F.col("n").alias("n_b")),
                    F.struct(F.col("node").alias("a"), F.col("high.node").alias("b"), F.col("n").alias("n_a"), F.col("high.n").alias("n_b")),
                )
            ).alias("p")
        )
        met = met.select("p.*").where((F.col("a") < F.col("b")) & self.alike("n_a", "n_b"))
        # One pair for each text first: most texts of a large group of near copies are then in one component, and pairs inside
        # a component cannot change it. All others are verified after that.
        firsts = met.groupBy("b").agg(F.min("a").alias("a")).select("a", "b", F.col("a").alias("top_a"), F.col("b").alias("top_b"))
        seen, found = self.verified(firsts, texts, None)
        labels = tops(found)
        further, found = self.verified(self.apart(members, labels), texts, seen)
        if not found.isEmpty():
            labels = raised(labels, tops(found.select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))))
        # The first and the last text of a bucket have met all others, so one of three texts is settled.
        larger = stored(self.named(members.where("size > 3"), labels).select("key", "node", "n", "size", "comp"), "named")
        parts = larger.groupBy(F.col("key").alias("_key")).agg(F.min("comp").alias("_least"), F.max("comp").alias("_most"))
        several = stored(parts.where("_least < _most").select("_key"), "several")
        if several.isEmpty():
            return labels
        left = larger.join(merged(several), F.col("key") == F.col("_key")).drop("_key")
        _, found = self.verified(self.allowed(left, texts), texts, seen.unionByName(further))
        if found.isEmpty():
            return labels
        return raised(labels, tops(found.select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))))

    def named(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """The members of buckets with comp, the top of their component."""
        known = labels.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
        met = members.join(merged(known), F.col("node") == F.col("_node"), "left")
        return met.select(*members.columns, F.coalesce("_comp", "node").alias("comp"))

    def apart(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of different components in a bucket: of its first, its last or its leading text with any other of its texts.

        The leading text is the one with the largest buckets. Components are joined to the members of buckets, whose number a
        large group does not raise, and not to pairs.
        """
        # A text is in one bucket for each sketch at most, which bounds the window.
        weight = F.sum("size").over(Window.partitionBy("node"))
        named = stored(self.named(members.select("key", "node", "n", "size"), labels).withColumn("weight", weight), "named")
        one = "node", "n", "comp"
        ends = named.groupBy(F.col("key").alias("_key")).agg(
            F.min(F.struct(*one)).alias("first"), F.max(F.struct(*one)).alias("last"), F.max(F.struct("weight", *one)).alias("lead"),
            F.min("comp").alias("_least"), F.max("comp").alias("_most"),
        )
        ends = stored(ends.where("_least < _most").select("_key", "first", "last", "lead"), "ends")
        both = named.join(merged(ends), F.col("key") == F.col("_key"))

        def pair(end: str) -> Column:
            own, other = F.struct("node", "n", "comp"), F.struct(f"{end}.node", f"{end}.n", f"{end}.comp")
            made = F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high"))
            return F.when((F.col("comp") != F.col(f"{end}.comp")) & self.alike("n", f"{end}.n"), made)

        pairs = both.select(F.explode(F.array_compact(F.array(pair("first"), pair("last"), pair("lead")))).alias("p"))
        return pairs.select(
            F.col("p.low.node").alias("a"), F.col("p.high.node").alias("b"), F.col("p.low.comp").alias("top_a"), F.col("p.high.comp").alias("top_b")
        )

    def allowed(self, left: DataFrame, bits: DataFrame) -> DataFrame:
        """All pairs of open buckets, in different components, that can be similar by their signatures."""
        blocks = F.ceil(F.col("size") / BLOCK_ROWS)
        placed = left.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
        )
        parts = placed.select(
            "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "n", "comp"
        )
        signed = parts.join(merged(bits.select(F.col("node").alias("_node"), "bits")), F.col("node") == F.col("_node")).drop("_node")
        dealt = signed.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
        return dealt.mapInArrow(_met(self.similarity), "a long, b long, top_a long, top_b long")


def _searched(
    docs: DataFrame, id_col: str, text_col: str, k: int, sketches: int, least: int, similarity: float
) -> tuple[_Search, DataFrame]:
    search = _Search(docs, id_col, text_col, k, sketches, least, similarity)
    nodes = search.texts.select("node", "t1", "t2", "doc", "x1", "x2")
    labels = search.labels()
    if labels is None:
        return search, nodes.withColumn("comp", F.col("node"))
    joined = nodes.join(merged(labels.select(F.col("node").alias("_node"), "comp")), F.col("node") == F.col("_node"), "left")
    return search, joined.withColumn("comp", F.coalesce("comp", "node")).drop("_node")


def _first(value: Column) -> Column:
    """The least struct of a group, null ids last."""
    return F.min(F.struct(F.col("doc").isNull().alias("none"), value))


def classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    sketches: int = SKETCHES,
    least: int = LEAST,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row for each row of the documents: its id, class_id (the least id of its class) and n_texts (different texts in it).

    Classes are the components of texts whose similarity is at least `similarity`; texts with the same words in the same order
    are equal. A text of fewer than k words is one run, so it only meets its equals; texts without words are equal. Null ids
    come last when the class id is chosen. Rows that repeat whole are rows of the same class.
    """
    search, nodes = _searched(docs, id_col, text_col, k, sketches, least, similarity)
    nodes = stored(nodes, "near")
    named = nodes.groupBy("comp").agg(_first(F.col("doc")).alias("_first"), F.count(F.lit(1)).alias("n_texts"))
    named = stored(named.select(F.col("comp").alias("_comp"), F.col("_first.doc").alias("class_id"), "n_texts"), "near")
    of_text = stored(
        nodes.join(merged(named), F.col("comp") == F.col("_comp")).select(
            F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "class_id", "n_texts"
        ), "near")
    rows = search.rows.select("doc", "t1", "t2")
    met = rows.join(merged(of_text), (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")))
    return met.select(F.col("doc").alias(id_col), "class_id", "n_texts")


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, all columns: the one with the least id (null last), of rows that repeat whole one."""
    settings = {"k": K, "sketches": SKETCHES, "least": LEAST, "similarity": SIMILARITY} | options
    _, nodes = _searched(docs, id_col, text_col, **settings)
    place = F.struct("doc", "x1", "x2")
    kept = nodes.groupBy("comp").agg(_first(place.alias("at")).alias("first")).select("first.at.*")
    kept = stored(kept.select(F.col("doc").alias("_doc"), F.col("x1").alias("_x1"), F.col("x2").alias("_x2")), "near")
    rows = packed(docs, _id=id_col, _text=text_col)
    x1, x2 = hash128(text_of(F.col("_text")))
    source = rows.select("_row", "_id", x1.alias("_y1"), x2.alias("_y2"))
    same = (F.col("_y1") == F.col("_x1")) & (F.col("_y2") == F.col("_x2")) & F.col("_id").eqNullSafe(F.col("_doc"))
    single = source.join(merged(kept), same).groupBy("_x1", "_x2", "_doc").agg(F.first("_row").alias("_row"))
    return unpacked(single, docs.columns, {})
