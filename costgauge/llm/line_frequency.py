"""Quality rules: lines that many documents of a host share do not count as a document's own text.

A host's boilerplate is found by counting, for each line, the distinct documents of that host which hold it. Lines above the
limit are removed, and a document that keeps too little of its text is rejected. Only 128-bit hashes of lines travel; the
text is read twice and never shuffled. With distinct_texts, documents with the same text count once: copies of a text are
then a matter for dedup and make none of its lines boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.llm.rows import WHITE, checkpointed, line_keys, lines_of, packed, text_of, unpacked, with_key

SYMBOLS = "#*$%&|<>"
GRAM = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    """The words of a text: runs of characters other than ASCII white space; null text has none."""
    return F.filter(F.split(text_of(text), r"[\x20\x09-\x0D]+", -1), lambda word: word != "")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def with_text_counts(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) to all columns.

    word_chars: code points in words. n_symbols: characters of SYMBOLS. n_dup_lines: lines with a word that equal an earlier
    line. n_repeat_words: words that lie in a window of three words which the text holds at least twice, its first place
    included; each word counts once. Null and empty text have 0 of all. Columns of these names are replaced, all others stay.
    """
    counted = _text_counts(packed(docs, _in=text_col), "_in")
    return unpacked(counted, docs.columns, {c: F.col(c) for c in COUNTS})


def _text_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Add the counts to a table whose names cannot clash with those used here."""
    text = text_of(F.col(text_col))
    split = docs.withColumns({"_text": text, "_words": words_of(F.col(text_col))})
    n = F.size("_words")
    at = F.when(n >= GRAM, F.sequence(F.lit(0), n - GRAM)).otherwise(F.array().cast("array<int>"))
    grams = split.withColumn(
        "_grams",
        F.transform(at, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(GRAM)])),
    )
    filled = F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    counted = grams.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.char_length(_without(F.col("_text"), WHITE)).cast("long"),
            "n_symbols": (F.char_length("_text") - F.char_length(_without(F.col("_text"), SYMBOLS))).cast("long"),
            "_filled": filled,
            # Most texts repeat no window; only the others are looked at closer.
            "_again": F.size(F.array_distinct("_grams")) < F.size("_grams"),
        }
    ).drop("_text", "_words")
    sorted_grams = counted.withColumns(
        {
            "n_dup_lines": (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long"),
            "_sorted": F.when(
                F.col("_again"), F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            ),
        }
    ).drop("_filled", "_grams", "_again")

    def repeated(entry: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get("_sorted", k - 1)["h"])
        after = F.get("_sorted", k + 1)["h"]
        return F.coalesce(before == entry["h"], F.lit(False)) | F.coalesce(after == entry["h"], F.lit(False))

    starts = sorted_grams.withColumn(
        "_starts", F.sort_array(F.transform(F.filter("_sorted", repeated), lambda entry: entry["i"]))
    ).drop("_sorted")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-GRAM).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(GRAM), i - acc["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_starts")


def _identified(docs: DataFrame, *, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """_row (all columns but the text), text, _host, _r1, _r2 (the row by id, text and host)."""
    rows = packed(docs, drop=[text_col], _id=id_col, text=text_col, _host=host_col)
    return with_key(rows, F.col("_id"), F.col("text"), F.col("_host"))


def host_lines(docs: DataFrame, *, id_col: str, text_col: str, host_col: str, distinct_texts: bool = False) -> DataFrame:
    """One row for each line with a key: h1, h2, _host, _t, pos, size (code points of the key), _r1, _r2.

    _t is what counts once: the document, or with distinct_texts its text.
    """
    source = _identified(docs, id_col=id_col, text_col=text_col, host_col=host_col)
    counted = F.xxhash64(F.lit(3), F.col("text").isNull(), F.col("text")) if distinct_texts else F.col("_r1")
    source = source.withColumn("_t", counted)
    keys = line_keys(lines_of(F.col("text")))
    rows = source.select("_r1", "_r2", "_t", "_host", F.posexplode(keys).alias("pos", "key"))
    return rows.where(F.col("key.size") > 0).select(
        "key.h1", "key.h2", "_host", "_t", "pos", F.col("key.size").cast("long").alias("size"), "_r1", "_r2"
    )


def removed_chars(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = 10,
    distinct_texts: bool = False,
) -> DataFrame:
    """For each row that holds lines above the limit: _r1, _r2, removed (code points of these lines' keys).

    A line is above the limit if more than max_docs documents of its host hold it, or with distinct_texts that many different
    texts. Rows of one id and text are one document. A null host is a host of its own.
    """
    found = host_lines(docs, id_col=id_col, text_col=text_col, host_col=host_col, distinct_texts=distinct_texts)
    lines = checkpointed(found)
    # Distinct by document first, so that a line which a whole host shares is counted in many tasks.
    texts = lines.groupBy("h1", "h2", "_host", "_t").agg(F.count(F.lit(1)).alias("_copies"))
    counts = texts.groupBy("h1", "h2", "_host").agg(F.count("_copies").alias("n"))
    # Stored, so that both sides of the join come straight from a shuffle and a hot line's partition can be split.
    frequent = checkpointed(
        counts.where(F.col("n") > max_docs).select(
            F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("_host").alias("f_host")
        )
    )
    same = (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & F.col("_host").eqNullSafe(F.col("f_host"))
    shared = lines.join(frequent, same)
    # Rows that repeat whole are the same places of the same row.
    places = shared.groupBy("_r1", "_r2", "h1", "h2").agg(F.size(F.collect_set("pos")).alias("n"), F.max("size").alias("size"))
    return places.groupBy("_r1", "_r2").agg(F.sum(F.col("n") * F.col("size")).alias("removed"))


def judge(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = 10,
    min_share: float = 0.3,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    distinct_texts: bool = False,
) -> DataFrame:
    """All columns but the text, the counts of with_text_counts, own_share, base_failed and kept.

    own_share: the share of the characters in lines (without white space at their ends) that lines at or under the limit
    hold; 1 without lines. base_failed: fewer than min_words words, or more than max_repeat_percent % of the words are
    repeated. kept: not base_failed, and own_share is at least min_share. Rows that repeat whole get equal results.
    """
    keyed = _identified(docs, id_col=id_col, text_col=text_col, host_col=host_col).drop("_id", "_host")
    sizes = F.transform(lines_of(F.col("text")), lambda line: F.char_length(F.btrim(line, F.lit(WHITE))))
    keyed = keyed.withColumn(
        "_chars", F.aggregate(sizes, F.lit(0).cast("long"), lambda total, size: total + size.cast("long"))
    )
    counted = _text_counts(keyed, "text").drop("text")
    columns = {"id_col": id_col, "text_col": text_col, "host_col": host_col}
    removed = removed_chars(docs, **columns, max_docs=max_docs, distinct_texts=distinct_texts)
    joined = counted.join(removed, ["_r1", "_r2"], "left")
    own = F.col("_chars") - F.coalesce("removed", F.lit(0))
    share = F.when(F.col("_chars") > 0, own / F.col("_chars")).otherwise(F.lit(1.0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    new = {c: F.col(c) for c in COUNTS} | {"own_share": share, "base_failed": failed, "kept": ~failed & (share >= min_share)}
    return unpacked(joined, [c for c in docs.columns if c != text_col], new)
