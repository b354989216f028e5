"""Secret scans: fixed patterns, and tokens that a Markov model of random strings explains better than one of identifiers.

Two character models of first order are counted from labelled samples, one from random strings and one from ordinary
identifiers. A token's score is the log of the ratio of its probabilities under the two. All work is DataFrame expressions:
a text is scanned where it is read, and only positions and tokens of texts with a match are shuffled. The model is a table
of at most (alphabet + 1)^2 numbers, whatever the input's size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costgauge.llm.rows import packed, quoted, text_of, unpacked, with_key

# What the base kinds match. A match is a run to its end; shorter runs are no match.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_CHARS = 6

KINDS = ("assign", "access", "hex", "markov")
MARKOV = KINDS.index("markov")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-"
STATES = len(ALPHABET) + 1  # 0: the string's start
MIN_TOKEN = 20
TOKEN = "[A-Za-z0-9+/_=.-]{%d,}"


def _pairs(text: Column) -> Column:
    """Index of each character's transition: state before * STATES + state."""
    states = F.transform(
        F.filter(F.split(text, "", -1), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)
    )
    return F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(0)), states).alias("a"), F.concat(states, F.array(F.lit(0))).alias("b")),
        lambda pair: pair["a"] * STATES + pair["b"],
    )


def train(samples: DataFrame, *, text_col: str = "text", random_col: str = "is_random") -> list[float]:
    """The log-likelihood ratio of each transition, from labelled strings (is_random true or false).

    Transitions are counted over all samples with one added to each; characters outside the alphabet count as the start
    state. Null texts and labels are left out; a class without samples is uniform. The result has STATES^2 numbers.
    """
    labelled = samples.select(F.col(text_col).alias("text"), F.col(random_col).cast("boolean").alias("is_random"))
    labelled = labelled.where(F.col("text").isNotNull() & F.col("is_random").isNotNull())
    counted = labelled.select("is_random", F.explode(_pairs(F.col("text"))).alias("pair"))
    counts = {(row.is_random, row.pair): row.n for row in counted.groupBy("is_random", "pair").agg(F.count("pair").alias("n")).collect()}
    logs = []
    for kind in (True, False):
        table = [[counts.get((kind, a * STATES + b), 0) + 1 for b in range(STATES)] for a in range(STATES)]
        logs.append([math.log(n / sum(row)) for row in table for n in row])
    return [a - b for a, b in zip(*logs, strict=True)]


def score(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token, over its length."""
    table = F.lit(model)
    total = F.aggregate(_pairs(token), F.lit(0.0), lambda acc, pair: acc + F.get(table, pair))
    return total / F.greatest(F.char_length(token), F.lit(1))


def labelled_samples(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = 1000,
    made: int = 4000,
) -> DataFrame:
    """Strings with their label: text, is_random.

    Ordinary: words of the sample_docs documents of good quality (labels.quality = 1) that come first by a hash of their
    id, identifiers joined from neighbouring words, rules drawn with one character, repeated numbers. Random: hashes of the numbers up to made, written in
    hexadecimal, base 64 and its variant for addresses, in upper case and as a mix of both.
    """
    good = labels.where(F.col("quality") == 1).select(F.col(id_col)).distinct()
    chosen = good.orderBy(F.xxhash64(F.lit(7), F.col(id_col)), id_col).limit(sample_docs)
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col, "left_semi")
    words = F.filter(F.split(text_of(F.col(text_col)), "[^A-Za-z0-9]+", -1), lambda word: F.char_length(word) > 1)
    listed = texts.select(words.alias("w"))
    joined = F.transform(
        "w",
        lambda word, i: F.concat(
            word,
            F.element_at(F.array(F.lit("_"), F.lit("-"), F.lit("."), F.lit("/"), F.lit("")), F.pmod(F.xxhash64(word), F.lit(5)).cast("int") + 1),
            F.coalesce(F.when(i % 2 == 0, F.get("w", i + 1)).otherwise(F.initcap(F.get("w", i + 1))), F.lit("")),
            F.when(i % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("_"), F.coalesce(F.get("w", i + 2), F.lit("")))),
        ),
    )
    ordinary = listed.select(F.explode(F.concat("w", joined)).alias("text")).distinct()
    numbers = docs.sparkSession.range(made)
    raw = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    plain = F.base64(F.unhex(raw))
    forms = [raw, F.substring(raw, 1, 40), plain, F.translate(plain, "+/=", "-_"), F.translate(plain, "+/=", ""), F.upper(F.translate(plain, "+/=", ""))]
    made_up = numbers.select(F.explode(F.array(*forms)).alias("text"))
    # Rules drawn with one character, and plain numbers, are ordinary too.
    rules = docs.sparkSession.range(200).select(F.explode(F.array(*[F.repeat(F.lit(c), 40) for c in "+/_=.-0"])).alias("text"))
    counters = numbers.select(F.repeat(F.col("id").cast("string"), 4).alias("text"))
    ordinary = ordinary.unionByName(rules).unionByName(counters)
    return ordinary.withColumn("is_random", F.lit(False)).unionByName(made_up.withColumn("is_random", F.lit(True)))


def _found(kind: int, text: Column, pattern: str, value_group: int) -> Column:
    """The matches of one kind: for each the code points before it since the last one, its length, its value."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    zipped = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value"))
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), F.char_length(x["match"]).alias("size"),
            F.when(F.lit(kind == MARKOV), x["match"]).alias("token"),
            F.char_length(x["value"]).alias("value_size"),
        ),
    )
    some = F.filter(rows, lambda x: x["size"].isNotNull())  # the text after the last match has none
    return F.when(text.rlike(pattern), some)


def spans(
    docs: DataFrame,
    model: list[float],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = 0.5,
    min_token: int = MIN_TOKEN,
) -> DataFrame:
    """For each row with a span: _r1, _r2 (its identity by id and text), spans array<struct<start, kind, end, score>>.

    Base spans are the leftmost non-overlapping matches of each base kind. Tokens of at least min_token characters whose
    score is over min_score and that overlap no base span are added as kind markov. Positions are code points, the end is
    exclusive; spans are in order of start, then of kind. Rows that repeat whole share one result. Null text has no span.
    """
    token = TOKEN % min_token
    text = text_of(F.col("text"))
    source = with_key(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), F.col("id"), F.col("text"))
    some = source.where(text.rlike(token) | text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX))
    patterns = ((0, ASSIGN, 2), (1, ACCESS, 0), (2, HEX, 0), (MARKOV, token, 0))
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,token:string,value_size:int>>")
    found = F.concat(*[F.coalesce(_found(kind, text, p, group), empty) for kind, p, group in patterns])
    # One row for each identity, and from here on all windows are over a text's own matches.
    single = some.select("_r1", "_r2", found.alias("found")).groupBy("_r1", "_r2").agg(F.first("found").alias("found"))
    rows = single.select("_r1", "_r2", F.inline("found"))
    own = Window.partitionBy("_r1", "_r2")
    so_far = own.partitionBy("_r1", "_r2", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    long_enough = (F.col("kind") != 0) | (F.col("value_size") >= ASSIGN_CHARS)
    base = F.col("kind") != MARKOV
    before = own.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = own.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.where(long_enough).withColumns(
        {
            "_reached": F.max(F.when(base, F.col("end"))).over(before),
            "_next": F.min(F.when(base, F.col("start"))).over(after),
        }
    )
    free = (F.coalesce("_reached", F.lit(0)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    scored = placed.where(base | free).withColumn("score", F.when(~base, score(F.col("token"), model)))
    kept = scored.where(base | (F.col("score") > min_score))
    span = F.struct("start", "kind", "end", "score")
    return kept.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def scan(docs: DataFrame, model: list[float], *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of the documents but the text, and spans (empty where nothing was found)."""
    found = spans(docs, model, id_col=id_col, text_col=text_col, **options)
    keyed = with_key(packed(docs, drop=[text_col], id=id_col, text=text_col), F.col("id"), F.col("text"))
    joined = keyed.select("_row", "_r1", "_r2").join(found, ["_r1", "_r2"], "left")
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,score:double>>")
    names = [c for c in docs.columns if c != text_col]
    return unpacked(joined, names, {"spans": F.coalesce("spans", empty)})


def written(listed: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(name) for name in KINDS])
    one = F.transform(
        listed,
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")
