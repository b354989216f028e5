"""The operators on their whole tables, with production parameters, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.llm import (
    bit_sliced,
    chat_tree,
    compress_lang,
    crc_resampling,
    cube_mix,
    fill_middle,
    line_blocks,
    line_dedup,
    line_frequency,
    order_minhash,
    resampling,
    secrets,
    word_bpe,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(value: Column) -> Column:
    return value.cast("long")


# White space at a line's ends, as DuckDB's trim takes it.
SQL_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL_KEY = f"translate(trim(line, {SQL_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op9_line_dedup",
    f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     rows AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
     keyed AS (SELECT doc_id, line, pos, {SQL_KEY} AS key FROM rows),
     frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
     marked AS (SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AS lost FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key is in at least 10 documents go everywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1)
    kept = line_dedup.with_kept_lines(docs, bitmaps)
    return kept.select(
        "_row.doc_id",
        long(F.size("lines")).alias("n_lines"),
        long(F.size("lines") - F.size("kept")).alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )

@query(
    "op7_line_frequency",
    f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
     words AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '') AS w FROM docs),
     places AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM words WHERE len(w) >= 3),
     grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM places),
     again AS (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1),
     starts AS (SELECT g.doc_id, g.i FROM grams g JOIN again a USING (doc_id, gram)),
     covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM starts, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
     lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs),
     keyed AS (SELECT *, {SQL_KEY} AS key FROM lines),
     filled AS (SELECT * FROM keyed WHERE key <> ''),
     dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n, sum(length(key)) AS chars FROM filled GROUP BY doc_id),
     frequent AS (SELECT key, source FROM filled GROUP BY key, source HAVING count(DISTINCT doc_id) > 10),
     gone AS (SELECT l.doc_id, sum(length(l.key)) AS chars FROM filled l JOIN frequent f
              ON l.key = f.key AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.doc_id),
     counted AS (
       SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
              CAST(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
              CAST(length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
              coalesce(p.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
              CASE WHEN coalesce(p.chars, 0) > 0 THEN (p.chars - coalesce(g.chars, 0)) / p.chars ELSE 1.0 END AS own_share
       FROM docs d JOIN words w USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN dups p USING (doc_id)
            LEFT JOIN gone g USING (doc_id)),
     failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND own_share >= 0.3 AS kept
FROM failed
""",
)
def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each text, and the verdict after lines that more than 10 documents of a host share are removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = line_frequency.judge(docs, max_docs=10, min_share=0.3)
    return judged.select("doc_id", *line_frequency.COUNTS, "base_failed", "kept")


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of the fixed patterns, and tokens that look random to the character models."""
    docs = table(spark, sf_dir, "documents")
    model = secrets.train(secrets.labelled_samples(docs, table(spark, sf_dir, "labels")))
    found = secrets.scan(docs.select("doc_id", "text"), model)
    base = F.filter("spans", lambda s: s["kind"] != secrets.MARKOV)

    def count(kind: int) -> Column:
        return long(F.size(F.filter("spans", lambda s: s["kind"] == kind)))

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


@query("op10_cube_mix")
def op10_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed 3 : 1 : 2 to 150 % of all words, no document more than twice."""
    mixed = cube_mix.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_use=2.0)
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source"
    )


@query(
    "op5_bit_sliced",
    """
WITH rows AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     scored AS (SELECT q.vec_id AS query_id, c.vec_id,
                       CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
                FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""",
)
def op5_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best by inner product, for the vectors whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return bit_sliced.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


HARD_TEXT = r"\### Assistant: </turn> ok"
SQL_ESCAPED = "replace(replace({}, '&', '&amp;'), '<', '&lt;')"


@query(
    "op1_chat_tree",
    f"""
WITH every AS (SELECT conv_id, turn, role, text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '{HARD_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{HARD_TEXT}'),
     t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM every),
     f AS (SELECT *, replace({SQL_ESCAPED.format("role")}, '>', '&gt;') AS r, {SQL_ESCAPED.format("text")} AS x FROM t),
     c AS (SELECT conv_id, count(*) AS n_turns,
                  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
                  CAST(sum(length('<turn ') + length(r) + length('>') + length(x) + length('</turn>')) AS BIGINT)
                    AS formatted_chars
           FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM c
""",
)
def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, through the prefix tree and back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(HARD_TEXT).alias("text"),
    )
    read = chat_tree.read_back(*chat_tree.build(turns.unionByName(hard)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("turns", lambda t: F.coalesce(t["loss"], F.lit(""))), "")
    return read.select(
        F.col("conv").alias("conv_id"),
        long(F.size("turns")).alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        long(F.char_length(loss)).alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["n_chars"]).alias("formatted_chars"),
    )


@query("op4_line_blocks")
def op4_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = line_blocks.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", long(F.char_length("text")))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op8_word_bpe")
def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = word_bpe.decode(word_bpe.encode(docs, TOKENIZER), TOKENIZER)
    return decoded.select(
        "doc_id",
        long(F.size("ids")).alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_importance_resampling")
def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document, and whether it is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.classify(docs, table(spark, sf_dir, "labels"))


@query("op3_order_minhash")
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: five words, similarity 0.8."""
    return order_minhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


# CRC-32 of a word's bytes, by the table of its polynomial.
SQL_CRC = """list_reduce(list_prepend(4294967295, list_transform(range(1, length(hex(encode(w))) // 2 + 1),
             lambda p: CAST('0x' || substr(hex(encode(w)), 2 * p - 1, 2) AS BIGINT))),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"""
SQL_HEX = "CAST('0x' || substr({}, {}, 8) AS BIGINT)"


@query(
    "op11_crc_resampling",
    f"""
WITH steps AS (SELECT list(list_reduce(list_prepend(i, range(8)),
                     lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) ORDER BY i) AS crc FROM range(256) AS r(i)),
     texts AS (SELECT doc_id, text, false AS aim FROM documents UNION ALL SELECT NULL, text, true FROM benchmark),
     rows AS (SELECT doc_id, aim, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
     words AS (SELECT doc_id, aim, unnest(ws) AS w FROM rows),
     uses AS (SELECT doc_id, aim, w, count(*) AS n FROM words GROUP BY ALL),
     bucket AS (SELECT w, xor({SQL_CRC}, 4294967295) % 10000 AS b FROM (SELECT DISTINCT w FROM uses), steps),
     held AS (SELECT b, coalesce(sum(n) FILTER (NOT aim), 0) AS s, coalesce(sum(n) FILTER (aim), 0) AS t
              FROM uses JOIN bucket USING (w) GROUP BY b),
     total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM held),
     gain AS (SELECT b, CAST(floor(1000 * ln((held.t + 1)::DOUBLE * (total.s + 10000)::DOUBLE
                / ((held.s + 1)::DOUBLE * (total.t + 10000)::DOUBLE))) AS BIGINT) AS g FROM held, total),
     weighed AS (SELECT doc_id, CAST(sum(n * g) AS BIGINT) AS weight
                 FROM uses JOIN bucket USING (w) JOIN gain USING (b) WHERE NOT aim GROUP BY doc_id),
     scored AS (
       SELECT r.doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(({SQL_HEX.format("sha256('2024:' || r.doc_id)", 1)} + 0.5)
                / 4294967296::DOUBLE))) AS BIGINT) AS score
       FROM rows r LEFT JOIN weighed USING (doc_id) WHERE NOT aim),
     drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
               QUALIFY rank <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20))
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
""",
)
def op11_crc_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document towards the benchmark texts, and the place of the tenth that is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return crc_resampling.draw(docs, table(spark, sf_dir, "benchmark"), percent=10, min_words=20, max_run=1, seed=2024)


@query(
    "op12_fill_middle",
    f"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS x,
                    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
             FROM documents),
     h AS (SELECT *, len(u) AS n, {", ".join(f"{SQL_HEX.format('x', 8 * i + 1)} AS h{i + 1}" for i in range(4))} FROM cut),
     ends AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high FROM h),
     parts AS (SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m,
                      array_to_string(u[high + 1:], '') AS s,
                      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                                OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
               FROM ends)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the texts with their middle last, and every text read back from its output."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_middle.transform(docs, rate=50, spm_rate=80, seed=42)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


@query("op13_compress_lang")
def op13_compress_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = compress_lang.held_out(F.col("doc_id"))
    model = compress_lang.fit(docs.where(~out))
    found = compress_lang.identify(docs.select("doc_id", "text"), model, reject=False)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "lead", "narrow")
