"""Registered queries of the data-pipeline operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm import chat, decontaminate, langid, linededup, lm, packing, periodic, quality, ranked, rules, simhash, substrings, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def fold(mod: int):
    """crc32 of the document id as text, modulo ``mod``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(mod))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    g = simhash.simhash_groups(docs, shingle=4, max_distance=4)
    return g.select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), F.col("component").alias("component_id"))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_digest(packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=2048))


TOXIC_AT = 0.7


def fit_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learns from the rows whose crc32 of the id, modulo 3, is not 1."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(3) != 1)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, fit_toxicity(spark, docs, sf_dir))
    return out.select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
ORACLES["op5_decontamination"] = f"""
WITH items AS (SELECT DISTINCT item_id, text FROM benchmark),
     iw AS (SELECT item_id, text, {_WORDS} AS w FROM items),
     ish AS (SELECT DISTINCT item_id, text, array_to_string(w[i:i + 4], ' ') AS s
             FROM (SELECT item_id, text, w, unnest(range(1, len(w) - 3)) AS i FROM iw)),
     n AS (SELECT item_id, text, count(*) AS n_shingles FROM ish GROUP BY ALL),
     dw AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
     dsh AS (SELECT DISTINCT doc_id, r, array_to_string(w[i:i + 4], ' ') AS s
             FROM (SELECT doc_id, r, w, unnest(range(1, len(w) - 3)) AS i FROM dw))
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared
FROM dsh JOIN ish USING (s) JOIN n USING (item_id, text)
GROUP BY doc_id, r, item_id, text, n_shingles
HAVING count(*) >= 0.8 * n_shingles
"""


def repeats_digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(substrings.remove_repeats(table(spark, sf_dir, "documents"), length=200, keep="none"))


@query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out=fold(5) == 1)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows whose crc32 of the id, modulo 5, is not 0."""
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0))
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = rules.judge(docs, rules.fit(docs), window=8)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("content")).alias("kept"),
        "n_lines", "n_content_lines", "content_words",
    )


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows whose crc32 of the id, modulo 3, is not 1."""
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs, fold(3) != 1))
    return out.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = linededup.dedup_lines(docs, threshold=0.8, min_tokens=1, columns=["doc_id"])
    return out.select("row.doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed"), F.md5("kept_text").alias("kept_md5"))


_LINE_WORDS = "list_distinct(regexp_extract_all(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'))"
ORACLES["op4_line_dedup"] = f"""
WITH l AS (SELECT doc_id, i - 1 AS i, string_split(text, chr(10))[i] AS s
           FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
     k AS (SELECT doc_id, i, s, {_LINE_WORDS} AS w FROM l),
     b AS (SELECT doc_id, i, w, len(w) AS n FROM k WHERE len(w) >= 1),
     t AS (SELECT doc_id, i, n, unnest(w) AS x FROM b),
     f AS (SELECT x, count(*) AS c FROM t GROUP BY x),
     r AS (SELECT t.*, row_number() OVER (PARTITION BY doc_id, i ORDER BY c, x) AS p FROM t JOIN f USING (x)),
     e AS (SELECT * FROM r WHERE p <= n - ceil(0.8 * n) + 1),
     c AS (SELECT DISTINCT y.doc_id, y.i, z.doc_id AS doc2, z.i AS i2 FROM e y JOIN e z USING (x)
           WHERE (z.doc_id, z.i) < (y.doc_id, y.i) AND y.n <= z.n / 0.8 AND z.n <= y.n / 0.8),
     g AS (SELECT DISTINCT c.doc_id, c.i FROM c JOIN b y ON y.doc_id = c.doc_id AND y.i = c.i JOIN b z ON z.doc_id = c.doc2 AND z.i = c.i2
           WHERE 1.8 * len(list_intersect(y.w, z.w)) >= 0.8 * (y.n + z.n)),
     o AS (SELECT l.doc_id, l.i, l.s, g.i IS NOT NULL AS gone FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i),
     m AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
                  coalesce(string_agg(i, ',' ORDER BY i) FILTER (WHERE gone), '') AS removed,
                  md5(coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_md5 FROM o GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, kept_md5
FROM documents LEFT JOIN m USING (doc_id)
"""


#: turns that hold the template's own marks, formatted beside the table
TRICKY = r"\### Assistant: </turn> ok"


@query
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7; every column is read back from the formatted output."""
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    out = chat.joined(chat.format_conversations(turns)).withColumns(
        {"turns": chat.read_back(F.col("formatted")), "loss_text": F.array_join("loss_texts", "")}
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_bad", "valid",
    )


ORACLES["op12_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(i)),
     f AS (SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
                  replace(replace(replace(text, '\', '\0'), '### ', '\1'), '</turn>', '\2') AS safe,
                  replace(replace(replace(replace(role, '\', '\0'), '### ', '\1'), '</turn>', '\2'), ': ', '\3') AS safe_role
           FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
     g AS (SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
                          WHEN before = 'user' THEN role = 'assistant' ELSE false END AS ok FROM f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(14 + length(safe_role) + length(safe))::BIGINT AS formatted_chars,
       count(*) FILTER (WHERE NOT ok) AS n_bad, count(*) FILTER (WHERE NOT ok) = 0 AND max(role) FILTER (WHERE k = n) = 'assistant' AS valid
FROM g GROUP BY conv_id
""".replace("\\\\", "\\")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: of a tenth of the documents the words from one on repeat at a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeated(w):
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i))), " ")

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]  # the words are taken once
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(planted, F.col("text"))).otherwise(F.col("text")).alias("text"))


def runs_digest(out: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return out.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_digest(periodic.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")), min_length=12))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return out.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLES["op13_ranked_search"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents),
     s AS (SELECT r, doc_id, len(t) AS len FROM d WHERE len(t) > 0),
     g AS (SELECT count(*) AS docs, sum(len)::BIGINT AS total FROM s),
     p AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(t) AS x FROM d) GROUP BY ALL),
     i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark),
     u AS (SELECT q, item_id, x, count(*) AS times FROM (SELECT q, item_id, unnest(t) AS x FROM i) GROUP BY ALL),
     f AS (SELECT x, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM (SELECT x, count(*) AS df FROM p GROUP BY x), g),
     z AS (SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len * docs) // total))))::BIGINT AS score
           FROM u JOIN f USING (x) JOIN p USING (x) JOIN s USING (r), g GROUP BY ALL),
     k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM z WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""
