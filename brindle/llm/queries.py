"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import base64
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import align, decontaminate, kneser_ney, lines, near_dups, phrases, pieces, quality, secrets, simhash, token_counts, tokens, toxicity
from brindle.llm._common import stored
from brindle.session import work_path
from brindle.sources.readers import parquet_table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

# Fixed value: how the byte-level vocabulary splits a text.
BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.ledger(parquet_table(spark, folder, "documents"))
    base = ~quality.passes(quality.BASE)
    return quality.apply_policy(rows, quality.POLICIES[-1]).withColumn("base_failed", base)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.summary(secrets.scan(parquet_table(spark, folder, "documents")))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(parquet_table(spark, folder, "documents"), parquet_table(spark, folder, "labels"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = parquet_table(spark, folder, "documents")
    return kneser_ney.scored(documents, kneser_ney.train(documents))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after four batches: all documents by one tokenizer, by another, without exact copies of the first, and revised.

    The revision counts the words of all documents anew, now cut at every character that is no ASCII letter or digit.
    The last two batches are committed twice, as a job that is run again would.
    """
    documents = parquet_table(spark, folder, "documents")
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    pieces_state = stored(token_counts.tiktoken_counts(documents, ranks, BPE_PATTERN, "byte_bpe_50k"), "token-state")
    words_state = token_counts.word_counts(documents)
    ledger = work_path(spark, "token-ledger")
    copies = token_counts.deletes(token_counts.repeated(documents, pieces_state))
    revision = token_counts.changes(words_state, token_counts.word_counts(documents, separator="[^A-Za-z0-9]+"))
    token_counts.commit(token_counts.inserts(pieces_state), ledger, "1")
    token_counts.commit(token_counts.inserts(words_state), ledger, "2")
    for _ in range(2):
        token_counts.commit(copies, ledger, "3")
        token_counts.commit(revision, ledger, "4")
    return token_counts.totals(spark, ledger, ["1", "2", "3", "4"])


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(parquet_table(spark, folder, "documents"), width=2)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "token-files")
    with open(BYTE_BPE, encoding="utf-8") as file:
        tokenizer = file.read()
    tokens.write_tokens(tokens.encoded(parquet_table(spark, folder, "documents"), tokenizer), path)
    return tokens.digest(tokens.read_tokens(spark, path))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    rows = pieces.encoded(parquet_table(spark, folder, "documents"), pieces.load(PIECE_MODEL))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.deduplicated(parquet_table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = (parquet_table(spark, folder, name) for name in ("documents", "benchmark"))
    return decontaminate.summary(decontaminate.contamination(documents, benchmark))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    with open(BYTE_BPE, encoding="utf-8") as file:
        tokenizer = file.read()
    with open(PIECE_MODEL, "rb") as file:
        model = file.read()
    return align.scored(parquet_table(spark, folder, "documents"), tokenizer, model)


def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(parquet_table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(parquet_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_scan,
        op3_toxicity,
        op4_lm_scoring,
        op5_token_counts,
        op6_minhash_near_dedup,
        op7_token_files,
        op8_sentencepiece,
        op9_line_dedup,
        op10_decontamination,
        op11_token_alignment,
        op12_simhash_near_dedup,
        op13_collocations,
    )
}
SQL: dict[str, str] = {}

SQL["op1_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
p AS (SELECT r, unnest(w) AS v, generate_subscripts(w, 1) AS k FROM w),
q AS (SELECT r, k, concat_ws(' ', v, lead(v, 1) OVER o, lead(v, 2) OVER o, lead(v, 3) OVER o) || ' ' || lead(v, 4) OVER o AS five
    FROM p WINDOW o AS (PARTITION BY r ORDER BY k)),
c AS (SELECT r, k, count(*) OVER (PARTITION BY r, five) AS n FROM q WHERE five IS NOT NULL),
x AS (SELECT r, count(DISTINCT k + j) AS n FROM c, range(5) AS s(j) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
        (len(l) - list_unique(l))::BIGINT AS n_dup_lines, coalesce(x.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN x USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 4 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END
        + CASE WHEN 2 * word_chars < 5 * n_words THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT *, fail_bits = 0 AS kept, 'v1' AS policy, fail_bits & 3 <> 0 AS base_failed FROM b"""

SQL["op13_collocations"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT r, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
q AS (SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
x AS (SELECT r, lang, unnest(w) AS a, generate_subscripts(w, 1) AS k FROM q),
y AS (SELECT lang, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM x WINDOW o AS (PARTITION BY r ORDER BY k)),
n AS (SELECT lang, count(*) AS n FROM x GROUP BY lang),
f1 AS (SELECT lang, a, count(*) AS f FROM y GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM y WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM y WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
m AS (SELECT lang, a, b, max(f) AS longest FROM
        (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY lang, a, b),
cuts AS (
    SELECT f2.lang, a || ' ' || b AS phrase, 1 AS k, f2.f AS a, l.f AS l, r.f AS r
    FROM f2 JOIN f1 AS l USING (lang, a) JOIN f1 AS r ON r.lang = f2.lang AND r.a = f2.b LEFT JOIN m USING (lang, a, b)
    WHERE f2.f >= 10 AND (longest IS NULL OR 100 * longest < 50 * f2.f)
    UNION ALL
    SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, 1, f3.f, l.f, r.f
    FROM f3 JOIN f1 AS l ON l.lang = f3.lang AND l.a = f3.a JOIN f2 AS r ON r.lang = f3.lang AND r.a = f3.b AND r.b = f3.c
    UNION ALL
    SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, 2, f3.f, l.f, r.f
    FROM f3 JOIN f2 AS l ON l.lang = f3.lang AND l.a = f3.a AND l.b = f3.b JOIN f1 AS r ON r.lang = f3.lang AND r.a = f3.c),
s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
t AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM s),
u AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM u JOIN n USING (lang) WHERE rank <= 2000"""
