"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and one failure bit per rule.
A policy is a versioned mask over these bits, so other policies and ablations read the ledger and never the
text again.  Nothing is shuffled by the ledger; an ablation groups by the mask, of which there are at most
2 ** len(RULES) values.

Defined results: null or empty text has no words and fails SHORT.  Null and repeated ids are rows like any
other.  Very long texts are handled inside their row with sorts and hash sets.  An empty table gives an
empty ledger.  Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm._common import NOT_SPACE, shingle_hashes, text_of, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A named condition on the measurements; a row that meets it fails."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """The rules whose failure rejects a document, under a version."""

    version: str
    rules: tuple[str, ...]


#: The position of a rule is its bit: new rules are added at the end.
RULES = (
    Rule("short", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "2 * word_chars < 5 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
)
BASE = Policy("base", ("short", "repeated_words"))
POLICIES = (BASE, Policy("v1", tuple(rule.name for rule in RULES)))


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    names = [rule.name for rule in rules]
    return sum(1 << names.index(name) for name in policy.rules)


def measured(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words), all long.

    Windows are compared by the 64-bit hash of their five words, inside one document only.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).select(
        "doc_id", "text", words(F.col("text")).alias("words")
    )
    rows = rows.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
        F.when(F.size("words") >= WINDOW, shingle_hashes(F.col("words"), WINDOW)).alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.withColumn(
        "ranked",
        F.when(repeats, F.sort_array(F.transform("windows", lambda key, at: F.struct(key.alias("key"), at.alias("at"))))),
    )
    twice = F.filter(
        F.transform(
            "ranked",
            lambda row, at: F.when(
                (row["key"] == F.get("ranked", at - 1)["key"]) | (row["key"] == F.get("ranked", at + 1)["key"]), row["at"]
            ),
        ),
        lambda at: at.isNotNull(),
    )
    rows = rows.withColumn("starts", F.sort_array(twice))
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda start, at: F.least(F.coalesce(F.get("starts", at + 1) - start, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0),
        lambda total, more: total + more,
    )
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def ledger(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The measurements with ``fail_bits``: bit i is set where rule i fails."""
    bits: Column = F.lit(0).cast("long")
    for bit, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured(documents, doc_id, text).withColumn("fail_bits", bits)


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def apply_policy(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A ledger with ``kept`` and ``policy`` (its version)."""
    return rows.withColumn("kept", passes(policy, rules)).withColumn("policy", F.lit(policy.version))


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each policy keeps, and what it would keep without one of its rules.

    (policy, without, n_kept, n_kept_words); ``without`` is null for the whole policy.  The ledger is grouped
    by its mask first; all policies are then evaluated on those few rows.
    """
    masks = rows.groupBy("fail_bits").agg(F.count("*").alias("n"), F.sum("n_words").alias("n_words"))
    cases = [
        F.struct(
            F.lit(policy.version).alias("policy"),
            F.lit(without).cast("string").alias("without"),
            F.lit(mask(Policy("", tuple(r for r in policy.rules if r != without)), rules)).cast("long").alias("mask"),
        )
        for policy in policies
        for without in (None, *policy.rules)
    ]
    cells = masks.select("*", F.explode(F.array(*cases)).alias("case"))
    kept = F.col("fail_bits").bitwiseAND(F.col("case.mask")) == 0
    return cells.groupBy("case.policy", "case.without").agg(
        F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(kept, F.col("n_words")).otherwise(0)).alias("n_kept_words"),
    )
