"""Word co-occurrence: counts, bigram relative frequency, pointwise mutual information.

All operators take ``lines`` with a ``tokens`` array per line.  Bigram cells (w1, w2) are counted with
map-side partial aggregation and shuffled by both words, so a frequent word never gathers its cells
in one task.  Pairs of words of a line are far more; they are made after the shuffle (``frequent_pair_counts``).  Rows per word (marginals, line counts) are joined back with plain equi joins: small
tables are broadcast by their measured size, large ones are sort-merge joined, where adaptive
execution splits the partitions of hot words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.text import WORD_LIMIT, line_words, sliding_pairs, tokenize
from brindle.session import written

# The default co-occurrence threshold and the name of a marginal row.
THRESHOLD = 10
MARGINAL = "*"

# A stripe with more cells than this is emitted as several blocks, so no row outgrows a task.
STRIPE_CELLS = 100_000

# Words that get a number of two bytes, at every size; all others stay text.
NUMBERED_WORDS = 32_767

# Pairs that one task counts, on average.
TASK_PAIRS = 4_000_000


def tokenized(lines: DataFrame, line: str = "line") -> DataFrame:
    """Replace the line by its tokens."""
    kept = [c for c in lines.columns if c != line]
    return lines.select(*kept, tokenize(line).alias("tokens"))


def word_line_counts(lines: DataFrame, limit: int = WORD_LIMIT) -> DataFrame:
    """(word, n): lines holding the word among their first ``limit`` tokens."""
    words = lines.select(F.explode(line_words("tokens", limit)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def line_total(lines: DataFrame) -> DataFrame:
    """One row: the number of lines, empty ones included."""
    return lines.agg(F.count("*").alias("lines"))


def word_line_counts_with_total(lines: DataFrame, limit: int = WORD_LIMIT) -> DataFrame:
    """``word_line_counts`` plus the line total under the marginal name."""
    return word_line_counts(lines, limit).unionByName(
        line_total(lines).select(F.lit(MARGINAL).alias("word"), F.col("lines").alias("n"))
    )


def bigram_counts(lines: DataFrame) -> DataFrame:
    """(w1, w2, n): neighbouring tokens inside a line."""
    pairs = lines.select(F.inline(sliding_pairs("tokens")).alias("w1", "w2"))
    # The join with the marginals asks for this filter; stated here, every use of the counts has the
    # same plan and shares one shuffle.
    return pairs.where("w1 is not null").groupBy("w1", "w2").agg(F.count("*").alias("n"))


def _bigram_marginals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("w1").agg(F.sum("n").alias("total"), F.count("*").alias("cells"))


def bigram_frequency_pairs(lines: DataFrame) -> DataFrame:
    """(w1, w2, value): n(w1,w2)/n(w1,*) per bigram, and a row (w1, '*') with the raw n(w1,*)."""
    counts = bigram_counts(lines)
    marginals = _bigram_marginals(counts)
    cells = counts.join(marginals, "w1").select("w1", "w2", (F.col("n") / F.col("total")).alias("value"))
    return cells.unionByName(
        marginals.select("w1", F.lit(MARGINAL).alias("w2"), F.col("total").cast("double").alias("value"))
    )


def to_stripes(cells: DataFrame, value, max_cells: int = STRIPE_CELLS) -> DataFrame:
    """(w1, block, stripe): map w2 -> value of each word.

    ``cells`` carries (w1, w2, cells, ...), where ``cells`` is the number of cells of w1.  Up to
    ``max_cells`` the word has the single block 0; beyond that its cells are spread over as many
    blocks as needed by a hash of w2.
    """
    blocks = F.ceil(F.col("cells") / F.lit(max_cells))
    blocked = cells.select("w1", F.pmod(F.xxhash64("w2"), blocks).cast("int").alias("block"), F.struct("w2", value.alias("v")).alias("cell"))
    return (
        blocked.repartition("w1", "block")
        .groupBy("w1", "block")
        .agg(F.map_from_entries(F.sort_array(F.collect_list("cell"))).alias("stripe"))
    )


def bigram_frequency_stripes(lines: DataFrame, max_cells: int = STRIPE_CELLS) -> DataFrame:
    """(w1, block, stripe): map w2 -> n(w1,w2)/n(w1,*)."""
    counts = bigram_counts(lines)
    cells = counts.join(_bigram_marginals(counts), "w1")
    return to_stripes(cells, F.col("n") / F.col("total"), max_cells)


def pair_counts(lines: DataFrame, limit: int = WORD_LIMIT) -> DataFrame:
    """(w1, w2, n) for unordered pairs w1 < w2: lines holding both words.

    Counts are symmetric, so half of the ordered pairs carry all the information; ``pmi_pairs`` adds
    the mirrored rows at the very end, after the shuffles.
    """
    return _count_pairs(lines.select(line_words("tokens", limit).alias("words")))


def _count_pairs(lines: DataFrame) -> DataFrame:
    # An outer explode of a computed array: for an inner one the optimizer adds filters on the array
    # below the scan's first exchange, which would tokenize every line two more times.
    left = lines.select(F.sort_array("words").alias("words")).select(
        "words", F.posexplode_outer("words").alias("at", "w1")
    )
    pairs = left.where("w1 is not null").select("w1", F.explode(F.slice("words", F.col("at") + 2, F.size("words"))).alias("w2"))
    return pairs.groupBy("w1", "w2").agg(F.count("*").alias("n"))


def frequent_pair_counts(
    lines: DataFrame, threshold: int, line_key: list[str], limit: int = WORD_LIMIT, numbered: int = NUMBERED_WORDS
) -> DataFrame:
    """``pair_counts`` with n >= threshold, in either order, from words that can still reach it.

    n(w1,w2) is at most the smaller of the two line counts, so a word on fewer lines than the
    threshold takes part in no kept pair.  Dropping it before pairing is exact and keeps the long tail
    of rare words out of the pair shuffle.

    What is shuffled is a list per word and line, not the pairs: each word travels with the words of its line that
    stand before it, which makes pairs after the shuffle only.  The ``numbered`` most frequent words are numbers by
    falling frequency and stand before all others, so a word brings the more frequent ones along and is the rarer
    one of its pairs; no list of a frequent word is long.  A line has at most ``limit`` words, which bounds the lists.
    """
    counts = written(word_line_counts(lines, limit), "word-counts").where(F.col("n") >= threshold)
    first = counts.orderBy(F.desc("n"), "word").limit(numbered).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("order"), "word"))).alias("words"))
    numbers = first.select(F.posexplode("words.word").alias("number", "word"))
    numbers = written(numbers.select(F.col("number").cast("smallint").alias("number"), "word"), "numbers")
    words = lines.select(*line_key, F.explode(line_words("tokens", limit)).alias("word"))
    few = words.join(F.broadcast(numbers), "word").select(*line_key, "number", F.lit(None).cast("string").alias("word"))
    rest = words.join(F.broadcast(numbers), "word", "left_anti").join(counts, "word", "left_semi")
    regrouped = few.unionByName(rest.select(*line_key, F.lit(None).cast("smallint").alias("number"), "word"))
    grouped = written(
        regrouped.groupBy(*line_key)
        .agg(F.sort_array(F.collect_list("number")).alias("numbers"), F.sort_array(F.collect_list("word")).alias("words"))
        .select("numbers", "words"),
        "line-lists",
    )
    size, more = F.size("numbers").cast("bigint"), F.size("words").cast("bigint")
    pairs = grouped.agg(F.sum(size * (size - 1) / 2), F.sum(more * (more - 1) / 2 + size * more)).first()
    least = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = [max(least, int((n or 0) // TASK_PAIRS) + 1) for n in pairs]

    lists = grouped.select("numbers", F.posexplode("numbers").alias("at", "n1")).where("at > 0")
    lists = lists.select("n1", F.slice("numbers", F.lit(1), F.col("at")).alias("before")).repartition(tasks[0], "n1")
    both = _often(lists.select("n1", F.explode("before").alias("n2")), threshold, "n1", "n2")

    lists = grouped.select("numbers", "words", F.posexplode("words").alias("at", "w1")).where((F.col("at") > 0) | (F.size("numbers") > 0))
    lists = lists.select("w1", "numbers", F.slice("words", F.lit(1), F.col("at")).alias("before")).repartition(tasks[1], "w1")
    entries = F.concat(
        F.transform("numbers", lambda n: F.struct(n.alias("n2"), F.lit(None).cast("string").alias("w2"))),
        F.transform("before", lambda w: F.struct(F.lit(None).cast("smallint").alias("n2"), w.alias("w2"))),
    )
    mixed = _often(lists.select("w1", F.inline(entries)), threshold, "w1", "n2", "w2")

    one, two = (F.broadcast(numbers.select(F.col("number").alias(f"n{i}"), F.col("word").alias(f"named{i}"))) for i in (1, 2))
    named = both.join(one, "n1").join(two, "n2").select(F.col("named1").alias("w1"), F.col("named2").alias("w2"), "n")
    return named.unionByName(mixed.join(two, "n2", "left").select("w1", F.coalesce("w2", "named2").alias("w2"), "n"))


def _often(pairs: DataFrame, threshold: int, *key: str) -> DataFrame:
    return pairs.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= threshold)


def _pmi(pairs: DataFrame, lines: DataFrame, limit: int) -> DataFrame:
    counts = word_line_counts(lines, limit)
    total = line_total(lines).scalar()
    scored = (
        pairs.join(counts.select(F.col("word").alias("w1"), F.col("n").alias("c1")), "w1")
        .join(counts.select(F.col("word").alias("w2"), F.col("n").alias("c2")), "w2")
        .select(
            "w1",
            "w2",
            "n",
            F.log10(
                F.col("n").cast("double") * total / (F.col("c1").cast("double") * F.col("c2").cast("double"))
            ).alias("pmi"),
        )
    )
    both = F.array(
        F.struct(F.col("w1").alias("w1"), F.col("w2").alias("w2")),
        F.struct(F.col("w2").alias("w1"), F.col("w1").alias("w2")),
    )
    return scored.select(F.inline(both).alias("w1", "w2"), "pmi", "n")


def pmi_pairs(
    lines: DataFrame, line_key: list[str], threshold: int = THRESHOLD, limit: int = WORD_LIMIT
) -> DataFrame:
    """(w1, w2, pmi, n): log10(n * lines / (c1 * c2)) for ordered pairs on at least ``threshold`` lines.

    Only words that are frequent enough are paired.  ``line_key`` identifies a line.  The words of the lines
    are read several times, so they are written once.
    """
    kept = written(lines.select(*line_key, line_words("tokens", limit).alias("tokens")), "line-words")
    return _pmi(frequent_pair_counts(kept, threshold, line_key, limit), kept, limit)


def pmi_stripes(
    lines: DataFrame, line_key: list[str], threshold: int = THRESHOLD, limit: int = WORD_LIMIT, max_cells: int = STRIPE_CELLS
) -> DataFrame:
    """(w1, block, stripe): map w2 -> (pmi, n); a word without a kept pair has no row.

    The kept pairs are few next to all counted ones and are read twice, so they are written once.
    """
    pairs = written(pmi_pairs(lines, line_key, threshold, limit), "pairs")
    sizes = pairs.groupBy("w1").agg(F.count("*").alias("cells"))
    return to_stripes(pairs.join(sizes, "w1"), F.struct("pmi", "n"), max_cells)
