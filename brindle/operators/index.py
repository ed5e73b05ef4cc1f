"""Inverted index: postings, gaps, size report, boolean retrieval, snippets.

A term's postings are stored in blocks of ``BLOCK_DOCS`` consecutive document ids.  That bounds every
list by its block width, however frequent the term is, and lets the blocks of a frequent term be built
and read by many tasks.  A collection whose ids fit one block has one list per term.
Blocks are full if ids are dense; sparse ids give more and shorter blocks with the same content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.text import as_column, snippet, tokenize

BLOCK_DOCS = 65_536

# The operators' codes next to term numbers.
IS_AND = -1
IS_OR = -2

# Operators of a postfix query; largest magnitudes per coded length; plain integer size.
AND = "AND"
OR = "OR"
VARINT_LIMITS = [(127, 1), (255, 2), (65_535, 3), (16_777_215, 4)]
VARINT_LONGEST = 5
PLAIN_BYTES = 4


def _block(doc_id: str, block_docs: int) -> Column:
    """Number of the block of an id, by whole numbers: a division of doubles is wrong for large ids."""
    return F.expr(f"(`{doc_id}` - pmod(`{doc_id}`, {block_docs}L)) div {block_docs}L")


def term_frequencies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(term, doc_id, tf) over all tokens of each document."""
    terms = documents.select(F.col(doc_id).alias("doc_id"), F.explode(tokenize(text)).alias("term"))
    return terms.groupBy("term", "doc_id").agg(F.count("*").cast("int").alias("tf"))


def build_postings(frequencies: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, block_df, last_doc, postings): (doc_id, tf) entries ascending by document id."""
    return _collect_blocks(
        frequencies.select("term", _block("doc_id", block_docs).alias("block"), "doc_id", "tf")
    )


def _collect_blocks(entries: DataFrame) -> DataFrame:
    return entries.groupBy("term", "block").agg(
        F.count("*").alias("block_df"),
        F.max("doc_id").alias("last_doc"),
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"),
    )


def document_frequency(index: DataFrame) -> DataFrame:
    """(term, df) from the block sizes, without touching the lists."""
    return index.groupBy("term").agg(F.sum("block_df").alias("df"))


def gap_view(index: DataFrame) -> DataFrame:
    """(term, block, block_df, gaps): each document id as its distance to the one before it.

    The first entry of a term counts from 0 and the first one of a later block from the last id of
    the block before, so the gaps of all blocks in order are those of the undivided list.  Only one
    row per block, not per posting, goes through the window.
    """
    by_term = Window.partitionBy("term").orderBy("block")
    starts = index.select("term", "block", F.lag("last_doc", 1, 0).over(by_term).alias("start"))
    gaps = F.transform(
        F.arrays_zip(
            F.col("postings.doc_id").alias("doc_id"),
            F.col("postings.tf").alias("tf"),
            F.concat(F.array("start"), F.slice(F.col("postings.doc_id"), F.lit(1), F.size("postings") - 1)).alias("before"),
        ),
        lambda p: F.struct((p["doc_id"] - p["before"]).alias("gap"), p["tf"].alias("tf")),
    )
    # A hash join that builds on the narrow side spares a sort of rows that hold whole lists.
    return index.join(starts.hint("shuffle_hash"), ["term", "block"]).select(
        "term", "block", "block_df", gaps.alias("gaps")
    )


def gap_decode(gaps: DataFrame) -> DataFrame:
    """The index from its gap view: the running sum inside a block, plus the sum of
    all gaps in the blocks before it."""
    by_term = Window.partitionBy("term").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = gaps.select(
        "term",
        "block",
        F.aggregate(F.col("gaps.gap"), F.lit(0).cast("bigint"), lambda a, g: a + g).alias("total"),
    )
    starts = sums.select("term", "block", F.coalesce(F.sum("total").over(by_term), F.lit(0)).alias("start"))
    blocks = gaps.join(starts.hint("shuffle_hash"), ["term", "block"])
    entries = blocks.select("term", "block", "start", F.posexplode_outer("gaps").alias("at", "entry"))
    running = Window.partitionBy("term", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return _collect_blocks(
        entries.select(
            "term",
            "block",
            (F.col("start") + F.sum("entry.gap").over(running)).alias("doc_id"),
            F.col("entry.tf").alias("tf"),
        )
    )


def coded_bytes(value: str | Column) -> Column:
    """Length of a non-negative integer in a variable-length coding."""
    value = as_column(value)
    (first, size), *rest = VARINT_LIMITS
    length = F.when(value <= first, size)
    for limit, size in rest:
        length = length.when(value <= limit, size)
    return length.otherwise(VARINT_LONGEST)


def size_report(gaps: DataFrame) -> DataFrame:
    """(term, df, coded, plain): bytes of df and all (gap, tf), coded by length and as plain integers."""
    body = F.aggregate(
        F.transform("gaps", lambda e: coded_bytes(e["gap"]) + coded_bytes(e["tf"])),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )
    sizes = gaps.select("term", "block_df", body.alias("body"))
    totals = sizes.groupBy("term").agg(F.sum("block_df").alias("df"), F.sum("body").alias("body"))
    return totals.select(
        "term",
        "df",
        (F.col("body") + coded_bytes("df")).alias("coded"),
        (PLAIN_BYTES * (2 * F.col("df") + 1)).alias("plain"),
    )


def check_postfix(query: str) -> list[str]:
    """The tokens of a postfix query; ValueError if operands are missing or left over."""
    tokens = query.split()
    depth = 0
    for token in tokens:
        depth += -1 if token in (AND, OR) else 1
        if depth < 1:
            raise ValueError(f"operand missing before {token!r} in {query!r}")
    if depth != 1:
        raise ValueError(f"{depth} results left in {query!r}, expected one")
    return tokens


def lookup(index: DataFrame, terms: list[str]) -> DataFrame:
    """The index rows of some terms; of a stored index only the folders of their buckets are opened."""
    rows = index.where(F.col("term").isin(terms))
    if not {"buckets", "bucket"} <= set(index.columns):
        return rows
    own = F.lit(False)
    for term in terms:
        own |= F.col("bucket") == bucket_of(F.lit(term), F.col("buckets"))
    return rows.where(own)


def bucket_of(term: Column, buckets: Column) -> Column:
    """The bucket of a stored index that holds a term."""
    return F.pmod(F.xxhash64(term), buckets).cast("int")


def boolean_search(index: DataFrame, query: str) -> DataFrame:
    """(doc_id) of the documents that satisfy one postfix query such as ``a b OR c AND``.

    Only the postings of the query's terms are read (``lookup``).  They meet once, grouped by document into one
    flag per term; the query is then a plain filter over the flags.
    """
    tokens = check_postfix(query)
    terms = sorted({t for t in tokens if t not in (AND, OR)})
    stack: list[Column] = []
    for token in tokens:
        if token in (AND, OR):
            right, left = stack.pop(), stack.pop()
            stack.append(left & right if token == AND else left | right)
        else:
            stack.append(F.col(f"has_{terms.index(token)}"))
    flags = [F.bool_or(F.col("term") == term).alias(f"has_{i}") for i, term in enumerate(terms)]
    hits = lookup(index, terms).select("term", F.explode("postings.doc_id").alias("doc_id"))
    return hits.groupBy("doc_id").agg(*flags).where(stack.pop()).select("doc_id")


def boolean_search_batch(index: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id) for a table (query_id, postfix) of queries of any number and length.

    Every query gets a cover: terms of which each answer has at least one.  An AND takes the cover of
    the side with fewer postings, an OR needs those of both.  The lists of the cover give a query's candidates, block
    by block.  Candidates probe the lists of all terms of the query by (term, block), so a block without candidates
    is never opened for a frequent word, and what comes back is the candidates that have the term.  The postfix
    is then evaluated once per query and block, on sets of at most a block's ids.  A malformed query fails the job.
    """
    parsed = (
        queries.select("query_id", F.filter(F.split("postfix", r"\s+"), lambda t: t != "").alias("tokens"))
        .withColumn("depth", _checked_depth("query_id", "tokens"))
        .where("depth > 0")
        .withColumn("terms", F.array_distinct(F.filter("tokens", lambda t: ~t.isin(AND, OR))))
    )
    numbered = parsed.select("query_id", F.posexplode("terms").alias("number", "term"))
    # A query refers to its terms by number, so what follows compares integers only.
    programs = parsed.select(
        "query_id",
        "depth",
        F.transform(
            "tokens",
            lambda t: F.when(t == AND, IS_AND).when(t == OR, IS_OR).otherwise(F.array_position("terms", t) - 1),
        ).cast("array<int>").alias("program"),
    )

    sizes = (
        numbered.join(document_frequency(index), "term", "left")
        .groupBy("query_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("number", F.coalesce("df", F.lit(0)).alias("df")))).alias("sizes"))
    )
    covers = programs.join(sizes, "query_id").select("query_id", F.explode(_cover("program", "sizes")).alias("number"))
    lists = index.select("term", "block", F.col("postings.doc_id").alias("docs"))
    candidates = (
        covers.join(numbered, ["query_id", "number"])
        .join(lists, "term")
        .groupBy("query_id", "block")
        .agg(F.array_distinct(F.flatten(F.collect_list("docs"))).alias("candidates"))
    )
    probes = candidates.join(numbered, "query_id").join(lists, ["term", "block"])
    hits = probes.select("query_id", "block", "number", F.array_intersect("candidates", "docs").alias("docs"))
    sets = hits.groupBy("query_id", "block").agg(F.map_from_entries(F.collect_list(F.struct("number", "docs"))).alias("sets"))
    return sets.join(programs, "query_id").select("query_id", F.explode(_answers("program", "sets")).alias("doc_id"))


def _cover(program: str, sizes: str) -> Column:
    """Numbers of terms of which every answer has at least one, with few postings in total."""

    def step(stack: Column, code: Column) -> Column:
        rest = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 2, F.lit(0)))
        top, below = F.try_element_at(stack, F.lit(-1)), F.try_element_at(stack, F.lit(-2))
        cheaper = F.when(top["cost"] < below["cost"], top).otherwise(below)
        both = F.struct(
            (top["cost"] + below["cost"]).alias("cost"), F.concat(top["numbers"], below["numbers"]).alias("numbers")
        )
        term = F.struct(F.element_at(F.col(sizes), code).alias("cost"), F.array(code).alias("numbers"))
        return (
            F.when(code == IS_AND, F.concat(rest, F.array(cheaper)))
            .when(code == IS_OR, F.concat(rest, F.array(both)))
            .otherwise(F.concat(stack, F.array(term)))
        )

    nothing = F.array().cast("array<struct<cost:bigint,numbers:array<int>>>")
    return F.array_distinct(F.element_at(F.aggregate(program, nothing, step), 1)["numbers"])


def _checked_depth(query_id: str, tokens: str) -> Column:
    """The greatest number of results waiting at once in a postfix.

    The job fails if an operator finds fewer than two, or if not exactly one is left at the end.
    """
    state = F.aggregate(
        tokens,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"), F.lit(True).alias("ok")),
        lambda s, t: F.struct(
            (s["now"] + F.when(t.isin(AND, OR), -1).otherwise(1)).alias("now"),
            F.greatest(s["most"], s["now"] + 1).alias("most"),
            (s["ok"] & ((s["now"] >= 2) | ~t.isin(AND, OR))).alias("ok"),
        ),
    )
    message = F.concat(F.lit("malformed postfix query "), F.col(query_id).cast("string"))
    return F.when(state.getField("ok") & (state.getField("now") == 1), state.getField("most")).otherwise(
        F.raise_error(message).cast("int")
    )


def _answers(program: str, sets: str) -> Column:
    """The ids that satisfy a postfix of term numbers and operators, from the ids that have each term."""
    nothing = F.array().cast("array<bigint>")

    def step(stack: Column, code: Column) -> Column:
        rest = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 2, F.lit(0)))
        top, below = F.try_element_at(stack, F.lit(-1)), F.try_element_at(stack, F.lit(-2))
        own = F.coalesce(F.try_element_at(F.col(sets), code), nothing)
        return (
            F.when(code == IS_AND, F.concat(rest, F.array(F.array_intersect(top, below))))
            .when(code == IS_OR, F.concat(rest, F.array(F.array_union(top, below))))
            .otherwise(F.concat(stack, F.array(own)))
        )

    return F.element_at(F.aggregate(program, F.array().cast("array<array<bigint>>"), step), 1)


def with_snippets(hits: DataFrame, documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Hits with a snippet of their document; texts are cut before they are shuffled."""
    texts = documents.select(F.col(doc_id).alias("doc_id"), snippet(text).alias("snippet"))
    return hits.join(texts, "doc_id")
