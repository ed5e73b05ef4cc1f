"""Inverted index, gaps, sizes, boolean retrieval."""

import random
import shutil
from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from brindle.operators import index as ix
from brindle.sources import sinks


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["the"] * 40 + ["red", "white", "rose", "pluck", "AND", "q"] + [f"t{chr(97 + i)}" for i in range(20)]
    ids = sorted(rng.sample(range(100_000), 150))
    return {i: " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for i in ids}


@pytest.fixture(scope="module")
def documents(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)


@pytest.fixture(scope="module", params=[ix.BLOCK_DOCS, 1_000])
def index(request, documents):
    return ix.build_postings(ix.term_frequencies(documents), request.param)


def brute(texts):
    lists = {}
    for doc_id in sorted(texts):
        for term, tf in Counter(texts[doc_id].lower().split()).items():
            lists.setdefault(term, []).append((doc_id, tf))
    return lists


def joined(blocks, column, first):
    """Lists of all blocks of a term, in block order."""
    lists = {}
    for r in blocks.orderBy("term", "block").collect():
        lists.setdefault(r.term, []).extend((e[first], e["tf"]) for e in r[column])
    return lists


def test_postings_are_ascending_and_complete(index, texts):
    assert joined(index, "postings", "doc_id") == brute(texts)
    assert dict(rows(ix.document_frequency(index))) == {t: len(p) for t, p in brute(texts).items()}


def test_blocks_bound_the_lists(index):
    blocks = index.select("block", F.floor(F.col("last_doc") / 1_000).alias("b"), F.size("postings").alias("n"))
    assert blocks.agg(F.max("n")).first()[0] <= 1_000


def test_gaps_are_those_of_the_undivided_list(index, texts):
    expected = {}
    for term, postings in brute(texts).items():
        before = [0] + [d for d, _ in postings]
        expected[term] = [(d - b, tf) for (d, tf), b in zip(postings, before)]
    gaps = ix.gap_view(index)
    assert joined(gaps, "gaps", "gap") == expected
    decoded = ix.gap_decode(gaps)
    names = ["term", "block", "block_df", "last_doc", "postings"]
    assert rows(decoded, *names) == rows(index, *names)


def test_size_report(index, texts):
    def length(n):
        return next((size for limit, size in ix.VARINT_LIMITS if n <= limit), ix.VARINT_LONGEST)

    expected = []
    for term, postings in brute(texts).items():
        before = [0] + [d for d, _ in postings]
        body = sum(length(d - b) + length(tf) for (d, tf), b in zip(postings, before))
        expected.append((term, len(postings), body + length(len(postings)), 4 * (1 + 2 * len(postings))))
    assert rows(ix.size_report(ix.gap_view(index))) == sorted(expected)


def brute_query(texts, query):
    lists = brute(texts)
    stack = []
    for token in query.split():
        if token in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            stack.append(left & right if token == "AND" else left | right)
        else:
            stack.append({d for d, _ in lists.get(token, [])})
    return stack.pop()


QUERIES = [
    "the",
    "red white AND",
    "red white OR",
    "white red OR rose AND pluck AND",
    "nosuchterm",
    "nosuchterm the OR",
    "nosuchterm the AND",
    "The",
    "ta tb AND tc td AND OR te OR",
    "red red AND red OR",
]


@pytest.mark.parametrize("query", QUERIES)
def test_boolean_search(index, texts, query):
    assert {r.doc_id for r in ix.boolean_search(index, query).collect()} == brute_query(texts, query)


def test_boolean_batch_equals_single_queries(spark, index, texts):
    deep = " ".join(f"t{chr(97 + i % 20)}{'x' * (i // 20)}" for i in range(70)) + " the" + " OR" * 69 + " AND"
    wide = "t0 " + " ".join(f"t{i}x OR" for i in range(1, 130)) + " red OR rose AND"
    everything = QUERIES + [deep, wide]
    queries = spark.createDataFrame(list(enumerate(everything)), "query_id int, postfix string")
    got = {}
    for r in ix.boolean_search_batch(index, queries).collect():
        got.setdefault(r.query_id, set()).add(r.doc_id)
    expected = {i: brute_query(texts, q) for i, q in enumerate(everything)}
    assert got == {i: docs for i, docs in expected.items() if docs}


@pytest.mark.parametrize("query", ["", "a AND", "a b", "AND a b", "a OR b", "a b c AND"])
def test_malformed_postfix(spark, index, query):
    with pytest.raises(ValueError):
        ix.boolean_search(index, query)
    queries = spark.createDataFrame([(1, query)], "query_id int, postfix string")
    with pytest.raises(Exception, match="malformed postfix"):
        ix.boolean_search_batch(index, queries).collect()


def test_snippets(index, documents, texts):
    hits = ix.with_snippets(ix.boolean_search(index, "red"), documents)
    cut = lambda s: s if len(s) <= 80 else s[:80] + "..."
    assert dict(rows(hits)) == {d: cut(texts[d]) for d in brute_query(texts, "red")}


def test_stored_index(spark, index, tmp_path):
    path = str(tmp_path / "index")
    sinks.write_index(index, path, 3)
    assert rows(sinks.read_index(spark, path).select(*index.columns)) == rows(index)


@pytest.mark.parametrize(
    "query, expected",
    [
        ("the red AND", {"red"}),
        ("the red OR rose AND", {"rose"}),
        ("red white OR the AND", {"red", "white"}),
        ("the", {"the"}),
        ("the nosuchterm AND", {"nosuchterm"}),
        ("ta tb AND tc td AND OR", None),
    ],
)
def test_cover_takes_the_rarer_side(spark, texts, query, expected):
    lists = brute(texts)
    terms = list(dict.fromkeys(t for t in query.split() if t not in ("AND", "OR")))
    program = [{"AND": ix.IS_AND, "OR": ix.IS_OR}.get(t) or terms.index(t) for t in query.split()]
    sizes = {i: len(lists.get(t, [])) for i, t in enumerate(terms)}
    row = spark.createDataFrame([(program, sizes)], "program array<int>, sizes map<int, bigint>")
    cover = {terms[i] for i in row.select(ix._cover("program", "sizes")).first()[0]}
    assert cover == expected if expected else len(cover) == 2
    assert all(any(term in texts[d].lower().split() for term in cover) for d in brute_query(texts, query))


def test_blocks_of_large_ids(spark):
    ids = [0, 65_535, 65_536, (1 << 53) + 1, (1 << 60) - 1]
    frequencies = spark.createDataFrame([("a", i, 1) for i in ids], "term string, doc_id bigint, tf int")
    assert rows(ix.build_postings(frequencies).select("block")) == sorted((b,) for b in {i // 65_536 for i in ids})


def test_a_lookup_opens_its_bucket_only(spark, index, texts, tmp_path):
    """All other buckets are taken away after the folder was listed: opening one of them would fail."""
    path = str(tmp_path / "index")
    sinks.write_index(index, path, 4)
    stored = sinks.read_index(spark, path)
    places = dict(rows(stored.select("term", "bucket").distinct()))
    terms = ["red", "white"]
    assert set(places.values()) == {0, 1, 2, 3}
    for bucket in set(range(4)) - {places[t] for t in terms}:
        shutil.rmtree(f"{path}/buckets=4/bucket={bucket}")
    assert {r.doc_id for r in ix.boolean_search(stored, "red white OR").collect()} == brute_query(texts, "red white OR")
    assert "PartitionFilters: [" in plan(ix.lookup(stored, terms)) and "PushedFilters: [In(term" in plan(ix.lookup(stored, terms))
    with pytest.raises(Exception, match="exist|FILE_NOT_EXIST"):
        stored.agg(F.sum("block_df")).collect()


def test_batch_over_many_blocks_and_a_stored_index(spark, documents, texts, tmp_path):
    """Blocks of three ids: most queries have candidates in some blocks only."""
    path = str(tmp_path / "index")
    sinks.write_index(ix.build_postings(ix.term_frequencies(documents), block_docs=3), path, 4)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, postfix string")
    got = {}
    found = ix.boolean_search_batch(sinks.read_index(spark, path), queries).collect()
    for r in found:
        got.setdefault(r.query_id, set()).add(r.doc_id)
    expected = {i: brute_query(texts, q) for i, q in enumerate(QUERIES)}
    assert got == {i: docs for i, docs in expected.items() if docs} and len(found) == sum(map(len, got.values()))
