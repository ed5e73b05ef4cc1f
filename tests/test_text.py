"""Tokens, lines, co-occurrence: edge rules and brute force on small random corpora."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brindle.functions import text
from brindle.operators import cooccurrence as co
from brindle.sources import readers


def tokenize(line):
    """The rule, word by word."""
    words = (re.sub(r"^[^a-z]+|[^a-z]+$", "", w.lower()) for w in re.split(r"[ \t\n\r\f]+", line))
    return [w for w in words if w]


@pytest.mark.parametrize(
    "line, expected",
    [
        ("", []),
        ("   ", []),
        ("Hello, World!", ["hello", "world"]),
        ("don't -- stop (now)", ["don't", "stop", "now"]),
        ("a1b 12 3c4", ["a1b", "c"]),
        ("été x y\vz", ["t", "x y\vz"]),
        ("tab\tcr\rff\fnl\nend", ["tab", "cr", "ff", "nl", "end"]),
        ("* ** a*", ["a"]),
    ],
)
def test_tokenize_rules(spark, line, expected):
    assert spark.createDataFrame([(line,)], "line string").select(text.tokenize("line")).first()[0] == expected
    assert tokenize(line) == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abZ ß\t'-1é\n\f.", max_size=30), min_size=1, max_size=20))
def test_tokenize_matches_word_by_word_rule(spark, lines):
    got = spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", text.tokenize("line"))
    assert [r[1] for r in sorted(got.collect())] == [tokenize(line) for line in lines]


@pytest.mark.parametrize(
    "body, expected",
    [
        ("", []),
        ("a", ["a"]),
        ("a\n", ["a"]),
        ("a\n\n", ["a", ""]),
        ("\n", [""]),
        ("a\r\nb\rc\nd", ["a", "b", "c", "d"]),
        ("a\n\nb", ["a", "", "b"]),
    ],
)
def test_lines_follow_text_file_rules(spark, tmp_path, body, expected):
    documents = spark.createDataFrame([(7, body)], "doc_id int, text string")
    assert [r.line for r in readers.document_lines(documents).orderBy("line_no").collect()] == expected
    path = tmp_path / "file.txt"
    path.write_text(body, newline="")
    assert sorted(r.line for r in readers.text_lines(spark, str(path)).collect()) == sorted(expected)


def test_snippet_and_merge(spark):
    df = spark.createDataFrame([("x" * 80, "y" * 81)], "a string, b string")
    assert df.select(text.snippet("a"), text.snippet("b")).first() == ("x" * 80, "y" * 80 + "...")
    maps = spark.sql("SELECT map('a', 1L, 'b', 2L) AS m, map('b', 3L, 'c', 4L) AS n")
    assert maps.select(text.merge_counts("m", "n")).first()[0] == {"a": 1, "b": 5, "c": 4}


@pytest.fixture(scope="module")
def corpus():
    """Skewed random lines: one word on most of them, a long tail, some short and some over 40 words."""
    rng = random.Random(3)
    vocabulary = ["the"] * 30 + ["of"] * 15 + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 12, 60]))) for _ in range(300)]
    return lines


@pytest.fixture(scope="module")
def lines(spark, corpus):
    frame = spark.createDataFrame(list(enumerate(corpus)), "line_no int, line string").repartition(5)
    return co.tokenized(frame)


def brute_pmi(corpus, threshold):
    words = [sorted(set(tokenize(line)[:40])) for line in corpus]
    single = Counter(w for line in words for w in line)
    pairs = Counter((a, b) for line in words for a in line for b in line if a != b)
    return {
        k: (math.log10(n * len(corpus) / (single[k[0]] * single[k[1]])), n) for k, n in pairs.items() if n >= threshold
    }


def test_word_line_counts(lines, corpus):
    expected = Counter(w for line in corpus for w in set(tokenize(line)[:40]))
    expected["*"] = len(corpus)
    assert dict(rows(co.word_line_counts_with_total(lines))) == expected


@pytest.mark.parametrize("threshold", [1, 10])
def test_pmi_pairs(lines, corpus, threshold):
    expected = brute_pmi(corpus, threshold)
    found = {(r.w1, r.w2): (r.pmi, r.n) for r in co.pmi_pairs(lines, ["line_no"], threshold).collect()}
    assert found.keys() == expected.keys()
    assert all(found[k][1] == expected[k][1] and math.isclose(found[k][0], expected[k][0], abs_tol=1e-12) for k in expected)


@pytest.mark.parametrize("threshold, numbered", [(1, 1), (10, 5), (10, 32_767)])
def test_pairs_are_made_behind_the_shuffle(lines, corpus, threshold, numbered):
    """No pair is shuffled to be counted: words travel with the words before them."""
    counted = co.frequent_pair_counts(lines, threshold, ["line_no"], numbered=numbered)
    assert not re.search(r"hashpartitioning\((w1|n1)#\d+L?, \w+#", plan(counted, "simple"))
    expected = {k: n for k, (_, n) in brute_pmi(corpus, threshold).items() if k[0] < k[1]}
    found = counted.collect()
    assert {tuple(sorted((r.w1, r.w2))): r.n for r in found} == expected and len(found) == len(expected)


def test_lines_of_one_key_are_one_line(spark):
    frame = spark.createDataFrame([(None, ["a", "b"]), (None, ["b", "c"]), (1, ["a", "c"])], "line_no int, tokens array<string>")
    found = co.frequent_pair_counts(frame, 1, ["line_no"], numbered=2).collect()
    assert sorted((*sorted((r.w1, r.w2)), r.n) for r in found) == [("a", "b", 2), ("a", "c", 2), ("b", "b", 1), ("b", "c", 2)]


@pytest.mark.parametrize("max_cells", [100_000, 7])
def test_stripes_are_the_pairs_regrouped(lines, max_cells):
    pairs = co.pmi_pairs(lines, ["line_no"], 10)
    stripes = co.pmi_stripes(lines, ["line_no"], 10, max_cells=max_cells)
    assert rows(stripes.select("w1", F.explode("stripe").alias("w2", "v")).select("w1", "w2", "v.pmi", "v.n")) == rows(
        pairs, "w1", "w2", "pmi", "n"
    )
    blocks = stripes.groupBy("w1").count().agg(F.max("count")).first()[0]
    assert (blocks == 1) == (max_cells == 100_000)


def test_bigrams(lines, corpus):
    cells = Counter(p for line in corpus for p in zip(tokenize(line), tokenize(line)[1:]))
    heads = Counter()
    for (a, _), n in cells.items():
        heads[a] += n
    expected = {(a, b): n / heads[a] for (a, b), n in cells.items()} | {(a, "*"): float(n) for a, n in heads.items()}
    assert {(r.w1, r.w2): r.value for r in co.bigram_frequency_pairs(lines).collect()} == expected
    stripes = co.bigram_frequency_stripes(lines, max_cells=5)
    assert {(r.w1, w): v for r in stripes.collect() for w, v in r.stripe.items()} == {
        k: v for k, v in expected.items() if k[1] != "*"
    }
