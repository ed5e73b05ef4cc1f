"""The registered token counts against plain Python: inserts, deletes of copies and a revision, on a whole table."""

import base64
import collections
import re

import public_tokenizers
import tiktoken

from brindle.llm import queries


def test_query_equals_brute_force(spark, tmp_path):
    texts = [None, "", "a-b c", "a-b c", "über, café 12", "x  y", "one", "one", "one"]
    rows = [(i, t, f"s{i % 2}", None if i == 5 else "en") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    bpe = tiktoken.Encoding("bpe", pat_str=queries.BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = collections.defaultdict(lambda: [0, 0])
    for i, text, source, lang in rows:
        own = expected[source, lang, "words-1"]
        own[0] += 1
        own[1] += len(re.findall("[A-Za-z0-9]+", text or ""))
        if text is None or text not in texts[:i]:
            own = expected[source, lang, "byte_bpe_50k"]
            own[0] += 1
            own[1] += len(bpe.encode_ordinary(text or ""))
    got = {(r.source, r.lang, r.version): [r.n_docs, r.n_tokens] for r in queries.op5_token_counts(spark, str(tmp_path)).collect()}
    assert got == dict(expected)
