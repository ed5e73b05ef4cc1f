"""Token alignment, SimHash links and collocations against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from brindle.llm import align, phrases, queries, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SENTENCE = "The quick brown fox jumps over the lazy dog, while the old cat sleeps near the warm stove. It dreams of fish"
TEXTS = [
    None, "", " ", "\n", SENTENCE, SENTENCE, SENTENCE + " again", SENTENCE.upper(), "  two  spaces\n next\t tab ", "日本語 テスト 𝄞x\x00y",
    "▁ is not allowed", "word▁inside of a text", "<|endoftext|> and </s> <unk> <0x0A>", "é è ü \x1c z", "x" * 5000, "a b " * 400,
    "don't we'll 12345 3.14 é", " lead", "trail ", "one", "one two", "naïve café — “quotes” …", "　wide space em",
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, [None, "en", "de"][i % 3], "clash", i, "x") for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", "clash", 1, "x"), (None, SENTENCE, "en", "clash", 2, "x"), (4, "another text of this id", None, "c", 3, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, row string, n bigint, bits string")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    with open(queries.BYTE_BPE, encoding="utf-8") as file:
        tokenizer = file.read()
    with open(queries.PIECE_MODEL, "rb") as file:
        model = file.read()
    a = Tokenizer.from_str(tokenizer)
    a.encode_special_tokens = True
    return tokenizer, model, a, sentencepiece.SentencePieceProcessor(model_proto=model)


def whole_alignment(a, b, text):
    """Groups and links of a text from the tokens' bytes alone: (groups, pairs), None without tokens."""
    if not text:
        return None
    chars = align.byte_level_alphabet()
    raw = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    own_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
    own_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(own_a) != raw or b"".join(own_b) != raw:
        return None
    owner_a = [k for k, x in enumerate(own_a) for _ in x]
    owner_b = [k for k, x in enumerate(own_b) for _ in x]
    pairs = [(ids_a[i], ids_b[j]) for i, j in sorted(set(zip(owner_a, owner_b)))]
    cuts = [k for k in range(1, len(raw) + 1) if k == len(raw) or (owner_a[k] != owner_a[k - 1] and owner_b[k] != owner_b[k - 1])]
    groups = []
    first = 0
    for cut in cuts:
        groups.append([[ids[k] for k in sorted(set(owner[first:cut]))] for ids, owner in ((ids_a, owner_a), (ids_b, owner_b))])
        first = cut
    return len(ids_a), len(ids_b), groups, pairs


def expected_alignment(rows, a, b):
    found = [whole_alignment(a, b, text) for _, text in rows]
    counts = collections.Counter(p for f in found if f for p in f[3])
    most = collections.defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for (doc_id, _), f in zip(rows, found):
        if f is None:
            yield (doc_id, 0, 0, 0, 0, 0, 0, "")
            continue
        line = ";".join("|".join(",".join(map(str, side)) for side in group) for group in f[2])
        best = sum(counts[p] == most[p[1]] for p in f[3])
        total = sum(counts[p] for p in f[3])
        yield (doc_id, f[0], f[1], len(f[2]), len(f[3]), best, total, hashlib.sha256(line.encode()).hexdigest())


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_whole_texts(documents, libraries):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = [tuple(r) for r in align.scored(documents, *libraries[:2]).select(COLUMNS).collect()]
    assert sorted(got, key=str) == sorted(expected_alignment(rows, *libraries[2:]), key=str)
    assert align.scored(documents.limit(0), *libraries[:2]).count() == 0


def test_rare_pairs_are_joined(documents, libraries, monkeypatch):
    """With room for a few broadcast pairs most are joined by the shuffle."""
    monkeypatch.setattr(align, "FREQUENT", 10)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = [tuple(r) for r in align.scored(documents, *libraries[:2]).select(COLUMNS).collect()]
    assert sorted(got, key=str) == sorted(expected_alignment(rows, *libraries[2:]), key=str)


def test_chunks_of_odd_texts(libraries, monkeypatch):
    """Random mixes of white space, scripts and marks; the worker forgets all the time."""
    monkeypatch.setattr(align, "REMEMBERED", 3_000)
    rng = random.Random(7)
    parts = [" ", " ", " ", "  ", "\n", "\t", " ", "\x1f", " ", "a", "the", "'s", "é", "é", "日", "𝄞", "12", "-", "…", "\x00", "ß", "<s>", "​", "᠎", "\u0085"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(600)]
    aligner = align.Aligner(*libraries[:2])
    for at in range(0, len(texts), 50):
        own = texts[at : at + 50]
        for text, (numbers, digest, pairs, times) in zip(own, list(aligner.align(own))):
            whole = whole_alignment(*libraries[2:], text)
            if whole is None:
                assert numbers == (0, 0, 0, 0) and digest == ""
                continue
            line = ";".join("|".join(",".join(map(str, side)) for side in group) for group in whole[2])
            assert digest == hashlib.sha256(line.encode()).hexdigest(), repr(text)
            assert numbers == (whole[0], whole[1], len(whole[2]), len(whole[3]))
            linked = collections.Counter(x << 32 | y for x, y in whole[3])
            assert dict(zip(pairs.tolist(), times.tolist())) == linked


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def signed(bits):
    return bits - (1 << 64) if bits >> 63 else bits


def reachable(prints):
    """Component of every row: rows are linked by two differing bits or fewer."""
    left = set(range(len(prints)))
    component = {}
    while left:
        stack = [left.pop()]
        seen = set(stack)
        while stack:
            row = stack.pop()
            near = {o for o in left if (prints[row] ^ prints[o]).bit_count() <= 2}
            left -= near
            seen |= near
            stack += near
        component |= dict.fromkeys(seen, frozenset(seen))
    return component


def test_simhash_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    prints = [slow_fingerprint(t) for _, t in rows]
    component = reachable(prints)
    expected = [
        (i, f"{p:016x}", min((rows[o][0] for o in component[k] if rows[o][0] is not None), default=None))
        for k, ((i, _), p) in enumerate(zip(rows, prints))
    ]
    got = [tuple(r) for r in simhash.near_duplicates(documents).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert simhash.near_duplicates(documents.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [0, 3, 10_000])
def test_links_connect_what_is_within_two_bits(spark, monkeypatch, crowd):
    """Whether halves are crowded or not, the components are those of all pairs."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(3)
    prints = {0, 1, 3, 7, 1 << 63, (1 << 63) | 1, (1 << 64) - 1}
    for _ in range(12):
        bits = rng.getrandbits(64)
        for _ in range(25):
            prints.add(bits)
            bits ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 1, 2, 3])))
    upper = rng.getrandbits(32) << 32
    prints |= {upper | rng.getrandbits(4) for _ in range(12)} | {upper ^ 1 << 40 | rng.getrandbits(5) << 3 for _ in range(12)}
    prints = sorted(prints)
    table = spark.createDataFrame([(signed(p),) for p in prints], "bits bigint")
    edges = [(r.a, r.b) for r in simhash.links(table).collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2 for a, b in edges)
    parent = {signed(p): signed(p) for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    component = reachable(prints)
    groups = {frozenset(signed(prints[o]) for o in c) for c in component.values()}
    own = collections.defaultdict(set)
    for p in parent:
        own[root(p)].add(p)
    assert groups == {frozenset(c) for c in own.values()}


def slow_collocations(rows, least=10, top=2000):
    counts = collections.defaultdict(collections.Counter)
    totals = collections.Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    for lang, f in counts.items():
        found = []
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        for p, a in candidates.items():
            longer = [n for q, n in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * n >= 50 * a for n in longer):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, phrase.decode(), -a, l, r, totals[lang], -score


NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = ["new", "york", "city", "the", "The", "of", "a", "é", "日本", "x y", "São", "Paulo", "q\x1cr", "...", "?", ";z"]
    weights = [6, 5, 4, 9, 2, 7, 6, 2, 2, 1, 2, 2, 1, 2, 1, 1]
    gaps = [" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\r\n", "\x0b", "! ", ": "]
    rows = []
    for i in range(400):
        text = "".join(w + rng.choice(gaps) for w in rng.choices(words, weights, k=rng.randint(0, 40)))
        if i % 3 == 0:
            text += " in New York City now"
        rows.append((i, text if i % 50 else None, [None, "en", "de", ""][i % 4], "clash", 7))
    rows += [(1, "new york city " * 500, "en", "clash", 7)] * 2 + [(2, "", "fr", "clash", 7)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, phrase string, n bigint")


@pytest.mark.parametrize("small", [False, True])
def test_collocations_equal_brute_force(corpus, monkeypatch, small):
    rows = [(r.lang, r.text) for r in corpus.collect()]
    expected = sorted(slow_collocations(rows, top=30))
    assert {e[0] for e in expected} >= {"und", "en", "de", ""}
    if small:
        # Many bursts, spills and forgotten numberings, and texts in many blocks; tasks import the module anew.
        one = corpus.repartition(1).select("lang", "text").collect()
        for name, value in (("BURST", 16), ("HELD", 200), ("NUMBERED", 12), ("AT_ONCE", 90)):
            monkeypatch.setattr(phrases, name, value)
        counter = phrases.Counter(5)
        runs = [run for r in one for run in counter.count("en", [(r.text or "").encode()])]
        runs += counter.spill(0)
        assert len(runs) > 50
        by_part = collections.defaultdict(list)
        for _, part, words, keys, n, _ in runs:
            by_part[part].append((words, keys, n))
        got = {}
        for own in by_part.values():
            found, _, counts = phrases._merged(own, 1)
            assert not set(found) & got.keys()
            got |= dict(zip(found, counts.tolist()))
        whole = collections.Counter()
        for r in one:
            for piece in re.split(r"[.,;:!?\x0a-\x0d]", (r.text or "").translate(LOWER)):
                words = re.findall(r"[^\x20\x09]+", piece)
                for size in (1, 2, 3):
                    whole.update(" ".join(words[k : k + size]).encode() for k in range(len(words) - size + 1))
        assert got == dict(whole)
        return
    got = phrases.collocations(corpus, top=30).select(NAMES)
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert phrases.collocations(corpus.limit(0)).count() == 0


def test_merge_with_many_words(monkeypatch):
    """The merge that packs numbers into two keys gives the same sequences."""
    counter = phrases.Counter(1)
    runs = [*counter.count("en", [b"a b c a b c d. a b"]), *counter.spill(0)]
    listed = [run[2:5] for run in runs]
    usual = phrases._merged(listed, 2)
    monkeypatch.setattr(phrases, "MASK", 2)
    wide = phrases._merged(listed, 2)
    assert dict(zip(usual[0], usual[2].tolist())) == dict(zip(wide[0], wide[2].tolist())) and b"a b c" in wide[0]
    assert np.array_equal(np.sort(usual[1]), np.sort(wide[1]))


def test_scores_are_exact_beyond_64_bits(spark):
    exact = spark.createDataFrame([(3_000_000_000, 3_000_000_001, 4_000_000_000)], "a bigint, l bigint, r bigint")
    row = exact.selectExpr(f"{phrases.EXACT} as score").first()
    assert row.score == 10**6 * 3_000_000_000**2 // (3_000_000_001 * 4_000_000_000)


def test_counting_phrases_holds_few_words_and_sequences():
    import random
    import tracemalloc

    from brindle.llm import phrases

    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(1_000_000)}" for _ in range(5_000)).encode() for _ in range(120)]
    counter, n, words = phrases.Counter(4), 0, 0
    tracemalloc.start()
    for at in range(0, len(texts), 20):
        for run in counter.count("en", texts[at : at + 20]):
            n, words = n + run[4], words + run[5]
    for run in counter.spill(0):
        n, words = n + run[4], words + run[5]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words == 600_000
    assert n >= 2 * 600_000
    assert peak < 280_000_000


def test_only_texts_with_candidates_travel(spark):
    from brindle.llm import decontaminate

    item = " ".join(f"w{i}" for i in range(20))
    texts = [f"x {item} y", item[:30], "a b c " * 500, "", None, f"{item} {item}", f"x {item} y"]
    documents = spark.createDataFrame([(i % 6, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([("i", item), ("j", "b c a")], "item_id string, text string")
    found = decontaminate.contamination(documents, benchmark)
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect())
    assert got == [
        (0, 22, 20, ["i"]), (0, 22, 20, ["i"]), (1, 10, 0, []), (2, 1500, 1497, ["j"]), (3, 0, 0, []), (4, 0, 0, []), (5, 40, 40, ["i"]),
    ]
    # What meets the places is the text of rows with a candidate, null for the others.
    assert "THEN text" in found._jdf.queryExecution().optimizedPlan().toString()
