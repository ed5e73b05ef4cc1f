"""Token ids of texts that contain an added token's string."""

import numpy as np

from brindle.llm import queries, tokens


def test_added_tokens_in_a_text_equal_the_library():
    from tokenizers import Tokenizer

    with open(queries.BYTE_BPE, encoding="utf-8") as file:
        written = file.read()
    library = Tokenizer.from_str(written)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a b<|endoftext|>c d", "<|endoftext| > no", "plain words here"]
    expected = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert 50256 in expected[0]
    ids, lengths = tokens.ChunkEncoder(written).encode(texts, 2)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == expected


def test_uneven_white_space_equals_the_library(monkeypatch):
    """Texts are cut beside uneven white space too, and long chunks are not kept."""
    import random

    from tokenizers import Tokenizer

    with open(queries.BYTE_BPE, encoding="utf-8") as file:
        written = file.read()
    library = Tokenizer.from_str(written)
    monkeypatch.setattr(tokens, "REMEMBERED", 20_000)
    rng = random.Random(2)
    parts = [" ", " ", "  ", "\n", "\t", " ", "\x1f", "a", "the", "'s", "é", "日", "12", "-", "x" * 80, "<|endoftext|>"]
    weights = [6, 6, 2, 2, 1, 1, 1, 5, 5, 2, 2, 2, 2, 2, 1, 0.2]
    encoder = tokens.ChunkEncoder(written)
    for _ in range(20):
        texts = ["".join(rng.choices(parts, weights, k=rng.randint(0, 40))) for _ in range(40)]
        ids, lengths = encoder.encode(texts, 2)
        expected = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == expected
        assert all(len(c) <= tokens.LONGEST for c in encoder.slots)


def test_long_unbroken_texts_equal_the_library():
    """Long segments go through the heap of edges; a character repeated 200,000 times stays fast."""
    import random

    import sentencepiece

    from brindle.llm import pieces

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    encoder = pieces.Encoder(pieces.load(queries.PIECE_MODEL))
    rng = random.Random(6)
    texts = ["x" * 200_000, "ab" * 5_000, "".join(rng.choices("etaoinshrdlu", k=20_000)), "=" * 3_000 + " a " + "the" * 900, "é日𝄞" * 400]
    for text, blob in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(blob, dtype="<i4").tolist() == library.encode(text)


def test_fresh_chunks_share_an_encoding():
    import public_tokenizers

    encoder = tokens.ChunkEncoder(open(public_tokenizers.path("byte_bpe_50k.json")).read())
    asked = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

        encode_batch = encode_batch_fast

    library = encoder.tokenizer
    encoder.tokenizer = Counting(library)
    texts = [" ".join(f"w{i}'s,{i * j}é" for j in range(50)) for i in range(20)] + ["a  b\n c", "\nend  x", ""]
    ids, lengths = encoder.encode(texts, 2)
    expected = [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    assert len(asked) < 50
