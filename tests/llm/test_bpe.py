"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from itemsync.llm import bpe
from tests.llm.conftest import nasty_texts

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(tokens):
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts() -> list[str]:
    rng = random.Random(5)
    ranges = [(32, 127), (0xA0, 0x530), (0x900, 0xD7FF), (0x10000, 0x1FFFF), (0x20000, 0x34000)]
    return [
        "<|endoftext|> is ordinary text",
        "it's I'LL we'd 'tis ''s",
        "a" * 3000,
        "日本語のテキスト" * 500,
        " " * 999 + "x \n\n\t  y",
        "\x1c\x1d a\x85b\xa0 c",
        "x՘y \U0001e6c01 \U000323b0a",
        "".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(20_000)),
        "".join(rng.choice("ab ") for _ in range(5000)),
    ]


def test_hash_is_minimal_and_perfect(tokens):
    hash = bpe.PerfectHash(tokens)
    assert sorted(hash.slot_of.tolist()) == list(range(len(tokens)))
    assert (hash.slots(tokens) == hash.slot_of).all()
    assert hash.slots([b"not a token of this vocabulary"]).max() < len(tokens)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 257])
def test_hash_of_few_keys(n):
    keys = [str(k).encode() for k in range(n)]
    assert sorted(bpe.PerfectHash(keys).slots(keys).tolist()) == list(range(n))


def test_every_token_is_found_whole(tokens):
    vocabulary = bpe.Vocabulary(tokens, PATTERN)
    assert vocabulary.whole(tokens) == list(range(len(tokens)))
    assert vocabulary.whole([b"qqqqzzzzqqqq", b""]) == [-1, -1]


def test_merging_matches_the_plain_rule(tokens):
    ranks = {token: rank for rank, token in enumerate(tokens)}
    rng = random.Random(3)
    for _ in range(300):
        piece = bytes(rng.choice(b"aeinrst") for _ in range(rng.randrange(1, 40)))
        parts = [bytes([b]) for b in piece]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.merged(piece, ranks) == [ranks[p] for p in parts]


def test_ids_are_those_of_the_library(tokens, library):
    encoder = bpe.Encoder(bpe.Vocabulary(tokens, PATTERN))
    texts = [text for _, text in nasty_texts()] + odd_texts()
    ids, ends = encoder.batch(texts)
    for text, found in zip(texts, np.split(ids, ends[:-1]), strict=True):
        assert found.tolist() == library.encode_ordinary(text or "")
        assert b"".join(tokens[i] for i in found) == (text or "").encode()


def test_a_long_pre_token_is_no_square(tokens, library):
    text = "".join(random.Random(1).choice("abcde") for _ in range(300_000))
    encoder = bpe.Encoder(bpe.Vocabulary(tokens, PATTERN))
    assert bytes(b for i in encoder.batch([text])[0] for b in tokens[i]) == text.encode()


def test_query_over_nasty_rows(spark, nasty, library):
    found = bpe.digests(nasty, PATH, PATTERN)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def expected(doc_id, text):
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        decoded = library.decode_bytes(ids)
        return doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()

    order = str
    assert sorted(map(tuple, found.collect()), key=order) == sorted((expected(*row) for row in nasty_texts()), key=order)


def test_columns_are_returned_whole(spark, nasty):
    shared = bpe.vocabulary(spark, PATH, PATTERN)
    back = bpe.decoded(bpe.encoded(nasty, shared), shared)
    assert back.select("row.*").columns == nasty.columns
    assert back.where(F.col("decoded") != F.coalesce("row.text", F.lit("")).cast("binary")).count() == 0


def test_empty_table(empty):
    assert bpe.digests(empty, PATH, PATTERN).count() == 0


def test_a_large_vocabulary_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="at most"):
        bpe.read_ranks(PATH)
    monkeypatch.undo()
    gap = tmp_path / "gap"
    gap.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="gap"):
        bpe.read_ranks(str(gap))
