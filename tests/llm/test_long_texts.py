"""Texts far beyond a block: the same results, and memory that a text's length does not multiply."""

import io
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest

from chronovox.llm import alignment, language_id, quality, token_count

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def peak(function) -> float:
    """MB that a call takes at most."""
    tracemalloc.start()
    function()
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def odd_texts(seed=3):
    rng = random.Random(seed)
    words = ["the", "a\n", "b#", "Long" * 40, "é" * 9, "x y z", "\n\n", "same words come again and again here now", "|$", "\t", "ÿ漢字" * 30, "q" * 700]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))).encode() for _ in range(25)] + [b"", b" ", b"w" * 3000, b" " + b"w" * 3000 + b" tail"]


@pytest.mark.parametrize("block", [16, 64, 300])
def test_quality_in_small_blocks_is_that_of_whole_texts(monkeypatch, block):
    texts = odd_texts()
    numbers = quality.measured(texts)
    sums = lambda: sum(np.bincount(b + quality.BUCKETS * t, minlength=len(texts) * quality.BUCKETS) for b, t in quality.ngrams(texts))
    grams = sums()
    monkeypatch.setattr(quality, "BLOCK", block)
    small = quality.measured(texts)
    assert all((numbers[k] == small[k]).all() for k in quality.METRICS)
    assert (sums() == grams).all()
    for text in texts:
        assert b"".join(p for _, p in quality.pieces_of([text])) == text


def test_quality_of_a_long_text_holds_little():
    text = ("some words that go on and on, " * 300_000).encode()
    model = quality.Model(np.zeros(quality.BUCKETS), 0.0)
    assert peak(lambda: model.judged([text])) < 350  # of nine million characters, where every window is a repeated one
    run = b"x" * 8_000_000
    assert peak(lambda: model.judged([run])) < 100


def test_a_word_of_any_length_in_the_token_count():
    vocabulary, byte_pieces = token_count.pieces_of(PIECES)
    model = token_count.Unigram(vocabulary, byte_pieces, runs=True)
    rng = random.Random(1)
    word = "".join(rng.choice("abcdeéß漢tionthe") for _ in range(400_000))
    assert peak(lambda: model.count(word)) < 20
    # the tables reach back over the longest piece only, and that is enough
    whole = token_count.Unigram(vocabulary, byte_pieces, runs=True)
    whole.longest = 5000
    some = word[:4000]
    assert model.count(some) == whole.count(some)


def test_alignment_and_language_of_long_texts():
    pair = alignment.loaded(public_tokenizers.path("byte_bpe_50k.json"), PIECES)
    text = "long words and more " * 200_000
    assert peak(lambda: alignment.groups(pair, *pair.encode(text))) < 150
    of, byte, to = language_id.automaton(b" the words that go on")
    blob = io.BytesIO()
    np.savez_compressed(blob, of=of, byte=byte, to=to)
    parser = language_id.Parser([("en", 21, blob.getvalue())])
    assert peak(lambda: parser.judge([text * 2])) < 250
