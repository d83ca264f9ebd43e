"""Ids through the word cache equal the tokenizer's own on whole texts."""

import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakewarden.llm import tokens

pytest.importorskip("public_tokenizers")
PATH = tokens.word_vocabulary()
HARD = ["", " ", "\n", "a", "it's we'd  they'll", "x\x01y \x01 z", "<|endoftext|> a<|endoftext|>b", "é ́x\ń", "A\tB\x0bC\x1cD E　F",
        "1234 a1b2c3!!", "ΑΣ ΟΔΟΣ\nİI", "日本語 テスト", "OF!! THE!! " * 50, "힣가 ᆨ", "a" * 3000, " \r\n\n  "]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(PATH)


def direct(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", HARD)
def test_equals_whole_text(encoder, text):
    assert encoder.encode(text).tolist() == direct(encoder, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab's.\n \t\x01é́Ω1!<|>")), max_size=40))
def test_any_text(text):
    mine = tokens.encoder(PATH)
    assert mine.encode(text).tolist() == direct(mine, text)


def test_null_and_slices(encoder, monkeypatch):
    assert encoder.encode(None).tolist() == []
    monkeypatch.setattr(tokens, "SLICE_CHARS", 10)
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    text = "the quick brown fox\njumps over the lazy dog " * 9 + "x" * 50
    assert encoder.encode(text).tolist() == direct(encoder, text)


def test_cache_keeps_words_met_again(monkeypatch):
    """Words met once go when the cache is full, frequent ones stay and are not encoded anew; ids stay right."""
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHED_WORDS", 40)
    mine = tokens.Encoder(PATH)
    encoded = []
    plain = mine._encoded
    monkeypatch.setattr(mine, "_encoded", lambda words: encoded.extend(words) or plain(words))
    texts = ["the quick, brown fox " + " ".join(f"w{k}x{j}." for j in range(7)) for k in range(60)]
    for k, text in enumerate(texts):
        assert [list(x) for x in (mine.encode_column(pa.array([text])) if k % 2 else mine.encode_many([text]))] == [direct(mine, text)]
    assert len(mine.index) <= 40 + 20
    assert all(encoded.count(w) == 1 for w in ("the", "quick", "brown", "fox"))


def test_cache_is_bounded_by_characters(monkeypatch):
    """Texts without blanks are words too: few, but as long as the texts."""
    monkeypatch.setattr(tokens, "CACHED_CHARS", 5_000, raising=False)
    mine = tokens.Encoder(PATH)
    for k in range(40):
        text = f"{k}q" * 300
        assert mine.encode(text).tolist() == direct(mine, text)
    assert sum(map(len, mine.index)) <= 6_500


def test_many_words_are_encoded_some_at_a_time(monkeypatch):
    """No call of the tokenizer gets all words of a text: its results are many times as large as the ids."""
    mine = tokens.Encoder(PATH)
    seen = []
    real = mine.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **kind):
            seen.append(sum(map(len, texts)))
            return real.encode_batch_fast(texts, **kind)

    text = " ".join(f"ab{k}c" for k in range(30_000))
    want = direct(mine, text)
    mine.tokenizer = Counted()
    assert mine.encode(text).tolist() == want
    assert max(seen) < len(text) / 2


def test_vocabulary_is_not_in_the_repository():
    assert not PATH.startswith(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_vocabularies_that_keep_case_or_blanks():
    """What may be taken apart is found by trying: others get whole texts."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer, models, pre_tokenizers

    texts = ["The cat, the CAT; a dog.", "", "It's 12 o'clock...\nAb\tcd  ef", "<|x|> Yes!", "é?!"]
    cased = Tokenizer(models.WordLevel({"the": 0, "The": 1, "cat": 2, "CAT": 3, "?": 4}, "?"))
    cased.pre_tokenizer = pre_tokenizers.Whitespace()
    for tokenizer, path in ((cased, None), (None, public_tokenizers.path("byte_bpe_50k.json")), (None, PATH)):
        if tokenizer is not None:
            with tempfile.NamedTemporaryFile("w", suffix=".json") as f:
                f.write(tokenizer.to_str())
                f.flush()
                encoder = tokens.Encoder(f.name)
        else:
            encoder = tokens.Encoder(path)
        whole = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        for _ in range(2):  # learned, then looked up
            assert [list(x) for x in encoder.encode_many(texts)] == whole
            assert [list(x) for x in encoder.encode_column(pa.array(texts))] == whole
            assert [list(x) for t in texts for x in encoder.encode_column(pa.array([t, None]))][::2] == whole
