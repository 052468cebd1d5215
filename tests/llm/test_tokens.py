"""Pieces against the tokenizer's own ids of whole texts."""

import random
import unicodedata

import pytest

from ledgerflow.llm import tokens

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
CATEGORIES = {}
for code in range(0x110000):
    kind = unicodedata.category(chr(code))
    if kind != "Cs":
        CATEGORIES.setdefault(kind, []).append(chr(code))


def random_text(rng):
    """Signs, letters whose lower-casing is odd, blanks, and characters of every category."""
    def char():
        at = rng.random()
        if at < 0.3:
            return rng.choice(".,;:!?#$%&*|'\"-()")
        if at < 0.5:
            return rng.choice("abzAZ019İıßſǅΣΐŉﬁ")
        if at < 0.65:
            return rng.choice(" \n ")
        return rng.choice(CATEGORIES[rng.choice(list(CATEGORIES))])

    return "".join(char() for _ in range(rng.randint(1, 14)))


@pytest.mark.parametrize("name", FILES)
def test_random_texts_of_every_category(name):
    import public_tokenizers

    encoder, rng = tokens.Encoder(public_tokenizers.path(name)), random.Random(5)
    texts = [random_text(rng) for _ in range(6000)]
    texts += ["a İ!", "Sayın İ. Melih", "a <|endoftext|> b", "<|", "x<|y|>", " ", "  a  b", ""]
    assert encoder.encode(texts) == encoder.whole(texts)


@pytest.mark.parametrize("name", FILES)
def test_very_long_texts_are_taken_whole(name, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokens, "SLICE_CHARS", 1000)
    encoder, rng = tokens.Encoder(public_tokenizers.path(name)), random.Random(6)
    word = lambda: "".join(rng.choice("abcdeéİ.,") for _ in range(rng.randint(1, 90)))
    texts = ["short one", " ".join(word() for _ in range(3000)), None, "x" * 5000, " ".join(word() for _ in range(20))]
    assert encoder.encode(texts) == encoder.whole([t or "" for t in texts])


@pytest.mark.parametrize("name", FILES)
def test_plain_texts_are_cut_into_words_that_are_encoded_many_at_a_time(name):
    import public_tokenizers

    encoder, rng = tokens.Encoder(public_tokenizers.path(name)), random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéÀßÿXYZ") for _ in range(rng.randint(1, 9)))
    texts = [" ".join(word() + rng.choice(["", ",", ".", ".\n" + word()]) for _ in range(50)) for _ in range(200)]
    odd = ["".join(rng.choice("abcd  .,Eé\nÀß'sĲ|-0²\x01\x7f\xa0\xad ") for _ in range(rng.randint(0, 20))) for _ in range(20000)]
    right, apart = encoder.whole(texts), []
    whole = encoder.whole
    encoder.whole = lambda some: apart.extend(some) or whole(some)
    assert all(map(tokens.is_plain, texts)) and encoder.encode(texts) == right
    assert all(len(piece.strip()) < 2 or piece[0].isalpha() for piece in apart) and len(apart) < 3000  # of 12,500
    encoder.whole = whole
    assert encoder.encode(odd) == encoder.whole(odd) and 2000 < sum(map(tokens.is_plain, odd)) < 18000


def test_a_tokenizer_of_another_kind_takes_no_lines(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    other = Tokenizer(models.WordLevel({"a": 0, "b": 1, "?": 2}, unk_token="?"))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    other.save(str(tmp_path / "other.json"))
    encoder = tokens.Encoder(str(tmp_path / "other.json"))
    # here a word's signs belong to it
    assert encoder.line is None and not encoder.cuts
