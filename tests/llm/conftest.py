import random

import pytest

ODD = [
    "a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​", "é", "é", "'s", "'LL", "1", "²", "½", "中",
    "😀", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "\x00", "İ", "ß", "Σ", "ΑΣ", "﻿", "\x0b", "\x1f", "the", "ing", "!!",
]


@pytest.fixture(scope="session")
def odd_texts():
    """Texts of awkward characters, with NULL, empty, long and repeated ones."""
    chance = random.Random(1)
    texts = ["".join(chance.choice(ODD) for _ in range(chance.randint(0, 30))) for _ in range(300)]
    return [*texts, None, "", " ", "x" * 9001, "ab " * 4000, "same words", "same words"]
