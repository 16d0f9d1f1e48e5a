import random

import pytest


@pytest.fixture
def prose():
    """Texts of invented words, the same in every run."""
    dice = random.Random(5)
    syllables = "an er in on th st ou re ti ea ing ble".split()

    def make(words: int) -> str:
        return " ".join("".join(dice.choices(syllables, k=dice.randint(1, 4))) for _ in range(words))

    return make
