"""Invented texts."""

import random


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))
