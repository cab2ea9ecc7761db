"""Texts for the tests."""


def text_of(rng, n, words=None):
    """n random words; with a large vocabulary by default, so that nothing recurs by chance."""
    if words:
        return " ".join(rng.choice(words) for _ in range(n))
    return " ".join(f"w{rng.randrange(10**7)}" for _ in range(n))


#: Texts that every operator must take.
ODD = [
    (None, "a row without an id"),
    (100, None),
    (101, ""),
    (102, " \t\n "),
    (103, "one"),
    (104, "repeated row"),
    (104, "repeated row"),
    (105, "x" * 200_000),
    (106, "word " * 40_000),
    (107, "mit Ümläuten, 漢字 and 😀 " * 3),
]
