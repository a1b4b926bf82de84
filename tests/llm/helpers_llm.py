"""Made-up texts."""

WORDS = "ka lo mi ne su ta ri vo pe du fa go hi ju ze".split()


def text_of(rng, n: int) -> str:
    """So many made-up words of two to four syllables."""
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(2, 4))) for _ in range(n))
