"""Small documents with every awkward case."""

from __future__ import annotations

import random

#: Names that the operators use inside, as further columns of the input.
CLASHES = ("row", "id", "fp", "version", "lines", "hits", "label", "bytes", "order", "sequence_id", "offset", "perplexity")


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(("oak", "elm", "Fir", "ash", "yew", "pine", "Lime", "larch")) + str(rng.randrange(60)) for _ in range(words))


def awkward_texts() -> list[tuple[int | None, str | None]]:
    """Ids may be missing or come twice; texts may be missing, empty, very long, equal or nearly so."""
    rng = random.Random(4)
    shared = sentence(rng, 30)
    rows: list[tuple[int | None, str | None]] = [
        (1, f"{shared}\nFirst own line here\n\n"),
        (2, None),
        (3, ""),
        (4, " \t\n \x0b"),
        (5, f"Überschrift ÄÖ é\n  {shared.upper()}  \nsecond own line"),
        (6, "x" * 150_000),
        (7, sentence(rng, 20_000)),
        (8, "\n".join(["the same line again"] * 500)),
        (9, "the same line again\nother"),
        (10, f"{shared}\nFirst own line here\n\n"),
        (10, f"{shared}\nFirst own line here\n\n"),
        (11, "one of two texts of an id, with enough words to matter"),
        (11, "another of two texts of an id, with enough words to matter"),
        (None, shared),
        (None, None),
        (12, "😀 emoji 😀 and 日本語 text without blanks 日本語"),
        (13, "!!! ??? ..."),
        (14, f"prefix {shared[:120]} suffix"),
    ]
    return rows + [(100 + k, sentence(rng, rng.randrange(1, 60))) for k in range(30)]
