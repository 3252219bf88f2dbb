"""Documents that the tests of the text operators share."""

from __future__ import annotations

import random

def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words)]
    lines, line = [], []
    for word in made:
        line.append(word)
        if len(line) > rng.randint(8, 30):
            lines.append(" ".join(line).capitalize() + ".")
            line = []
    return "\n".join([*lines, " ".join(line)])


#: Null, empty and blank texts, repeated rows, one document twice, long texts.
ODD = [
    (1, None), (2, ""), (3, "   "), (4, "\n\n"), (5, "one"), (5, "one"), (6, "one"),
    (7, prose(7, 4_000)), (8, prose(8, 60)), (8, prose(8, 60)), (9, prose(8, 60)),
    (10, "x" * 30_000), (11, "tab\tand  two  spaces \n at the end "), (12, "日本語 ñandú Straße 😀"),
    (None, "no id"), (None, None), (13, "a <|endoftext|> b"),
]
