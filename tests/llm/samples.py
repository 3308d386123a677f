"""Texts that operators must stand: nulls, blanks, long ones, copies and odd characters."""

import random


def words(n, seed, kinds=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(kinds)}" for _ in range(n))


def edited(text, every, seed):
    r = random.Random(seed)
    return " ".join(f"e{r.randrange(9999)}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


BASE = words(200, 1)
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "One"),
    (5, "one"),
    (6, "one two  three\n\nfour"),
    (7, BASE),
    (8, BASE.upper()),
    (9, edited(BASE, 60, 2)),
    (10, edited(BASE, 60, 3)),
    (11, edited(BASE, 12, 4)),
    (12, words(30_000, 5)),
    (13, "a b a b a b a b a b a b a b"),
    (14, "Ünïcode\x0bwörds … <|endoftext|> 日本 don't  it's"),
    (15, words(60, 6) + "\n" + words(60, 7) + "\n" + words(60, 6)),
    (15, words(60, 6) + "\n" + words(60, 7) + "\n" + words(60, 6)),
    (None, "no id " + words(20, 8)),
    (None, "no id " + words(20, 8)),
    (20, "no id " + words(20, 8)),
]
