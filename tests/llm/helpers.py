"""Small documents with every odd case, and brute-force versions."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, k1 long, h long, n long, item long, shard int, rank int, carried string, _text string, _size long, _block long, marks string, nth int"


def documents(spark, rows):
    """rows: (doc_id, text, lang, source). The other columns are there to clash."""
    full = [(*r, len(r[1]) if r[1] is not None else None, 1, 2, 3, 4, 5, 6, 7, 8, "c", "t", 9, 10, "m", 11) for r in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(3)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):03d}"[: rng.choice([3, 4])] for _ in range(n))


def odd_rows(seed: int = 1) -> list[tuple]:
    """Nulls anywhere, empty and blank texts, ties, repeated rows and ids, a long text, code points of all sizes."""
    rng = random.Random(seed)
    passage, long = words(rng, 60), words(rng, 30_000)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "one", "en", "b"), (5, "One", "de", "b"), (6, "one two", None, "b"),
        (7, long, "en", "a"), (8, words(rng, 80) + " " + passage + " " + words(rng, 50), "en", "a"), (9, words(rng, 70) + " " + passage, "de", None),
        (10, "é ü ñ 漢字 😀 " + words(rng, 40), "fr", "c"), (11, words(rng, 300), "fr", "c"), (11, words(rng, 30), "fr", "c"), (None, words(rng, 40), "en", "a"), (None, None, None, None),
        (12, "x" * 3000, "en", "d"), (13, "ab " * 800, "en", "d"), (14, "%%% ### !!!", "en", "e"), (15, "  \x1c", "en", "e"), (16, "<|endoftext|> and text", "en", "e"),
    ]
    copy = words(rng, 90)
    rows += [(20 + i, copy, "en", "hot") for i in range(40)]
    rows += [(100, rows[10][1], "fr", "c")] + [rows[7]] * 2
    near = copy.split()
    for i in range(30):
        changed = list(near)
        changed[rng.randrange(len(changed))] = f"n{i}"
        rows.append((200 + i, " ".join(changed), "en", "hot"))
    return rows
