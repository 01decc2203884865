from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and data river stone light model house green field paper music winter table north".split()


def passage(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, blanks, nulls, repeated rows and a very long text."""
    shared = passage(1, 30)
    texts: list[str | None] = [passage(100 + i, 40) for i in range(12)]
    texts += [texts[0], texts[0] + "  ", texts[1].replace(" ", "\n", 3), texts[2].upper(), None, "", " \t\n", "...", "a", "a b"]
    texts += [f"{passage(200 + i, 9)} {shared} {passage(300 + i, 9)}" for i in range(5)]
    texts += [shared + " " + shared, passage(7, 6000), passage(7, 6000) + " tail"]
    base = passage(9, 120).split()
    for i in range(6):
        near = list(base)
        near[i * 7] = "changed"
        texts.append(" ".join(near))
    rows = [(i * 3 + 1, t, "en" if i % 4 else None, f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, texts[4], None, None, None), (None, None, None, None, None)]


def table(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA).repartition(3)


def plain(rows, key=lambda r: r) -> list:
    return sorted((tuple(r) for r in rows), key=repr)
