"""Rows that the tests of the training-data operators share."""

import random


def vocabulary(rng, n=400):
    return ["".join(rng.choice(["ba", "co", "dé", "fi", "Gu", "ja", "ñe", "x1"]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def some_rows():
    """Nulls, empty and long texts, copies, near copies, repeated rows and shared passages, as (doc_id, text, source)."""
    rng = random.Random(5)
    known = vocabulary(rng)

    def prose(n):
        return " ".join(rng.choice(known) + ("\n" if rng.random() < 0.08 else "") for _ in range(n))

    first, passage = prose(200), prose(30)
    near = first.split(" ")
    near[100] = "changed"
    rows = [(1, first, "a"), (2, first, "b"), (3, None, "a"), (4, "", None), (5, " \n\t ", "a"), (None, prose(40), None),
            (1, first, "a"), (7, " ".join(near), "a"), (8, prose(3), "b"), (9, prose(3000), "a"), (10, prose(60) + " " + passage, "b"),
            (11, passage + "\n" + prose(50), "c"), (12, "same line here\n" * 12, "c"), (None, None, "c"), (13, "x" * 5000, "b"),
            (14, prose(1), "a"), (15, prose(12), "é"), (16, passage, "c")]
    rows += [(100 + i, prose(25) + "\nOne line that all have to the letter of it\n" + prose(25), "h") for i in range(12)]
    return rows


def bag(frame, *columns):
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=repr)
