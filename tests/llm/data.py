"""Small documents with everything that goes wrong: nulls, blanks, long texts, copies, repeated ids."""

import random

CLASHING = "score double, n long, cls long, row string, component string, y int, a int, b int, item int, bucket int, rank int, v int"
SCHEMA = f"doc_id long, text string, {CLASHING}"


def words(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def hard_documents() -> list[tuple[int | None, str | None]]:
    base = words(400, 1).split()
    near = base[:200] + ["changed"] + base[201:]
    return [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two three"), (5, "one two three"), (6, "ONE two\tthree"),
        (7, " ".join(base)), (8, " ".join(base)), (9, " ".join(near)), (10, words(30_000, 2)), (11, words(30_000, 2) + " end"),
        (None, words(50, 3)), (12, words(50, 3)), (13, "same same same same same same same"), (14, "same same same same same"),
        (15, words(30, 4)), (16, words(30, 4).upper()), (17, "x" * 100_000), (7, words(60, 5)), (18, words(60, 5)),
    ]


def frame(spark, rows):
    full = [(*r, *[None] * (len(CLASHING.split(",")))) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
