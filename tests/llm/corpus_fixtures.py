import random

import pytest

COLUMNS = "doc_id long, text string, source string, kept string, shard int, n_words string, chunk int, start int"


def sentence(draw: random.Random, words: int) -> str:
    return " ".join("".join(draw.choice("abcdeéßñ漢") for _ in range(draw.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Texts by identifier: null, empty, blank and long ones, copies, near copies, shared passages."""
    draw = random.Random(5)
    base, passage, other = sentence(draw, 120), sentence(draw, 60), sentence(draw, 400)
    words = base.split()
    rows = [
        (1, base), (2, base), (3, " ".join([*words[:50], "changed", *words[51:]])), (4, base.upper()), (5, None), (6, ""),
        (7, " \n\t "), (8, "one two three"), (9, "one two three"), (10, f"{sentence(draw, 30)} {passage} {sentence(draw, 20)}"),
        (11, f"{sentence(draw, 10)}\n{passage}\n{sentence(draw, 40)}"), (12, f"{passage} x {passage}"), (13, other),
        (14, sentence(draw, 3000)), (15, "a" * 5000), (16, "the line\n" * 40), (17, "<|endoftext|> it's 12 ▁ <s> \x1c\x85 Ⅳ"),
        (None, sentence(draw, 50)), (18, " ".join(words[20:100])), (19, "ab " * 300),
        (20, " ".join([*words[:10], "new", *words[11:]])), (1, base),
    ]
    return rows


@pytest.fixture
def documents(spark, texts):
    """The texts with further columns whose names operators use too."""
    rows = [(i, t, "s", "k", n, "w", n, n) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
