import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm.tokens import default_vocabulary

SF = "/root/testdata/sf0.001"


def make_rows():
    """Documents with every awkward case; ids are unique but for the cases that say so."""
    rng = random.Random(5)
    vocabulary = ["the", "of", "Kiesel", "naïve", "été", "stone,", "X1", "tree", "ein", "word"] + [
        "".join(rng.choice("abcdefghijk") for _ in range(6)) for _ in range(400)
    ]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = prose(70), prose(150).split()
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "a b c"), (5, "A b C"), (6, "😀 \x1c　 é")]
    rows += [(10 + i, prose(60)) for i in range(10)]
    rows += [(30 + i, f"{prose(8)} {passage} {prose(8)}") for i in range(12)]  # a shared passage
    for i in range(25):  # near copies
        words = list(base)
        words[rng.randrange(150)] = f"w{i}"
        rows.append((50 + i, " ".join(words)))
    rows += [(90 + i, "all the same " * 9) for i in range(20)]  # copies of a repeating text
    rows.append((120, " ".join(prose(50) for _ in range(400)) + " " + passage))  # very long
    rows.append((121, "aa " * 5000))
    rows.append((122, "0123456789abcdef" * 2000))
    return rows, prose, passage


@pytest.fixture(scope="session")
def rows():
    return make_rows()[0]


@pytest.fixture(scope="session")
def passage():
    return make_rows()[2]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def clashing(spark, rows):
    """Columns that a careless operator would trip over, one with a dot."""
    names = ["n_words", "kept", "shard", "slot", "hash", "rid", "a", "b", "node", "size", "length",
             "spans", "mask", "first", "label", "block", "x.y"]
    wide = [(*r, *[7] * len(names)) for r in rows[:60]]
    columns = ", ".join(f"`{n}` int" for n in names)
    return spark.createDataFrame(wide, f"doc_id long, text string, {columns}")


@pytest.fixture(scope="session")
def ids_of():
    tokenizer = Tokenizer.from_file(default_vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
