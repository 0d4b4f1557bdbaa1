import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n int, key string"


@pytest.fixture(scope="session")
def ship(spark):
    from snapkeep.llm.frames import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def edge_docs():
    """Nulls, empty, short, long and repeated rows, near and exact copies."""
    rnd = random.Random(5)
    vocab = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(300)] + ["é", "Straße", "ñandú"]
    sentence = lambda n: " ".join(rnd.choices(vocab, k=n)) + "."
    base = [sentence(rnd.randint(20, 120)) for _ in range(25)]
    passage = sentence(60)
    docs = list(enumerate(base))
    docs += [(100 + i, t) for i, t in enumerate(base[:8])]                                   # exact copies
    for i, t in enumerate(base[:12]):                                                        # near copies
        w = t.split()
        w[rnd.randrange(len(w))] = "changed"
        docs.append((200 + i, " ".join(w).upper() if i % 3 else " ".join(w)))
    docs += [(300 + i, sentence(30) + "\n" + passage + "\n" + sentence(30)) for i in range(10)]
    docs += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "one two three"), (405, "one two three")]
    docs += [(406, "x" * 5000), (407, "ab " * 3000), (408, sentence(9000)), (None, base[0]), (None, None)]
    docs += [(409, base[1]), (409, base[1]), (410, base[2]), (410, sentence(40))]
    return docs


def frame(spark, docs):
    rows = [(d, t, "en" if i % 2 else None, "s", None if t is None else len(t), 0.5, i, "k") for i, (d, t) in enumerate(docs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)
