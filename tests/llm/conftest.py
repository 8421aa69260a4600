import random

import pytest

from tidemark.llm.common import importable

WORDS = ["the", "of", "ein", "übung", "and", "x", "foo.", "Bar\n", "long-word-here", " y"]
#: Names that operators use inside; a table may have such columns, too.
CLASHES = ["digest", "text_key", "bucket", "chunk", "label", "component", "kept", "_id", "score", "key", "answers", "payload"]


@pytest.fixture
def frame(spark):
    """Rows as a table of several partitions with columns whose names clash."""
    importable(spark)

    def make(rows, ddl):
        return spark.createDataFrame(rows, ddl).repartition(3).selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHES if f" {c} " not in ddl and f"{c} " not in ddl))

    return make


@pytest.fixture
def prose():
    """Texts of n words, the same in every run."""
    source = random.Random(5)

    def make(n):
        return " ".join(source.choice(WORDS) + str(source.randint(0, 9)) for _ in range(n))

    return make


@pytest.fixture
def corpus(prose):
    """Ids and texts: exact and edited copies, shared passages, nulls, empty, long, repeated rows, texts without words."""
    source = random.Random(6)
    base, line, edge = prose(300), prose(60), " ".join(prose(60).split()[:50])
    rows = [(i, prose(source.randint(0, 90))) for i in range(50)]
    rows += [(100 + i, base) for i in range(6)]
    for i in range(25):
        words = base.split(" ")
        words[source.randrange(len(words))] = f"EDIT{i}"
        rows.append((200 + i, " ".join(words)))
    for i in range(25):
        rows.append((300 + i, f"{prose(source.randint(0, 30))} {line} {prose(20)}"))
        rows.append((340 + i, f"{prose(source.randint(0, 30))} {edge} {prose(20)}"))
    rows += [(None, base + line), (None, None), (None, prose(40)), (5, None), (6, ""), (7, "a " * 700), (8, "ab" * 900), (9, " \n\t ")]
    rows += [(400, f"{line} {line}"), (400, f"{line} {line}"), (100, base), (401, base[50:1400] + line[:150] + base[:300])]
    rows += [(402, prose(9_000)), (403, base.upper())]
    source.shuffle(rows)
    return rows
