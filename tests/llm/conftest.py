import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # Names that operators use inside.
    *[T.StructField(n, T.StringType()) for n in ("rec", "text_key", "bucket", "key", "class", "n", "list", "shard", "slot", "kept", "base", "rule")],
])
CLASHES = [f.name for f in SCHEMA.fields[3:]]


def make_texts(seed: int = 5):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, line = prose(120), "Shared Line of text"
    texts = [None, "", " \t\n", "one", "One two three", "line\nline\n\nline", "x" * 1500, "é😀 ü\nß 漢字 text " * 30]
    base = prose(150)
    texts += [base, base, base.upper(), base + " more", base.replace(words[3], "changed", 1), base.swapcase()]
    texts += [prose(80) + passage + prose(60) for _ in range(6)]
    texts += [f"{prose(10)}\n {line} \n{prose(12)}" for _ in range(12)]
    texts += [prose(rnd.randint(1, 260)) for _ in range(40)]
    texts += ["mail a.b@c.example.org and 10.20.30.40, 300.1.1.1 then 4111 1111 1111 1111 or 4111 1111 1111 1112 call +1 (555) 123-4567 now +12 3"]
    texts += ["1 " * 3000, "7" * 5000, "a@" * 500 + "b.c", "long " * 20_000, "▁ odd ▁▁"]
    return texts


@pytest.fixture(scope="session")
def rows():
    texts = make_texts()
    out = [(n, t) for n, t in enumerate(texts)]
    out += [(8, texts[8]), (8, texts[8]), (None, "no id here at all"), (None, None), (9, "same id, other text, and some more words")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", *CLASHES) for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    return spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0)) for i, _ in rows if i is not None][:50] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")

