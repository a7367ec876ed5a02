"""Tables with everything that an operator must stand: nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""

import random

import pytest

ODD = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, digest string, bands string, label string, part string, words int, lines string, h string, group_size long, score double, rows long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng, n, sep=" "):
    return sep.join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    long_ = "\n".join(prose(rng, 25) for _ in range(1500))
    texts = [None, "", " \t\n", "word", "TWO Words", base, base, base.upper(), base.replace("alpha", "other", 1), base + " end", long_, long_, "x" * 300_000, "ä" * 1000 + " ß  \x00é", "\n" * 50, "A\r\nB\r\nA", base + "\n" + base, "😀 " * 200]
    rows = [(i, t, (None, "aa", "bb")[i % 3], (None, "s1")[i % 2], i) for i, t in enumerate(texts)]
    rows += [(None, base, "aa", "s1", 1), (None, None, None, None, None), rows[5], (5, "another text under one id", "bb", None, 3), (-7, base, "aa", "s1", 0)]
    return [(*r, 9, "k", "d", "b", "l", "p", 1, "x", "h", 1, 0.5, 2) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "odd")
    spark.createDataFrame(odd_rows(), ODD).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "none")
    spark.createDataFrame([], ODD).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
