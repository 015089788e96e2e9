import random

import pytest

WORDS = "the of and to in that it was for with as his on be at by this had not are but from or have an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too mr how little good world".split()


def prose(rng: random.Random, n: int) -> str:
    """Invented words between common ones, in lines."""
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) if rng.random() < 0.4 else "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(4, 9))))
        if rng.random() < 0.08:
            out[-1] += rng.choice([".", ",", ".\n"])
    return " ".join(out)


@pytest.fixture(scope="session")
def documents(spark):
    """(DataFrame with clashing and extra columns, rows): near and exact copies, odd texts, a repeated row, a null id."""
    rng = random.Random(4)
    rows = []
    base = [prose(rng, rng.randint(30, 200)) for _ in range(12)]
    for i, text in enumerate(base):
        rows.append((i, text))
        words = text.split(" ")
        for k in range(rng.randint(0, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = "changed%d" % rng.randint(0, 5)
            rows.append((100 + 10 * i + k, " ".join(copy)))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "ONE\ttwo"), (305, "123 456"), (306, "é" * 5000), (307, prose(rng, 20_000)), (None, base[0]), (300, None), (308, base[1])]
    frame = spark.createDataFrame([(d, t, "en", "x", 1.5, "y") for d, t in rows], "doc_id long, text string, lang string, source string, score double, cls string")
    return frame.repartition(3), rows


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
