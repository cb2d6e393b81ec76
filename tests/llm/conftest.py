import random

import pytest

CLASHING = "id long, component_id string, n_shingles int, kept string, score string, n_words string, mix_size int, size string, label2 int"


def sentence(rng, words=60):
    parts = ["th", "in", "er", "an", "ou", "re", "st", "é", "ß", "ti", "on"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Ids, texts, languages and sources: ordinary ones, near and exact copies, and every odd case."""
    rng = random.Random(5)
    rows = [(i, sentence(rng, rng.randint(20, 120)), ["en", "fr"][i % 2], f"s{i % 3}") for i in range(60)]
    base = rows[7][1].split()
    for i in range(60, 75):
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"edit{i}"
        rows.append((i, " ".join(copy), "en", "s0"))
    rows += [(i, rows[3][1].upper(), None, "s1") for i in range(75, 80)]
    rows += [
        (80, None, "en", None), (81, "", "fr", "s0"), (82, " \n\t ", "en", "s1"), (83, "one two", None, "s2"), (84, "One\ttwo", "en", "s2"),
        (85, " ".join(sentence(rng, 200) for _ in range(100)), "fr", "s1"), (86, "x" * 50_000, "en", "s2"), (87, "12 34 #%| 56", "en", None),
        (88, "a b  c\n\nd <|endoftext|> e 日本語 🙂", "en", "s0"), (None, "a text without an id and nothing else to say", "en", "s0"),
        (3, rows[3][1], "fr", "s0"), (3, rows[3][1], "fr", "s0"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names the operators use themselves."""
    full = [(*r, len(r[1] or ""), 1, "x", 2, "no", "high", "many", 3, "big", 4) for r in texts]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
