import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and house river stone winter light morning people water under great story".split(),
    "fr": "le de et maison rivière pierre hiver lumière matin peuple eau sous grande histoire".split(),
}


def sentence(rng: random.Random, lang: str, size: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ",", "."]) for _ in range(size))


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with copies, near copies, odd texts, nulls in every column and clashing extra columns."""
    rng = random.Random(5)
    rows = []
    for number in range(120):
        lang = "en" if number % 3 else "fr"
        rows.append([number, sentence(rng, lang, rng.randint(6, 120)), lang, f"src{number % 4}", None])
    base = [f"word{i}" for i in range(100)]
    for number in range(120, 130):  # near copies with one word changed, in place of another each
        rows.append([number, " ".join([*base[: number - 100], "changed", *base[number - 99 :]]), "en", "hot", None])
    rows += [[130, " ".join(base), "en", "hot", None], [131, " ".join(base), "en", "hot", None]]
    rows += [[132, None, None, None, None], [133, "", "en", None, 0], [134, "   \n\t ", None, "src1", 6]]
    rows += [[135, "12 34 !!", "fr", "src2", 8], [136, "x", "en", "src0", 1], [137, "long " * 30_000, "en", "src0", None]]
    rows += [[138, "一 二 🙂 ▁ a▁b  c\n\n\n d <|endoftext|> é", "en", "src0", None], [None, "no key here", "en", "src0", 11]]
    rows += [rows[3], rows[130]]
    rows = [[a, b, c, d, len(b) if e is None and b is not None and a != 5 else e] for a, b, c, d, e in rows]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "1 AS key", "0.5 AS score", "2 AS class").repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
