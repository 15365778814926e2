import random

import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "row long, fp long, key string, block int, gone_id long, good int, size long, k1 long, doc string, kept int"


def prose(seed: int, n: int) -> str:
    words = [f"{a}{b}{c}" for a in ("ba", "ke", "mo", "tri") for b in ("la", "no", "si") for c in ("n", "st", "r", "")]
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def copies(text: str, every: int) -> str:
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def edge_rows() -> list[tuple]:
    rows = [(i, prose(i % 17, 40 + i % 30), ("en", "fr")[i % 2], f"s{i % 3}") for i in range(60)]
    rows += [
        (100, None, "en", "s0"),
        (101, "", None, None),
        (102, " \t\n ", "en", "s1"),
        (103, "one", "en", "s1"),
        (104, prose(5, 60_000), "fr", "s2"),
        (105, copies(prose(1, 200), 90), "en", "s0"),
        (106, prose(1, 200), "en", "s0"),
        (107, "Ünï «ç» 漢字 🙂 ​x <|endoftext|> it's A-B\\n", "de", "ß"),
        (106, prose(1, 200), "en", "s0"),
        (106, prose(1, 200), "en", "s0"),
        (None, prose(3, 50), None, "s1"),
        (-5, prose(3, 50), "en", "s1"),
    ]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    extra = [(*r, 7, 7, "x", 1, 3, 0, 9, 4, "y", 2) for r in edge_rows()]
    return spark.createDataFrame(extra, f"{FIELDS}, {CLASHING}").repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], FIELDS)
