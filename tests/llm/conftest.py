import random

import pytest

WORDS = "the of and to in that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know get through back much before go good new write our used me man too any day same right look think also around another came come work three word must because does part even place well such here take why things help put years different away again off went old number".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        w = "".join(rng.choice(("ta", "re", "mi", "lo", "su", "ne", "vo", "ka")) for _ in range(rng.randint(1, 4))) if rng.random() < 0.6 else rng.choice(WORDS)
        out.append(w + ("." if rng.random() < 0.1 else "") + ("\n" if rng.random() < 0.03 else ""))
    return " ".join(out)


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def make(rng):
    return lambda n: prose(rng, n)


@pytest.fixture
def documents(spark):
    def build(rows, extra=False):
        """(doc_id, text) rows as a documents table; ``extra``: with columns whose names clash with results."""
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        if extra:
            schema += ", fp long, kept boolean, start string, value int, path string, root string, words int, score double, labels string"
            full = [(*r, 1, True, "x", 2, "p", "r", 3, 0.5, "l") for r in full]
        return spark.createDataFrame(full, schema)

    return build
