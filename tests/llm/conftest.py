import pytest

from addrloom.llm.rows import find_library

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string, data string, "
    "fp long, digest string, key string, pieces string, own_id long, bytes string, spans string, record struct<text:string>, `odd name.x` string"
)


@pytest.fixture(autouse=True)
def library(spark):
    find_library(spark)


def document(doc_id, text):
    """A row whose other columns have names that the operators use inside, or nulls."""
    odd = isinstance(doc_id, int) and doc_id % 2
    return (
        doc_id, text, "en" if odd else None, "s" if odd else None, len(text) if text is not None else None,
        *((True, "r", "d", 1, "x", "k", "p", 5, "b", "s", ("inner",), "o") if odd else (None,) * 12),
    )


@pytest.fixture(scope="session")
def table(spark):
    def make(rows):
        return spark.createDataFrame([document(*r) for r in rows], SCHEMA)

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    import random

    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 50)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and odd characters."""
    shared = prose("shared", 60)
    long = prose("long", 30_000)
    texts = [
        "", None, " ", "\n", "one", "one two three", "ONE two  three", shared, shared, shared + " end", shared + " End",
        prose(1, 80) + "\n" + shared, prose(2, 80) + "\nCommon line\n" + shared, long, long + " x", "a" * 3000, "spam " * 400,
        "é ñ 中文 😀 ’s ''s 12³ <|endoftext|>  \t x", "\x1c\x85 z \r\n y", "password = 'Zx81kQpw77Lm'\nCommon line \n" + prose(3, 60),
        "### " * 80, "same line here\n" * 20 + prose(4, 60),
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, f" COMMON line\t\n{prose(50 + i, 55)}\n\ncommon LINE") for i in range(9)]
    rows += [(None, None), (None, shared), (None, "lonely text of no id"), (3, "\n"), (7, shared), (7, "other text, same id"), (7, shared)]
    return rows
