import pytest

from conftest import SF001  # noqa: F401

WORDS = "ab cd ef gh ij kl mn op qr st uv wx yz one two three four five six seven eight nine ten".split()


def prose(seed: int, n: int) -> str:
    """Invented text without repeats of three words."""
    out, x = [], seed * 7919 + 1
    for k in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"{WORDS[x % len(WORDS)]}{k}{WORDS[(x >> 8) % len(WORDS)]}")
    return " ".join(out)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, schema) -> DataFrame in a few partitions."""
    def make(rows, schema=DOCS):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


def doc(i, text, lang="en", source="src0"):
    return (i, text, lang, source, len(text) if text is not None else None)
