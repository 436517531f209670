import pytest

from tests.conftest import spark  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, kept string, keep string, spans string, base string, mark string, comp int, h1 int, part int, line int"


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    """Documents with columns whose names the operators use themselves."""

    def make(rows, source="s"):
        full = [(i, t, "en", (s[0] if s else source), len(t or "")) + ("x", 1, "x", "x", "x", "x", "x", 1, 1, 1, 1) for i, t, *s in rows]
        return spark.createDataFrame(full, DOCS)

    return make
