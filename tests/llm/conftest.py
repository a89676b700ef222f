import pytest
from helpers_llm import some_rows

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, shard string, token int, class int, "
          "bucket string, words array<int>, slot int, `__dk` string")


@pytest.fixture
def rows():
    return some_rows()


@pytest.fixture
def documents(small):
    """A frame of documents with further columns whose names the operators use themselves."""
    def build(rows, parts=3):
        full = [(doc_id, text, "en", source, len(text or ""), "s", "t", 1, 2, "b", [1], 3, "k") for doc_id, text, source in rows]
        return small.createDataFrame(full, SCHEMA).repartition(parts)

    return build
