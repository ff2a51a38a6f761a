import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row string, _hit int, text_key string"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes tables of documents, with columns whose names clash with what operators add."""

    def make(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = ["en"] * len(texts) if langs is None else langs
        rows = [(i, t, lang, "s", len(t or ""), "r", 7, "k") for i, t, lang in zip(ids, texts, langs)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


#: Nulls, nothing, white space, repeated rows and null ids.
ODD_TEXTS = [None, "", " \n\t", "a", "one two", "one two", "Ünïcödé ÅÉ 漢字 🙂 text", "a" * 30_000]
ODD_IDS = [0, 1, 2, 3, 4, 4, None, 7]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD_TEXTS, ODD_IDS, [None, "", "en", "en", "xx", "xx", "de", "en"])


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
