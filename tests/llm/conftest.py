import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(*texts, lang="en", source="src0", start=0):
    return [(start + i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture()
def docs_of(spark):
    """A documents table of the given texts (ids from 0) or of whole rows."""
    def make(*texts, **kw):
        data = [t if isinstance(t, tuple) else r for t, r in zip(texts, rows(*texts, **kw), strict=True)]
        return spark.createDataFrame(data, DOC_SCHEMA)
    return make
