import pytest

#: Names that the operators give to columns of their own.
CLASHING = ("uid", "_id", "_uid", "copy", "n", "row", "kept", "once", "size", "kind", "picked_id", "n_copies", "label", "score", "sig", "token")


@pytest.fixture()
def docs_of(spark):
    """A documents-like table of (doc_id, text) pairs, with further columns whose names clash with those of operators."""

    def make(rows, source=None):
        full = [(i, t, "en", (source or {}).get(i, "src0"), len(t or ""), *(f"{name} {i}" for name in CLASHING)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in CLASHING)).repartition(3)

    return make
