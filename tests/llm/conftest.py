import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names operators use for themselves
CLASH = "fp string, score string, key string, length int, bucket int, component_id int, _id int, shard int, fingerprint string"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with null and clashing columns."""

    def make(rows, partitions=3):
        names = [c.split()[0] for c in CLASH.split(",")]
        data = [(i, t, None if k % 2 else "en", None if k % 3 else "src", None, *["x" if "string" in c else 7 for c in CLASH.split(",")])
                for k, (i, t) in enumerate(rows)]
        assert len(names) + 5 == (len(data[0]) if data else len(names) + 5)
        return spark.createDataFrame(data, f"{DOCS}, {CLASH}").repartition(partitions)

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame([(i, q, 0, 1.0) for i, q in rows], "doc_id long, quality int, toxic int, score double")

    return make


#: ids and texts that every operator must take
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\r "), (4, "one"), (5, "one two"), (None, "a text without id"), (6, "same words here"),
       (6, "same words here"), (7, "Été ıİ \U0001f600 ​ x"), (8, "\\ % &# %zz \\u12"), (9, "word " * 60_000)]


@pytest.fixture
def odd():
    return list(ODD)
