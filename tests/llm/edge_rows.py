"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
BASE = " ".join(f"alpha{i} beta{i}" for i in range(60))

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, digest string, fp string, "
    "hit string, ids string, start string, winner string, group_size string, label string"
)


def row(doc_id, text):
    return (doc_id, text, "en", "s", None, "x", "x", "x", "x", "x", "x", "x", "x", None)


TEXTS = [
    (1, BASE), (2, BASE.upper()), (3, BASE), (3, BASE), (4, None), (5, ""), (6, "   \n\t "), (7, LONG), (8, LONG + " end"),
    (None, BASE), (None, None), (9, "one"), (10, "One"), (11, "ÄÖ äö one"), (12, "äö äö ONE"), (13, BASE + " more"),
    (14, "you are an idiot and a moron. Released under the MIT License."), (15, "x\u2581y  z\u00a0\u0301 \U0001f600 \x00"),
]


def edge_docs(spark):
    return spark.createDataFrame([row(*t) for t in TEXTS], SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
