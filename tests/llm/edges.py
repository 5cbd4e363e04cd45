"""Awkward tables: nulls, empty and long texts, ties, repeated rows, clashing column names, no rows."""

WORDS = "the of and thing other water stone light early river mountain garden window letter".split()
LONG = " ".join(WORDS[i * i % 14] + str(i % 97) for i in range(40_000))
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _hash bigint, rep bigint, bucket bigint, "
    "score double, rank int, length bigint, word string, best int, host string, node bigint, label bigint, _id bigint, _mark bigint, mark bigint, part int, items int"
)
ROWS = [
    (1, None, "en", "s"),
    (2, "", None, None),
    (3, LONG, "en", "s"),
    (4, "the water of the river and the stone of the mountain", "en", "s"),
    (4, "the water of the river and the stone of the mountain", "en", "s"),
    (5, "the water of the river and the stone of the mountain", "en", None),
    (None, "the water of the river and the stone", "en", "s"),
    (6, "  \t\n ", None, "s"),
    (7, "word", "en", "s"),
    (8, "123 ... 456", None, None),
    (9, LONG + " more", "en", "s"),
]


def edge_docs(spark):
    rows = [(*r, 0, None, 1, 2, 0.5, 1, 9, "w", 3, "h", 4, 5, 6, 7, 8, 9, 10) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
