"""Documents with the edge cases that every operator has to take."""

LONG = " ".join(f"w{i * 7919 % 9973}" for i in range(30_000))
EDGES = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "word", "en"), (4, "word", "en"), (5, LONG, "en"), (6, LONG, "fr"),
    (None, "a text without an id but with some words in it", "en"), (7, "été ñandú 日本語 😀 naïve\x00 nul", "fr"), (8, "x" * 20_000, None),
]


def edge_docs(spark, rows=EDGES):
    """The rows with columns whose names operators use inside."""
    extra = ["t", "n", "s", "key", "rid", "row", "size", "id", "language", "word", "score", "path", "shard", "cluster", "tail"]
    df = spark.createDataFrame([(i, t, lang, "src", len(t or "")) + ("x",) * len(extra) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra))
    return df


def empty_docs(spark):
    return edge_docs(spark).limit(0)
