"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

from pyspark.sql import types as T

WORDS = "the of and thing reed onder blest hanin stanti whor edble ingha tionre ershe thanou".split()


def prose(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * 7 + seed * 3 + (i * i) % 11 + i // 13) % len(WORDS)] + str((i * 31 + seed * 17) % 97) for i in range(n))


DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside or return
        *[T.StructField(n, T.StringType()) for n in ("size", "taken", "start", "words", "kind", "n", "id", "doc", "th", "base", "score", "kept", "bucket", "target", "hits", "h")],
    ]
)


def documents(spark, rows=None):
    """(doc_id, text, source) rows with all further columns filled with a fixed value."""
    if rows is None:
        rows = [
            (1, None, "a"),
            (2, "", "a"),
            (3, "   \n\t ", None),
            (4, prose(120), "b"),
            (5, prose(120), "b"),
            (5, prose(120), "b"),
            (6, prose(40, 5), None),
            (None, prose(30, 6), "c"),
            (None, None, None),
            (7, prose(30_000, 7), "c"),
            (8, "one", "d"),
            (9, prose(120).upper(), "d"),
        ]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * 16) for i, t, s in rows], DOC)


def write(spark, folder, documents, labels=None, benchmark=None, pages=None, conversations=None):
    """The tables as Parquet below ``folder``; absent ones are empty."""
    documents.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    tables = {
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (benchmark, "item_id long, text string"),
        "pages": (pages, "page_id long, url string, html string, host string, wrapper string"),
        "conversations": (conversations, "conv_id long, turn long, role string, text string, part string, pos string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows or [], schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
