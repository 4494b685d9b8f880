"""Small frames with the awkward rows that every operator must take."""

LONG = "\n".join(f"line {i} of a very long text with words {i * 7} and {i * 13}." for i in range(4000))
ROWS = [
    (1, "Alpha beta gamma delta.\nSecond line here.", "en", "s1"),
    (2, "Alpha beta gamma delta.\nSecond line here.", "en", "s1"),
    (3, None, None, None),
    (4, "", "en", "s2"),
    (5, "   \n\t ", "de", "s2"),
    (6, LONG, "en", "s1"),
    (6, LONG, "en", "s1"),
    (None, "a text without an id", "en", "s3"),
    (7, "one", "fr", None),
    (8, "naïve café 漢字 𝔘 \x00 end", "fr", "s3"),
]
#: Columns whose names operators use for their own results.
CLASHING = {"row": 1, "id": 2, "size": 3, "key": 4, "sig": 5, "score": 6.0, "n": 7, "text_": 8, "digest": "x", "_file": "y", "_gone": 0,
            "taken": 0, "target": 0.0, "position": 0.5, "n_tokens": 1, "label": 1, "r": 0, "h": 0, "ids": "z"}


def docs(spark, rows=None, clashing=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS if rows is None else rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if clashing else df


def empty(spark):
    return docs(spark).limit(0)
