"""Documents with the awkward rows that every operator has to take."""

DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, fp string, __other int"

WORDS = "the cat sat on a mat and the dog ran over to see what it was that made so much noise in there".split()


def sentence(k: int, n: int = 40) -> str:
    return " ".join(WORDS[(i * (k + 3) + k * k + i // 5) % len(WORDS)] + ("x" * (i % (k + 2))) for i in range(n))


def edge_docs(spark):
    texts = [
        (1, sentence(1)),
        (2, sentence(2)),
        (3, sentence(1)),
        (4, sentence(1) + " tail"),
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, "one"),
        (9, "é ü ñ 中文 😀 " * 30),
        (10, "long " * 30_000),
        (10, "same id, other text"),
        (10, "same id, other text"),
        (None, "no id"),
        (None, None),
        (11, "a\x00b\x1cc ~ </s> <s> <|endoftext|> ▁"),
        (12, "x" * 5_000),
    ]
    rows = [(i, t, "en", "s", len(t or ""), 7, "f", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS_SCHEMA).repartition(3)


def stored(df, path):
    """``df`` written to files and read back, as operators that number rows by scan want it."""
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))
