"""Documents with everything odd, under columns whose names clash with the operators' own."""

SCHEMA = "doc_id long, text string, id string, score string, bands int, payload string, n_chars long"
ODD = [None, "", " ", "\n\n", "***", "word", "Ä ö\tß €uro 日本語 🙂", "same same\nsame", "same same\nsame", "\\ <s> [INST] \\[/INST] <|end|>", "x" * 200_000, "word " * 30_000, "é" * 63 + "a", "null\x00byte"]


def odd_documents(spark, more=()):
    rows = [(k, t, "1", "s", 0, "p", len(t) if t is not None else None) for k, t in enumerate([*ODD, *more])]
    return spark.createDataFrame([*rows, (None, "a row without an id", None, None, None, None, None)], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
