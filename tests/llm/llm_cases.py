"""Texts and tables that every operator must stand."""

ODD_TEXTS = ["", None, " ", "\n", "a", "the quick brown fox", "The  Quick\tbrown fox", "x" * 30_000, "word " * 20_000,
             "日本語のテキスト 🙂", "é" * 50, "<|endoftext|> [INST] </s>", "\u0000 nul", "a.b!c?\nd", "- " * 500]


def odd_documents(spark):
    """Nulls in every column, repeated rows, ties, and columns whose names operators use inside."""
    rows = [(i, t, "en", "s", None if t is None else len(t), i * 1.0, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (5, "another text of the same id", None, None, None, None, None),
             (None, "the quick brown fox", "en", "s", 1, 1.0, "y"), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "fp double, row_hash string")


def same(a, b):
    """Equal rows, in any order."""
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
