"""Rows that every operator must bear: nulls, empty and long texts, copies, odd spaces, clashing names."""

DOC_TYPE = ("doc_id long, text string, lang string, source string, n_chars long, "
            "row long, id long, print long, hash string, words string, carried string, label int, ids string")


def _long(words):
    """Words without repeated windows."""
    return " ".join(f"w{i * 7919 % words}x{i}" for i in range(words))


ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "the Quick brown fox  jumps over the lazy dog again and again"),
    (3, None), (4, ""), (5, " \t\n "), (6, "one two"), (7, "ONE two"),
    (8, "line a\nline b\nline a\n\nline a "), (9, "a b c a b c a b c"),
    (10, _long(20000)), (11, _long(20000) + " end"), (12, "ü ß – 𝄞 ▁ x"),
    (12, "ü ß – 𝄞 ▁ x"), (12, "another text"), (None, "no id"), (None, "one two"),
    (13, "\x1c odd\x0bspace here　too  "), (14, "The quick brown fox  jumps over\nthe lazy dog again and again"),
    (15, "x" * 5000), (16, "*** ### $$$ <b>|</b> %% && !!"),
]


def documents(spark, rows=ROWS):
    """Texts with the columns of ``documents`` and some more, whose names the operators use inside."""
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 1, 2, 3, "h", "w", "c", 0, "i") for i, t in rows], DOC_TYPE)
