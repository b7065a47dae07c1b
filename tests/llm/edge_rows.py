"""Documents that operators must not trip over."""

EXTRA = "label int, n long, id long, grp string, word string, bucket int"


def edge_documents(spark):
    """Nulls, empty and long texts, repeats and columns whose names clash."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away into the dark green forest"),
        (2, "the QUICK brown fox jumps over the lazy dog and runs far away into the dark green forest"),
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (6, "one two"),
        (7, "one\ttwo"),
        (8, "ab " * 3000 + "näïve 漢字 \u00a0x 12 km"),
        (8, "ab " * 3000 + "näïve 漢字 \u00a0x 12 km"),
        (None, "nobody's text has four words"),
        (10, "x"),
    ]
    return spark.createDataFrame(
        [(i, t, 1, 2, 3, "g", "w", 4) for i, t in rows], "doc_id long, text string, " + EXTRA
    ).repartition(3)
