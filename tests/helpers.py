"""Small shared helpers for tests."""


def lines_df(spark, lines, with_id=False):
    """A DataFrame of text lines (column ``line``), optionally with ``line_id``."""
    if with_id:
        return spark.createDataFrame([(l, i) for i, l in enumerate(lines)], "line string, line_id long")
    return spark.createDataFrame([(l,) for l in lines], "line string")
