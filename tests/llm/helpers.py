"""Small tables with the cases that every operator must bear."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, component_id long"


def edge_documents():
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 700} and{i % 13}" for i in range(20_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog near the old river bank", "en", "a", 67, "x", 9),
        (1, "the quick brown fox jumps over the lazy dog near the old river bank", "en", "a", 67, "x", 9),
        (2, "The quick brown fox  jumps over the lazy dog near the old river bank", None, None, None, None, None),
        (3, "", "en", "a", 0, "x", 1),
        (4, None, "fr", "b", None, "x", 1),
        (None, "mit license", "en", "b", 11, "x", 1),
        (5, " \t\n", "de", None, 3, "x", 1),
        (6, long, "en", "a", len(long), "x", 1),
        (7, "один два три 漢字 🙂", "ru", "c", 17, "x", 1),
        (8, "1234 5678 !!!", "en", "c", 13, "x", 1),
        (None, None, None, None, None, None, None),
    ]


def edge_frame(spark):
    return spark.createDataFrame(edge_documents(), SCHEMA)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(df, tmp_path, name="documents"):
    """The table as a folder that queries can read."""
    path = f"{tmp_path}/{name}.parquet"
    df.coalesce(1).write.parquet(path)
    return df.sparkSession.read.parquet(path)
