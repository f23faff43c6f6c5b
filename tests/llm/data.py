"""Small hand-made tables with the awkward cases every operator must take."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"

PROSE = ("the river bends where the old mill stood and children throw stones at the dark water while "
         "their mothers talk about the price of bread and the weather that never keeps its word")
OTHER = ("der alte Mann ging langsam durch den Wald und dachte an seine Kinder die weit weg wohnten "
         "und nur selten schrieben obwohl er jeden Abend auf einen Brief wartete")


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source) with nulls, empties, repeats, ties, odd characters and a long text."""
    long_text = "\n".join(f"{PROSE} {i} {OTHER}" for i in range(400))
    return [
        (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, OTHER, "de", "b"),
        (3, None, "en", "a"), (4, "", "en", None), (5, "   \n\t ", "de", "b"), (6, "12345 !!! 678", None, "b"),
        (7, OTHER + ".", "de", None), (8, long_text, "en", "c"), (9, "x", "en", "c"),
        (10, "ünï𝔘 \U0001f600 ñandú çà\x00\x0b\x0cend", "es", "é"), (None, PROSE + " again", "en", "a"),
        (None, None, None, None), (11, long_text + " tail", "en", "c"), (12, "word " * 3000, "en", "c"),
    ]


def awkward(spark):
    """The rows with extra columns whose names clash with what operators make."""
    return spark.createDataFrame(
        [(*r, 7, "keep", 0.5, 1) for r in awkward_rows()],
        "doc_id long, text string, lang string, source string, _d int, row string, score double, n_lines int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, None, 1), (None, 1, 1), (8, 1, 0), (9, 0, 1), (7, 1, 1)],
                                 "doc_id long, quality int, toxic int")
