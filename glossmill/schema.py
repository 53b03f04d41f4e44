"""The manifest: one row for each timed segment of a video."""

from __future__ import annotations

from pyspark.sql import types as T

# The manifest's columns in their order, and older names of them.
REQUIRED = ("SAMPLE_ID", "VIDEO_ID")
STRINGS = ("SAMPLE_ID", "VIDEO_ID", "REL_PATH", "VIDEO_NAME", "SPLIT", "TEXT", "GLOSS", "SIGNER_ID", "LANGUAGE", "VARIATION_ID", "SOURCE_URL", "HANDEDNESS")
DOUBLES = ("START", "END", "FPS", "BBOX_X1", "BBOX_Y1", "BBOX_X2", "BBOX_Y2")
LONGS = ("CLASS_ID", "REPETITION_ID", "SRC_WIDTH", "SRC_HEIGHT", "FRAME_COUNT")
FLAGS = ("PERSON_DETECTED", "AVAILABLE")
ORDER = (
    "SAMPLE_ID", "VIDEO_ID", "START", "END", "SPLIT", "TEXT", "GLOSS", "CLASS_ID", "BBOX_X1", "BBOX_Y1", "BBOX_X2", "BBOX_Y2", "PERSON_DETECTED",
    "SIGNER_ID", "LANGUAGE", "FPS", "VARIATION_ID", "SOURCE_URL",
)
ALIASES = {
    "SENTENCE_NAME": "SAMPLE_ID",
    "VIDEO_NAME": "VIDEO_ID",
    "START_REALIGNED": "START",
    "END_REALIGNED": "END",
    "SENTENCE": "TEXT",
    "CAPTION": "TEXT",
}
POLICIES = ("fail_fast", "drop_unavailable", "mark_unavailable")


def kind(column: str) -> T.DataType:
    """The type of a manifest column; columns that aren't known are strings."""
    for names, t in ((DOUBLES, T.DoubleType()), (LONGS, T.LongType()), (FLAGS, T.BooleanType())):
        if column in names:
            return t
    return T.StringType()


def struct(columns: list[str]) -> T.StructType:
    """The schema of a manifest file with these columns, under their canonical or older names."""
    return T.StructType([T.StructField(c, kind(ALIASES.get(c, c)), True) for c in columns])
