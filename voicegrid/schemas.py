"""Schemas and enum domains of the records that the engine reads and writes."""

from pyspark.sql import types as T

EMOTIONS = ("happy", "normal", "grumpy", "angry", "curious", "sad")
POST_TYPES = ("cat", "dog")
CORRUPT = "_corrupt"

ORIGINALS = T.StructType([T.StructField("content", T.StringType())])
AUGMENTED = T.StructType([T.StructField(n, T.StringType()) for n in ("content", "emotion", "post_type", "transformed_content")])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema and a column that keeps lines that don't parse."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
