"""Fixed row shapes."""

from pyspark.sql import types as T

LABELLED = T.StructType(
    [T.StructField("Sentence", T.StringType()), T.StructField("Emotion", T.StringType())]
)

LABELLED_ALT = T.StructType(
    [T.StructField("clean_text", T.StringType()), T.StructField("category", T.StringType())]
)

UNLABELLED = T.StructType([T.StructField("Sentence", T.StringType())])

RAW_COMMENT = T.StructType(
    [T.StructField("User ID", T.StringType()), T.StructField("Comment", T.StringType())]
)

COMMENT = T.StructType(
    [T.StructField("UserID", T.StringType()), T.StructField("Sentence", T.StringType())]
)

SCORED = T.StructType(
    [
        T.StructField("UserID", T.StringType()),
        T.StructField("Sentence", T.StringType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("class", T.StringType()),
    ]
)

# A message holds its comments as an array. Items are read as strings, whether they are JSON text,
# objects or pairs; the second parse decides.
MESSAGE = T.StructType([T.StructField("comments", T.ArrayType(T.StringType()))])

PAIR = T.ArrayType(T.StringType())

# Kafka-like rows, also used by the file stand-in for a topic.
PAYLOAD = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

CORRUPT = "_bad_row"
