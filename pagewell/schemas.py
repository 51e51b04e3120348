"""Row shapes shared by the operators."""

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())
VECTOR = T.ArrayType(T.FloatType())

SOURCE = T.StructType([
    T.StructField("ordinal", T.LongType()),
    T.StructField("source", T.StringType()),
])

# A null content means the source could not be loaded.
PAGE = T.StructType([*SOURCE.fields, T.StructField("content", T.StringType())])

# `part` numbers the documents of one source, in the order its parser gave them.
PARSED = T.StructType([
    T.StructField("ordinal", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("metadata", STRING_MAP),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source_type", T.StringType()),
])

# Both payload shapes in one struct; to_json leaves out the null fields, so each
# row prints the shape it was written with.
PAYLOAD = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", STRING_MAP),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source_type", T.StringType()),
])

# One row per point of a batch. `copies` is the number of sent points the row
# stands for, so that counting what was sent survives de-duplication.
POINT = T.StructType([
    T.StructField("point_id", T.StringType()),
    T.StructField("vector", VECTOR),
    T.StructField("payload", PAYLOAD),
    T.StructField("ordinal", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("copies", T.LongType()),
])

# Points as they are stored, one folder per collection and batch.
POINT_LOG = T.StructType([*POINT.fields, T.StructField("batch_id", T.LongType())])

# What `operators.codes` adds to them, apart.
CODE_LOG = T.StructType([
    POINT["point_id"], T.StructField("code", T.BinaryType()), T.StructField("step", T.DoubleType()),
    T.StructField("error", T.DoubleType()), T.StructField("batch_id", T.LongType())])

# Append-only history of the collections.
CATALOG = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("vector_size", T.IntegerType()),
    T.StructField("distance", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("deleted", T.BooleanType()),
    T.StructField("action", T.StringType()),
    T.StructField("sent", T.LongType()),
    T.StructField("origin", T.StringType()),
])

REJECT = T.StructType([
    T.StructField("ordinal", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("detail", T.StringType()),
])

SEARCH_ARGS = T.StructType([
    T.StructField("collection_name", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("limit", T.StringType()),
    T.StructField("offset", T.StringType()),
    T.StructField("documents", T.ArrayType(T.StructType([
        T.StructField("text", T.StringType()),
        T.StructField("metadata", STRING_MAP),
    ]))),
])
