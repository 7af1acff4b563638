"""Declared schemas and fixed values shared by the operators."""

from pyspark.sql import types as T

QUESTION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("type", T.ArrayType(T.StringType())),
    ]
)

TEST_QUESTION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("question", T.StringType()),
    ]
)

CATEGORY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

RANKING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)

SYSTEM_OUTPUT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("type", T.ArrayType(T.StringType())),
    ]
)

HIERARCHY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("parent", T.StringType()),
    ]
)

# They must equal the ones of the original task for right results.
ROOT_TYPE = "owl#Thing"
TYPE_PREFIX = "dbo:"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCTUATION_WITHOUT_PERIOD = "!\"#$%&'()*+,-/:;<=>?@[\\]^_`{|}~"
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()
QUESTION_WORDS = "who what when where which whom whose why".split()
LITERAL_LABELS = ["boolean", "string", "number", "date"]
ABSTRACT_WORDS = 10
DOCUMENT_CHARS = 20_000
TRAIN_QUESTIONS = 1_000
BASELINE_DEPTH = 10
FIRST_PASS_DEPTH = 5
BM25_K1 = 1.2
BM25_B = 0.75
QUERY_FEATURES = ["query_length", "query_sum_idf", "query_max_idf", "query_avg_idf"]
DOC_FEATURES = ["doc_length_catch_all"]
QUERY_DOC_FEATURES = [
    "unique_query_terms_in_catch_all",
    "sum_TF_catch_all",
    "max_TF_catch_all",
    "avg_TF_catch_all",
]
FEATURES = QUERY_FEATURES + DOC_FEATURES + QUERY_DOC_FEATURES
