"""Declared schemas of the inputs. Nothing is inferred from data."""

from pyspark.sql import types as T

CORRUPT = "_corrupt"

# One hit of a preprint log. Keywords stay a VARIANT because a bare string is accepted there.
PREPRINT_HIT = (
    "item STRUCT<id STRING, doi STRING, title STRING, abstract STRING, publishedDate STRING, "
    "submittedDate STRING, status STRING, version STRING, license STRUCT<name STRING>, "
    "keywords VARIANT, authors ARRAY<STRUCT<firstName STRING, lastName STRING>>, "
    "asset STRUCT<original STRUCT<url STRING>>>"
)
PREPRINT_COLUMNS = [
    "id", "doi", "title", "abstract", "publishedDate", "submittedDate",
    "status", "version", "license", "keywords", "authors", "pdf_url",
]

_INFO = (
    "ARRAY<STRUCT<ReferenceNumber BIGINT, "
    "Value STRUCT<StringWithMarkup ARRAY<STRUCT<String STRING>>>>>"
)
COMPOUND_RECORD = (
    "Record STRUCT<RecordNumber BIGINT, RecordTitle STRING, "
    "Reference ARRAY<STRUCT<ReferenceNumber BIGINT, SourceName STRING, SourceID STRING, "
    "Description STRING, URL STRING>>, "
    "Section ARRAY<STRUCT<TOCHeading STRING, "
    f"Section ARRAY<STRUCT<TOCHeading STRING, Information {_INFO}, "
    f"Section ARRAY<STRUCT<TOCHeading STRING, Information {_INFO}>>>>>>>"
)

RESPONSE_LINE = (
    "custom_id STRING, error STRING, response STRUCT<body STRUCT<"
    "choices ARRAY<STRUCT<message STRUCT<content STRING>>>, "
    "usage STRUCT<completion_tokens BIGINT>>>"
)

# Answer schemas. A nullable field is optional: its empty value is null.
QUESTION = T.StructType([T.StructField("question", T.StringType(), True)])
TWO_HOP = T.StructType(
    [
        T.StructField("question", T.StringType(), False),
        T.StructField("chunk1", T.StringType(), False),
        T.StructField("chunk2", T.StringType(), False),
    ]
)
ANSWER_SCHEMAS = {"QueryGeneration": QUESTION, "TwoHopQueryGeneration": TWO_HOP}


def answer_schema(answer: T.StructType | str) -> T.StructType:
    """A schema itself, or one of the two named ones."""
    if isinstance(answer, T.StructType):
        return answer
    if answer not in ANSWER_SCHEMAS:
        raise ValueError(f"unknown answer schema {answer}; known: {', '.join(ANSWER_SCHEMAS)}")
    return ANSWER_SCHEMAS[answer]


# Columns of the result cache that are not answer fields.
TELEMETRY = [
    "raw", "raw_response", "input_tokens", "output_tokens", "reasoning_tokens",
    "latency", "date", "reasoning", "error", "model",
]
