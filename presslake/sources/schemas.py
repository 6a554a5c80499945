"""Declared schemas. Nothing is inferred: dynamic keys would otherwise become struct fields."""

from __future__ import annotations

from pyspark.sql import types as T

TERMS = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
DISTRICTS = T.StructType([T.StructField("districts", TERMS)])
LOCATIONS = T.MapType(T.StringType(), DISTRICTS)
NEWSPAPER = T.StructType([T.StructField("name", T.StringType()), T.StructField("link", T.StringType())])
NEWSPAPERS = T.MapType(T.StringType(), T.ArrayType(NEWSPAPER))


STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
COUNTS = T.MapType(STRING, LONG)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(*names: str) -> T.StructType:
    return struct(**{name: STRING for name in names})


CONFIG = T.StructType(
    [
        T.StructField("disaster_id", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("hazard_names", TERMS),
        T.StructField("keywords", TERMS),
        T.StructField("locations", LOCATIONS),
        T.StructField("newspapers", NEWSPAPERS),
        T.StructField("country_codes", T.ArrayType(T.StringType())),
        T.StructField("specific_links", T.ArrayType(T.StringType())),
    ]
)
FEED = struct(
    query_id=STRING, country_ord=INT, ord=LONG, title=STRING, link=STRING, published=STRING, summary=STRING,
    source=strings("title"),
)
METADATA_COLUMNS = [
    "title", "link", "date", "source", "summary", "language",
    "hazard", "keyword", "location", "newspaper", "query_type", "disaster_id",
]
METADATA = strings(*METADATA_COLUMNS)
PAGE = struct(page_id=LONG, url=STRING, html=STRING, status=INT)
ARTICLE = struct(
    id=STRING, title=STRING, final_url=STRING, original_url=STRING, normalized_url=STRING,
    article_text=STRING, article_language=STRING,
    metadata=strings(
        "csv_date", "csv_source", "csv_summary", "csv_language", "csv_hazard", "csv_keyword", "csv_location",
        "csv_newspaper", "query_type",
    ),
    disaster_id=STRING, extraction_timestamp=STRING, extraction_quality=STRING,
)
STATISTICS = struct(
    disaster_id=STRING, extraction_timestamp=STRING, total_articles=LONG,
    by_language=COUNTS, by_quality=COUNTS, by_date=COUNTS, by_location=COUNTS, by_keyword=COUNTS,
)
REQUEST_LOG = struct(
    request_id=LONG, ts=T.TimestampType(), state_key=STRING, success=T.BooleanType(), error_type=STRING,
    response_time=T.DoubleType(),
)
REGISTRY = strings("State/UT", "Newspaper Name", "Language(s)", "Website")
