"""Table schemas.

``date`` is naive UTC (TIMESTAMP_NTZ).  Landed fields whose JSON type varies
between records are VARIANT, counts among them: 12, 12.0, "12" and 1e3 all land.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "variant": T.VariantType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(fields: str) -> T.StructType:
    """``"name type, ..."`` as a struct, without needing a session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


POST = struct(
    "id string, platform string, brand string, text string, date timestamp_ntz, url string, "
    "likes bigint, retweets bigint, replies bigint, engagement bigint, author string, "
    "month string, month_num int, data_source string"
)

CLASSIFIED = T.StructType(
    POST.fields
    + struct(
        "bucket string, bucket_label string, confidence double, sentiment string, "
        "is_complaint boolean, is_escalation boolean, topic_label string"
    ).fields
)

# Platform names and the landed field names of each platform.
MICROBLOG, FORUM, PROFESSIONAL = "Twitter/X", "Reddit", "LinkedIn"

RAW_MICROBLOG = struct(
    "id variant, id_str variant, text string, full_text string, rawContent string, "
    "createdAt variant, created_at variant, url string, tweetUrl string, "
    "likeCount variant, favorite_count variant, retweetCount variant, retweet_count variant, "
    "replyCount variant, author variant, user variant"
)
RAW_FORUM = struct(
    "id variant, title string, body string, selftext string, text string, "
    "createdAt variant, created_utc variant, url string, permalink string, score variant, "
    "ups variant, numComments variant, num_comments variant, author variant"
)
RAW_PROFESSIONAL = struct(
    "id variant, urn variant, text string, commentary string, content string, body string, "
    "postedAt variant, publishedAt variant, date variant, url string, postUrl string, "
    "totalReactionCount variant, likes variant, repostCount variant, commentsCount variant, "
    "comments variant, author variant, authorName string"
)
# End of fixed values.

#: File-name suffix of a landed source and its (platform, schema).
RAW_SOURCES = {
    "twitter": (MICROBLOG, RAW_MICROBLOG),
    "reddit": (FORUM, RAW_FORUM),
    "linkedin": (PROFESSIONAL, RAW_PROFESSIONAL),
}
