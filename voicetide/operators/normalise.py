"""Platform items to the unified post schema.

A missing field counts as null, so items that lack columns normalise too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicetide import schema as S
from voicetide.functions import scalars as sc
from voicetide.functions import timestamps as ts

BASE = ("id", "platform", "brand", "text", "date", "url", "likes", "retweets", "replies",
        "engagement", "author")


class _Fields:
    """Typed access to item fields that may be absent."""

    def __init__(self, items: DataFrame):
        self._items = items
        self._columns = set(items.columns)

    def _get(self, name: str, dtype: str) -> Column:
        if name in self._columns:
            return self._items[name]
        return F.lit(None).cast(dtype)

    def text(self, *names: str) -> list[Column]:
        return [self._get(n, "string") for n in names]

    def count(self, *names: str) -> list[Column]:
        """Counts as whole numbers, from a number or its text."""
        return [self._count(n) for n in names]

    def _count(self, name: str) -> Column:
        value = self._get(name, "bigint")
        if name not in self._columns or not isinstance(
            self._items.schema[name].dataType, T.VariantType
        ):
            return value
        whole = F.try_variant_get(value, "$", "bigint")
        return F.coalesce(whole, F.try_variant_get(value, "$", "double").try_cast("bigint"))

    def variant(self, *names: str) -> list[Column]:
        return [self._get(n, "variant") for n in names]

    def key(self, *names: str) -> Column:
        found = [ts.variant_text(ts.truthy_variant(v)) for v in self.variant(*names)]
        return F.coalesce(*found, F.lit(""))

    def first_variant(self, *names: str) -> Column:
        return F.coalesce(*[ts.truthy_variant(v) for v in self.variant(*names)])

    def nested(self, name: str, path: str) -> Column:
        return F.try_variant_get(self._get(name, "variant"), path, "string")


def _with_parsed_date(posts: DataFrame) -> DataFrame:
    """Parse the landed timestamp in its own projection, so that the parser's
    many uses of the value do not repeat the choice of the field."""
    return posts.withColumn("date", ts.variant_to_utc(F.col("date")))


def normalise_microblog(items: DataFrame) -> DataFrame:
    f = _Fields(items)
    return _with_parsed_date(items.select(
        f.key("id", "id_str").alias("id"),
        F.lit(S.MICROBLOG).alias("platform"),
        "brand",
        sc.first_truthy(f.text("text", "full_text", "rawContent"), "").alias("text"),
        f.first_variant("createdAt", "created_at").alias("date"),
        sc.first_truthy(f.text("url", "tweetUrl"), "").alias("url"),
        sc.first_nonzero(f.count("likeCount", "favorite_count")).alias("likes"),
        sc.first_nonzero(f.count("retweetCount", "retweet_count")).alias("retweets"),
        sc.first_nonzero(f.count("replyCount")).alias("replies"),
        # The score takes the primary counters only, without their fallbacks.
        sc.null_to_zero_sum(f.count("likeCount", "retweetCount", "replyCount")).alias("engagement"),
        sc.first_truthy(
            [f.nested("author", "$.userName"), f.nested("user", "$.screen_name")], ""
        ).alias("author"),
    ))


def normalise_forum(items: DataFrame) -> DataFrame:
    f = _Fields(items)
    body = sc.first_truthy(f.text("body", "title", "selftext", "text"), "")
    title = sc.fill_text(f.text("title")[0])
    return _with_parsed_date(items.select(
        f.key("id").alias("id"),
        F.lit(S.FORUM).alias("platform"),
        "brand",
        # A post with a title only repeats it: the title is also its body.
        sc.strip(F.concat(title, F.lit(" "), body)).alias("text"),
        f.first_variant("createdAt", "created_utc").alias("date"),
        sc.first_truthy(f.text("url", "permalink"), "").alias("url"),
        sc.first_nonzero(f.count("score", "ups")).alias("likes"),
        F.lit(0).cast("bigint").alias("retweets"),
        sc.first_nonzero(f.count("numComments", "num_comments")).alias("replies"),
        sc.null_to_zero_sum(f.count("score", "numComments")).alias("engagement"),
        f.key("author").alias("author"),
    ))


def normalise_professional(items: DataFrame) -> DataFrame:
    f = _Fields(items)
    return _with_parsed_date(items.select(
        f.key("id", "urn").alias("id"),
        F.lit(S.PROFESSIONAL).alias("platform"),
        "brand",
        sc.first_truthy(f.text("text", "commentary", "content", "body"), "").alias("text"),
        f.first_variant("postedAt", "publishedAt", "date").alias("date"),
        sc.first_truthy(f.text("url", "postUrl"), "").alias("url"),
        sc.first_nonzero(f.count("totalReactionCount", "likes")).alias("likes"),
        sc.first_nonzero(f.count("repostCount")).alias("retweets"),
        sc.first_nonzero(f.count("commentsCount", "comments")).alias("replies"),
        # Reposts are not part of this platform's score.
        sc.null_to_zero_sum(f.count("totalReactionCount", "commentsCount")).alias("engagement"),
        sc.first_truthy([f.nested("author", "$.name"), f.text("authorName")[0]], "").alias("author"),
    ))


NORMALISERS = {
    "twitter": normalise_microblog,
    "reddit": normalise_forum,
    "linkedin": normalise_professional,
}


def add_month_columns(posts: DataFrame) -> DataFrame:
    return posts.withColumns(
        {"month": sc.month_name(F.col("date")), "month_num": sc.month_number(F.col("date"))}
    )


def tag_source(posts: DataFrame, data_source: str) -> DataFrame:
    return posts.withColumn("data_source", F.lit(data_source))


def available_columns(posts: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return posts.select(*[c for c in wanted if c in posts.columns])
