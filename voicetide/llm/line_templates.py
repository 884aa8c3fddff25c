"""Line dedup by a tree of line templates of fixed depth.

A line is placed by its number of tokens and its leading tokens; a token with a
digit is a variable field from the start.  Two kinds of templates recur:

* whole lines: equal but for tokens with digits;
* generalised lines: inside a leaf, a token that fewer than ``MIN_DOCS`` lines
  hold at its place becomes a variable field; lines with the same remaining
  tokens share a template, if those are at least ``SIMILARITY`` of the line.

A template that recurs in ``MIN_DOCS`` texts or more is dropped from all of them,
unless it recurs only because texts were copied: a text's sketch comes from lines
of its own, or from the rarest of its lines if it has hardly any (``sketches``), so
copies share it and unrelated texts don't, however many lines they share.  There
must be ``MIN_DOCS`` different sketches; further copies don't change that.  Copied documents are left to document dedup.

All of it is DataFrame code.  The verdict depends on a line's content alone, so
equal texts count once, no row ids are needed, and texts meet their bad lines
through a hash of the text.  Counts are aggregated before every shuffle; a line
that a third of the texts hold is one row per task.

Defined results.  Null text: stays null, no lines.  Empty text: no lines.  Blank
lines are never dropped; lines of fewer than ``MIN_TOKENS`` tokens must recur in
``MIN_SHORT_DOCS`` texts.  Repeated
rows and equal texts: one text for the counts, all cleaned alike.  A text whose
lines all go is empty.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicetide.llm.base import discard, free_name, tidy, written
from voicetide.llm.graph import components

#: Texts a template must recur in.
MIN_DOCS = 3
#: Leading tokens that the tree looks at after the number of tokens.
DEPTH = 3
#: Lines of fewer tokens may meet by chance: they must recur in more texts.
MIN_TOKENS = 3
MIN_SHORT_DOCS = 10
#: Share of a line's tokens that a generalised template must keep, and its least length.
SIMILARITY = 0.7
MIN_GENERAL_TOKENS = 6
#: Tokens at each end of a line that tell edited copies of it.
EDGE = 5
#: Least share of its tokens in lines of its own by which a text is no copy.
OWN = 0.05
FIELD = "<*>"


def plain(line: Column) -> Column:
    """Whether a line's tokens are parted by one space and hold no digit, as most are."""
    untidy = line.rlike(r"[0-9\t\r\f\x0B]") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return ~untidy


def spaced(line: Column) -> Column:
    """Tokens parted by one space."""
    return F.trim(F.regexp_replace(line, r"[ \t\r\f\x0B]+", " "))


def fields(line: Column) -> Column:
    """Tokens with digits as variable fields."""
    return F.regexp_replace(line, r"[^ 0-9]*[0-9][^ ]*", FIELD)


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.when(plain(line), line).otherwise(fields(spaced(line))))


def bound(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once.

    Spark copies a projected expression into every later use of it, but not
    through a generator; the outer form adds no filter that computes it again.
    """
    return rows.select("*", F.explode_outer(F.array(value)).alias(name))


def text_hash(text: Column) -> Column:
    """60 bits of an md5, an order that other engines have as well."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def lines(docs: DataFrame) -> DataFrame:
    """(h, line, lh, head, tail, n): the masked lines that may be dropped, per text hash."""
    texts = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("text").alias("h"), "text")
    each = texts.select("h", F.explode_outer(F.split("text", "\n")).alias("_line"))
    raw = F.col("_line")
    tidy = spaced(raw)
    # most lines are only searched, once, and not rebuilt
    masked = F.when(plain(raw), F.struct(raw.alias("raw"), raw.alias("line"), F.lit("").alias("digits"))).otherwise(
        F.struct(tidy.alias("raw"), fields(tidy).alias("line"), F.regexp_replace(tidy, "[^0-9]+", "").alias("digits"))
    )
    # ends are taken with the line's digits: pages of one form are not copies

    def end(side: int) -> Column:
        return text_hash(F.concat(F.lit(f"{side}/"), F.substring_index("_m.raw", " ", side * EDGE), F.lit("/"), F.col("_m.digits")))

    line = F.col("_m.line")
    return (
        bound(each, "_m", masked).filter(line != "")
        .select(
            "h", line.alias("line"), F.xxhash64(line).alias("lh"), end(1).alias("head"), end(-1).alias("tail"),
            (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).alias("n"),
        )
    )


def leaf(line: Column, n: Column) -> Column:
    """The leaf of the tree: number of tokens and leading tokens."""
    key = F.concat(F.substring_index(line, " ", DEPTH), F.lit("/"), n.cast("string"))
    return F.md5(key.cast("binary"))


def texts_of(each: DataFrame, key: str) -> DataFrame:
    """(key, <key>_texts) of the line ends found in two texts or more."""
    found = each.select("h", key).distinct().groupBy(key)
    return found.agg(F.count(F.lit(1)).alias(f"{key}_texts")).filter(F.col(f"{key}_texts") > 1)


def sketches(each: DataFrame) -> DataFrame:
    """(h, sketch): texts that are near copies share a sketch, other texts don't.

    A line is a text's own if neither its head nor its tail is found in ``MIN_DOCS``
    texts: an edit meets one of them, so an edited line still counts as recurring.
    Lines in which the two overlap are judged by the head.
    A text with enough lines of its own has one of those as sketch, whatever it
    shares; one that a second text holds is preferred, so pairs of copies agree.
    A text of one line has that as sketch, whatever its numbers.  Short lines tell
    texts apart only where there are no others (``places_of``).
    The others are made of recurring lines.  Their rarest two are joined to
    components: those of a group of copies are rarer than what the group shares
    with the rest, and they hang together where edits change the choice.
    """
    long = each.filter(F.col("n") >= MIN_TOKENS)
    seen = long.join(texts_of(long, "head"), "head", "left").join(texts_of(long, "tail"), "tail", "left")
    of_head = F.coalesce("head_texts", F.lit(1))
    of_tail = F.when(F.col("n") < 2 * EDGE, 0).otherwise(F.coalesce("tail_texts", F.lit(1)))
    placed = seen.select(
        "h", "lh", "n", "c", F.greatest(of_head, of_tail).alias("_t"),
        F.when(of_head >= of_tail, F.col("head")).otherwise(F.col("tail")).alias("_k"),
    )
    mine = F.col("_t") < MIN_DOCS
    texts = written(
        placed.groupBy("h").agg(
            F.sum("n").alias("_all"), F.sum(F.when(mine, F.col("n"))).alias("_own"),
            F.when(F.sum("c") == 1, F.min("lh")).alias("_line"),
            F.min(F.when(mine & (F.col("_t") > 1), F.col("_k"))).alias("_pair"),
            F.min(F.when(mine, F.col("_k"))).alias("_one"),
            # the lines of one text
            F.slice(
                F.array_sort(F.collect_set(F.when(~mine, F.struct("_t", "_k")))), 1, 2
            ).alias("_rarest"),
        ).select(
            "h", "_line", (F.coalesce("_own", F.lit(0)) >= OWN * F.col("_all")).alias("_alone"),
            F.coalesce("_pair", "_one").alias("_o"),
            F.get("_rarest", F.lit(0))["_k"].alias("a"), F.get("_rarest", F.lit(1))["_k"].alias("b"),
        ),
        "texts",
    )
    reached = components(texts.filter("NOT _alone AND b IS NOT NULL").select("a", "b").distinct())
    joined = texts.join(reached.toDF("a", "_c"), "a", "left")
    shared = F.coalesce("_c", "a", "_o")
    several = F.when(F.col("_alone"), F.col("_o")).otherwise(shared)
    return joined.select("h", F.coalesce("_line", several).alias("sketch"))


def places_of(docs: DataFrame) -> DataFrame:
    """(h, lh, leaf, n, sketch): every text's distinct lines."""
    found = lines(docs).withColumn("leaf", leaf(F.col("line"), F.col("n")))
    each = written(
        found.groupBy("h", "lh", "leaf", "n").agg(
            F.count(F.lit(1)).alias("c"), F.min("head").alias("head"), F.min("tail").alias("tail")
        ),
        "lines",
    )
    short = each.groupBy("h").agg(F.bit_xor("lh").alias("_x"), F.max("n").alias("_n")).filter(
        F.col("_n") < MIN_TOKENS
    )
    known = sketches(each).union(short.select("h", "_x"))
    places = written(each.join(known, "h").select("h", "lh", "leaf", "n", "sketch"), "places")
    discard(each)
    return places


def recurring(places: DataFrame, key: str) -> DataFrame:
    """Keys found in enough texts that are not copies, however many copies there are besides."""
    by_sketch = places.select(key, "n", "sketch").distinct()
    found = by_sketch.groupBy(key, "n").agg(F.count(F.lit(1)).alias("sketches"))
    least = F.when(F.col("n") < MIN_TOKENS, MIN_SHORT_DOCS).otherwise(MIN_DOCS)
    return found.filter(F.col("sketches") >= least).select(key)


def generalised(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(lh, template) of the lines that share a template with variable fields.

    All lines of a leaf count, each once however many texts hold it.  For a token to
    be constant, one line isn't enough even if it recurs: a line counts for less
    than ``MIN_DOCS`` texts, so a frequent value of a field is a field as a rare one is.
    """
    every = (
        places.filter(F.col("n") >= MIN_GENERAL_TOKENS)
        .groupBy("lh", "leaf").agg(F.least(F.count(F.lit(1)), F.lit(MIN_DOCS - 1)).alias("texts"))
    )
    leaves = (
        every.groupBy("leaf").agg(F.sum("texts").alias("_t"))
        .filter(F.col("_t") >= MIN_DOCS).select("leaf")
    )
    wanted = every.join(leaves, "leaf")
    content = lines(docs).filter(F.col("n") >= MIN_GENERAL_TOKENS).select("lh", "line")
    # equal lines are one row before the tokens are taken apart
    whole = content.join(wanted, "lh").groupBy("lh", "leaf", "texts").agg(F.min("line").alias("line"))
    tokens = written(
        whole.select("lh", "leaf", "texts", F.posexplode(F.split("line", " ")).alias("pos", "token")),
        "tokens",
    )
    tidy(docs.sparkSession)
    place = ["leaf", "pos", "token"]
    constant = (
        tokens.filter(F.col("token") != FIELD).groupBy(*place).agg(F.sum("texts").alias("_t"))
        .filter(F.col("_t") >= MIN_DOCS).select(*place)
    )
    kept = tokens.join(constant, place, "left_semi")
    mark = F.xxhash64("pos", "token")
    size = tokens.groupBy("lh").agg(F.count(F.lit(1)).alias("size"))
    shape = kept.groupBy("lh", "leaf").agg(
        F.count(F.lit(1)).alias("kept"), F.bit_xor(mark).alias("_x"),
        F.sum(F.shiftright(mark, 16)).alias("_s"),
    )
    return (
        shape.join(size, "lh").filter(F.col("kept") >= SIMILARITY * F.col("size"))
        .select("lh", F.struct("leaf", "kept", "_x", "_s").alias("template"))
    )


def bad_lines(docs: DataFrame) -> DataFrame:
    """(h, bad): per text hash the hashes of its lines whose template recurs."""
    places = places_of(docs)
    tidy(docs.sparkSession)
    exact = recurring(places, "lh")
    shared = written(generalised(docs, places), "templates")
    tidy(docs.sparkSession)
    of_text = shared.join(places, "lh").select("template", "n", "sketch")
    general = shared.join(recurring(of_text, "template"), "template").select("lh")
    bad = exact.union(general).distinct()
    return places.join(bad, "lh").groupBy("h").agg(F.collect_set("lh").alias("bad"))


def dedup(docs: DataFrame, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """All rows and columns, with the recurring lines gone from ``text``; adds the columns
    ``counts``: non-blank lines before, and lines dropped (given ones are replaced)."""
    rows = docs.drop(*counts)
    h, bad, filled, s = (free_name(rows, c) for c in ("_h", "_bad", "_filled", "_s"))
    found_bad = bad_lines(docs).toDF(h, bad)
    joined = rows.join(found_bad, F.xxhash64(F.col("text")) == F.col(h), "left")
    every = F.split("text", "\n")
    stay = F.filter(every, lambda x: ~F.array_contains(F.col(bad), line_hash(x)))
    n_filled = F.size(F.filter(every, lambda x: x.rlike(r"[^ \t\r\f\x0B]")))
    own = [c for c in rows.columns if c != "text"]
    found = joined.select(
        *[F.col(f"`{c}`") for c in own], "text", n_filled.alias(filled),
        F.when(F.col(bad).isNotNull(), F.struct(stay.alias("l"), F.size(every).alias("n"))).alias(s),
    )
    clean = F.when(F.col(s).isNull(), F.col("text")).otherwise(F.array_join(F.col(s)["l"], "\n"))
    dropped = F.when(F.col(s).isNull(), F.lit(0)).otherwise(F.col(s)["n"] - F.size(F.col(s)["l"]))
    return found.select(
        *[clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in rows.columns],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.col(filled)).alias(counts[0]),
        dropped.alias(counts[1]),
    )
