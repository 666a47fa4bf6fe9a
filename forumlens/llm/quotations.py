"""Quotation linking: conversations in reply order, without the quotes.

Quoted lines begin with `>` marks, whose number is the level. Lines of one level that stand together are a passage. A
passage is normalised (lower case, white space as one space) and hashed, and so are the original messages: as a
whole, by paragraph and by line, always without their own quotes. A passage belongs to the latest earlier message of
its conversation with the same hash and text; if there is none, its longest line decides in the same way.

A message replies to the latest message that its passages of the first level belong to, or else to the message
before it. Its thread begins at the message that the chain of linked quotes leads to. Messages are in order of
conversation, thread, turn, so a reply follows what it quotes.

All steps are DataFrame expressions. "The latest earlier message" is found in two levels, by blocks of turns,
never by joining all occurrences of a passage with each other, so a conversation or a line that a
third of all rows share gives no more rows than it has.

Defined cases: a null text has no lines and stays null; a text of quotes only becomes empty. Rows without conv_id
or turn are kept, unlinked. Messages with the same conv_id and turn are kept and link alike. A passage without
letters, digits or other marks is not linked. Input columns with the names of the new ones are replaced, others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import drop_columns, fresh, quoted
from forumlens.session import stored

BLOCK = 1024
MARKS = r"^((?:[ \t]*>)+)[ \t]?"
#: A line that announces a quote in the lines below it.
ANNOUNCES = r"^(?:On|Am|Le|El)\b.*:\s*$|^.*\b(?:wrote|writes|schrieb|escribió|a écrit)\s*:\s*$"


def lines_of(text: Column) -> Column:
    """The lines of a text: level, content without marks."""
    parts = F.split(text, r"\r\n|\r|\n")
    return F.transform(
        parts,
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", "")).alias("level"),
            F.regexp_replace(line, MARKS, "").alias("content"),
        ),
    )


def without_quotes(lines: Column) -> Column:
    """The lines of level 0, without those that announce a quote; blank lines at the ends go."""
    kept = F.filter(
        lines,
        lambda line, i: (line["level"] == 0)
        & ~(F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False)) & line["content"].rlike(ANNOUNCES)),
    )
    return F.regexp_replace(F.array_join(F.transform(kept, lambda line: line["content"]), "\n"), r"^\s*\n|\s+$", "")


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def latest_before(asking: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """`asking` (keys, turn, ...) with `found`, the largest smaller `turn` in `given` (keys, turn) with equal keys, or null."""
    at = F.floor(F.col("turn") / BLOCK).alias("at")
    given = given.select(*keys, "turn", at).distinct()
    last = given.groupBy(*keys, "at").agg(F.max("turn").alias("last"))
    blocks = last.unionByName(asking.select(*keys, at, F.lit(None).cast("long").alias("last")).distinct()).groupBy(*keys, "at").agg(F.max("last").alias("last"))
    before = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*keys, "at", F.max("last").over(before).alias("carried"))
    names = [c for c in asking.columns if c not in (*keys, "turn")]
    both = asking.select(*keys, "turn", at, F.struct(*names).alias("row")).unionByName(given.withColumn("row", F.lit(None)), allowMissingColumns=True)
    within = Window.partitionBy(*keys, "at").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    met = both.withColumn("near", F.max(F.when(F.col("row").isNull(), F.col("turn"))).over(within)).filter("row is not null")
    found = met.join(carried, [*keys, "at"], "left")
    return found.select(*keys, "turn", "row.*", F.coalesce("near", "carried").alias("found"))


def passages_of(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, first, text (normalised) and longest line of each quoted passage."""
    lines = messages.select("conv_id", "turn", "key", F.posexplode("lines").alias("place", "line")).select("conv_id", "turn", "key", "place", "line.*").filter("level > 0")
    run = F.col("place") - F.row_number().over(Window.partitionBy("key", "level").orderBy("place"))
    parts = lines.withColumn("run", run).groupBy("conv_id", "turn", "key", "level", "run").agg(F.sort_array(F.collect_list(F.struct("place", "content"))).alias("parts"))
    content = F.transform("parts", lambda p: p["content"])
    longest = F.array_max(F.transform("parts", lambda p: F.struct(F.length(normalised(p["content"])).alias("n"), (-p["place"]).alias("place"), p["content"].alias("content"))))
    out = parts.select("conv_id", "turn", "key", "level", F.element_at("parts", 1)["place"].alias("first"), normalised(F.array_join(content, " ")).alias("whole"), normalised(longest["content"]).alias("longest"))
    return out.filter(F.col("whole") != "")


def originals_of(messages: DataFrame) -> DataFrame:
    """conv_id, turn, unit: normalised messages, paragraphs and lines, without quotes."""
    paragraphs = F.split("clean", r"\n[ \t]*\n")
    units = F.concat(F.array("clean"), paragraphs, F.split("clean", "\n"))
    named = messages.select("conv_id", "turn", F.explode(F.array_distinct(F.transform(units, normalised))).alias("unit"))
    return named.filter(F.col("unit") != "")


def linked_passages(messages: DataFrame) -> DataFrame:
    """Each passage with `origin`, the turn that it is taken from, or null."""
    passages = stored(passages_of(messages), "passages")
    asked = passages.select("conv_id", F.xxhash64("whole").alias("hash")).union(passages.select("conv_id", F.xxhash64("longest"))).distinct()
    units = originals_of(messages).withColumn("hash", F.xxhash64("unit")).join(asked, ["conv_id", "hash"], "left_semi")
    units = stored(units.select("conv_id", "turn", F.col("unit").alias("passage")), "units")
    keys = ["conv_id", "passage"]
    by_whole = latest_before(passages.withColumn("passage", F.col("whole")), units, keys).withColumnRenamed("found", "by_whole").drop("passage")
    by_line = latest_before(by_whole.withColumn("passage", F.col("longest")), units, keys).withColumnRenamed("found", "by_line").drop("passage")
    return by_line.withColumn("origin", F.coalesce("by_whole", "by_line")).drop("by_whole", "by_line")


def thread_starts(replies: DataFrame) -> DataFrame:
    """conv_id, turn and thread: where the chain of links (conv_id, turn, to) from each linked turn begins."""
    links = stored(replies.select("conv_id", "turn", "to").groupBy("conv_id", "turn").agg(F.max("to").alias("to")), "links")
    while True:
        ahead = links.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("farther"))
        jumped = links.join(ahead, ["conv_id", "to"], "left")
        if jumped.filter("farther is not null").isEmpty():
            return links.withColumnRenamed("to", "thread")
        links = stored(jumped.select("conv_id", "turn", F.coalesce("farther", "to").alias("to")), "links")


def link_quotations(messages: DataFrame) -> DataFrame:
    """`messages` (conv_id, turn, text, ...) with text, reply_to, thread, n_quotes and n_linked, in reply order."""
    new = ["reply_to", "thread", "n_quotes", "n_linked"]
    messages = drop_columns(messages, *new)
    names = messages.columns
    key, clean = (fresh(n, names) for n in ("key", "clean"))
    base = messages.withColumns({key: F.monotonically_increasing_id(), clean: without_quotes(lines_of(F.col("text")))})
    base = stored(base, "messages")  # fixes the numbers
    narrow = base.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.col(key).alias("key"), F.col(clean).alias("clean"), lines_of(F.col("text")).alias("lines")).filter("conv_id is not null and turn is not null")

    passages = stored(linked_passages(narrow), "linked")
    per_message = passages.groupBy("key").agg(F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"), F.max(F.when(F.col("level") == 1, F.col("origin"))).alias("to"))
    order = narrow.select("conv_id", "turn", "key")
    previous = latest_before(order, order.select("conv_id", "turn"), ["conv_id"]).withColumnRenamed("found", "previous")
    joined = stored(previous.join(per_message, "key", "left"), "replies")
    threads = thread_starts(joined.filter("to is not null"))
    known = joined.join(threads, ["conv_id", "turn"], "left").select(
        F.col("key").alias(key),
        F.coalesce("to", "previous").alias("reply_to"),
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
    text = {c: F.col(clean).alias("text") if c.lower() == "text" else F.col(quoted(c)) for c in names}
    out = base.join(known, key, "left").select(*text.values(), "reply_to", "thread", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
    return out.orderBy("conv_id", "thread", "turn")
