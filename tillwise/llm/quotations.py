"""Quotation linking: who answers whom, and conversations without quotes.

Lines that begin with ``>`` are quotes, one level per mark. Runs of non-blank lines of one
level are passages; a passage is known by the hash of its normalised words, so rewrapped
quotes still match. A quoted passage belongs to the latest earlier message of the conversation
that has it as own text. The message a reply quotes at level 1 is its parent.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.staging import stage

#: The marks at the beginning of a quoted line.
MARKS = r"^([ \t]*>)+"
BLANK = r"[ \t\r\n\x0B\f]+"
#: Turns of a conversation that are gone through in one sorted group.
STRETCH = 4096


def normalised(text: Column) -> Column:
    """A-Z lower-cased, white space as single blanks."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lower, BLANK, " "))


def level(line: Column) -> Column:
    """Number of quote marks before a line's text."""
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def with_passages(messages: DataFrame, text: str = "text") -> DataFrame:
    """Add ``body`` (the text without quoted lines) and ``passages``.

    ``passages`` is an array of ``level, hash`` in text order. The lines are folded in one
    pass over the array of lines, inside the row.
    """
    line = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1),
        lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("text"), x.alias("line")),
    )
    rows = messages.withColumn("_lines", line)
    own = F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["line"])
    # a line starts a passage unless the line before has its level and both are not blank
    blank = F.transform("_lines", lambda x: normalised(x["text"]) == "")
    rows = rows.withColumn("_blank", blank)
    starts = F.transform(
        "_lines",
        lambda x, i: F.when(F.get("_blank", i), F.lit(0)).when(
            (i == 0) | F.get("_blank", i - 1) | (F.get("_lines", i - 1)["level"] != x["level"]), F.lit(1)
        ),
    )
    return rows.withColumn("_starts", starts).withColumn("body", F.trim(F.array_join(own, "\n")))


def passages(messages: DataFrame, key: list[str]) -> DataFrame:
    """``key, level, hash`` of every passage of every message, repeats included.

    Lines are exploded and put together again by passage number inside their message, so a
    very long message is the largest unit of work.
    """
    lines = messages.select(*key, F.posexplode(F.arrays_zip("_lines", "_starts")).alias("at", "x")).select(
        *key, "at", F.col("x._lines.level").alias("level"), F.col("x._lines.text").alias("line"), "x._starts"
    )
    number = F.sum(F.coalesce("_starts", F.lit(0))).over(Window.partitionBy(*key).orderBy("at"))
    parts = lines.withColumn("number", number).where("_starts IS NULL OR _starts = 1")
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), " "
    )
    return (
        parts.groupBy(*key, "number", "level")
        .agg(normalised(text).alias("text"))
        .select(*key, "level", F.sha2("text", 256).alias("hash"))
    )


def link(messages: DataFrame) -> DataFrame:
    """Return the messages ``conv_id, turn, role, text`` without quotes, in reply order.

    Columns: ``conv_id, turn, role, body, parent_turn, root_turn, depth, n_quotes, n_linked``.
    ``parent_turn`` is the latest earlier message that the reply quotes at level 1; without
    one the message begins a thread. ``n_linked`` counts the quoted passages, at any level,
    whose original is an earlier message. Sorted by conversation, thread and turn, so a
    message follows its parent; a large conversation is spread over tasks.

    Null texts are empty bodies. Rows with null ``conv_id`` or ``turn`` are kept as threads
    without links. Repeated rows with one key are all kept; each counts its own quotes and they
    share parent and thread. A passage that several earlier messages have is the latest one's. A message
    of any length is taken apart whole. No rows give no rows; other columns are not read.
    """
    keyed = with_passages(
        messages.select("conv_id", "turn", "role", "text").withColumn(
            "_row", F.xxhash64("conv_id", "turn", "role", "text")
        )
    )
    # equal rows have equal passages: they are taken apart once
    once = keyed.dropDuplicates(["conv_id", "turn", "_row"])
    found = stage(passages(once, ["conv_id", "turn", "_row"]), "passages")
    quotes = found.where("level > 0")
    sources = stage(latest_before(found.where("level = 0"), quotes), "sources")
    quotes = quotes.join(sources, ["conv_id", "hash", "turn"], "left")
    earlier = F.col("source")
    counts = quotes.groupBy("conv_id", "turn", "_row").agg(
        F.count("*").alias("n_quotes"),
        F.count(earlier).alias("n_linked"),
        F.max(F.when(F.col("level") == 1, earlier)).alias("parent"),
    )
    counts = stage(counts, "quotes")
    parents = (
        counts.where("parent IS NOT NULL").groupBy("conv_id", "turn").agg(F.max("parent").alias("parent_turn"))
    )
    threads = roots(parents)
    return (
        keyed.join(
            counts.select("conv_id", "turn", "_row", "n_quotes", "n_linked"), ["conv_id", "turn", "_row"], "left"
        )
        .join(threads, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "body",
            "parent_turn",
            F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        )
        .orderBy("conv_id", "root_turn", "turn", "role", "body")
    )


def latest_before(originals: DataFrame, quotes: DataFrame) -> DataFrame:
    """``conv_id, hash, turn, source``: for each quoted passage the latest earlier turn that has it as its own.

    Each passage of a turn counts once. Turns are cut into stretches: inside one the latest original is
    carried along in order, and the last ones of all earlier stretches are a row each. So a
    passage that a very long conversation says again and again is no single sorted group.
    """

    def distinct(rows: DataFrame, original: bool) -> DataFrame:
        known = rows.select("conv_id", "hash", "turn").dropna().distinct()
        return known.withColumn("_original", F.lit(original))

    both = distinct(originals, True).unionByName(distinct(quotes, False))
    both = both.withColumn("_stretch", F.floor(F.col("turn") / STRETCH)).withColumn("_said", F.when(F.col("_original"), F.col("turn")))
    # a quote stands before an original of its own turn
    order = Window.partitionBy("conv_id", "hash", "_stretch").orderBy("turn", "_original")
    inside = both.withColumn("_here", F.last("_said", ignorenulls=True).over(order)).where("NOT _original")
    ends = both.groupBy("conv_id", "hash", "_stretch").agg(F.max("_said").alias("_last"))
    before = Window.partitionBy("conv_id", "hash").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "hash", "_stretch", F.max("_last").over(before).alias("_before"))
    return (
        inside.join(carried, ["conv_id", "hash", "_stretch"])
        .select("conv_id", "hash", "turn", F.coalesce("_here", "_before").alias("source"))
        .where("source IS NOT NULL")
    )


def roots(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, root_turn, depth`` by pointer doubling.

    Each round joins the messages that have not reached their root with the ancestors that
    all have reached so far, so a chain of n messages takes log2(n) rounds and short
    threads leave early. Parents are earlier, so there are no circles.
    """
    active = stage(
        parents.select(
            "conv_id",
            "turn",
            "parent_turn",
            F.col("parent_turn").alias("root_turn"),
            F.lit(1).cast("long").alias("depth"),
        ),
        "threads",
    )
    done = active.limit(0)
    while True:
        further = active.unionByName(done).select(
            "conv_id",
            F.col("turn").alias("root_turn"),
            F.col("root_turn").alias("_root"),
            F.col("depth").alias("_depth"),
        )
        step = stage(
            active.join(further, ["conv_id", "root_turn"], "left").select(
                "conv_id",
                "turn",
                "parent_turn",
                F.coalesce("_root", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                F.col("_root").isNotNull().alias("_moved"),
            ),
            "threads",
        )
        done = done.unionByName(step.where("NOT _moved").drop("_moved"))
        active = step.where("_moved").drop("_moved")
        if not active.limit(1).count():
            return done


def quoted(conversations: DataFrame) -> DataFrame:
    """Conversations in mail style: every message quotes an earlier one and what stood before that.

    It answers the previous message, every third turn the one before the previous. The answered message
    stands under one mark, the one before it under two, as mail programs leave them. Messages
    are found by key, not by collecting a conversation.
    """
    own = conversations.select("conv_id", "turn", "role", "text")
    texts = own.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    back = F.when(F.col("turn") % 3 == 0, 2).otherwise(1)

    def marked(steps: int) -> DataFrame:
        marks = "> " * steps
        text = F.concat(F.lit(marks), F.replace(F.col("text"), F.lit("\n"), F.lit("\n" + marks)))
        return texts.select("conv_id", F.col("turn").alias(f"_at{steps}"), text.alias(f"_{steps}"))

    return (
        own.withColumn("_at1", F.col("turn") - back)
        .withColumn("_at2", F.col("turn") - back - 1)
        .join(marked(1), ["conv_id", "_at1"], "left")
        .join(marked(2), ["conv_id", "_at2"], "left")
        .select("conv_id", "turn", "role", F.concat_ws("\n", "_2", "_1", F.coalesce("text", F.lit(""))).alias("text"))
    )


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    """The conversations hold no quotes of their own, so they are first put into mail style."""
    return link(quoted(spark.read.parquet(f"{folder}/conversations.parquet")))


_TRIMMED = "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\r\\n\\x0B\\f]+', ' ', 'g'), ' ')"


def oracle() -> str:
    line = "regexp_replace(line, '^([ \\t]*>)+', '')"
    marks = "length(regexp_extract(line, '^([ \\t]*>)+')) - length(replace(regexp_extract(line, '^([ \\t]*>)+'), '>', ''))"
    return f"""
      WITH RECURSIVE m AS (
        SELECT c.conv_id, c.turn, c.role, concat_ws(chr(10),
          '> > ' || replace(b.text, chr(10), chr(10) || '> > '),
          '> ' || replace(a.text, chr(10), chr(10) || '> '), coalesce(c.text, '')) AS text
        FROM conversations c
        LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn - CASE WHEN c.turn % 3 = 0 THEN 2 ELSE 1 END
        LEFT JOIN conversations b ON b.conv_id = c.conv_id AND b.turn = c.turn - CASE WHEN c.turn % 3 = 0 THEN 3 ELSE 2 END),
      l AS (
        SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM m),
      p AS (SELECT *, {marks} AS level, {_TRIMMED.format(line)} AS words FROM l),
      s AS (
        SELECT *, CASE WHEN words = '' THEN 0
          WHEN lag(level) OVER w IS NOT DISTINCT FROM level AND lag(words) OVER w <> '' THEN NULL ELSE 1 END AS starts
        FROM p WINDOW w AS (PARTITION BY conv_id, turn ORDER BY pos)),
      n AS (SELECT *, sum(coalesce(starts, 0)) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS number FROM s),
      passages AS (
        SELECT conv_id, turn, number, level, sha256(string_agg(words, ' ' ORDER BY pos)) AS hash
        FROM n WHERE starts IS NULL OR starts = 1 GROUP BY ALL),
      originals AS (SELECT DISTINCT conv_id, hash, turn FROM passages WHERE level = 0),
      quotes AS (
        SELECT q.conv_id, q.turn, q.number, q.level, max(o.turn) AS source
        FROM passages q LEFT JOIN originals o ON o.conv_id = q.conv_id AND o.hash = q.hash AND o.turn < q.turn
        WHERE q.level > 0 GROUP BY ALL),
      counts AS (
        SELECT conv_id, turn, count(*) AS n_quotes, count(source) AS n_linked,
               max(CASE WHEN level = 1 THEN source END) AS parent_turn FROM quotes GROUP BY ALL),
      tree AS (
        SELECT m.conv_id, m.turn, m.turn AS root_turn, 0::BIGINT AS depth
        FROM m LEFT JOIN counts c ON c.conv_id = m.conv_id AND c.turn = m.turn WHERE c.parent_turn IS NULL
        UNION ALL
        SELECT c.conv_id, c.turn, t.root_turn, t.depth + 1
        FROM counts c JOIN tree t ON t.conv_id = c.conv_id AND t.turn = c.parent_turn),
      bodies AS (
        SELECT conv_id, turn, trim(string_agg(CASE WHEN level = 0 THEN line END, chr(10) ORDER BY pos), ' ') AS body
        FROM p GROUP BY ALL)
      SELECT m.conv_id, m.turn, m.role, coalesce(b.body, '') AS body, c.parent_turn, t.root_turn, t.depth,
             coalesce(c.n_quotes, 0) AS n_quotes, coalesce(c.n_linked, 0) AS n_linked
      FROM m JOIN bodies b ON b.conv_id = m.conv_id AND b.turn = m.turn
      JOIN tree t ON t.conv_id = m.conv_id AND t.turn = m.turn
      LEFT JOIN counts c ON c.conv_id = m.conv_id AND c.turn = m.turn"""
