"""Chat formatting by quotation linking.

Lines of a message that start with ``>`` are quotes; their number is the level. Quoted lines, without their
marks, are normalised (lower case, single blanks) and cut into passages of at most ``PASSAGE`` words; the last
one of a longer line reaches back to have as many. Passages are hashed, and so are the runs of words of the
messages' own lines taken together, so a quote of part of a line, or one that was wrapped anew, is found too.
A passage belongs to the first message of its conversation that holds it, if that is of an earlier turn. A
message answers the message that most words of its passages of the lowest linked level belong to (ties: the
later one), or else the last message of the last turn before it, over gaps in the numbers too. Messages that
answer a turn other than the one before begin a thread of their own; other messages go on the thread of what
they answer. Threads in order of their first turn, and turns within them, are the conversations in reply order.

Several messages of one turn are all kept; their order is that of a digest of role and text. Equal rows are one
message while links are sought and come out as often as they came in. Rows whose conversation or turn is null
are kept but answer nothing, and nothing answers them; their thread is their turn. Null texts count as empty;
a message that only quotes has an empty text. An empty table gives an empty result; other columns are ignored.

Runs of words are hashed only in conversations that quote, and only of the lengths their passages have. Passages
meet one row per distinct run of a conversation, the turn before is found in even slices of all turns, and
threads by doubling pointers, so neither a very long conversation nor a very common line makes a large group.
A very long text is one row, cut where it lies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.llm.common import ready
from mentionlake.operators.running import previous
from mentionlake.session import materialize

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
BLANKS = r"[ \t\n\f\r]+"
PASSAGE = 8  # words
SALTS = 32  # parts of a conversation's messages while lengths of passages are handed to them
BLOCK = 10_000  # copies of a message that are made at a time


def level(line: Column) -> Column:
    """How often a line is quoted."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def words(text: Column) -> Column:
    plain = F.lower(F.regexp_replace(F.regexp_replace(text, MARKS, ""), BLANKS, " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def lines(text: Column, quoted: bool) -> Column:
    """The lines of a text that are quotes, or its own ones."""
    return F.filter(F.split(text, r"\r?\n"), lambda line: line.rlike(MARKS) == F.lit(quoted))


def cut(line: Column) -> Column:
    """A quoted line's words in passages."""
    n = F.size(line)
    whole = F.transform(
        F.sequence(F.lit(0), F.ceil(n / PASSAGE).cast("int") - 1),
        lambda i: F.slice(line, F.least(i * PASSAGE, n - PASSAGE) + 1, PASSAGE))
    return F.when(n <= PASSAGE, F.array(line)).otherwise(whole)


def quoted_passages(messages: DataFrame) -> DataFrame:
    """(conv, me, level, passage, size, n): the passages that each message quotes and their words in all."""
    quotes = messages.select("conv", "me", F.explode(lines(F.col("text"), True)).alias("line")).select(
        "conv", "me", level(F.col("line")).alias("level"), words(F.col("line")).alias("words"))
    return (
        quotes.where(F.size("words") > 0).select("conv", "me", "level", F.explode(cut(F.col("words"))).alias("words"))
        .groupBy("conv", "me", "level", F.xxhash64("words").alias("passage"), F.size("words").alias("size"))
        .agg(F.sum(F.size("words")).alias("n"))
    )


def first_holders(messages: DataFrame, quoted: DataFrame) -> DataFrame:
    """(conv, passage, original): the first message of a conversation that holds a run of words."""
    sizes = quoted.groupBy("conv").agg(F.collect_set("size").alias("sizes")).select(
        "conv", "sizes", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = words(F.array_join(lines(F.col("text"), False), " "))
    held = (
        messages.select("conv", "me", "text", F.pmod(F.xxhash64("me"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(sizes, ["conv", "salt"])
        .select("conv", "me", own.alias("words"), "sizes")
        .select("conv", "me", "words", F.explode("sizes").alias("size"))
        .where(F.size("words") >= F.col("size"))
    )
    runs = F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("size") + 1),
        lambda i: F.xxhash64(F.slice("words", i, F.col("size"))))
    return (
        held.select("conv", "me", F.explode(F.array_distinct(runs)).alias("passage"))
        .groupBy("conv", "passage").agg(F.min("me").alias("original"))
    )


def threads(messages: DataFrame) -> DataFrame:
    """(conv, me, thread) from (conv, me, parent, linked): the message that begins each message's thread."""
    begins = F.col("parent").isNull() | F.col("linked")
    at = materialize(
        messages.select("conv", "me", F.when(begins, F.col("me")).otherwise(F.col("parent")).alias("thread")), "threads")
    # pointers are doubled for the messages that have not arrived yet; most arrive in a few rounds
    arrived, moving = [at.where("thread = me")], at.where("thread <> me")
    while moving.limit(1).count():
        known = reduce(DataFrame.unionByName, [*arrived, moving])
        further = known.select("conv", F.col("me").alias("thread"), F.col("thread").alias("next"))
        step = materialize(moving.join(further, ["conv", "thread"]), "threads")
        arrived.append(step.where("next = thread").select("conv", "me", "thread"))
        moving = step.where("next <> thread").select("conv", "me", F.col("next").alias("thread"))
    return reduce(DataFrame.unionByName, arrived)


def link(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conversation, turn, role, parent_turn, linked, n_quoted, thread, text, formatted) of every message.

    ``text`` comes without quotes, ``formatted`` as a chat turn with its role; ``n_quoted`` counts quoted lines.
    Sorted by conversation, thread and turn, these are conversations in reply order.
    """
    ready(messages.sparkSession)
    said = F.col("role").cast("string")
    tag = F.md5(F.concat(F.coalesce(F.concat(F.length(said), F.lit(":"), said), F.lit("")), F.lit("|"), "text"))
    rows = materialize(
        messages.select(
            F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"))
        .groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
        .withColumn("me", F.struct("turn", tag.alias("tag"))),
        "messages",
    )
    placed = rows.where(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quoted = materialize(quoted_passages(placed), "quoted")
    votes = (
        quoted.join(first_holders(placed, quoted), ["conv", "passage"]).where("original.turn < me.turn")
        .groupBy("conv", "me", "level", "original").agg(F.sum("n").alias("n"))
    )
    answered = votes.groupBy("conv", "me").agg(
        F.max_by("original", F.struct(-F.col("level"), F.col("n"), F.col("original"))).alias("original"))
    keys = placed.select("conv", "turn", "me")
    turns = keys.groupBy("conv", "turn").agg(F.max("me").alias("last"))
    before = previous(turns, ["conv"], ["turn"], "before", F.col("last")).select("conv", "turn", "before")
    linked = materialize(
        keys.join(before, ["conv", "turn"]).join(answered, ["conv", "me"], "left").select(
            "conv", "me", F.coalesce("original", "before").alias("parent"),
            (F.col("original").isNotNull() & ~F.col("original.turn").eqNullSafe(F.col("before.turn"))).alias("linked"),
        ),
        "linked",
    )
    arranged = linked.join(threads(linked), ["conv", "me"])
    own = F.trim(F.array_join(lines(F.col("text"), False), "\n"))
    count = F.size(F.filter(lines(F.col("text"), True), lambda line: F.size(words(line)) > 0))
    blocks = F.ceil(F.col("copies") / BLOCK)
    left = F.least(F.col("copies") - F.col("block") * BLOCK, F.lit(BLOCK)).cast("int")
    return (
        rows.join(arranged, ["conv", "me"], "left")
        .select(
            "conv", "turn", "role", "copies", F.col("parent.turn").alias("parent_turn"),
            F.coalesce("linked", F.lit(False)).alias("linked"), count.cast("long").alias("n_quoted"),
            F.coalesce("thread.turn", "turn").alias("thread"), own.alias("text"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), left)))
        .select(
            F.col("conv").alias(conversation), F.col("turn").alias(turn), "role", "parent_turn", "linked", "n_quoted",
            "thread", "text",
            F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text")).alias("formatted"))
    )


ORACLE = r"""
WITH RECURSIVE g AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, count(*) AS copies FROM conversations GROUP BY ALL),
n AS (SELECT *, struct_pack(turn := turn, tag := md5(coalesce(length(role) || ':' || role, '') || '|' || text)) AS me,
             [x FOR x IN regexp_split_to_array(text, '\r?\n') IF NOT regexp_matches(x, '^[ \t]*((?:>[ \t]?)+)')] AS own,
             [x FOR x IN regexp_split_to_array(text, '\r?\n') IF regexp_matches(x, '^[ \t]*((?:>[ \t]?)+)')] AS quotes FROM g),
m AS (SELECT * FROM n WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, me, unnest(quotes) AS line FROM m),
w AS (SELECT conv_id, me, len(regexp_replace(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level,
             [x FOR x IN string_split(lower(regexp_replace(regexp_replace(line, '^[ \t]*((?:>[ \t]?)+)', ''), '[ \t\n\f\r]+', ' ', 'g')), ' ')
              IF x <> ''] AS words FROM l),
c AS (SELECT conv_id, me, level, words, unnest(range(greatest(1, CAST(ceil(len(words) / 8) AS BIGINT)))) AS i FROM w WHERE len(words) > 0),
p AS (SELECT conv_id, me, level,
             CASE WHEN len(words) <= 8 THEN words ELSE words[least(i * 8, len(words) - 8) + 1:least(i * 8, len(words) - 8) + 8] END AS passage FROM c),
q AS (SELECT conv_id, me, level, passage, sum(len(passage)) AS n FROM p GROUP BY ALL),
z AS (SELECT DISTINCT conv_id, len(passage) AS size FROM q),
o AS (SELECT conv_id, me, [x FOR x IN string_split(lower(regexp_replace(array_to_string(
               [regexp_replace(x, '^[ \t]*((?:>[ \t]?)+)', '') FOR x IN own], ' '), '[ \t\n\f\r]+', ' ', 'g')), ' ') IF x <> ''] AS words FROM m),
r AS (SELECT conv_id, me, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM o JOIN z USING (conv_id)),
f AS (SELECT conv_id, words[i:i + size - 1] AS passage, min(me) AS original FROM r GROUP BY ALL),
v AS (SELECT q.conv_id, q.me, level, original, sum(n) AS n FROM q JOIN f USING (conv_id, passage) WHERE original.turn < q.me.turn GROUP BY ALL),
a AS (SELECT conv_id, me, original FROM v
      QUALIFY row_number() OVER (PARTITION BY conv_id, me ORDER BY level, n DESC, original DESC) = 1),
u AS (SELECT conv_id, turn, max(me) AS last FROM m GROUP BY ALL),
b AS (SELECT conv_id, turn, lag(last) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM u),
k AS (SELECT m.conv_id, m.me, coalesce(a.original, b.before) AS parent,
             a.original IS NOT NULL AND a.original.turn IS DISTINCT FROM b.before.turn AS linked
      FROM m JOIN b USING (conv_id, turn) LEFT JOIN a ON a.conv_id = m.conv_id AND a.me = m.me),
t AS (SELECT conv_id, me, me AS thread FROM k WHERE parent IS NULL OR linked
      UNION ALL
      SELECT k.conv_id, k.me, t.thread FROM k JOIN t ON k.conv_id = t.conv_id AND k.parent = t.me WHERE NOT k.linked),
e AS (SELECT n.conv_id, n.turn, n.role, k.parent.turn AS parent_turn, coalesce(k.linked, false) AS linked,
             len([x FOR x IN n.quotes IF regexp_matches(regexp_replace(x, '^[ \t]*((?:>[ \t]?)+)', ''), '[^ \t\n\f\r]')]) AS n_quoted,
             coalesce(t.thread.turn, n.turn) AS thread, trim(array_to_string(n.own, chr(10)), ' ') AS text, n.copies
      FROM n LEFT JOIN k ON k.conv_id = n.conv_id AND k.me = n.me LEFT JOIN t ON t.conv_id = n.conv_id AND t.me = n.me)
SELECT conv_id, turn, role, parent_turn, linked, n_quoted, thread, text,
       '<|' || coalesce(role, '') || '|>' || chr(10) || text AS formatted
FROM (SELECT *, unnest(range(copies)) FROM e)
"""
