"""Chat formatting by quotation linking, with DataFrame functions only.

Quoted lines are told by leading > marks; runs of lines on one level are passages. A passage is
tried as a whole, line by line and sentence by sentence: each candidate is hashed after
normalisation and joined to the earliest message that says the same in its own words, as its whole
text, a paragraph, a line or a sentence. The longest candidate that has an original links the passage.
Inside a conversation any number of words will do; in another one it takes ``MIN_WORDS``, as shorter
words are said everywhere. The links give each message the one it replies to; following them to the
start of each thread (pointer doubling) gives the reply order. Quotes, and the line that announces
them, are left out of the texts.

Sums come before joins: originals are reduced to one row per passage and conversation, and to the
two smallest conversations of each passage (one of them may be the quoting one). Both are landed
before the join, so that a line that a third of all messages quote can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import landed

MIN_WORDS = 3
MARK = r"^[ \t]*(?:>[ \t]?)+"
ANNOUNCES = r"^\s*(?:On .*wrote|Am .*schrieb.*|Le .*a écrit|El .*escribió|.* (?:writes|said)) ?:\s*$"


def normalised(text: Column) -> Column:
    """Lower case; everything but letters and digits is a blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _words(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.size(F.split(norm, " ", -1)))


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` plus lines: an array of (level, body)."""
    lines = F.split(F.coalesce("text", F.lit("")), r"\r?\n", -1)

    def line(x: Column) -> Column:
        mark = F.regexp_extract(x, f"({MARK})", 1)
        return F.struct(F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"), F.substr(x, F.length(mark) + 1).alias("body"))

    return messages.withColumn("lines", F.transform(lines, line))


def _own_text(lines: Column) -> Column:
    """The level 0 lines, without those that announce the quote on the next line."""
    kept = F.filter(lines, lambda x, i: (x.level == 0) & ~(
        x.body.rlike(ANNOUNCES) & F.coalesce(F.try_element_at(lines, i + 2).level > 0, F.lit(False))
    ))
    joined = F.regexp_replace(F.array_join(F.transform(kept, lambda x: x.body), "\n"), r"\n\s*\n", "\n\n")
    return F.regexp_replace(joined, r"\A\s+|\s+\z", "")


def _sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(F.regexp_replace(text, r"\s+", " "), "([.!?]) ", "$1\n"), "\n", -1)


def quoted_passages(rows: DataFrame) -> DataFrame:
    """``rows`` (id, conv_id, turn, lines) -> (id, conv_id, turn, run, level, at, nth, n_words, hash):
    the candidates of each quoted run, numbered: the whole, its lines, its sentences."""
    lines = rows.where(F.exists("lines", lambda x: x.level > 0)).dropDuplicates(["id"]).select("id", "conv_id", "turn", F.posexplode("lines").alias("at", "line"))
    lines = lines.select("id", "conv_id", "turn", "at", "line.level", "line.body")
    blank = F.trim(F.regexp_replace("body", r"\s+", " ")) == ""
    one = Window.partitionBy("id").orderBy("at")  # the lines of one message
    lines = lines.withColumn("kind", F.when((F.col("level") > 0) & ~blank, F.col("level")).otherwise(F.lit(0)))
    lines = lines.withColumn("new", (F.col("kind") != F.coalesce(F.lag("kind").over(one), F.lit(0))).cast("int"))
    lines = lines.withColumn("run", F.sum("new").over(one)).where("kind > 0")
    bodies = F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x.body)
    runs = lines.groupBy("id", "conv_id", "turn", "run").agg(F.first("level").alias("level"), F.min("at").alias("at"), bodies.alias("bodies"))
    whole = F.array_join("bodies", " ")
    parts = F.concat(F.array(whole), F.col("bodies"), _sentences(whole))
    tried = runs.select("id", "conv_id", "turn", "run", "level", "at", F.posexplode(F.transform(parts, normalised)).alias("nth", "norm"))
    return tried.select("id", "conv_id", "turn", "run", "level", "at", "nth", _words(F.col("norm")).alias("n_words"), F.md5(F.col("norm").cast("binary")).alias("hash"))


def own_passages(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, hash) of every paragraph, line, sentence and whole text of the messages' own words."""
    blocks = F.concat(F.array("own"), F.split("own", r"\n[ \t]*\n", -1), F.split("own", "\n", -1), _sentences(F.col("own")))
    norms = F.filter(F.array_distinct(F.transform(blocks, normalised)), lambda x: x != "")
    return rows.where("turn is not null").select("conv_id", "turn", F.explode(F.transform(norms, lambda x: F.md5(x.cast("binary")))).alias("hash"))


def _linked(quotes: DataFrame, own: DataFrame) -> DataFrame:
    """(id, level, at, nth, n_words, from_conv, from_turn): the candidates whose original is found,
    first in the same conversation and before the quote, then anywhere else."""
    tried = quotes.where("n_words > 0")
    own = own.join(tried.select("hash").distinct(), "hash", "left_semi")
    here = landed(own.groupBy("conv_id", "hash").agg(F.min("turn").alias("here_turn")))
    nth = F.row_number().over(Window.partitionBy("hash").orderBy("conv_id"))  # two rows a task and passage are shuffled
    two = here.where("conv_id is not null").withColumn("nth", nth).where("nth <= 2")
    place = F.struct(F.col("conv_id").alias("c"), F.col("here_turn").alias("t"))
    two = landed(two.groupBy("hash").agg(*[F.max(F.when(F.col("nth") == i, place)).alias(f"away{i}") for i in (1, 2)]))
    found = tried.join(here, ["conv_id", "hash"], "left").join(two, "hash", "left")
    inside = F.coalesce(F.col("here_turn") < F.col("turn"), F.lit(False))
    away = F.when(F.col("away1.c").eqNullSafe(F.col("conv_id")), F.col("away2")).otherwise(F.col("away1"))
    found = found.withColumn("away", F.when(F.col("n_words") >= MIN_WORDS, away)).where(inside | F.col("away").isNotNull())
    return found.select(
        "id", "level", "at", "nth", "n_words",
        F.when(inside, F.col("conv_id")).otherwise(F.col("away.c")).alias("from_conv"), F.when(inside, F.col("here_turn")).otherwise(F.col("away.t")).alias("from_turn"),
    )


def _threads(replies: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``replies`` (conv_id, turn, up), up < turn -> (conv_id, turn, thread_turn, depth)."""
    now = landed(replies.groupBy("conv_id", "turn").agg(F.min("up").alias("thread_turn")).withColumn("depth", F.lit(1).cast("long")))
    for _ in range(max_rounds):
        up = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread_turn").alias("further"), F.col("depth").alias("more"))
        both = now.join(up, (F.col("conv_id") == F.col("c")) & (F.col("thread_turn") == F.col("t")), "left")
        after = landed(both.select("conv_id", "turn", F.coalesce("further", "thread_turn").alias("thread_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved")))
        now = after.drop("moved")
        if after.where("moved").isEmpty():
            return now
    raise RuntimeError("reply chains did not settle")


def link_replies(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n_quotes, quoted_conv, quoted_turn, thread_turn, depth) of every
    message, with ``text`` freed from quotes.

    ``quoted_*`` is the original of the message's first linked passage on the lowest quote level, by
    the longest of its candidates that has one (null without any). If it is in the same conversation the message replies to it;
    ``thread_turn`` is the turn that its chain of replies starts from (its own without reply) and
    ``depth`` the number of replies up to there. Order by (conv_id, thread_turn, turn) puts each
    message behind the one it replies to.

    A null or empty text gives an empty one; blank lines are kept single. Messages without
    conversation or turn are kept, without reply of their own and never quoted inside a
    conversation. Messages that share conversation and turn share a thread; equal rows stay
    repeated. Passages without a letter or digit are removed but not linked. An empty table gives an
    empty result; other columns aren't read.
    """
    rows = parsed(conversations.select("conv_id", "turn", "role", "text"))
    key = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    rows = rows.withColumn("id", F.md5(key.cast("binary"))).withColumn("own", _own_text(F.col("lines")))
    quotes = landed(quoted_passages(rows))
    empty = quotes.isEmpty()
    out = rows.select("id", "conv_id", "turn", "role", F.col("own").alias("text"))
    if empty:
        return out.select(
            "conv_id", "turn", "role", "text", F.lit(0).cast("long").alias("n_quotes"), F.col("conv_id").alias("quoted_conv"), F.col("turn").alias("quoted_turn"),
            F.col("turn").alias("thread_turn"), F.lit(0).cast("long").alias("depth"),
        ).withColumn("quoted_conv", F.when(F.lit(False), F.col("quoted_conv"))).withColumn("quoted_turn", F.when(F.lit(False), F.col("quoted_turn")))
    links = landed(_linked(quotes, own_passages(rows)))
    best = links.groupBy("id").agg(F.min_by(F.struct("from_conv", "from_turn"), F.struct("level", "at", -F.col("n_words"), "nth")).alias("q"))
    counted = quotes.where("nth = 0").groupBy("id").agg(F.count("*").alias("n_quotes"))
    told = landed(counted.join(best, "id", "left").select("id", "n_quotes", "q.from_conv", "q.from_turn"))
    out = out.join(told, "id", "left").drop("id")
    inside = out.where("from_conv = conv_id and from_turn < turn").select("conv_id", "turn", F.col("from_turn").alias("up")).distinct()
    out = out.join(_threads(inside), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "text", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.col("from_conv").alias("quoted_conv"),
        F.col("from_turn").alias("quoted_turn"), F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def rendered(role: Column, text: Column) -> Column:
    """A message as training text. Role marks inside a text or role are broken up, so none can be forged."""
    plain = lambda x: F.replace(F.replace(x, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    return F.concat(F.lit("<|"), plain(F.coalesce(role, F.lit("unknown"))), F.lit("|>\n"), plain(text), F.lit("\n"))


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The messages range-sorted into conversations, each behind the one it replies to, with the
    rendered form of each. A conversation may span tasks; none is gathered in one row."""
    order = ["conv_id", "thread_turn", "turn", "role", "text"]
    return linked.withColumn("rendered", rendered(F.col("role"), F.col("text"))).repartitionByRange(*order).sortWithinPartitions(*order)
