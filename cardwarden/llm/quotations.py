"""Quotation linking: which message a quote comes from, and conversations in reply order without quotes.

Everything is a column expression, a join or an aggregate. A line that starts with marks ``>`` is quoted, as many
levels deep as it has marks. Quoted lines and the lines that messages wrote themselves are normalised and hashed;
the original of a quoted line is the first message of its conversation that wrote it, found by one aggregate, so
a line that everybody repeats makes no pairs. A message replies to the original that most of its first-level
quotes come from, the latest one of several. Threads are followed by doubling, one written table a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import stage, table

QUOTED = r"^[ \t]*((?:>[ \t]?)+)"


def level(line: Column) -> Column:
    """Number of quote marks before a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTED, 1), "[^>]", ""))


def passage_hash(line: Column) -> Column:
    """Hash of a line without marks, in lower case, runs of white space as one space."""
    plain = F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, QUOTED, "")), r"\s+", " "))
    return F.when(plain != "", F.struct(F.xxhash64(plain).alias("h"), F.crc32(plain.cast("binary")).alias("c")))


def threads(parents: DataFrame, name: str) -> DataFrame:
    """(mid, root, depth) of the messages in ``parents`` (mid, parent), which has no cycles."""
    now = stage(parents.select("mid", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), f"{name}-0")
    turn = 0
    while True:
        up = now.select(F.col("mid").alias("at"), F.col("root").alias("above"), F.col("depth").alias("more"))
        met = now.join(up, F.col("root") == F.col("at"), "left")
        turn += 1
        after = stage(met.select("mid", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved")), f"{name}-{turn}")
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def link_quotations(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text", name: str = "quotations") -> DataFrame:
    """One row per message: conversation, turn, ``plain_text`` (without quoted lines), ``reply_to`` (turn of the
    message it answers, null if none), ``thread_turn`` (turn of its thread's first message), ``depth`` in the
    thread, ``quoted`` and ``linked`` (quoted lines, and those with a known original), ``levels`` (deepest quote).
    Ordering by conversation, thread_turn, depth, turn puts every message after the one it answers.

    A null text is empty; messages with a null conversation or turn are neither linked nor originals; of equal
    (conversation, turn) all stay. A quote links to earlier turns only. Extra columns are not carried.
    """
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), r"\r?\n")
    rows = messages.select(F.monotonically_increasing_id().alias("mid"), F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("at"), lines.alias("lines"))
    own = F.filter("lines", lambda x: level(x) == 0)
    rows = stage(rows.select("mid", "conv", "at", F.array_join(own, "\n").alias("plain_text"), F.filter("lines", lambda x: level(x) > 0).alias("quotes")), name)
    quotes = rows.where(F.size("quotes") > 0).select("mid", "conv", "at", F.explode("quotes").alias("line"))
    quotes = quotes.select("mid", "conv", "at", level(F.col("line")).alias("level"), passage_hash(F.col("line")).alias("p"))
    quotes = quotes.groupBy("mid", "conv", "at", "level", "p").agg(F.count(F.lit(1)).alias("n"))
    quotes = stage(quotes, f"{name}-quotes")
    asked = quotes.where("p IS NOT NULL AND at IS NOT NULL").select(F.col("conv").alias("q_conv"), F.col("p").alias("q_p")).distinct()
    written = rows.where("conv IS NOT NULL AND at IS NOT NULL").select("mid", "conv", "at", F.explode(F.split("plain_text", "\n")).alias("line"))
    written = written.select("mid", "conv", "at", passage_hash(F.col("line")).alias("p"))
    written = written.join(asked, (F.col("conv") == F.col("q_conv")) & (F.col("p") == F.col("q_p")), "left_semi")
    originals = written.groupBy("conv", "p").agg(F.min(F.struct("at", "mid")).alias("first"))
    originals = originals.select(F.col("conv").alias("o_conv"), F.col("p").alias("o_p"), F.col("first.at").alias("o_at"), F.col("first.mid").alias("o_mid"))
    same = (F.col("conv") == F.col("o_conv")) & (F.col("p") == F.col("o_p")) & (F.col("o_at") < F.col("at"))
    found = stage(quotes.join(originals, same, "left"), f"{name}-found")
    counts = found.groupBy("mid").agg(
        F.sum("n").alias("quoted"), F.sum(F.when(F.col("o_mid").isNotNull(), F.col("n")).otherwise(0)).alias("linked"), F.max("level").alias("levels"),
    ).withColumnRenamed("mid", "c_mid")
    votes = found.where("level = 1 AND o_mid IS NOT NULL").groupBy("mid", "o_mid", "o_at").agg(F.sum("n").alias("votes"))
    parents = votes.groupBy("mid").agg(F.max(F.struct("votes", "o_at", "o_mid")).alias("top"))
    parents = stage(parents.select("mid", F.col("top.o_mid").alias("parent"), F.col("top.o_at").alias("reply_to")), f"{name}-parents")
    chains = threads(parents, f"{name}-threads").join(parents.select("mid", "reply_to"), "mid")
    roots = rows.select(F.col("mid").alias("root"), F.col("at").alias("thread_turn"))
    chains = chains.join(roots, "root").select(F.col("mid").alias("t_mid"), "reply_to", "thread_turn", "depth")
    out = rows.join(counts, F.col("mid") == F.col("c_mid"), "left").join(chains, F.col("mid") == F.col("t_mid"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        F.col("conv").alias("conv_id"), F.col("at").alias("turn"), "plain_text", "reply_to", F.coalesce("thread_turn", "at").alias("thread_turn"),
        zero("depth"), zero("quoted"), zero("linked"), zero("levels"),
    )


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(table(spark, sf_dir, "conversations"))
