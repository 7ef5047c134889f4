"""Quotation linking: quoted passages traced to the messages they come from, and conversations in reply order without quotes.

A line's quote level is the number of '>' before it; lines of one level in a row are a passage. A passage is taken whole, in
blocks between blank lines and in lines; each of these is normalised (lower case, words of letters and digits) and hashed,
and so are the parts of what each message says itself. A message replies to the one that holds the longest part it quotes
at the lowest level. Everything is a Spark SQL expression or a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import quoted, without, written

LEAST_WORDS = 2  # a part of one word links nothing
QUOTE = r"^(?:[ \t]*>)+"
# Lines that announce a quotation, in the languages of the corpus.
ANNOUNCED = r"^\s*(?:On .{1,200} wrote|Am .{1,200} schrieb.{0,100}|Le .{1,200} a écrit|El .{1,200} escribió)\s*:\s*$"
OUTPUT = ["text", "n_quotes", "max_level", "n_linked", "parent_conv", "parent_turn", "root_conv", "root_turn", "depth"]


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    """struct(level, text) for each line."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda l: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(l, QUOTE, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(l, QUOTE + r"[ \t]?", "").alias("text"),
        ),
    )


def _parts(text: Column) -> Column:
    """struct(hash, size) of a text's parts, each once: the whole, its blocks, its lines."""
    whole = F.concat(F.array(text), F.split(text, r"\n[ \t\r]*\n", -1), F.split(text, "\n", -1))
    kept = F.filter(F.array_distinct(F.transform(whole, _normal)), lambda n: F.size(F.split(n, " ")) >= LEAST_WORDS)
    return F.transform(kept, lambda n: F.struct(F.sha2(n, 256).alias("hash"), F.length(n).alias("size")))


def parsed(messages: DataFrame, text: str = "text") -> DataFrame:
    """The messages with `_own` (what a message says itself) and `_passages`, struct(level, text) of each quoted passage."""
    raw = F.coalesce(quoted(text).cast("string"), F.lit(""))
    at = lambda i: F.get(F.col("_lines"), i)
    first = F.filter(
        F.transform("_lines", lambda l, i: F.when((i == 0) | (at(i - 1)["level"] != l["level"]), i)), lambda i: i.isNotNull()
    )
    passages = F.transform(
        "_first",
        lambda s, k: F.struct(
            at(s)["level"].alias("level"),
            F.array_join(F.transform(F.slice("_lines", s + 1, F.coalesce(F.get("_first", k + 1), F.size("_lines")) - s), lambda l: l["text"]), "\n").alias("text"),
        ),
    )
    announces = lambda l, i: l["text"].rlike(ANNOUNCED) & (F.coalesce(at(i + 1)["level"], F.lit(0)) > 0)
    own = F.filter("_lines", lambda l, i: (l["level"] == 0) & ~announces(l, i))
    return (
        messages.withColumn("_lines", _lines(raw))
        .withColumn("_first", first)
        .withColumn("_passages", F.filter(passages, lambda p: p["level"] > 0))
        .withColumn("_own", F.trim(F.array_join(F.transform(own, lambda l: l["text"]), "\n")))
        .drop("_lines", "_first")
    )


def _threads(links: DataFrame) -> DataFrame:
    """links (conv, turn, parent_conv, parent_turn) with root_conv, root_turn and depth, by pointer doubling: each round
    doubles how far up a message has looked. A parent always comes before its reply, so there are no cycles."""
    up = written(links.select("conv", "turn", F.col("parent_conv").alias("root_conv"), F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = up.select(F.col("conv").alias("root_conv"), F.col("turn").alias("root_turn"), F.col("root_conv").alias("c"), F.col("root_turn").alias("t"), F.col("depth").alias("d"))
        further = up.join(above, ["root_conv", "root_turn"], "left")
        if not further.filter("d is not null").limit(1).count():
            return up
        up = written(
            further.select("conv", "turn", F.coalesce("c", "root_conv").alias("root_conv"), F.coalesce("t", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth")),
            "threads",
        )


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The messages with `text` replaced by what they say themselves, and with the output columns.

    n_quotes: quoted passages; max_level: the deepest; n_linked: quoted parts found elsewhere; parent: the message replied
    to, null if none; root and depth: first message of the thread, and how many replies below it. Ordered by (root_conv,
    root_turn, depth, conv, turn) a conversation reads in reply order. Of several messages with a part, the earliest in
    the same conversation counts, else the earliest of all that comes before; a message never replies to a later one.

    A null text is empty. Rows with a null conversation or turn link nothing and are their own root. Rows with the same
    conversation and turn are one message of several texts for the links, and come out each. Columns with the name of an
    output column are replaced; an empty table gives no rows.
    """
    kept = without(messages, [c for c in OUTPUT if c != text])
    read = parsed(kept, text)
    key = [quoted(conv).cast("long").alias("conv"), quoted(turn).cast("long").alias("turn")]
    said = read.select(*key, F.explode(_parts(F.col("_own"))).alias("p")).select("conv", "turn", "p.hash")
    local = said.groupBy("hash", "conv").agg(F.min("turn").alias("local_turn"))
    # A frequent line is one row from here on: its first message.
    overall = local.filter("conv is not null and local_turn is not null").groupBy("hash").agg(F.min(F.struct("conv", "local_turn")).alias("first"))
    passages = read.filter(F.size("_passages") > 0).select(*key, F.explode("_passages").alias("q"))
    parts = passages.select("conv", "turn", F.col("q.level").alias("level"), F.explode(_parts(F.col("q.text"))).alias("p")).select("conv", "turn", "level", "p.*").distinct()
    here = F.col("local_turn") < F.col("turn")
    before = (F.col("first.conv") < F.col("conv")) | ((F.col("first.conv") == F.col("conv")) & (F.col("first.local_turn") < F.col("turn")))
    found = (
        parts.join(local, ["hash", "conv"], "left")
        .join(overall, "hash", "left")
        .select(
            "conv",
            "turn",
            "level",
            "size",
            F.coalesce(here, F.lit(False)).alias("near"),
            F.when(here, F.col("conv")).when(before, F.col("first.conv")).alias("parent_conv"),
            F.when(here, F.col("local_turn")).when(before, F.col("first.local_turn")).alias("parent_turn"),
        )
        .filter("parent_conv is not null")
    )
    best = F.max(F.struct((-F.col("level")).alias("level"), "near", "size", (-F.col("parent_conv")).alias("c"), (-F.col("parent_turn")).alias("t")))
    links = written(
        found.groupBy("conv", "turn")
        .agg(best.alias("b"), F.count("*").alias("n_linked"))
        .select("conv", "turn", (-F.col("b.c")).alias("parent_conv"), (-F.col("b.t")).alias("parent_turn"), "n_linked"),
        "links",
    )
    threads = links.join(_threads(links), ["conv", "turn"])
    threads = threads.withColumnRenamed("conv", "_conv").withColumnRenamed("turn", "_turn")
    own_conv, own_turn = quoted(conv).cast("long"), quoted(turn).cast("long")
    joined = read.join(threads, (own_conv == F.col("_conv")) & (own_turn == F.col("_turn")), "left")
    return joined.select(
        *[F.col("_own").alias(text) if c == text else quoted(c) for c in kept.columns],
        F.size("_passages").cast("long").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("_passages", lambda p: p["level"])), F.lit(0)).cast("long").alias("max_level"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "parent_conv",
        "parent_turn",
        F.coalesce("root_conv", own_conv).alias("root_conv"),
        F.coalesce("root_turn", own_turn).alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
