"""Quotation linking for conversations.

Messages quote others by lines that begin with one > per level. Adjacent lines of one level are a block. Of a quoted block every
window of WINDOW words, every shorter line, and the block as a whole are normalised and hashed; of a message's own text every
window, line, sentence and block, and all of it. So a sentence out of a longer line, some of several paragraphs, or lines broken
elsewhere still meet their original. A passage belongs to the first message of the conversation that said it. A message
answers one that holds a quoted block of it as a whole, half of its passages or LEAST of them: of several the one with the outermost
such block, then a whole one, then the most passages, then the latest. Parents lead to the roots of threads by pointer jumping; a
conversation is then ordered by thread and turn, without the quoted text, so each message follows the one it answers.

One hash has one original, so neither a common line nor a long conversation multiplies rows, and no task holds a whole
conversation. Only conversations with a quoted block have their own texts cut into passages.

Defined results: a null or empty text quotes nothing and stays null or empty, as does a quote without letters and digits; a very
long text makes one passage a word; a message with a null conversation or turn has no parent; rows with the same conversation
and turn share their parent; ties are settled as above; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantrank.llm.common import let, number_rows, write_stage

MARKS = r"^(?:[ \t]*>)+"
#: The line above a quote that names its author, in four languages.
ATTRIBUTION = r"(?i)^[ \t]*(?:on|le|am|el)\b.*\b(?:wrote|écrit|schrieb|escribió)[ \t]*:[ \t]*$"
#: Words of a window; passages of a block that an original holds at least, unless it holds half of them.
WINDOW, LEAST = 5, 3


def parse(messages: DataFrame) -> DataFrame:
    """Add lines: an array of (level, said), without attributions; level 0 is the message's own."""
    marks = lambda line: F.regexp_extract(line, f"({MARKS})", 1)
    level = lambda line: F.length(F.regexp_replace(marks(line), "[^>]", ""))
    raw = F.transform(
        F.split(F.coalesce("text", F.lit("")), r"\r?\n"),
        lambda line: F.struct(level(line).alias("level"), F.regexp_replace(line, MARKS + "[ \t]?", "").alias("said")),
    )
    parsed = messages.withColumn("raw", raw)
    named = lambda x, i: (x["level"] == 0) & x["said"].rlike(ATTRIBUTION) & (F.coalesce(F.get("raw", i + 1)["level"], F.lit(0)) > 0)
    return parsed.withColumn("lines", F.filter("raw", lambda x, i: ~named(x, i))).drop("raw")


def _blocks(lines: Column) -> Column:
    """The runs of adjacent lines of one level: an array of (level, said), said an array of lines."""

    def cut(x: Column) -> Column:
        new = lambda i: (i == 0) | (F.get(x, i - 1)["level"] != F.get(x, i)["level"])
        starts = F.filter(F.sequence(F.lit(0), F.size(x) - 1), new)
        return let(
            F.concat(starts, F.array(F.size(x))),
            lambda at: F.transform(
                F.slice(at, 1, F.size(at) - 1),
                lambda s, k: F.struct(
                    F.get(x, s)["level"].alias("level"),
                    F.transform(F.slice(x, s + 1, F.get(at, k + 1) - s), lambda line: line["said"]).alias("said"),
                ),
            ),
        )

    return F.when(F.size(lines) > 0, let(lines, cut))


def _words(said: Column) -> Column:
    return F.array_remove(F.split(F.lower(said), r"[^\p{L}\p{N}]+"), "")


def _windows(words: Column) -> Column:
    """Every window of WINDOW words; none if there are fewer."""
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, WINDOW), " "))


def _each(said: Column) -> Column:
    """The normalised words of every string of an array."""
    return F.transform(said, lambda x: F.array_join(_words(x), " "))


def quoted_passages(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, block, level, total, passage, piece, whole) of every quoted block: 128-bit hashes of its pieces (windows and
    shorter lines, total of them) and of the block as a whole."""
    blocks = parsed.where(F.exists("lines", lambda x: x["level"] > 0)).select("conv_id", "turn", F.posexplode(_blocks(F.col("lines"))).alias("block", "b"))
    blocks = blocks.where("b.level > 0").select("conv_id", "turn", "block", "b.level", "b.said", _words(F.array_join("b.said", " ")).alias("words"))
    short = F.filter(F.transform("said", _words), lambda w: F.size(w).between(1, WINDOW - 1))
    all_of_it = F.array_join("words", " ")
    pieces = F.concat(_windows(F.col("words")), F.transform(short, lambda w: F.array_join(w, " ")), F.when(F.size("words") < WINDOW, F.array(all_of_it)).otherwise(F.array().cast("array<string>")))
    cut = blocks.where(F.size("words") > 0).select("conv_id", "turn", "block", "level", all_of_it.alias("all_of_it"), F.array_distinct(pieces).alias("pieces"))
    units = cut.select(
        "conv_id", "turn", "block", "level", F.size("pieces").alias("total"), "all_of_it", "pieces", F.explode(F.array_union("pieces", F.array("all_of_it"))).alias("unit")
    )
    piece = (F.col("unit") != F.col("all_of_it")) | F.array_contains("pieces", F.col("all_of_it"))
    return units.select(
        "conv_id", "turn", "block", "level", "total", F.md5("unit").alias("passage"), piece.alias("piece"), (F.col("unit") == F.col("all_of_it")).alias("whole")
    ).distinct()


def own_passages(parsed: DataFrame) -> DataFrame:
    """(conv_id, passage, origin): the first turn that says a passage as its own text."""
    own = F.filter(_blocks(F.col("lines")), lambda b: b["level"] == 0)
    texts = F.transform(own, lambda b: F.array_join(b["said"], "\n"))
    lines = F.flatten(F.transform(own, lambda b: b["said"]))
    sentences = F.flatten(F.transform(texts, lambda t: F.split(t, r"[.!?\n]+")))
    windows = F.flatten(F.transform(texts, lambda t: let(_words(t), _windows)))
    units = F.concat(windows, _each(lines), _each(sentences), _each(texts), _each(F.array(F.array_join(lines, "\n"))))
    found = parsed.select("conv_id", "turn", F.explode(F.array_distinct(units)).alias("unit")).where("unit != ''")
    return found.groupBy("conv_id", F.md5("unit").alias("passage")).agg(F.min("turn").alias("origin"))


def parents(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, parent) for every message that quotes an earlier one."""
    quoted = write_stage(quoted_passages(parsed.where("conv_id is not null and turn is not null")), "quoted")
    talks = write_stage(quoted.select("conv_id").distinct(), "talks")
    # Written, so that the join can split a passage that very many messages quote.
    first = write_stage(own_passages(parsed.join(talks, "conv_id", "left_semi")), "origins")
    met = quoted.join(first, ["conv_id", "passage"]).where("origin < turn")
    blocks = met.groupBy("conv_id", "turn", "block", "level", "total", "origin").agg(
        F.sum(F.col("piece").cast("long")).alias("n"), F.max("whole").alias("whole")
    )
    held = blocks.where(F.col("whole") | (2 * F.col("n") >= F.col("total")) | (F.col("n") >= LEAST))
    strength = held.groupBy("conv_id", "turn", "origin").agg(F.min("level").alias("level"), F.max("whole").alias("whole"), F.sum("n").alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("level"), "whole", "n", "origin"))
    return strength.groupBy("conv_id", "turn").agg(best.alias("best")).select("conv_id", "turn", F.col("best.origin").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root): each round doubles the number of links that a pointer leaps."""
    pointers = write_stage(links.select("conv_id", "turn", F.col("parent").alias("root")), "threads")
    while True:
        up = pointers.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"))
        leapt = write_stage(pointers.join(up, ["conv_id", "root"], "left"), "threads")
        pointers = leapt.select("conv_id", "turn", F.coalesce("next", "root").alias("root"))
        if leapt.where("next is not null").isEmpty():
            return pointers


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, text without quotes, quote_depth, parent, thread, position (from 0)."""
    rows = messages.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    parsed = parse(rows)
    links = write_stage(parents(parsed), "reply-links")
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["said"]), "\n")
    deep = F.array_max(F.transform("lines", lambda x: x["level"])).cast("long")
    clean = F.when(F.col("text").isNull(), None).when(deep > 0, F.btrim(own, F.lit(" \t\n"))).otherwise(F.col("text"))
    said = parsed.select("conv_id", "turn", "role", clean.alias("text"), deep.alias("quote_depth"))
    threaded = said.join(links, ["conv_id", "turn"], "left").join(roots(links), ["conv_id", "turn"], "left")
    return number_rows(threaded.withColumn("thread", F.coalesce("root", "turn")).drop("root"), ["conv_id"], ["thread", "turn", "role", "text"], "position", ordered=True)
