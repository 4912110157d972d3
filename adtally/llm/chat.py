"""Chat formatting: turns to one marked text per conversation, and back.

A run of turns of one role becomes one block.  A block of the trained role is
``<s>role\\ntext</s>``, any other ``[INST]role\\ntext[/INST]``; the texts inside a block are
kept apart by ``[NEXT]``, so the single turns can be read back.  A control string inside a
text gets a backslash after its first character (one more if it has some already), which
is undone on reading.

Only Spark expressions are used.  A conversation is sorted and formatted in chunks of turn
numbers first, so that one with very many turns is spread over tasks, and the chunks are
then joined to one array of segments.  The array itself is one value of one row, as any
formatted conversation must be, which bounds a conversation to Spark's 2 GB a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRAINED = "assistant"
CHUNK = 256
# The control strings without their first character.
_TAIL = r"(/?s>|/?INST\]|NEXT\]|NL\])"


def escape(text: Column) -> Column:
    """``text`` without any control string; undone by :func:`unescape`."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, r"$1$2$3")


def _opened(role: Column, trained: str) -> Column:
    name = F.replace(escape(role), F.lit("\n"), F.lit("[NL]"))
    return F.concat(F.when(role == trained, "<s>").otherwise("[INST]"), name, F.lit("\n"))


def _closed(role: Column, trained: str) -> Column:
    return F.when(role == trained, "</s>").otherwise("[/INST]")


def _between(before: Column, role: Column, trained: str) -> Column:
    """What stands between two neighbouring turns."""
    return F.when(before == role, "[NEXT]").otherwise(F.concat(_closed(before, trained), _opened(role, trained)))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_chat(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", trained: str = TRAINED, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: its id, ``n_turns``, ``n_blocks`` and ``segments``.

    The formatted text is the concatenation of the segments' ``text`` (:func:`formatted`);
    ``loss`` marks those that are trained on, one per turn of the ``trained`` role.

    Turns stand in the order of their number, a null number first; ties go by role, then
    text.  Repeated rows are repeated turns.  A null role or text counts as empty; a null
    id is a conversation of its own.  No rows give no rows; other columns are ignored.
    """
    rows = turns.select(
        F.col(conversation).alias("_c"), F.floor(F.col(turn) / chunk).alias("_k"), F.col(turn).alias("n"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chunks = rows.groupBy("_c", "_k").agg(F.array_sort(F.collect_list(F.struct("n", "role", "text"))).alias("t"))

    def pieces(t: Column, i: Column) -> Column:
        before = F.element_at(F.col("t"), F.greatest(i, F.lit(1)))["role"]  # of the turn at index i - 1
        lead = F.when(i == 0, "").otherwise(_between(before, t["role"], trained))
        return F.array(_segment(lead, F.lit(False)), _segment(escape(t["text"]), t["role"] == trained))

    last = F.element_at("t", -1)["role"]
    runs = F.aggregate("t", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("role")),
                       lambda a, t: F.struct((a["n"] + F.when(a["role"] == t["role"], 0).otherwise(1)).alias("n"),
                                             t["role"].alias("role")), lambda a: a["n"])
    parts = chunks.select("_c", F.struct(
        F.col("_k"), F.col("t")[0]["role"].alias("first"), last.alias("last"), runs.alias("runs"),
        F.size("t").cast("bigint").alias("n"), F.flatten(F.transform("t", pieces)).alias("segments")).alias("p"))
    whole = parts.groupBy("_c").agg(F.array_sort(F.collect_list("p")).alias("p"))

    def joined(p: Column, i: Column) -> Column:
        before = F.element_at(F.col("p"), F.greatest(i, F.lit(1)))["last"]
        lead = F.when(i == 0, _opened(p["first"], trained)).otherwise(_between(before, p["first"], trained))
        return F.concat(F.array(_segment(lead, F.lit(False))), p["segments"])

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("b"), F.lit(None).cast("string").alias("role"))
    counts = F.aggregate("p", zero, lambda a, p: F.struct(
        (a["n"] + p["n"]).alias("n"), (a["b"] + p["runs"] - F.when(a["role"] == p["first"], 1).otherwise(0)).alias("b"),
        p["last"].alias("role")))
    end = F.array(_segment(_closed(F.element_at("p", -1)["last"], trained), F.lit(False)))
    return whole.select(F.col("_c").alias(conversation), counts.alias("k"),
                        F.concat(F.flatten(F.transform("p", joined)), end).alias("segments")).select(
        conversation, F.col("k.n").alias("n_turns"), F.col("k.b").alias("n_blocks"), "segments")


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(text: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>."""
    def turns(block: Column) -> Column:
        inner = F.regexp_replace(block, r"^(\[INST\]|<s>)", "")
        name = F.substring_index(inner, "\n", 1)
        role = unescape(F.replace(name, F.lit("[NL]"), F.lit("\n")))
        body = F.substring(inner, F.length(name) + 2, F.length(inner))
        return F.transform(F.split(body, r"\[NEXT\]"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(text, r"\[/INST\]|</s>")
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))
