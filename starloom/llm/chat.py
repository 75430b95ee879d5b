"""Chat formatting from an event log, with DataFrame operations only.

The log has one row per event: conv_id, seq, kind, turn, role, text. Kinds:

* ``message`` and ``edit`` set the text of a turn, whatever it held;
* ``delta`` appends to the text of a turn;
* ``regenerate`` does what ``edit`` does, and drops all that later turns held so far.

Folding needs no loop over events: an event counts if no later event has reset its turn and no
later ``regenerate`` hit an earlier turn. Conversations are partitioned once, and folding,
offsets and rendering reuse that partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import staged


@dataclass(frozen=True)
class Template:
    """How a turn is written: begin head role tail text end. ``mark`` escapes itself and these strings."""

    begin: str = "<s>"
    head: str = "[INST]"
    tail: str = "[/INST]"
    end: str = "</s>"
    mark: str = "~"
    learned: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[tuple[str, str]]:
        """Each string that texts may not hold, and what stands for it; the mark first."""
        strings = (self.mark, self.begin, self.head, self.tail, self.end)
        return [(s, f"{self.mark}{k}") for k, s in enumerate(strings)]

    def escaped(self, text: Column) -> Column:
        for string, code in self.controls():
            text = F.replace(text, F.lit(string), F.lit(code))
        return text

    def unescaped(self, text: Column) -> Column:
        for string, code in reversed(self.controls()):
            text = F.replace(text, F.lit(code), F.lit(string))
        return text


def fold_events(log: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the final messages of ``log``.

    Events of one conversation are ordered by seq; ties and nulls in seq count as one moment,
    in which texts join in their own order. role is that of the turn's latest event. Null
    text and null role are empty, an unknown or null kind is a ``delta``. Null conv_id is a
    conversation, null turn a turn of its own before all others. Empty log: no rows.
    """
    kind, seq = F.coalesce("kind", F.lit("delta")), F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 62)))
    events = log.select(
        F.col("conv_id").cast("long"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"),
        seq.alias("seq"),
        kind.alias("kind"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).repartition("conv_id")
    resets = F.when(F.col("kind").isin("message", "edit", "regenerate"), F.col("seq"))
    redone = F.when(F.col("kind") == "regenerate", F.col("seq"))
    own = Window.partitionBy("conv_id", "turn")
    before = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    counted = (
        events.withColumns({"reset": F.max(resets).over(own), "dropped": F.max(redone).over(before)})
        .where("reset IS NULL OR seq >= reset")
        .where("dropped IS NULL OR seq > dropped")
    )
    parts = F.array_sort(F.collect_list(F.struct("seq", F.when(F.col("kind").isin("message", "edit", "regenerate"), 0).otherwise(1).alias("late"), "text", "role")))
    return counted.groupBy("conv_id", "turn").agg(parts.alias("parts")).select(
        "conv_id", "turn", F.element_at("parts", -1)["role"].alias("role"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")
    )


def render(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, loss) of ``messages`` (conv_id, turn, role, text), turns in order.

    loss holds (start, length) in code points of each text of a learned role, escaped as
    it stands in ``formatted``. Texts that hold control strings are escaped reversibly.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    written = messages.withColumns(
        {
            "opening": F.concat(F.lit(template.begin + template.head), template.escaped(F.col("role")), F.lit(template.tail)),
            "body": template.escaped(F.col("text")),
        }
    ).withColumn("segment", F.concat("opening", "body", F.lit(template.end)))
    placed = written.withColumns(
        {
            "at": F.row_number().over(order),
            "start": F.coalesce(F.sum(F.length("segment")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")),
        }
    )
    span = F.when(F.col("role").isin(*template.learned), F.struct((F.col("start") + F.length("opening")).alias("start"), F.length("body").cast("long").alias("length")))
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "segment"))).alias("turns"), F.array_sort(F.collect_list(span)).alias("loss"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"), "loss")


def parse(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns of rendered conversations: conv_id, at (from 0), role, text, learned (lies under the loss mask).

    The reverse of ``render``: splits at the control strings, unescapes, and holds each text's
    place against the mask, in one pass over the string.
    """
    quoted = "\\Q" + template.end + "\\E"
    pieces = formatted.select("conv_id", F.posexplode(F.split("formatted", quoted, -1)).alias("at", "piece"))
    lead = len(template.begin + template.head)
    head = F.substring_index("piece", template.tail, 1)
    before = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    turns = pieces.withColumns(
        {
            "start": F.coalesce(F.sum(F.length("piece") + len(template.end)).over(before), F.lit(0).cast("long")) + F.length(head) + len(template.tail),
            "length": (F.length("piece") - F.length(head) - len(template.tail)).cast("long"),
            "head": F.substring(head, lead + 1, 1 << 30),
            "body": F.expr(f"substring(piece, length(substring_index(piece, '{template.tail}', 1)) + {len(template.tail) + 1})"),
        }
    ).where("piece != ''")
    mask = formatted.select(F.col("conv_id").alias("mask_id"), F.explode("loss").alias("span")).select(
        "mask_id", F.col("span.start").alias("mask_start"), F.col("span.length").alias("mask_length")
    )
    hit = F.col("conv_id").eqNullSafe(F.col("mask_id")) & (F.col("start") == F.col("mask_start")) & (F.col("length") == F.col("mask_length"))
    return turns.join(mask, hit, "left").select(
        "conv_id", "at", template.unescaped(F.col("head")).alias("role"), template.unescaped(F.col("body")).alias("text"), F.col("mask_start").isNotNull().alias("learned")
    )


def format_log(log: DataFrame, template: Template = Template()) -> DataFrame:
    """``fold_events`` and ``render``, written to the shared folder: conv_id, formatted, loss."""
    return staged(render(fold_events(log), template), "chat")


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back from ``formatted``: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = parse(formatted, template).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text", "learned"))).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.array_join(F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: t["text"]), "").alias("loss"),
    )
    sizes = formatted.select(F.col("conv_id").alias("size_id"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.join(sizes, F.col("conv_id").eqNullSafe(F.col("size_id"))).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"
    )
