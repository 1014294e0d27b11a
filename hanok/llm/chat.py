"""Dialogues from each speaker's point of view, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hanok.llm.shared import written

MAX_CHARS = 1 << 25  # characters of a rendering, beyond which a dialogue does not fit in one row and is cut between turns
BLOCK = 1024  # turns whose places are added up at a time
# How a turn is written.
BEGIN, END = "<|im_start|>", "<|im_end|>"
NARRATOR = "system"  # speaks to all and has no point of view of its own


def _speakers(said: DataFrame, narrator: str) -> DataFrame:
    return said.where(F.col("role") != narrator).groupBy("conv_id").agg(F.sort_array(F.collect_set("role")).alias("speakers"))


def _cut(said: DataFrame, max_chars: int) -> DataFrame:
    """(conv_id, part, turns) of long dialogues, cut where ``max_chars`` are full.

    Copies are counted before anything is gathered, and lengths are added up within ranges of rows and then over the ranges.
    """
    rows = said.groupBy("conv_id", "turn", "role", "text", "chars").agg(F.count(F.lit(1)).alias("copies"))
    full = F.greatest(F.lit(1), F.floor(F.lit(max_chars) / F.col("chars")))
    rows = rows.withColumn("full", full).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.col("full"))))
    rows = rows.withColumn("times", F.least("full", F.col("copies") - F.col("first")))
    order = ["turn", "role", "text", "first"]
    rows = rows.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id())
    rows = written(rows.select("conv_id", *order, "times", (F.col("times") * F.col("chars")).alias("size"), "range"), "dialogues")
    key = ["conv_id", "range"]
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(*key).agg(F.sum("size").alias("size")).select(*key, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0))).join(ranges, key)
    pieces = rows.groupBy("conv_id", F.floor((F.col("start") + F.col("at")) / max_chars).alias("full")).agg(
        F.sort_array(F.collect_list(F.struct(*order, "times"))).alias("turns")
    )
    pieces = written(pieces, "dialogues")
    nth = Window.partitionBy("conv_id").orderBy("full")
    numbered = pieces.join(pieces.select("conv_id", "full", (F.row_number().over(nth) - 1).cast("long").alias("part")), ["conv_id", "full"])
    one = F.transform(F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["times"].cast("int")))), lambda t: F.struct(t["turn"], t["role"], t["text"]))
    return numbered.select("conv_id", "part", one.alias("turns"))


def _dialogues(said: DataFrame, narrator: str, max_chars: int) -> DataFrame:
    """(conv_id, part, speakers, turns), the turns in order; a dialogue that fits in a row has one part, and is shuffled once."""
    large = written(said.groupBy("conv_id").agg(F.sum("chars").alias("chars")).where(F.col("chars") > max_chars).select("conv_id"), "dialogues")
    some = not large.isEmpty()
    short = said.join(large, "conv_id", "left_anti") if some else said
    whole = short.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    roles = F.array_except(F.transform("turns", lambda t: t["role"]), F.array(F.lit(narrator)))
    whole = whole.select("conv_id", F.lit(0).cast("long").alias("part"), roles.alias("speakers"), "turns")
    if not some:
        return whole
    long_ones = said.join(large, "conv_id", "left_semi")
    cut = _cut(long_ones, max_chars).join(_speakers(long_ones, narrator), "conv_id")
    return whole.unionByName(cut)


def perspectives(turns: DataFrame, narrator: str = NARRATOR, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per dialogue, participant and part: conv_id, part, speaker, text, masks, n_turns, n_own.

    ``turns`` has conv_id, turn, role, text. Each participant of a dialogue (every role but the narrator's) is the assistant of one
    rendering of the whole dialogue; the others speak as users under their names, the narrator as system. ``masks`` lists the
    stretches that the participant says, ``start:end`` in code points of ``text``, end exclusive and comma-joined: what is learned from.

    Turns follow by number, those with the same number by role and text. A null text is empty. A null turn counts as -1, a null
    role as the narrator's, and turns without conv_id belong to no dialogue. Repeated rows are said again. A dialogue has one part, 0,
    however many turns it has; only where it has more than ``max_chars`` characters and fits in no row it goes on in further
    parts, cut between turns.
    """
    said = turns.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit(narrator)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    said = said.withColumn("chars", (F.char_length("text") + F.char_length("role") + len(f"{BEGIN}user name=\n{END}\n")).cast("long"))
    seen = _dialogues(said, narrator, max_chars).withColumn("speaker", F.explode("speakers")).drop("speakers")

    def head(t):
        return (
            F.when(t["role"] == F.col("speaker"), F.lit(f"{BEGIN}assistant\n"))
            .when(t["role"] == narrator, F.lit(f"{BEGIN}{narrator}\n"))
            .otherwise(F.concat(F.lit(f"{BEGIN}user name="), t["role"], F.lit("\n")))
        )

    pieces = F.transform("turns", lambda t: F.struct(head(t).alias("head"), t["text"].alias("said"), (t["role"] == F.col("speaker")).alias("own")))
    seen = seen.withColumn("pieces", pieces)
    tail = f"{END}\n"

    def step(acc, p):
        start = acc["at"] + F.char_length(p["head"])
        end = start + F.char_length(p["said"])
        span = F.struct(start.alias("start"), end.alias("end"))
        spans = F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((end + len(tail)).alias("at"), spans.alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("pieces") - 1) / BLOCK).cast("int")), lambda n: F.aggregate(F.slice(F.col("pieces"), n * BLOCK + 1, F.lit(BLOCK)), none, step))

    def onward(acc, block):
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    seen = seen.withColumn("blocks", blocks)
    seen = seen.withColumn("starts", F.aggregate("blocks", first, onward)["starts"])
    place = lambda s, at: F.concat_ws(":", (s["start"] + at).cast("string"), (s["end"] + at).cast("string"))
    spans = F.flatten(F.zip_with("blocks", "starts", lambda b, at: F.transform(b["spans"], lambda s: place(s, at))))
    return seen.select(
        "conv_id",
        "part",
        "speaker",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["said"], F.lit(tail))), "").alias("text"),
        F.array_join(spans, ",").alias("masks"),
        F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
    )
