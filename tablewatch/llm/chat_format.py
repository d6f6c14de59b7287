"""Chat formatting in budgeted windows.

Conversations become training texts of at most ``budget`` tokens.  Prefix sums
of the turns' tokens deal each conversation's turns to spans: a turn belongs to
the span ``floor(tokens before it / stride)``, with ``stride`` half of what the
budget leaves beside the system turn and the repeated history, so that a span
of turns no longer than a stride always fits (a longer turn makes an
``over_budget`` window, turns are never cut).  A window is

    the leading system turn, the last turns before the span worth at most
    ``history`` tokens, the span's own turns

and its loss mask covers the texts of the span's own assistant turns, so every
assistant text is a target exactly once.

Prefix sums are made in two levels: rows are range-partitioned by conversation
and turn (a long conversation spreads over many partitions), each partition
adds up its own, and one small row per partition carries the sums on.

The template marks a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside
texts and roles every ``<``, any backslashes and ``|`` in a row get one more
backslash, and roles escape line breaks, so no text can contain a marker and
everything reads back exactly.

Defined cases: null texts and roles are empty; rows that tie on the turn are
ordered by role and text; repeated rows are turns of their own; a null
conversation id is a conversation; only a conversation's first turn can be its
system turn; a conversation of a system turn alone has one window; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import write_scratch
from tablewatch.llm.quality_rules import BYTE_PATTERN, TOKENIZERS

BUDGET, HISTORY = 1024, 256
OVERHEAD = 6  # tokens of a turn's markers and role
PIECE = 400  # characters encoded at a time
START, END = "<|im_start|>", "<|im_end|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def _sums(turns: DataFrame, tokenizers: str) -> DataFrame:
    """Turns in order with their tokens, their place in the conversation and
    the tokens before them."""
    with open(f"{tokenizers}/byte_bpe_50k.tiktoken", "rb") as f:
        shared = turns.sparkSession.sparkContext.broadcast(f.read())  # one file, 0.8 MB
    ordered = (turns.select("conv", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                            F.monotonically_increasing_id().alias("u"))
               .repartitionByRange("conv", "turn", "role", F.xxhash64("text"), "u")
               .sortWithinPartitions("conv", "turn", "role", "text", "u").drop("u"))
    schema = T.StructType(ordered.schema.fields + [T.StructField(n, T.LongType()) for n in ("tokens", "part", "seq", "place", "upto")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("turns", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        part, seq, conv, place, upto = TaskContext.get().partitionId(), 0, object(), 0, 0
        for batch in batches:
            out = []
            for c, text in zip(batch.column("conv").to_pylist(), batch.column("text").to_pylist()):
                text = escape(text)
                n = OVERHEAD + sum(len(encoding.encode_ordinary(text[k:k + PIECE])) for k in range(0, len(text), PIECE))
                if c != conv:
                    conv, place, upto = c, 0, 0
                upto += n
                out.append((n, part, seq, place, upto))
                place += 1
                seq += 1
            numbers = np.array(out, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(numbers[:, k]) for k in range(5)]], names=schema.names)

    rows = write_scratch(ordered.mapInArrow(run, schema), "chat-turns")
    ends = rows.groupBy("part").agg(F.min_by("conv", "seq").alias("first"), F.max_by(F.struct("conv", "place", "upto"), "seq").alias("last")) \
        .orderBy("part").collect()  # one row per partition
    carried, carry = [], None
    for r in ends:
        n0, t0 = (carry[1], carry[2]) if carry and carry[0] == r["first"] else (0, 0)
        carried.append((r["part"], r["first"], n0, t0))
        conv, place, upto = r["last"]
        more = (n0, t0) if conv == r["first"] else (0, 0)
        carry = (conv, place + 1 + more[0], upto + more[1])
    schema = T.StructType([T.StructField("part0", T.LongType()), T.StructField("conv0", rows.schema["conv"].dataType),
                           T.StructField("n0", T.LongType()), T.StructField("t0", T.LongType())])
    starts = rows.sparkSession.createDataFrame(carried, schema)
    return (rows.join(F.broadcast(starts), (F.col("part") == F.col("part0")) & F.col("conv").eqNullSafe(F.col("conv0")), "left")
            .select("conv", "turn", "role", "text", "tokens", (F.col("place") + F.coalesce("n0", F.lit(0))).alias("place"),
                    (F.col("upto") + F.coalesce("t0", F.lit(0)) - F.col("tokens")).alias("before")))


_WINDOW = [("formatted", T.StringType()), ("loss", T.ArrayType(T.ArrayType(T.IntegerType()))), ("n_repeated", T.IntegerType()),
           ("n_own", T.IntegerType()), ("tokens", T.LongType()), ("over_budget", T.BooleanType())]


def windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            budget: int = BUDGET, history: int = HISTORY, tokenizers: str = TOKENIZERS) -> DataFrame:
    """One row per window: conversation, window, formatted text, loss mask
    (start and length of each target in code points), counts."""
    turns = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = _sums(turns, tokenizers)  # a scan of what it has written
    lead = F.col("place").eqNullSafe(F.lit(0)) & (F.col("role") == "system")
    heads = rows.filter(lead).select(F.col("conv").alias("hc"), F.col("tokens").alias("ht"), F.struct("place", "role", "text", "tokens").alias("head"))
    body = rows.filter(~lead).join(heads.select("hc", "ht"), F.col("conv").eqNullSafe(F.col("hc")), "left").drop("hc")
    head_tokens = F.coalesce("ht", F.lit(0))
    stride = F.greatest(F.lit(1), F.floor((F.lit(budget) - head_tokens - history) / 2)).cast("long")
    body = body.withColumn("before", F.col("before") - head_tokens).withColumn("stride", stride) \
        .withColumn("w", F.floor(F.col("before") / F.col("stride")))
    turn = F.struct("place", "role", "text", "tokens")
    own = body.select("conv", "w", turn.alias("t"), F.lit(True).alias("mine"))
    # A turn may be history of the spans that begin within the next ``history`` tokens.
    starts = body.groupBy("conv", "w").agg(F.min("before").alias("begin")).select(F.col("conv").alias("c"), F.col("w").alias("v"), "begin")
    reach = F.floor((F.col("before") + history) / F.col("stride"))
    past = (body.filter(reach > F.col("w")).withColumn("to", F.explode(F.sequence(F.col("w") + 1, reach)))
            .join(starts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("to") == F.col("v")))
            .filter(F.col("begin") - F.col("before") <= history)
            .select("conv", F.col("to").alias("w"), turn.alias("t"), F.lit(False).alias("mine")))
    # Windows with a system turn; one that stands alone makes window 0.
    spans = starts.select("c", "v").unionAll(heads.select(F.col("hc").alias("c"), F.lit(0).cast("long").alias("v"))).distinct()
    first = spans.groupBy("c").agg(F.min("v").alias("v0"))
    retained = (heads.join(spans, F.col("hc").eqNullSafe(F.col("c")))
                .join(first.withColumnRenamed("c", "c0"), F.col("hc").eqNullSafe(F.col("c0")))
                .select(F.col("hc").alias("conv"), F.col("v").alias("w"), F.col("head").alias("t"), (F.col("v") == F.col("v0")).alias("mine")))
    packed = own.unionAll(past).unionAll(retained).groupBy("conv", "w").agg(F.sort_array(F.collect_list(F.struct("t", "mine"))).alias("turns"))
    schema = T.StructType([T.StructField(conv_col, rows.schema["conv"].dataType), T.StructField("window", T.LongType())]
                          + [T.StructField(n, k) for n, k in _WINDOW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for turns_ in batch.column("turns").to_pylist():
                text, at, loss, total = [], 0, [], 0
                for x in turns_:
                    t = x["t"]
                    opening = f"{START}{escape_role(t['role'])}\n"
                    body_ = escape(t["text"])
                    if x["mine"] and t["role"] == "assistant":
                        loss.append([at + len(opening), len(body_)])
                    text += [opening, body_, END, "\n"]
                    at += len(opening) + len(body_) + len(END) + 1
                    total += t["tokens"]
                mine = sum(x["mine"] for x in turns_)
                out.append(("".join(text), loss, len(turns_) - mine, mine, total, total > budget))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("w"), pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.list_(pa.list_(pa.int32()))), pa.array([x[2] for x in out], pa.int32()),
                 pa.array([x[3] for x in out], pa.int32()), pa.array([x[4] for x in out], pa.int64()),
                 pa.array([x[5] for x in out], pa.bool_())], names=schema.names)

    return packed.mapInArrow(run, schema)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of a formatted text."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its windows: turns, targets and their
    SHA-256.  A digest runs over a conversation from end to end, so its windows
    pass one task in order; they are streamed, only the hash state is held."""
    ordered = formatted.select(F.col(conv_col).alias("conv"), "window", "formatted", "loss", "n_repeated") \
        .repartition("conv").sortWithinPartitions("conv", "window")
    schema = T.StructType([T.StructField(conv_col, formatted.schema[conv_col].dataType), T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
                           T.StructField("n_windows", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, state = nothing, None

        def row() -> tuple:
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=schema.names)

        kind = pa.int64()
        for batch in batches:
            kind, rows = batch.schema.field("conv").type, []
            for r in batch.to_pylist():
                if r["conv"] != conv or conv is nothing:
                    if conv is not nothing:
                        rows.append(row())
                    conv, state = r["conv"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                text = r["formatted"]
                for role, said in read_back(text)[r["n_repeated"]:]:  # the repeated ones stand first
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for at, n in r["loss"]:
                    said = unescape(text[at:at + n])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += 1
            if rows:
                yield made(rows)
        if conv is not nothing:
            yield made([row()])

    return ordered.mapInArrow(run, schema)
