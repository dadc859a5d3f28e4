"""Chat formatting at the level of tokens, with a loss mask and reversible escaping.

Every turn becomes: a reserved id that opens a turn, the ids of its role line, the ids of its text, and
a reserved id that closes it.  Role and text are encoded apart, so no merge crosses their border, and
reserved ids lie above the vocabulary, so no text can produce one.  The text form of the reserved ids,
and control strings of other templates, are escaped where they occur in a role or text: a backslash is
put before them (and one more if backslashes stand there already), taken away again on reading.

Turns are encoded by as many tasks as there are; then the turns of a conversation come in order, where
prefix sums give each turn's place.  No task holds more than one turn, however long its conversation.

Null texts and roles count as empty; null turns come first; equal turns keep the order of role and text;
rows without conv_id form one conversation of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .shared import batch, by_batch, table, tidy
from .tokens import encoder, vocabulary

OPEN, CLOSE = "<|turn|>", "<|end|>"

# fixed values: control strings of common chat templates
CONTROL = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|start_header_id|>", "<|end_header_id|>",
    "<|eot_id|>", OPEN, CLOSE,
)
_CONTROL = "|".join(map(re.escape, CONTROL))
_PLAIN = re.compile(rf"(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"\\(\\*)({_CONTROL})")
LEARNED = "assistant"


def escape(text: str) -> str:
    return _PLAIN.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def encode_turns(turns: DataFrame, vocab: str) -> DataFrame:
    """conv_id, turn, role, text -> the turn's ids, and which of them the loss counts."""

    def work(rows):
        enc = encoder(vocab)
        base = enc.tokenizer.get_vocab_size()
        roles = [escape(r or "") + "\n" for r in rows.column("role").to_pylist()]
        texts = [escape(t or "") for t in rows.column("text").to_pylist()]
        heads = [ids[b[k] : b[k + 1]] for _, ids, b in enc.column(pa.array(roles, pa.string())) for k in range(len(b) - 1)]
        bodies = [ids[b[k] : b[k + 1]] for _, ids, b in enc.column(pa.array(texts, pa.string())) for k in range(len(b) - 1)]
        ids = [np.concatenate([[base], h, t, [base + 1]]).tolist() for h, t in zip(heads, bodies)]
        yield batch(
            conv_id=rows.column("conv_id"), turn=rows.column("turn"), role=rows.column("role"), text=rows.column("text"),
            ids=pa.array(ids, pa.list_(pa.int32())),
            loss_from=pa.array([1 + len(h) for h in heads], pa.int32()),
            loss_length=pa.array([len(t) if r == LEARNED else 0 for t, r in zip(bodies, rows.column("role").to_pylist())],
                                 pa.int32()),
        )

    return by_batch(
        turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"), work,
        "conv_id long, turn long, role string, text string, ids array<int>, loss_from int, loss_length int")


def format_chats(turns: DataFrame, vocab: str) -> DataFrame:
    """One row per turn: its ids, the place of its first id in the conversation, and its loss span there."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.size("ids").cast("long")
    return (
        encode_turns(turns, vocab)
        .withColumn("number", F.row_number().over(order))
        .withColumn("offset", F.sum(size).over(before) - size)
        .select(
            "conv_id", "turn", "number", "offset", "ids",
            (F.col("offset") + F.col("loss_from")).alias("loss_start"),
            (F.col("offset") + F.col("loss_from") + F.col("loss_length")).alias("loss_end"),
        )
    )


def read_back(formatted: DataFrame, vocab: str) -> DataFrame:
    """Digests of each conversation, read from its formatted ids and loss spans alone."""

    def work(batches):
        tokenizer = encoder(vocab).tokenizer
        base = tokenizer.get_vocab_size()
        state, conv, seen = None, None, False

        def result():
            n, turns, loss_n, loss, chars = state
            return (conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars)

        for rows in batches:
            done = []
            columns = [rows.column(c).to_pylist() for c in ("conv_id", "ids", "offset", "loss_start", "loss_end")]
            spans, texts = [], []
            for ids, offset, start, end in zip(*columns[1:]):
                if ids[0] != base or ids[-1] != base + 1:
                    raise ValueError("a turn lacks its reserved ids")
                spans.append((start - offset, end - offset))
                texts += [ids[1:-1], ids[start - offset : end - offset]]
            texts = tokenizer.decode_batch(texts, skip_special_tokens=False)
            for k, name in enumerate(columns[0]):
                if not seen or name != conv:
                    if seen:
                        done.append(result())
                    conv, seen, state = name, True, (0, hashlib.sha256(), 0, hashlib.sha256(), 0)
                n, turns, loss_n, loss, chars = state
                role, _, body = texts[2 * k].partition("\n")
                counted = unescape(texts[2 * k + 1])
                turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                loss.update(counted.encode("utf-8", "surrogatepass"))
                chars += len(OPEN) + len(texts[2 * k]) + len(CLOSE)
                state = (n + 1, turns, loss_n + len(counted), loss, chars)
            if done:
                yield digests(done)
        if seen:
            yield digests([result()])

    def digests(done):
        names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars".split()
        return batch(**{n: pa.array(x, pa.string() if "sha" in n else pa.int64()) for n, x in zip(names, zip(*done))})

    # the formatted rows are already dealt by conversation
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "number").mapInArrow(
        tidy(work), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_chats(turns, vocabulary()), vocabulary())
