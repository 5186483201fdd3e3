"""Chats as prefix trees: turns shared by several conversations are emitted once.

Every conversation is a path of turns. Equal conversations are one path. Paths are ordered by the
chained hashes of their turns, which puts those with the same initial turns next to each other: the
order is a depth-first walk of all trees, and it is dealt out by ranges, so that a first turn which
very many conversations share is worked on by many tasks. Each task compares a path with the one
before it, by the turns themselves, and emits only what is new. A block of output ends at
``block_tokens``; a tree that goes on in the next block repeats the ancestors it still needs there.

A block holds the tokens of its nodes one after another. A node has its place, its parent, the
position id of its first token (the number of tokens of its ancestors) and the intervals of tokens
that it may attend to: its ancestors, joined where they are neighbours, and itself, causally.
``loss`` is the interval of an assistant's text.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is put into
every ``<|``, ``<\\|``, ``<\\\\|`` ..., so no text can hold a control string, and taking one away
restores it. Turns are encoded in three parts, so tokens never cross the ends of a text.

A null text or role counts as empty. Turns of one number are ordered by role and text; a null
number comes first. Null conversation ids make one conversation. Other columns are ignored, an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.words import bounded_batches
from postlane.shared import settle

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
BLOCK_TOKENS = 65_536
NODE = (
    "struct<parent: int, first: int, length: int, position: int, loss_first: int, "
    "loss_length: int, attends: array<struct<first: int, last: int>>, path: string>"
)
BLOCKS = f"tokens array<int>, nodes array<{NODE}>"
READ = (
    "path string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], unescape(role))


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """The formatted turn: what stands before the text, the text, and what follows."""
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        if not rest.endswith(f"{END}\n"):
            raise ValueError("a turn does not end")
        turns.append((unescape_role(role), unescape(rest[: -len(END) - 1])))
    return turns


def paths(
    conversations: DataFrame, conv_id: str, turn: str, role: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """Which path each conversation takes, and the different paths with their turns.

    ``steps`` holds, per turn, the hash of the conversation up to there.
    """
    turns = bounded_batches(conversations).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("one"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    whole = whole.select(
        "conv_id",
        F.transform("turns", lambda one: F.struct(one["role"].alias("role"), one["text"].alias("text"))).alias("turns"),
    )
    chained = F.aggregate(
        "turns",
        F.array().cast("array<string>"),
        lambda done, one: F.concat(
            done,
            F.array(
                F.sha2(
                    F.concat_ws(
                        "\n",
                        F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")),
                        F.sha2(one["role"], 256),
                        F.sha2(one["text"], 256),
                    ),
                    256,
                )
            ),
        ),
    )
    whole = settle(whole.withColumn("steps", chained).withColumn("path", F.element_at("steps", -1)), "chats")
    different = whole.groupBy("path").agg(F.first("steps").alias("steps"), F.first("turns").alias("turns"))
    return whole.select("conv_id", "path"), different


def build_blocks(different: DataFrame, tokenizer: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block: its tokens and its nodes."""
    ordered = different.repartitionByRange("steps").sortWithinPartitions("steps").select("path", "turns")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        kind = pa.schema(
            [
                ("tokens", pa.list_(pa.int32())),
                (
                    "nodes",
                    pa.list_(
                        pa.struct(
                            [
                                *((name, pa.int32()) for name in (
                                    "parent", "first", "length", "position", "loss_first", "loss_length"
                                )),
                                ("attends", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                                ("path", pa.string()),
                            ]
                        )
                    ),
                ),
            ]
        )
        tokens: list[int] = []
        nodes: list[dict] = []
        stack: list[tuple[tuple[str, str], tuple[list[int], ...], int]] = []

        def encoded(role: str, text: str) -> tuple[list[int], ...]:
            return tuple(encoder.encode(part, add_special_tokens=False).ids for part in turn_parts(role, text))

        def emit(key: tuple[str, str], parts: tuple[list[int], ...], depth: int) -> None:
            parent = stack[depth - 1][2] if depth else -1
            above = nodes[parent] if depth else None
            first, length = len(tokens), sum(map(len, parts))
            attends = []
            if above is not None:
                attends = [dict(one) for one in above["attends"]]
                last = above["first"] + above["length"]
                if attends and attends[-1]["last"] == above["first"]:
                    attends[-1]["last"] = last
                else:
                    attends.append({"first": above["first"], "last": last})
            spoken = key[0] == ASSISTANT
            nodes.append(
                {
                    "parent": parent,
                    "first": first,
                    "length": length,
                    "position": above["position"] + above["length"] if above else 0,
                    "loss_first": first + len(parts[0]) if spoken else first,
                    "loss_length": len(parts[1]) if spoken else 0,
                    "attends": attends,
                    "path": None,
                }
            )
            for part in parts:
                tokens.extend(part)
            stack[depth:] = [(key, parts, len(nodes) - 1)]

        def finish() -> pa.RecordBatch:
            row = pa.RecordBatch.from_pylist([{"tokens": tokens, "nodes": nodes}], kind)
            tokens.clear(), nodes.clear()
            return row

        for batch in batches:
            for path, turns in zip(batch.column(0), batch.column(1)):
                keys = [(one["role"], one["text"]) for one in turns.as_py()]
                same = 0
                while same < min(len(keys), len(stack)) and stack[same][0] == keys[same]:
                    same += 1
                del stack[same:]
                if len(tokens) >= block_tokens:
                    yield finish()
                    again = [entry[:2] for entry in stack]
                    stack.clear()
                    for depth, (key, parts) in enumerate(again):
                        emit(key, parts, depth)
                for depth in range(same, len(keys)):
                    emit(keys[depth], encoded(*keys[depth]), depth)
                nodes[stack[-1][2]]["path"] = path.as_py()
        if nodes:
            yield finish()

    return settle(ordered.mapInArrow(build, BLOCKS), "chat-blocks")


def read_blocks(blocks: DataFrame, tokenizer: str) -> DataFrame:
    """Per path: what its tokens say, found through the attention intervals of its last node."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        decoder = Tokenizer.from_file(tokenizer)

        def text_of(ids: np.ndarray) -> str:
            return decoder.decode(ids.tolist(), skip_special_tokens=False)

        for batch in batches:
            for at in range(batch.num_rows):
                tokens = np.asarray(batch.column(0)[at].values)
                nodes = batch.column(1)[at].as_py()
                found = []
                for number, node in enumerate(nodes):
                    if node["path"] is None:
                        continue
                    last = node["first"] + node["length"]
                    spans = [(one["first"], one["last"]) for one in node["attends"]]
                    formatted = text_of(
                        np.concatenate([tokens[a:b] for a, b in [*spans, (node["first"], last)]])
                    )
                    turns = parse_turns(formatted)
                    whole = hashlib.sha256()
                    for role, text in turns:
                        whole.update(f"{role}\n{text}\n".encode())
                    spoken, above = [], number
                    while above >= 0:
                        one = nodes[above]
                        if one["loss_length"]:
                            begin = one["loss_first"]
                            spoken.append(unescape(text_of(tokens[begin : begin + one["loss_length"]])))
                        above = one["parent"]
                    loss = "".join(reversed(spoken))
                    found.append(
                        {
                            "path": node["path"],
                            "n_turns": len(turns),
                            "turns_sha256": whole.hexdigest(),
                            "loss_chars": len(loss),
                            "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                            "formatted_chars": len(formatted),
                        }
                    )
                if found:
                    yield pa.RecordBatch.from_pylist(found)

    return blocks.mapInArrow(read, READ)


def format_chats(
    conversations: DataFrame,
    tokenizer: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Build the blocks of all conversations and read every conversation back from them."""
    members, different = paths(conversations, conv_id, turn, role, text)
    read = settle(read_blocks(build_blocks(different, tokenizer, block_tokens), tokenizer), "chats-read")
    return members.join(read, "path").drop("path")
