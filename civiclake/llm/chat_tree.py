"""Chat formatting as prefix trees.

Conversations that share their first turns are merged: a turn that several of
them share is emitted once, and the turns are laid out depth first. Every node
(turn) has the position its tokens start at, counted along its own conversation,
and the intervals of its ancestors, which are all it may attend to besides
itself (one interval for each branch: ancestors that lie side by side are one). A conversation is read back by following its leaf's ancestors.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.packing import encoder
from civiclake.session import materialize

START, END, USER, USER_END, ANSWER, OTHER = "<s>", " </s>", "[INST] ", " [/INST]", "[OUT] ", "[ROLE:"
SEQUENCES = """sequence string, ids binary, position_ids binary, node_start array<int>, node_end array<int>, node_parent array<int>,
node_position array<int>, node_attends array<array<int>>, loss_start array<int>, loss_end array<int>, leaf_key array<string>, leaf_node array<int>"""


def escape(text: str) -> str:
    r"""A backslash before each ``\``, ``<``, ``[`` and ``]``: no control string is left."""
    return re.sub(r"[\\<\[\]]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def segment(role: str, text: str) -> tuple[str, str, str, bool]:
    """(head, escaped text, tail, in the loss) of one turn."""
    if role == "user":
        return START + USER, escape(text), USER_END, False
    if role == "assistant":
        return START + ANSWER, escape(text), END, True
    return START + OTHER + escape(role) + "] ", escape(text), END, False


TURN = re.compile(r"<s>\[(?:INST\] ((?:[^\\\[<]|\\.)*) \[/INST\]|OUT\] ((?:[^\\\[<]|\\.)*) </s>|ROLE:((?:[^\\\]]|\\.)*)\] ((?:[^\\\[<]|\\.)*) </s>)", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) per turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        user, answer, role, text = m.groups()
        out.append(("user", user) if user is not None else ("assistant", answer) if answer is not None else (unescape(role), text))
        at = m.end()
    return [(r, unescape(t)) for r, t in out]


def joined(intervals: list[int], start: int, end: int) -> list[int]:
    """Flat intervals with [start, end) after them; where the last one ends there it grows."""
    if intervals and intervals[-1] == start:
        return [*intervals[:-1], end]
    return [*intervals, start, end]


class Tree:
    """One sequence under construction."""

    def __init__(self, encode: Callable[[str], np.ndarray]) -> None:
        self.encode = encode
        self.ids: list[np.ndarray] = []
        self.size = 0
        self.path: list[tuple[str, int]] = []  # the open branch: (turn digest, node)
        self.cols: dict[str, list] = {k: [] for k in ("start", "end", "parent", "position", "attends", "loss_start", "loss_end", "leaf_key", "leaf_node")}

    def add(self, key: str, digests: list[str], turns: list) -> None:
        shared = 0
        while shared < min(len(self.path), len(digests)) and self.path[shared][0] == digests[shared]:
            shared += 1
        del self.path[shared:]
        c = self.cols
        for digest, turn in zip(digests[shared:], turns[shared:], strict=True):
            head, text, tail, loss = segment(turn["role"], turn["text"])
            parts = [self.encode(p) for p in (head, text, tail)]
            parent = self.path[-1][1] if self.path else -1
            begin = self.size + len(parts[0])
            c["start"].append(self.size)
            c["loss_start"].append(begin if loss else 0)
            c["loss_end"].append(begin + len(parts[1]) if loss else 0)
            c["parent"].append(parent)
            c["position"].append(0 if parent < 0 else c["position"][parent] + c["end"][parent] - c["start"][parent])
            c["attends"].append([] if parent < 0 else joined(c["attends"][parent], c["start"][parent], c["end"][parent]))
            self.ids += parts
            self.size += sum(map(len, parts))
            c["end"].append(self.size)
            self.path.append((digest, len(c["start"]) - 1))
        c["leaf_key"].append(key)
        c["leaf_node"].append(self.path[-1][1])

    def row(self) -> pd.DataFrame:
        c = self.cols
        ids = np.concatenate(self.ids).astype("<u4") if self.ids else np.empty(0, "<u4")
        positions = np.concatenate([np.arange(e - s) + p for s, e, p in zip(c["start"], c["end"], c["position"], strict=True)]).astype("<u4")
        return pd.DataFrame({"sequence": [c["leaf_key"][0]], "ids": [ids.tobytes()], "position_ids": [positions.tobytes()], "node_start": [c["start"]],
                             "node_end": [c["end"]], "node_parent": [c["parent"]], "node_position": [c["position"]], "node_attends": [c["attends"]],
                             "loss_start": [c["loss_start"]], "loss_end": [c["loss_end"]], "leaf_key": [c["leaf_key"]], "leaf_node": [c["leaf_node"]]})


def conversations(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, key, path, turns): one row per conversation. The path is one
    digest per turn; equal conversations have equal paths and keys."""
    t = F.struct(F.col(turn_col).isNull().alias("last"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(t)).alias("turns"))
    digest = F.transform("turns", lambda x: F.md5(F.concat_ws(":", F.length(x["role"]).cast("string"), x["role"], x["text"])))
    path = F.array_join(digest, "")
    return rows.select("conv_id", F.md5(path).alias("key"), path.alias("path"),
                       F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def format_trees(convs: DataFrame, tokenizer: str, *, sequence_tokens: int = 32_768) -> DataFrame:
    """Sequences of token ids with their trees (see ``SEQUENCES``).

    Equal conversations are one leaf. Conversations are sorted by their path over
    range partitions, so the ones that share turns meet, and a first turn that a
    third of all conversations share is spread over many tasks. A tree is closed
    when its first turn changes or it holds ``sequence_tokens``; the next sequence
    then repeats the turns it shares. One conversation is held whole.
    """
    one = convs.groupBy("path", "key").agg(F.any_value("turns").alias("turns"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        tree = Tree(encode)
        for pdf in frames:
            for key, path, turns in zip(pdf["key"], pdf["path"], pdf["turns"], strict=True):
                digests = [path[i:i + 32] for i in range(0, len(path), 32)]
                if tree.path and (tree.path[0][0] != digests[0] or tree.size >= sequence_tokens):
                    yield tree.row()
                    tree = Tree(encode)
                tree.add(key, digests, list(turns))
        if tree.path:
            yield tree.row()

    return materialize(one.repartitionByRange("path").sortWithinPartitions("path").mapInPandas(run, SEQUENCES), "chat-sequences")


def read_back(sequences: DataFrame, tokenizer: str) -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of
    every leaf, from the token ids alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = decoder(tokenizer)
        for pdf in frames:
            rows = []
            for s in pdf.itertuples(index=False):
                ids = np.frombuffer(s.ids, "<u4")
                for key, leaf in zip(s.leaf_key, s.leaf_node, strict=True):
                    nodes = [leaf]
                    while s.node_parent[nodes[-1]] >= 0:
                        nodes.append(s.node_parent[nodes[-1]])
                    nodes.reverse()
                    text = decode(np.concatenate([ids[s.node_start[n]:s.node_end[n]] for n in nodes]))
                    loss = "".join(unescape(decode(ids[s.loss_start[n]:s.loss_end[n]])) for n in nodes)
                    turns = parse(text)
                    said = "".join(f"{r}\n{t}\n" for r, t in turns)
                    rows.append((key, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(rows, columns=["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return sequences.mapInPandas(run, "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def decoder(path: str) -> Callable[[np.ndarray], str]:
    if path.endswith(".tiktoken"):
        import base64

        with open(path, "rb") as f:
            piece = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
        return lambda ids: b"".join(map(piece.__getitem__, ids.tolist())).decode()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return lambda ids: tok.decode(ids.tolist(), skip_special_tokens=False)


def format_and_read(turns: DataFrame, tokenizer: str, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text", sequence_tokens: int = 32_768) -> DataFrame:
    """Format all conversations and read each one back: (conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Turns are ordered by turn (null last), then role and text. Null roles and
    texts are empty; a null conversation id is a conversation of its own;
    repeated turns are all kept; control strings inside texts and roles are
    escaped. An empty table gives an empty result; other columns are ignored.
    """
    convs = materialize(conversations(turns, conv_col, turn_col, role_col, text_col), "chat-conversations")
    back = read_back(format_trees(convs, tokenizer, sequence_tokens=sequence_tokens), tokenizer)
    return convs.select("conv_id", "key").join(back, "key").drop("key")
