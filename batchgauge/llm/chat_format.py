"""Conversations as token sequences with a loss mask.

A turn is <|im_start|>role\\ntext<|im_end|>\\n. Its parts are encoded separately and the two
marks are put in as reserved ids beyond the vocabulary, so no text can produce them. In the
written form a text that spells a mark is told apart by an escape: `<`, any backslashes, `|`
gets one more backslash, and reading takes one away. Roles also have their backslashes and
line breaks escaped, so the first line break of a turn ends its role.

Encoding runs on every row where it lies. A running sum of token counts per conversation then
gives each turn its place, and the masked range of assistant texts with it. The result has a
row per turn, so a conversation of any length is never one value. Reading back streams the
rows of a conversation in order and holds one turn at a time. The turns of one conversation pass through one
task in order, in the running sum as in the reading: a digest of a sequence cannot be split.

Defined results: null text is empty, null role is an empty role. Turns come by turn (null
first), then role, then text; repeated rows are repeated turns. Null conv_id is a conversation.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 64_000_000
LEARNED_ROLE = "assistant"
#: Fixed value: the public pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START, END = "<|im_start|>", "<|im_end|>"
TURNS = "conv_id long, turn long, role string, text string, ids array<int>, learn_from int, learn_until int"
_BLANKS = re.compile(r"\s{10000}")
_MARK, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escaped_role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


class Coder:
    """A byte-level vocabulary with two reserved ids after its last."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.coder = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.start = max(table.values()) + 1
        self.end = self.start + 1

    def encode(self, text: str) -> list[int]:
        """The ids of a text. A very long run of white space is cut: the pattern takes one stack frame a character there."""
        cuts = [0, *(m.end() for m in _BLANKS.finditer(text)), len(text)]
        return [i for a, b in zip(cuts, cuts[1:]) for i in self.coder.encode_ordinary(text[a:b])]

    def decode(self, ids: list[int]) -> str:
        return self.coder.decode_bytes(ids).decode("utf-8")

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """The ids of a turn, and where its text lies in them."""
        head = [self.start, *self.encode(escaped_role(role) + "\n")]
        body = self.encode(escaped(text))
        return [*head, *body, self.end, *self.encode("\n")], len(head), len(head) + len(body)


def vocabulary(spark: SparkSession, path: str = VOCABULARY):
    """The rank file as a broadcast value; files beyond a fixed size are refused."""
    data = Path(path).read_bytes()
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def formatted(conversations: DataFrame, path: str = VOCABULARY, learned: str = LEARNED_ROLE) -> DataFrame:
    """Rows (conv_id, position, ids, token_start, loss_from, loss_until), one per turn.

    Token numbers count from the start of the conversation; a turn that is not learned from
    has loss_from = loss_until.
    """
    ranks = vocabulary(conversations.sparkSession, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ranks.value)
        for batch in batches:
            roles, texts = (batch.column(i).to_pylist() for i in (2, 3))
            made = [coder.turn(r or "", t or "") for r, t in zip(roles, texts)]
            yield pa.record_batch({
                "conv_id": batch.column(0), "turn": batch.column(1), "role": batch.column(2), "text": batch.column(3),
                "ids": pa.array([m[0] for m in made], pa.list_(pa.int32())),
                "learn_from": pa.array([m[1] for m in made], pa.int32()),
                "learn_until": pa.array([m[2] if r == learned else m[1] for m, r in zip(made, roles)], pa.int32()),
            })

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.mapInArrow(encode, TURNS)
        .withColumns({"position": F.row_number().over(order), "token_start": before})
        .select(
            "conv_id", "position", "ids", "token_start",
            (F.col("token_start") + F.col("learn_from")).alias("loss_from"),
            (F.col("token_start") + F.col("learn_until")).alias("loss_until"),
        )
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long, loss_tokens long"
)


def read_back(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per conversation what its tokens and mask say, decoded and unescaped.

    Rows of a conversation must be in one partition, as `formatted` leaves them.
    """
    ranks = vocabulary(turns.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ranks.value)
        state, key = None, None
        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for conv, _, ids, start, a, b in zip(*columns):
                if state is None or conv != key:
                    if state is not None:
                        done.append(state)
                    key, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                first, last = ids.index(coder.start), ids.index(coder.end)
                inner = coder.decode(ids[first + 1 : last])
                role, text = inner.split("\n", 1)
                learned = unescaped(coder.decode(ids[a - start : b - start]))
                state[1] += 1
                state[2].update(f"{unescaped_role(role)}\n{unescaped(text)}\n".encode("utf-8", "surrogatepass"))
                state[3] += len(learned)
                state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(START) + len(inner) + len(END) + len(coder.decode(ids[last + 1 :]))
                state[6] += len(ids)
                state[7] += b - a
            if done:
                yield _rows(done)
        if state is not None:
            yield _rows([state])

    return turns.sortWithinPartitions("conv_id", "position").mapInArrow(run, DIGESTS)


def _rows(states: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    plain = [[x.hexdigest() if hasattr(x, "hexdigest") else x for x in s] for s in states]
    return pa.record_batch({n: pa.array([s[i] for s in plain], kinds[i]) for i, n in enumerate(names)})
