"""Chat formatting at token level.

A turn becomes  TURN role TEXT text END  where TURN, TEXT and END are ids beyond the vocabulary. Role and
text are encoded separately by a byte-level tokenizer that knows no special tokens, so no text can
make a reserved id. Where the ids are written out as a string the reserved ids have names; those
names, and control strings of common templates, are escaped in texts: a backslash goes after the
first character of `<|end|>`, one more where some are there already, so taking one away is exact.
The loss mask is the prefix sum of +1 at the first and -1 after the last token of every assistant text.

Scale: tokenizing, the expensive part, runs per row on whatever partition holds the row, so one huge
conversation is tokenized everywhere at once. Only then are rows brought together by conversation
and sorted by turn; conversations are read as a stream, so memory does not grow with their length,
and come out as chunks of at most CHUNK_TOKENS tokens or one turn.

Rows are ordered by turn (null first), then role and text; repeated rows are turns of their own. Null
text and null role are empty. Rows with null conv_id form one conversation. A role other than
assistant carries no loss. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.common import table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
RESERVED = (TURN, TEXT, END)
#: Control strings of common templates, escaped in texts like our own.
CONTROL = (
    *RESERVED, "<|system|>", "<|user|>", "<|assistant|>", "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>", "<|eot_id|>",
    "<|start_header_id|>", "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
ESCAPE = "\\"
CHUNK_TOKENS = 65536
VOCABULARY = "byte_bpe_50k.tiktoken"

_ANY = "|".join(f"{re.escape(c[0])}(?P<e{i}>{re.escape(ESCAPE)}*){re.escape(c[1:])}" for i, c in enumerate(CONTROL))
_PATTERN = re.compile(_ANY)


def escape(text: str) -> str:
    """One more backslash in every control string of the text."""
    return _PATTERN.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return _PATTERN.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == ESCAPE else m[0], text)


class Tokenizer:
    """A byte-level vocabulary plus the reserved ids, which no text encodes to."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.reserved = {name: len(ranks) + 1 + i for i, name in enumerate(RESERVED)}
        self.names = {i: name for name, i in self.reserved.items()}
        self.first_reserved = len(ranks) + 1

    def encode(self, text: str) -> list[int]:
        """The ids of the text as a whole, however long."""
        return self._encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self._encoding.decode_bytes(ids).decode("utf-8")


def assemble(tokenizer: Tokenizer, role: str, text: str) -> tuple[list[int], np.ndarray]:
    """Ids of a turn and its loss mask."""
    head = [tokenizer.reserved[TURN], *tokenizer.encode(escape(role)), tokenizer.reserved[TEXT]]
    body = tokenizer.encode(escape(text))
    ids = [*head, *body, tokenizer.reserved[END]]
    change = np.zeros(len(ids) + 1, np.int8)
    if role == "assistant":
        change[len(head)] += 1
        change[len(head) + len(body)] -= 1
    return ids, np.cumsum(change[:-1], dtype=np.int8)


def format_turns(rows: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, ids, mask of every row; role and text only for the order of tied turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(tokenizer_path)
        for batch in batches:
            done = [assemble(tokenizer, r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            ids = pa.array([np.asarray(i, np.int32).tobytes() for i, _ in done], pa.binary())
            mask = pa.array([np.packbits(m.astype(np.uint8)).tobytes() for _, m in done], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], ids, mask], names=[*names, "ids", "mask"])

    names = ("conv_id", "turn", "role", "text")
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, ids binary, mask binary")


def format_conversations(rows: DataFrame, tokenizer_path: str | None = None, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """conv_id, chunk, last, ids (int32), mask (bits): the conversations, chunks of each one after another."""
    turns = format_turns(rows, tokenizer_path).repartition("conv_id")
    turns = turns.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text").drop("turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, started, chunk, ids, mask, size = None, False, 0, [], [], 0

        def out(last: bool) -> pa.RecordBatch:
            bits = np.concatenate(mask) if mask else np.empty(0, np.uint8)
            row = [[conv], [chunk], [last], [b"".join(ids)], [np.packbits(bits).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=["conv_id", "chunk", "last", "ids", "mask"])

        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
            for c, i, m in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "ids", "mask")), strict=True):
                n = len(i) // 4
                if started and (c != conv or size and size + n > chunk_tokens):
                    yield out(c != conv)
                    chunk, ids, mask, size = (chunk + 1 if c == conv else 0), [], [], 0
                conv, started = c, True
                ids.append(i)
                mask.append(np.unpackbits(np.frombuffer(m, np.uint8), count=n))
                size += n
        if started:
            yield out(True)

    return turns.mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, chunk long, last boolean, ids binary, mask binary")


class Reader:
    """Reads formatted conversations back, chunk by chunk."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.n_turns, self.loss_chars, self.chars = tokenizer, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, ids: np.ndarray, mask: np.ndarray) -> None:
        """Whole turns: split at the reserved ids, decode between them, unescape."""
        marks = np.flatnonzero(ids >= self.tokenizer.first_reserved)
        part, loss = [], []
        for at, until in zip(marks, [*marks[1:], len(ids)], strict=True):
            name = self.tokenizer.names[int(ids[at])]
            raw = self.tokenizer.decode(ids[at + 1 : until].tolist())
            self.chars += len(name) + len(raw)
            if name == END:
                self.turns.update(f"{part[0]}\n{part[1]}\n".encode())
                self.n_turns += 1
                part = []
                continue
            part.append(unescape(raw))
            under = mask[at + 1 : until]
            if under.any():
                loss.append(unescape(self.tokenizer.decode(ids[at + 1 : until][under.astype(bool)].tolist())))
        for text in loss:
            self.loss.update(text.encode())
            self.loss_chars += len(text)


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """What reading the chunks back gives; they must still stand in the order they were made in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(tokenizer_path)
        reader = Reader(tokenizer)
        for batch in batches:
            found = []
            for conv, last, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "last", "ids", "mask")), strict=True):
                ids = np.frombuffer(ids, np.int32)
                reader.read(ids, np.unpackbits(np.frombuffer(mask, np.uint8), count=len(ids)))
                if last:
                    found.append((conv, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))
                    reader = Reader(tokenizer)
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*found, strict=True)) or [()] * 6
            names = ["conv_id", *[x.split()[0] for x in DIGESTS.split(", ")]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], names=names)

    return formatted.mapInArrow(run, f"conv_id {dict(formatted.dtypes)['conv_id']}, {DIGESTS}")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return digests(format_conversations(rows.unionByName(more)))


def _sql() -> str:
    """Without formatted_chars, which depends on the template; see the tests for that."""
    said = "</s>[INST] ok [/INST]"
    names = [c for c in CONTROL]
    pattern = "|".join(re.sub(r"([\[\]|/\\<>])", r"\\\1", c[0]) + r"\\*" + re.sub(r"([\[\]|/\\<>])", r"\\\1", c[1:]) for c in names)
    tags = sum(map(len, RESERVED))
    return f"""
    with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
               union all select -1, 0, 'user', '{said}' union all select -1, 1, 'assistant', '{said}'),
    n as (select *, {tags} + length(role) + length(text) + len(regexp_extract_all(role, '{pattern}')) + len(regexp_extract_all(text, '{pattern}')) as chars from c)
    select conv_id, count(*)::bigint as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
           coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
           sum(chars)::bigint as formatted_chars
    from n group by conv_id
    """


QUERIES = {"op3_chat": op3_chat}
ORACLE_SQL = {"op3_chat": _sql()}
