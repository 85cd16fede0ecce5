"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one text, turn after turn:

    <s>[INST]role[/INST]text</s>

A control string inside a role or a text gets a backslash behind its first
character (one more where some stand there already), so that no text can end
a turn or open one; taking one backslash away gives the text back exactly.

The rendered conversation is encoded once, by a tokenizer of the
``tokenizers`` library to which the control strings are known as special
tokens: no token crosses one, so the tokens of a text begin and end with it.
Each token comes with its place in the rendered text. The loss mask marks
the tokens that overlap an assistant's text: two binary searches of the
sorted token spans in the sorted turn spans.

Records are written as Parquet, one row per conversation:

=========== ============= ==================================================
conv_id     long
piece, more int, boolean  place of the row in its conversation, and whether
                          another one follows (see below)
text        string        rendered text
ids         array<int>    token ids
starts,ends array<int>    code points of the text that each token stands for
loss        array<bool>   the tokens that are trained on
=========== ============= ==================================================

Rows are dealt by conversation and sorted by turn; a task streams through
its rows and never gathers more than ``PIECE`` code points: a conversation
beyond that is cut between turns into several rows, so one that holds a
third of the table takes no more memory than the others (only as one ordered
record it is one task's work).

Defined results: null texts and null roles are empty; rows of equal turn go
by role and text, null turns first; null conv_ids together are one
conversation. Only the role ``assistant`` is trained on. Empty input gives no
rows. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

from .common import partitions

BOS, EOS, HEAD, BODY = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = (BOS, EOS, HEAD, BODY)
TRAINED = "assistant"
#: Code points of rendered text in a row, about.
PIECE = 1 << 21
#: Code points that are encoded in one call.
BATCH = 1 << 18

RECORD = "conv_id long, piece int, more boolean, text string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_RECORD = pa.schema([("conv_id", pa.int64()), ("piece", pa.int32()), ("more", pa.bool_()), ("text", pa.string()), ("ids", pa.list_(pa.int32())),
                     ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))])


class Template:
    """Renders turns and reads them back. ``control`` are strings of two or
    more characters whose first one does not occur in the rest of any."""

    def __init__(self, control: tuple[str, ...] = CONTROL):
        heads = {c[0] for c in control}
        if any(len(c) < 2 or heads & set(c[1:]) or "\\" in c for c in control):
            raise ValueError("the first character of a control string must not occur later in one")
        self.control = control
        tails = "|".join(re.escape(c[0]) + r"\\*" + "(?=" + re.escape(c[1:]) + ")" for c in control)
        self._plain = re.compile(tails)
        self._escaped = re.compile("|".join(re.escape(c[0]) + r"\\+" + "(?=" + re.escape(c[1:]) + ")" for c in control))
        self._turn = re.compile("(.*?)".join(map(re.escape, (BOS + HEAD, BODY, EOS))), re.S)

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][:-1], text)

    def turn(self, role: str, text: str) -> tuple[str, int]:
        """A rendered turn, and the code points before its text."""
        head = f"{BOS}{HEAD}{self.escape(role)}{BODY}"
        return f"{head}{self.escape(text)}{EOS}", len(head)

    def read(self, rendered: str) -> Iterator[tuple[str, str]]:
        """(role, text) of every turn. Raises if anything else stands there."""
        at = 0
        for m in self._turn.finditer(rendered):
            if m.start() != at:
                break
            at = m.end()
            yield self.unescape(m[1]), self.unescape(m[2])
        if at != len(rendered):
            raise ValueError(f"no turn at {at}: {rendered[at : at + 40]!r}")


class Encoder:
    """A tokenizer that knows the control strings as special tokens."""

    def __init__(self, path: str, control: tuple[str, ...]):
        from tokenizers import AddedToken, Tokenizer, processors

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        # offsets with their white space, so that spans leave no gap
        self.tok.post_processor = processors.ByteLevel(trim_offsets=False)
        self.tok.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in control])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of every text."""
        out = []
        for e in self.tok.encode_batch(texts, add_special_tokens=False):
            spans = np.array(e.offsets, np.int32).reshape(-1, 2)
            out.append((np.array(e.ids, np.int32), spans[:, 0], spans[:, 1]))
        return out


def known_specials(path: str) -> tuple[str, ...]:
    """Special tokens that the tokenizer file itself names; in texts they
    are escaped like the control strings."""
    from tokenizers import Tokenizer

    return tuple(sorted(t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values() if t.special))


def aligned_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """The tokens [start, end) that overlap one of the sorted, disjoint
    ``spans``: more spans begin before the token's end than have ended by its
    start."""
    lo, hi = np.array(spans, np.int64).reshape(-1, 2).T
    return np.searchsorted(lo, ends, "left") > np.searchsorted(hi, starts, "right")


def masked_runs(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The pieces of ``text`` under the mask, one for each run of masked
    tokens. Tokens that share a code point count it once."""
    edge = np.flatnonzero(np.diff(np.r_[False, loss, False]))
    return [text[starts[a] : ends[b - 1]] for a, b in zip(edge[::2], edge[1::2])]


_CACHE: dict[tuple, tuple[Template, Encoder]] = {}


def _tools(tokenizer: str) -> tuple[Template, Encoder]:
    if tokenizer not in _CACHE:
        control = CONTROL + known_specials(tokenizer)
        _CACHE[tokenizer] = Template(control), Encoder(tokenizer, CONTROL)
    return _CACHE[tokenizer]


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


def write_chats(turns: DataFrame, tokenizer, path: str | None = None, piece: int = PIECE) -> str:
    """Format ``turns`` (conv_id, turn, role, text) and write the records;
    returns the path. ``tokenizer`` gives the tokenizer file's place; it is
    called in the workers."""
    spark = turns.sparkSession
    path = path or scratch_dir(spark, "chats")
    rows = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, encoder = _tools(tokenizer())
        done: list[tuple] = []  # rendered pieces that wait for their encoding
        waiting = 0

        def flush():
            coded = encoder.encode([t for _, _, _, t, _ in done])
            cols = [[c for c, *_ in done], [p for _, p, *_ in done], [m for _, _, m, *_ in done], [t for _, _, _, t, _ in done]]
            ids, starts, ends = (list(x) for x in zip(*coded))
            loss = [aligned_mask(s, e, spans) for s, e, (*_, spans) in zip(starts, ends, done)]
            lists = []
            for values, kind in ((ids, pa.int32()), (starts, pa.int32()), (ends, pa.int32()), (loss, pa.bool_())):
                at = np.cumsum([0, *map(len, values)]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(values), kind)))
            return pa.RecordBatch.from_arrays([*[pa.array(c, f.type) for c, f in zip(cols, _RECORD)], *lists], schema=_RECORD)

        def pieces() -> Iterator[tuple]:
            """(conv_id, piece, more, text, trained spans), turns streamed."""
            now, number, size, parts, spans = None, 0, 0, [], []
            for conv, role, text in _runs(batches, ["conv_id", "role", "text"]):
                if parts and (conv != now or size >= piece):
                    yield now, number, conv == now, "".join(parts), spans
                    number = number + 1 if conv == now else 0
                    size, parts, spans = 0, [], []
                now = conv
                rendered, head = template.turn(role, text)
                if role == TRAINED:
                    spans.append((size + head, size + len(rendered) - len(EOS)))
                parts.append(rendered)
                size += len(rendered)
            if parts:
                yield now, number, False, "".join(parts), spans

        for item in pieces():
            done.append(item)
            waiting += len(item[3])
            if waiting >= BATCH:
                yield flush()
                done.clear()
                waiting = 0
        if done:
            yield flush()

    rows.select("conv_id", "role", "text").mapInArrow(form, RECORD).write.option("compression", "zstd").parquet(path)
    return path


def read_digests(spark: SparkSession, path: str, tokenizer) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of every conversation, from the written records."""
    files = spark.read.schema(RECORD).parquet(path).select("conv_id", "piece", "more", "text", "starts", "ends", "loss")
    several = files.where("more or piece > 0").repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "piece")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, _ = _tools(tokenizer())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        rows: list[tuple] = []
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        for batch in batches:
            cols = [batch.column(c) for c in ("starts", "ends", "loss")]
            for i, (conv, more, text) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("conv_id", "more", "text")])):
                for role, said in template.read(text):
                    n_turns += 1
                    turns.update(f"{role}\n{said}\n".encode())
                spans = [c[i].values.to_numpy(zero_copy_only=False) for c in cols]
                for run in masked_runs(text, *spans):
                    said = template.unescape(run)
                    loss_chars += len(said)
                    loss.update(said.encode())
                chars += len(text)
                if not more:
                    rows.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_DIGEST)
                rows = []

    form = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    single = files.where("not more and piece = 0").mapInArrow(digest, form)
    return single.union(several.mapInArrow(digest, form))


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
