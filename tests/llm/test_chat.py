"""Chat records against a direct reading of the turns."""

import hashlib
import random

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import chat
from tidemark.llm.common import prepare
from tidemark.llm.queries import chat_tokenizer

SCHEMA = "conv_id long, turn long, role string, text string, ids string, piece int, more string"
BITS = ["<", "s>", "</s>", "<s>", "[", "INST]", "[INST]", "[/INST]", "\\", "\\\\", "<|endoftext|>", "|endoftext|>", "é", "漢", "🙂", " ", "\n", "word", "́"]


def want(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        said = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=str)


def made(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))


def table(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)


def test_records_read_back_whole(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "</s>", "", None]), rng.choice([None, made(rng), made(rng), made(rng)]))
            for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(None, None, "assistant", "a"), (None, 2, "assistant", "b [INST]"), (7, 0, "assistant", "tie"), (7, 0, "assistant", "tie"),
             (500, 0, "user", "long " * 40_000), (500, 1, "assistant", "<s>é" * 30_000)]
    rows += [(900, i, ["user", "assistant"][i % 2], f"part {i} </s>") for i in range(400)]  # about a third of all rows
    for piece in (chat.PIECE, 700):  # 700: long conversations fall into several records
        path = chat.write_chats(table(spark, rows), chat_tokenizer, piece=piece)
        got = chat.read_digests(spark, path, chat_tokenizer).collect()
        assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got), key=str) == want(rows)
        records = spark.read.parquet(path).collect()
        assert sum(r.formatted_chars for r in got) == sum(len(r.text) for r in records)
        assert (max(r.piece for r in records) > 5) == (piece == 700)
    tok = chat.Encoder(chat_tokenizer(), chat.CONTROL).tok
    plain = Tokenizer.from_file(chat_tokenizer())
    for r in records:
        assert tok.decode(r.ids, skip_special_tokens=False) == r.text  # the ids alone give the text
        first = next((i for i, x in enumerate(r.loss) if x), None)
        if first is not None:
            last = next((i for i in range(first, len(r.loss)) if not r.loss[i]), len(r.loss))
            said = r.text[r.starts[first] : r.ends[last - 1]]
            assert r.ids[first:last] == plain.encode(said, add_special_tokens=False).ids


def test_empty_table(spark):
    path = chat.write_chats(table(spark, []), chat_tokenizer)
    assert chat.read_digests(spark, path, chat_tokenizer).collect() == []


def test_escapes_are_reversible_and_leave_no_control_string():
    template, rng = chat.Template(chat.CONTROL + ("<|endoftext|>",)), random.Random(1)
    for _ in range(3000):
        text = made(rng)
        hidden = template.escape(text)
        assert template.unescape(hidden) == text and not any(c in hidden for c in template.control)
        turns = [(made(rng), made(rng)) for _ in range(3)]
        assert list(template.read("".join(template.turn(r, t)[0] for r, t in turns))) == turns


def test_mask_by_binary_search_equals_every_overlap():
    rng = np.random.default_rng(5)
    for _ in range(300):
        cuts = np.sort(rng.integers(0, 40, 12))
        starts, ends = cuts[:-1], cuts[1:]
        edges = np.unique(rng.integers(0, 40, 6))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
        got = chat.aligned_mask(starts, ends, spans)
        for s, e, g in zip(starts, ends, got):
            if s < e:
                assert g == any(max(s, a) < min(e, b) for a, b in spans)
