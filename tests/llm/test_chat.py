import hashlib
import random

import numpy as np
import pyarrow as pa

from costloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, loss string, formatted string"
PIECES = ["</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>", "\\", "<", "[", "/", "s>", "]", "é", "𝒳", "a", " ", "\n", "INST]", ""]
ROLES = ["user", "assistant", "system", "tool", "", "we</s>ird\\", "r\n"]


def turns():
    r = random.Random(2)
    rows = []
    for conv in range(40):
        for turn in r.sample(range(20), r.randint(1, 9)):
            rows.append((conv, turn, r.choice(ROLES), "".join(r.choice(PIECES) for _ in range(r.randint(0, 9)))))
    rows += [(100, None, None, None), (100, 1, "assistant", None), (101, 1, "user", "same"), (101, 1, "user", "same"), (None, 2, "assistant", "a" * 300_000),
             (None, 1, "user", "q"), (102, 0, "user", "only")]
    return rows


def digests(rows):
    out = []
    for conv in {r[0] for r in rows}:
        part = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv))
        said = "".join(f"{role}\n{text}\n" for _, role, text in part)
        loss = "".join(text for _, role, text in part if role == "assistant")
        out.append((conv, len(part), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "l", "f") for r in rows], SCHEMA)


def read(df):
    return sorted((tuple(r)[:5] for r in chat.read_back(df).collect()), key=repr)


def test_what_is_read_back_is_what_was_formatted(spark):
    rows = turns()
    assert read(chat.format_chats(frame(spark, rows).repartition(4))) == digests(rows)


def test_small_batches_give_the_same(spark):
    rows = turns()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert read(chat.format_chats(frame(spark, rows))) == digests(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_template(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "a\\b"), (1, 3, "tool", "x")]
    out = chat.format_chats(frame(spark, rows)).first()
    assert out.formatted == "<s><<SYS>>\nbe kind\n<</SYS>>[INST] hi <\\/s> [/INST] a\\\\b</s><|role|>tool<|text|>x<|end|>"
    assert [out.formatted[r.start:r.end] for r in out.loss] == ["a\\\\b"]


def test_assembly_in_pieces(monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(200)]
    roles = [r.choice(ROLES) for _ in texts]
    conv = np.sort(np.array([r.randint(0, 30) for _ in texts]))
    whole = chat.assemble(conv, pa.array(roles), pa.array(texts))
    monkeypatch.setattr(chat, "SCATTER", 64)
    monkeypatch.setattr(chat, "_SLICE", 40)
    again = chat.assemble(conv, pa.array(roles), pa.array(texts))
    assert whole[0].equals(again[0]) and whole[1].equals(again[1])
    assert [t for s in whole[0].to_pylist() for t in chat.parse(s)] == list(zip(roles, texts))


def test_empty_table(spark):
    assert read(chat.format_chats(frame(spark, []))) == []
