import hashlib

from pyspark.sql import functions as F

from rinkframe.llm import chat

SAID = "</s>[INST] ok [/INST]"


def test_round_trip_of_control_strings(text_spark):
    texts = ["", SAID, "<|im_end|>\n", "a\\b\\\\<|", "\\", "<<SYS>>x<</SYS>>", "[\\INST]", "<\\|", "é\n" * 3000, "<", "[" * 9]
    rows = [(1, k, ("user", "assistant", "<|im_start|>")[k % 3], t) for k, t in enumerate(texts)]
    rows += [(2, 0, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 5, "assistant", "y"), (1, 700, "assistant", "far")]
    df = text_spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("key", F.lit(1))
    out = chat.format_conversations(df).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).collect()
    for conv in (1, 2, None):
        mine = sorted((r for r in out if r["conv_id"] == conv), key=lambda r: r["chunk"])
        want = sorted([(r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        assert [(t["role"], t["text"]) for r in mine for t in r["turns"]] == [w[1:] for w in want]
        assert "".join(r["loss"] for r in mine) == "".join(w[2] for w in want if w[1] == "assistant")
        for r in mine:
            inner = r["formatted"].replace(chat.OPEN, "").replace(chat.MIDDLE, "").replace(chat.CLOSE, "")
            assert not any(c in inner for c in chat.CONTROL)


def test_fingerprints_select_mappings(text_spark):
    records = [
        '{"prompt": "p", "completion": "c"}', '{"instruction": "i", "input": 3, "output": null}',
        '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "tool", "value": 1}]}',
        '{"messages": [{"role": "user", "content": "m"}]}', '{"other": 1}', '[]', None]
    df = text_spark.createDataFrame([(k, r) for k, r in enumerate(records)], "k int, raw string")
    out = {r["k"]: r for r in chat.canonical(df.withColumn("record", F.parse_json("raw"))).select("k", "layout", "turns").collect()}
    turns = {k: r["turns"] and [tuple(t) for t in r["turns"]] for k, r in out.items()}
    assert turns[0] == [("user", "p"), ("assistant", "c")]
    assert turns[1] == [("system", "i"), ("user", "3"), ("assistant", "")]
    assert turns[2] == [("user", "h"), ("assistant", "g"), ("tool", "1")]
    assert turns[3] == [("user", "m")]
    assert turns[4] is turns[5] is turns[6] is None and out[4]["layout"] is None


def test_empty_table(text_spark):
    df = text_spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_conversations(df).count() == 0
    assert hashlib.sha256(b"").hexdigest() == text_spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]


def test_chunks_are_cut_by_bytes(text_spark):
    """Turns of one number, or none, make parts of bounded size whose order is kept."""
    rows = [(1, None, "user", f"{k:03d} é" * 5) for k in range(60)] * 2
    rows += [(1, 3, "assistant", "x" * n) for n in (0, 1, 700, 2000)] + [(2, 3, "assistant", "")]
    df = text_spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {"chunk": F.lit(1), "number": F.lit(2), "part": F.lit(3), "content": F.lit("c")})
    out = chat.format_conversations(df, chunk_bytes=500).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    for conv in (1, 2):
        mine = sorted((r for r in out if r["conv_id"] == conv), key=lambda r: r["chunk"])
        want = sorted([(-1 if r[1] is None else r[1], r[2], r[3]) for r in rows if r[0] == conv])
        assert [(t["role"], t["text"]) for r in mine for t in r["turns"]] == [w[1:] for w in want]
        for r in mine:
            sizes = [len(t["role"] + t["text"].encode().decode("latin-1")) for t in r["turns"]]
            assert sum(sizes[:-1]) < 500
    assert len(out) > 10
