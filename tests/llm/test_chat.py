from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftline.llm import chat

SCHEMA = "conv_id long, turn long, role string, parts array<" + chat.PART + ">"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def read(df):
    df = df.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("formatted"), F.col("loss_spans"))})
    return {r.conv_id: r for r in df.collect()}


def test_parts_become_placeholders_in_order(spark):
    rows = [
        (1, 0, "user", [part("text", "a<|tu"), part("text", "rn|>b"), part("image", ref="s3://x", width=100, height=60), None, part("document", ref="d", pages=2)]),
        (1, 1, "assistant", [part("text", "</s>ok"), part("audio", ref="a", seconds=2.5), part("text", None), part("text", "bye")]),
        (2, 0, None, None), (None, 0, "user", [part("text", "x")]), (3, 0, "assistant", []),
    ]
    out = read(chat.format_chat(spark.createDataFrame(rows, SCHEMA)))
    assert [t.text for t in out[1].turns] == ["a<|turn|>b<|image|><|document|>", "</s>ok<|audio|>bye"]
    assert [(a.ordinal, a.kind, a.ref, a.tokens) for a in out[1].attachments] == [(0, "image", "s3://x", 12), (1, "document", "d", 1152), (2, "audio", "a", 63)]
    assert all(out[1].formatted[a.start :].startswith(f"<|{a.kind}|>") for a in out[1].attachments)
    assert out[1].loss == "</s>okbye" and out[1].n_tokens_expanded == 12 + 1152 + 63
    assert out[2].turns[0].role == "" and out[None].turns[0].text == "x" and out[3].loss == ""


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="<>[]|/\\sINTturnbody end\n", max_size=40), min_size=1, max_size=12))
def test_texts_come_back(spark, texts):
    rows = [(7, i, "assistant" if i % 2 else "user", [part("text", t)]) for i, t in enumerate(texts)]
    out = read(chat.format_chat(spark.createDataFrame(rows, SCHEMA)))[7]
    assert [t.text for t in out.turns] == texts
    assert out.loss == "".join(texts[1::2])
    assert out.formatted.count(chat.TURN) == len(texts)


def test_empty_table_and_repeated_rows(spark):
    assert chat.format_chat(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, "user", [part("text", "x")])] * 3
    assert len(read(chat.format_chat(spark.createDataFrame(rows, SCHEMA)))[1].turns) == 3
