from hypothesis import given, settings
from hypothesis import strategies as st

from sedimenta.llm.chat import chat_digest, chat_examples, read_turns
from pyspark.sql import functions as F

from tests.llm.helpers import sha

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>", "<\\|end|>", "<\\\\s>", "<<SYS>>x<</SYS>>", "<|nl|>", "[/INST]" * 500, "$1 \\2", ""]


def rows():
    out = []
    for c in range(12):
        n = c % 6 + 1
        for t in range(n):
            role = "system" if t == 0 and c % 4 == 0 else ("user" if t % 2 == 0 else "assistant")
            out.append((c, t, role, ODD[(c * 5 + t) % len(ODD)]))
    out += [(50, 0, None, None), (50, 1, "assistant", None), (51, 3, "a\nb<|nl|>", "x"), (51, 3, "assistant", "tie"), (51, None, "user", "first")]
    out += [(52, 0, "assistant", "only"), (None, 0, "user", "no id"), (53, 0, "user", "twice"), (53, 0, "user", "twice")]
    out += [(54, t, ("user", "assistant")[t % 2], f"turn {t} " * 30) for t in range(120)]
    return out


def expected(data):
    by = {}
    for c, t, role, text in data:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def test_digest_reads_back_every_turn_and_reply(spark):
    data = rows()
    examples = chat_examples(spark.createDataFrame(data, SCHEMA).withColumn("formatted", F.lit("other")))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_digest(examples).collect()}
    assert got == expected(data)


def test_one_example_per_reply_with_all_turns_before(spark):
    data = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    out = chat_examples(spark.createDataFrame(data, SCHEMA)).orderBy("example").collect()
    masked = [r.formatted[r.loss_start : r.loss_start + r.loss_length] for r in out]
    assert masked == ["a1", "a2", ""]
    turns = [F.lit(r.formatted) for r in out]
    read = spark.range(1).select(*[read_turns(t).alias(f"c{i}") for i, t in enumerate(turns)]).first()
    assert [[t.text for t in c] for c in read] == [["q1", "a1"], ["q1", "a1", "q2", "a2"], ["q1", "a1", "q2", "a2", "q3"]]
    assert [r.is_last for r in out] == [False, False, True]


def test_native_plan(spark):
    plan = chat_digest(chat_examples(spark.createDataFrame(rows(), SCHEMA)))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    assert chat_digest(chat_examples(spark.createDataFrame([], SCHEMA))).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<>[]/\\|sINSTturnedl &\n", max_size=40), min_size=1, max_size=5))
def test_escaping_is_reversible(spark, texts):
    data = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    got = chat_digest(chat_examples(spark.createDataFrame(data, SCHEMA))).first()
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == expected(data)[1]
