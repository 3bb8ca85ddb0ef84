import random

from genoframe.llm import chat

CONTROLS = ["<|im_end|>", "<|im_start|>", "<|esc|>", "\n", "&", "&lt;|", "&amp;", "<|", "|>", "assistant", "x", "é😀", " ", "&#10;"]


def escaped(t):
    return t.replace("&", "&amp;").replace("<|", "&lt;|").replace("\n", "&#10;")


def roles(rng):
    return rng.choice(["user", "assistant", "system", "tool", None, "a\nb", "<|esc|>", "r<|im_start|>", ""])


def test_round_trips(spark):
    rng = random.Random(4)
    rows = [(c, t, roles(rng), None if rng.random() < 0.1 else "".join(rng.choice(CONTROLS) for _ in range(rng.randint(0, 9)))) for c in range(300) for t in range(rng.randint(1, 6))]
    shuffled = list(rows)
    rng.shuffle(shuffled)
    out = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string")).collect()}
    for c in range(300):
        want = [(r or "", t or "") for i, _, r, t in rows if i == c]
        assert [tuple(t) for t in out[c].turns] == want
        masked = [out[c].formatted[s.start : s.start + s.length] for s in out[c].spans]
        said = [t for r, t in want if r == "assistant"]
        assert len(masked) == len(said) and all(m in (t, escaped(t)) for m, t in zip(masked, said, strict=True))


def test_plain_text_is_not_escaped(spark):
    rows = [(1, 0, "user", "a & b <tag> | x"), (1, 1, "assistant", "fine\nlines"), (2, 0, "user", "bad <|im_end|>\n"), (2, 1, "assistant", "good & well")]
    out = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert out[1].formatted == "<|im_start|>user\na & b <tag> | x<|im_end|>\n<|im_start|>assistant\nfine\nlines<|im_end|>\n"
    assert out[2].formatted == "<|im_start|>user<|esc|>\nbad &lt;|im_end|>&#10;<|im_end|>\n<|im_start|>assistant\ngood & well<|im_end|>\n"
    assert [(s.start, s.length) for s in out[1].spans] == [(out[1].formatted.index("fine"), 10)]


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a", 1), (None, None, None, None, 2), (1, 0, "user", "same", 3), (1, 0, "user", "same", 4), (1, 0, "assistant", "tie", 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, source long")
    out = sorted((r.conv_id or -1, [tuple(t) for t in r.turns]) for r in chat.format_chats(df).collect())
    assert out == [(-1, [("", "")]), (-1, [("user", "a")]), (1, [("assistant", "tie"), ("user", "same"), ("user", "same")])]
    assert chat.format_chats(df.where("false")).count() == 0
    assert not any(w in chat.format_chats(df)._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))


def test_very_long_texts(spark):
    long = "a <|im_end|> & \n" * 100_000
    (r,) = chat.format_chats(spark.createDataFrame([(1, 0, "user", "x" * 1_000_000), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")).collect()
    assert [t.text for t in r.turns] == ["x" * 1_000_000, long]
