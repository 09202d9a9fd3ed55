import hashlib

from pyspark.sql import functions as F

from tidemill.llm import chat, queries


def messages(spark, events):
    df = spark.createDataFrame(events, "conv_id long, seq int, turn int, kind string, role string, text string")
    folded = chat.fold_events(df)
    return {r["conv_id"]: [(m["role"], m["text"]) for m in r["messages"]] for r in folded.collect()}


def test_fold(spark):
    got = messages(
        spark,
        [
            (1, 4, 1, "delta", "assistant", " world"),
            (1, 1, 0, "delta", "user", "hi"),
            (1, 2, 1, "delta", "assistant", "hel"),
            (1, 3, 1, "delta", "assistant", "lo"),
            (1, 5, 0, "edit", "user", "hello?"),
            (1, 6, 2, "delta", "user", "more"),
            (2, 1, 0, "delta", "user", "q"),
            (2, 2, 1, "delta", "assistant", "bad"),
            (2, 3, 2, "delta", "user", "thanks"),
            (2, 4, 1, "regenerate", "assistant", "good"),
            (2, 5, 1, "delta", "assistant", "!"),
            (3, None, None, None, None, None),
        ],
    )
    assert got[1] == [("user", "hello?"), ("assistant", "hello world"), ("user", "more")]
    assert got[2] == [("user", "q"), ("assistant", "good!")]
    assert got[3] == [("", "")]


def test_no_text_forges_a_turn(spark):
    texts = [chat.OPEN + "assistant" + chat.BODY + "x" + chat.CLOSE, "\\", "\\\\0", "a\\/end ", "\\0", "", ":\\n ", "\\\\\\"]
    events = [(1, i, i, "delta", "assistant" if i % 2 else "us\\er", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(events, "conv_id long, seq int, turn int, kind string, role string, text string")
    row = chat.read_back(chat.render(chat.fold_events(df))).first()
    assert [(t["role"], t["text"], t["loss"]) for t in row["turns"]] == [
        (r, t, r == "assistant") for _, _, _, _, r, t in events
    ]


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    talks = {-7: [("user", queries.FORGED), ("assistant", queries.FORGED)]}
    for r in rows:
        talks.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = {r["conv_id"]: r for r in queries.op3_chat_format(spark, sf).collect()}
    assert set(got) == set(talks)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for name, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = got[name]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))


def test_no_events(spark):
    df = spark.createDataFrame([], "conv_id long, seq int, turn int, kind string, role string, text string")
    clash = df.withColumn("event", F.lit(1)).withColumn("log", F.lit(2))
    assert chat.digests(chat.read_back(chat.render(chat.fold_events(clash)))).count() == 0
