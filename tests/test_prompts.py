import io

import pandas as pd
import pytest

from murmura.operators import prompts as p

POSTS = [
    (1, "a", 'He said "hi", ok', "line one\nline two", 3.0, 1, "100"),
    (2, "a", "plain", None, 12.5, 2, "300"),
    (3, "b", " padded", "é", None, 0, "200"),
    (4, "a", "oldest", "x", 1.0, 0, "50"),
    (5, None, "no group", "x", 1.0, 0, "50"),
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(
        POSTS,
        "id int, subreddit string, title string, body string, score double, num_comments int, "
        "created_utc string",
    ).repartition(3)


@pytest.fixture(scope="module")
def contexts(posts):
    return p.prompt_context(posts, 2)


def test_context_is_the_csv_pandas_writes(contexts):
    frame = pd.DataFrame(
        [(r[2], r[3], r[1], r[4], r[5]) for r in POSTS],
        columns=["title", "body", "subreddit", "score", "num_comments"],
    )
    got = {r["subreddit"]: (r["n_rows"], r["context"]) for r in contexts.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"] == (2, frame.iloc[[1, 0]].to_csv(index=False).removesuffix("\n"))
    assert got["b"] == (1, frame.iloc[[2]].to_csv(index=False).removesuffix("\n"))


def test_context_without_comment_counts(posts):
    first = p.prompt_context(posts.drop("num_comments"), 1).first()["context"]
    assert first.startswith("title,body,subreddit,score\n")


def test_joint_context(contexts):
    row = p.joint_context(contexts, ["b", "a", "missing"]).first()
    assert row["n_rows"] == 3
    frame = pd.read_csv(io.StringIO(row["context"]))
    assert frame["subreddit"].tolist() == ["b", "a", "a"]
    assert frame["title"].tolist() == [" padded", "plain", 'He said "hi", ok']


def test_prompts(contexts):
    got = p.build_prompts(contexts, {"ask": "What is new?"}, "Role.")
    assert got.columns == ["subreddit", "instruction", "prompt"]
    row = got.filter("subreddit = 'b'").first()
    context = contexts.filter("subreddit = 'b'").first()["context"]
    assert row["prompt"] == f"Role.\n\nData (CSV):\n{context}\n\nInstruction: What is new?"
    two = {"ask": "What is new?", "more": "And then?"}
    assert p.build_prompts(contexts, two, "Role.").count() == 4


def test_questions_as_a_table(spark, contexts):
    asked = [("a", "q1", "Why?"), ("a", "q2", "Who?"), ("b", "q1", "When?"), ("zz", "q1", "Where?")]
    questions = spark.createDataFrame(asked, "subreddit string, name string, text string")
    got = p.build_prompts(contexts, questions, "Role.").collect()
    assert {(r["subreddit"], r["instruction"], r["prompt"].rsplit(": ", 1)[1]) for r in got} == set(asked[:3])


def test_all_groups_in_pages(contexts):
    whole = p.joint_contexts(contexts).first()
    frame = pd.read_csv(io.StringIO(whole["context"]))
    assert whole["page"] == 0 and whole["n_rows"] == 3
    assert frame["subreddit"].tolist() == ["a", "a", "b"]
    pages = p.joint_contexts(contexts, 1).orderBy("page").collect()
    assert [(r["page"], r["n_rows"]) for r in pages] == [(0, 2), (1, 1)]


def test_a_post_loaded_twice_is_one_place_each(spark):
    rows = [(1, "a", "t", "x", 1.0, "100"), (1, "a", "t", "y", 1.0, "100"), (None, "a", "n", "z", 1.0, "200")]
    posts = spark.createDataFrame(
        rows, "id int, subreddit string, title string, body string, score double, created_utc string"
    )
    assert p.prompt_context(posts, 2).first()["n_rows"] == 2
    assert "n,z" in p.prompt_context(posts, 1).first()["context"]


def test_transcripts(spark):
    messages = [
        (1, 2, "assistant", "€ two"),
        (1, 0, "system", "zero"),
        (1, 1, "user", None),
        (1, 3, None, "three"),
        (2, None, None, None),
    ]
    df = spark.createDataFrame(messages, "conv_id int, turn int, role string, text string")
    got = {(r["conv_id"], r["page"]): r["transcript"] for r in p.render_transcripts(df).collect()}
    assert got == {
        (1, 0): "Assistant:\nzero\n\nUser:\n\n\nAssistant:\n? two\n\nUser:\nthree",
        (2, 0): "No messages.",
    }


def test_long_transcripts_go_on_over_pages(spark):
    df = spark.range(2500).selectExpr("1 AS conv_id", "id AS turn", "'user' AS role", "'m' || id AS text")
    pages = p.render_transcripts(df.repartition(5)).orderBy("page").collect()
    whole = "\n\n".join(r["transcript"] for r in pages)
    assert [r["page"] for r in pages] == [0, 1, 2]
    assert whole == "\n\n".join(f"User:\nm{i}" for i in range(2500))


def test_messages_without_a_turn_stay(spark):
    rows = [(1, 0, "user", "first"), (1, None, "user", "lost b"), (1, None, None, "lost a"), (3, None, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {(r["conv_id"], r["page"]): r["transcript"] for r in p.render_transcripts(df).collect()}
    assert got == {
        (1, 0): "User:\nfirst",
        (1, -1): "User:\nlost a\n\nUser:\nlost b",
        (3, -1): "User:\nonly",
    }
    pages = p.render_transcripts(df, page_turns=1).filter("conv_id = 1").orderBy("page").collect()
    assert [r["page"] for r in pages] == [-2, -1, 0]
