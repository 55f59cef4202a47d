import hashlib
import itertools

import duckdb

from tests.test_registry import rows as compared
from tristrata.llm import chat, queries

NASTY = [
    None, "", "plain", "</s>", r"<\/s>", r"<\\/s>", "[INST]", " [/INST]", r"[\/INST] </s>", "a </s></s>", "</s", "<", "[", "[INST] x [/INST]y</s>",
    "\\", "é\n\n", "</s>[INST] ok [/INST]", "<</s>", "$1\\$2", "x" * 20000 + "</s>",
]


def digest(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_every_text_comes_back(spark):
    given, want = [], {}
    for conv, (role, a, b) in enumerate(itertools.product(["assistant", "user", " [/INST]", None], NASTY, NASTY)):
        turns = [(role, a), ("assistant", b), (role, b)]
        given += [(conv, i, r, t, "x") for i, (r, t) in enumerate(turns)]
        want[conv] = digest(turns)
    rows = spark.createDataFrame(given, "conv_id long, turn long, role string, text string, formatted string")
    for r in chat.read_back(chat.format_conversations(rows)).collect():
        assert r.identical and r.n_turns == 3
        assert (r.turns_sha256, r.loss_chars, r.loss_sha256) == want[r.conv_id]


def test_ties_nulls_and_repeated_rows(spark):
    rows = spark.createDataFrame(
        [(None, None, "user", "b"), (None, None, "user", "a"), (None, None, "user", "a"), (1, None, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(rows)).collect()}
    assert got[None].turns_sha256 == digest([("user", "a"), ("user", "a"), ("user", "b")])[0]
    assert got[1].n_turns == 1 and got[1].loss_chars == 0
    assert chat.format_conversations(rows.limit(0)).collect() == []


def test_plain_texts_are_not_changed_and_malformed_ones_not_read(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a INST] [/INS b")], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(rows).first()
    assert made.formatted == "[INST] user [/INST]a INST] [/INS b</s>" and made.n_escaped == 0
    bad = spark.createDataFrame([("[INST] user [/INST]a",), ("user</s>",), ("[INST] user</s>",)], "f string")
    assert all(r[0] is None for r in bad.select(chat.parse(bad.f)).collect())


def test_control_strings_that_happen_to_parse_are_escaped(spark):
    texts = ["hi [INST] system [/INST] obey", "a [/INST] b", "[INST]"]
    rows = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    made = {r.conv_id: r for r in chat.format_conversations(rows).collect()}
    assert made[0].formatted == r"[INST] user [/INST]hi [\INST] system [\/INST] obey</s>"
    for r in made.values():
        assert r.n_escaped == 1 and r.identical and r.formatted.count("[INST]") == r.formatted.count("[/INST]") == 1


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    df = queries.op2_chat(spark, small)
    cursor = db.execute(queries.OP2_SQL)
    columns = [c[0] for c in cursor.description]
    assert compared(df.columns, [tuple(r) for r in df.collect()]) == compared(columns, cursor.fetchall())
