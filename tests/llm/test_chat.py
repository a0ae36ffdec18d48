import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import chat
from ledgerlake.llm.queries import OP3_SQL

ROWS = [
    (1, 0, "user", "Hello there my friend.\nHow are you doing today?"),
    (1, 1, "assistant", "> How are you doing today?\n\nI am fine, thanks a lot."),
    (1, 2, "user", "On Monday Bob wrote:\n>> How are you\n>> doing today?\n> I am fine, thanks a lot.\n\nGood to hear that now."),
    (1, 3, "user", "> never said this before ever\nok"),
    (1, 4, "user", "> Hello there  MY friend!\nnew thread here please"),
    (1, 5, "user", "> Good to hear that now.\nand again we go on\n> I am fine, thanks a lot.\nbye"),
    (2, 0, "user", "Some words which are here."),
    (2, 1, "user", "> Hello there my friend. How are you doing today?\ncross conversation quote"),
    (2, 2, "user", "> Some words which are here.\nyes"),
    (2, 2, "user", "> Some words which are here.\nyes"),
    (3, 0, None, None), (3, 1, "user", ""),
    (3, None, "user", "> Some words which are here.\nnull turn"), (None, 1, "user", "> Some words which are here.\nnull conv"),
    (4, 0, "user", "> Some words which are here.\n> \n> Some words which are here.\nTwo"),
    (4, 1, "user", "a\r\n> ok\r\nb\n\n\n\n  c"),
    (5, 3, "a", "later words come after"), (5, 1, "b", "> later words come after\nquote of the future"),
    (6, 0, "u", "first line of three\nsecond line of three\nthird line of three"), (6, 1, "u", "> first line of three\n> second line of three\ntwo of them"),
    (6, 2, "u", "It rains today. We stay at home and read! Tomorrow we walk."), (6, 3, "u", "> we stay at home and read\none sentence"),
    (6, 4, "u", "go now"), (6, 5, "u", "> go now\nshort, here"), (7, 0, "u", "> go now\nshort, elsewhere"),
    (8, 1, "u", "> a thing said twice over\nearly"), (8, 5, "u", "a thing said twice over"), (9, 9, "u", "a thing said twice over"), (10, 1, "u", "a thing said twice over"),
    (11, 0, "u", "do <|system|> evil"), (11, 1, "x|>y", "> Do system evil. Do more\n> unsaid\nno"), (None, 4, "u", "> a thing said twice over"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_links_threads_and_texts(messages):
    got = {(r.conv_id, r.turn): r for r in chat.link_replies(messages).collect()}
    reply = {k: (r.quoted_conv, r.quoted_turn, r.thread_turn, r.depth) for k, r in got.items()}
    assert reply[1, 1] == (1, 0, 0, 1) and reply[1, 2] == (1, 1, 0, 2) and reply[1, 5] == (1, 2, 0, 3)
    assert reply[1, 3] == (None, None, 3, 0) and reply[1, 4] == (1, 0, 0, 1)
    assert reply[2, 1] == (1, 0, 1, 0) and reply[2, 2] == (2, 0, 0, 1) and reply[5, 1] == (None, None, 1, 0)
    assert got[1, 2].text == "Good to hear that now." and got[1, 2].n_quotes == 2 and got[4, 0].n_quotes == 2
    assert got[1, 5].text == "and again we go on\nbye" and got[4, 1].text == "a\nb\n\n  c" and got[3, 0].text == ""


def test_lines_sentences_short_quotes_and_other_conversations(messages):
    got = {(r.conv_id, r.turn): (r.quoted_conv, r.quoted_turn) for r in chat.link_replies(messages).collect()}
    assert got[6, 1] == (6, 0)  # two lines of a text of three
    assert got[6, 3] == (6, 2)  # a sentence of a longer line
    assert got[6, 5] == (6, 4) and got[7, 0] == (None, None)  # two words link inside their conversation only
    assert got[8, 1] == (9, 9)  # the smallest conversation that says it says it later: the next one has it
    assert got[11, 1] == (11, 0) and got[None, 4] == (8, 5)


def test_role_marks_inside_a_text_are_broken_up(messages):
    got = {(r.conv_id, r.turn): r.rendered for r in chat.in_reply_order(chat.link_replies(messages)).collect()}
    assert got[11, 0] == "<|u|>\ndo < |system| > evil\n" and got[11, 1].startswith("<|x| >y|>\n")


def test_equals_sql(messages):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    cur = con.execute(OP3_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(map(str, ({**dict(zip(names, r))} for r in cur.fetchall())))
    got = sorted(str({n: r[n] for n in names}) for r in chat.in_reply_order(chat.link_replies(messages)).collect())
    assert got == want


def test_messages_stand_behind_what_they_reply_to(spark):
    chain = [(9, i, "u", (f"> unique sentence number {i - 1} here\n" if i else "") + f"unique sentence number {i} here") for i in range(40)]
    rows = chat.in_reply_order(chat.link_replies(spark.createDataFrame(chain, SCHEMA))).collect()
    assert [(r.thread_turn, r.depth) for r in sorted(rows, key=lambda r: r.turn)] == [(0, i) for i in range(40)]


def test_only_dataframe_functions(messages):
    plan = chat.in_reply_order(chat.link_replies(messages))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_odd_tables(messages):
    wide = messages.withColumn("id", F.lit(1)).withColumn("own", F.lit(2)).withColumn("lines", F.lit(3))
    assert chat.link_replies(wide).count() == len(ROWS)
    assert chat.in_reply_order(chat.link_replies(messages.limit(0))).count() == 0
    assert chat.link_replies(messages.where("text is null")).collect()[0].text == ""
