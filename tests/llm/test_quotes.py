import random

import duckdb
import pytest

from zonelake.llm import quotes as Q

SCHEMA = "conv_id bigint, turn int, role string, text string, thread string, level int, body string"


def rows():
    a, b, c = "The first point is about trains.\nThe second is about boats.", "I agree with the boats part.", "What about planes in winter?"
    chain = [(9, t, "user", (f"> message number {t - 1} of the chain\n" if t else "") + f"message number {t} of the chain", None, None, None) for t in range(40)]
    return chain + [
        (1, 0, "user", a, "x", 1, None), (1, 1, "assistant", "> The  second is about\tBOATS.\n\n" + b, None, None, None),
        (1, 2, "user", c, None, None, "y"), (1, 3, "assistant", ">> The first point is about trains.\n>> The second is about boats.\n> I agree with the boats part.\nSo do I, mostly.", None, None, None),
        (1, 4, "tool", "> > The second is about boats.\nanswering through the nested quote only", None, None, None),
        (1, 5, None, "> nobody ever said this here\n\nstill here", None, None, None), (1, 6, "user", None, None, None, None),
        (1, 7, "user", "> What about planes in winter?\n> So do I, mostly.\r\nmixed quote of two messages", None, None, None),
        (1, 8, "user", "", None, None, None), (2, 1, "user", "> What about planes in winter?\nother conversation", None, None, None),
        (2, 1, "user", "> What about planes in winter?\nother conversation", None, None, None),
        (3, 0, "user", "> short\n>\nquotes the future > here", None, None, None), (3, 5, "user", "quotes the future > here\nlonger than that", None, None, None),
        (None, 0, "user", a, None, None, None), (None, 1, "user", "> " + a.split("\n")[0] + "\nx", None, None, None), (4, None, "user", "no turn", None, None, None),
        (6, 0, "user", "an opening remark", None, None, None), (6, 1, "user", "> an opening remark\nyes", None, None, None), (6, 1, "user", "> something else entirely\nno\nmaybe so", None, None, None),
        (6, 2, "user", "> maybe so\nquoting the second text", None, None, None),
        (5, 0, "user", "word " * 30_000, None, None, None), (5, 1, "user", "> " + "word " * 30_000 + "\nseen", None, None, None)]


def as_set(got):
    return sorted(((r.conv_id, r.turn, r.role, r.reply_to, r.thread, r.depth, r.body, r.chat) for r in got), key=str)


def by_key(spark, data):
    return {(r.conv_id, r.turn): r for r in Q.format_chats(spark.createDataFrame(data, SCHEMA)).collect()}


def test_links_threads_and_bodies(spark):
    got = by_key(spark, rows())
    assert len(Q.format_chats(spark.createDataFrame(rows(), SCHEMA)).collect()) == len(rows())
    place = {k: (r.reply_to, r.thread, r.depth) for k, r in got.items()}
    assert place[(1, 0)] == (None, 0, 0) and place[(1, 1)] == (0, 0, 1) and place[(1, 3)] == (1, 0, 2)
    assert place[(1, 4)] == (0, 0, 1) and place[(1, 5)] == (None, 5, 0) and place[(1, 6)] == (None, 6, 0)
    assert place[(1, 7)] == (2, 2, 1) and place[(2, 1)] == (None, 1, 0) and place[(3, 0)] == (None, 0, 0)
    assert place[(None, 1)] == (None, 1, 0) and place[(5, 1)] == (0, 0, 1) and place[(9, 39)] == (38, 0, 39)
    assert got[(1, 3)].body == "So do I, mostly." and got[(1, 5)].body == "still here" and got[(3, 0)].body == "quotes the future > here"
    assert got[(1, 6)].body is None and got[(1, 6)].chat == "<|user|>\n<|end|>" and got[(1, 5)].chat.startswith("<|unknown|>")
    assert all(r.reply_to is None or r.reply_to < r.turn for r in got.values())


def by_sql(data):
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", [r[:4] for r in data])
    return sorted(db.execute("select conv_id, turn, role, reply_to, thread, depth, body, chat from (" + Q.OP10_SQL + ")").fetchall(), key=str)


def test_equals_the_sql(spark):
    assert as_set(Q.format_chats(spark.createDataFrame(rows(), SCHEMA)).collect()) == by_sql(rows())


def test_short_quotes_and_sentences(spark):
    data = [(1, 0, "user", "Why?"), (1, 1, "user", "> Why?\nBecause."), (1, 2, "user", "A first sentence here. A second sentence here. And 3.5 more!"),
            (1, 3, "user", "> A second sentence here.\nOk."), (1, 4, "user", "> And 3.5 more!\nNo."), (1, 5, "user", "> Because.\n> A first sentence here.\nboth"),
            (1, 6, "user", "> a first\n> sentence here.\nwrapped"), (1, 7, "user", "> 5 more!\nno sentence"),
            (2, 0, "user", "\u4f60\u597d\u3002\u518d\u89c1\uff01"), (2, 1, "user", "> \u518d\u89c1\uff01\nx"), (2, 2, "user", "> x\n>\n> Nobody.\ny"), (2, 3, "user", ">\n> \nblank quote")]
    data = [(*r, None, None, None) for r in data]
    got = {k: r.reply_to for k, r in by_key(spark, data).items()}
    assert got == {(1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 2, (1, 4): 2, (1, 5): 2, (1, 6): 2, (1, 7): None,
                   (2, 0): None, (2, 1): 0, (2, 2): 1, (2, 3): None}
    assert as_set(Q.format_chats(spark.createDataFrame(data, SCHEMA)).collect()) == by_sql(data)


def quote_trees(seed, conversations=12, turns=70):
    """Messages that answer a random earlier one: its text, a line or a sentence of it is quoted, with the quotes it held."""
    rnd, out, answered = random.Random(seed), [], {}
    for c in range(conversations):
        written, parents = [], []
        for t in range(turns):
            own = [" ".join(f"{rnd.choice('abcdefgh')}{c}t{t}s{rnd.randrange(10**6)}" for _ in range(rnd.randint(1, 4))) + rnd.choice(".!?") for _ in range(4)]
            own = [" ".join(own[:2]), " ".join(own[2:])]
            parent = rnd.randrange(t) if t and rnd.random() < 0.85 else None
            quote = []
            if parent is not None:
                above, said = written[parent]
                pick = [said, [rnd.choice(said)], [rnd.choice(rnd.choice(said).replace("! ", ". ").replace("? ", ". ").split(". "))]][rnd.randrange(3)]
                if len(pick) == 1 and pick[0] not in said:  # a sentence: with the mark that it ends with
                    whole = next(x for x in said if pick[0] in x)
                    end = whole.index(pick[0]) + len(pick[0])
                    pick = [pick[0] + whole[end:end + 1].strip()]
                quote = [">" + x if x.startswith(">") else "> " + x for x in (above if rnd.random() < 0.5 else [])] + ["> " + x.upper() for x in pick]
            written.append((quote, own))
            parents.append(parent)
            out.append((c, t, "user", "\n".join(quote + own), None, None, None))
        answered.update({(c, t): p for t, p in enumerate(parents)})
    return out, answered


@pytest.mark.parametrize("seed", [1, 2])
def test_generated_quote_trees(spark, seed):
    data, answered = quote_trees(seed)
    got = Q.format_chats(spark.createDataFrame(data, SCHEMA)).collect()
    assert as_set(got) == by_sql(data)
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == answered
    assert max(r.depth for r in got) > 5


@pytest.mark.parametrize("data", [[]])
def test_empty_table(spark, data):
    assert Q.format_chats(spark.createDataFrame(data, SCHEMA)).count() == 0
