import re
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SF_MID
from zonelake.llm import common as C
from zonelake.llm import decontam as D
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, item_id string, containment string"
ITEM = "A train leaves Boston at 40 km per hour and meets another train from Denver after 3 hours on the way home"


def slow_template(text):
    """Tokens (plain, typed, value) of one text, word by word."""
    words = []
    for line in (text or "").split("\n"):
        words += line.split(" ") + ["\x00"]
    out, first, number = [], True, False
    for w in words:
        w = w.strip(" \t\r\x0b\x0c")
        if not w:
            continue
        core = re.sub(r"^[\W_]+|[\W_]+$", "", w)
        low = "%" if w == "%" else core.lower()
        if low:
            if core and D.NUMBER.fullmatch(low):
                out.append(("<num>", "<num>", low))
            elif number and (low in D.UNITS):
                out.append(("<unit>", "<unit>", low))
            elif core[:1].isupper() and core != core.upper() and not first:
                out.append((low, "<name>", low))
            else:
                out.append((low, low, None))
            number = out[-1][0] == "<num>"
            if out[-1][1] == out[-1][0] and not out[-1][0].startswith("<"):
                out[-1] = (low, low, None)
        first = w.rstrip("\"'”’)]»").endswith((".", "!", "?", ":", "\x00"))
    return out


def slow_windows(text, n=5):
    """{(position, form): (tokens, slots)}"""
    t, out = slow_template(text), {}
    for p in range(len(t) - n + 1):
        part = t[p:p + n]
        for form in (0, 1):
            tokens = tuple(x[form] for x in part)
            if sum(not x.startswith("<") for x in tokens) >= 2 and (form == 0 or tokens != tuple(x[0] for x in part)):
                out[(p, form)] = (tokens, [x[2] for x, y in zip(part, tokens) if y.startswith("<")])
    return out


def slow_flags(docs, items):
    known = {k: slow_windows(text) for k, (_, text) in enumerate(items)}
    where = defaultdict(list)
    for k, w in known.items():
        for (p, _), (tokens, slots) in w.items():
            where[tokens].append((k, p, slots))
    out = []
    for doc, text, *_ in docs:
        diagonals = defaultdict(list)
        for (p, _), (tokens, slots) in slow_windows(text).items():
            for k, q, own in where.get(tokens, ()):
                diagonals[(k, p - q)].append((q, own, slots))
        cover = defaultdict(set)
        for (k, _), found in diagonals.items():
            value = defaultdict(set)
            for _, own, slots in found:
                for a, b in zip(own, slots):
                    value[a].add(b)
            if all(len(v) == 1 for v in value.values()):
                cover[k] |= {q for q, _, _ in found}
        hit = {items[k][0]: len(q) / len({p for p, _ in known[k]}) for k, q in cover.items()
               if len(q) / len({p for p, _ in known[k]}) >= 0.8}
        out.append((doc, bool(hit), sorted(hit), round(max(hit.values(), default=0.0), 9)))
    return sorted(out, key=str)


def fast_flags(spark, docs, items):
    got = D.flag_contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id int, text string")).collect()
    return sorted([(r.doc_id, r.contaminated, list(r.item_ids), round(r.containment, 9)) for r in got], key=str)


DOCS = [
    (1, "Intro text. " + ITEM + " and more words follow here", None, None),
    (2, ITEM.replace("40", "75").replace("3 hours", "9 hours").replace("Boston", "Lisbon").replace("Denver", "Porto"), None, None),
    (3, ITEM.lower(), None, None), (4, ITEM.upper(), None, None),
    (5, "A clean text about trains that leave the station at noon and never meet anyone from there", None, None),
    (6, None, "x", None), (7, "", None, "y"), (None, ITEM.replace(" and ", "\nand  "), None, None), (1, "Intro text. " + ITEM, None, None),
    (8, " ".join(ITEM.split()[:12]), None, None), (9, ("filler words again " * 30_000) + ITEM, None, None),
    (10, "The sum of 4 and 4 is the same as 5 more than that", None, None),
    (11, "The sum of 6 and 7 is the same as 5 more than that", None, None),
]
ITEMS = [(0, ITEM), (1, "too short"), (2, None), (3, "The sum of 9 and 9 is the same as 1 more than that"), (4, "1 2 3 4 5 6 7 8 9"), (0, ITEM)]


def test_cases_and_brute_force(spark):
    got = fast_flags(spark, DOCS, ITEMS)
    assert got == slow_flags(DOCS, ITEMS)
    items = defaultdict(list)
    for doc, _, found, _ in got:
        items[doc] += found
    assert items[1] == [0, 0] and items[2] == [0] and items[3] == [0] and items[4] == [0] and items[None] == [0] and items[9] == [0]
    assert not items[5] and not items[6] and not items[7] and not items[8]
    assert items[10] == [3] and not items[11]  # 9 stands for 4 twice; it can't stand for 6 and 7


def test_empty_tables(spark):
    assert all(not r[1] for r in fast_flags(spark, DOCS[:6], []))
    assert fast_flags(spark, [], ITEMS) == []


def test_filter_keeps_clean_rows_and_columns(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    kept = D.drop_contaminated(docs, spark.createDataFrame(ITEMS, "item_id int, text string"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8, 11]


def test_bitmap_holds_every_hash(spark):
    hashes = np.random.default_rng(0).integers(-2**63, 2**63, 500)
    frame = spark.createDataFrame([(int(h),) for h in hashes], "hash long")
    bits = C.bitmap_bytes(C.bitmap(frame, "hash"))
    own = hashes.view(np.uint64)
    assert C.bits_set(bits, own).all() and np.unpackbits(bits).sum() == len(np.unique(own & np.uint64(C.BITMAP_BITS - 1)))
    other = spark.createDataFrame([(int(h) + 1, "x") for h in hashes], "hash long, part string").union(frame.selectExpr("hash", "'y'"))
    found = C.maybe_in(other, "hash", C.bitmap(frame, "hash"))
    assert found.columns == ["hash", "part"] and found.where("part = 'y'").count() == 500 and found.where("part = 'x'").count() < 5


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op5_decontamination"](spark, SF_MID).collect()
    assert sorted([(r.doc_id, r.contaminated, list(r.item_ids), round(r.containment, 9)) for r in got], key=str) == slow_flags(docs, items)
    by = {r.doc_id: r for r in got}
    for doc, text in docs:
        assert set(by[doc].item_ids) >= {i for i, t in items if t in text}


def slow_shares(text, item):
    """Share of the item's windows that a text covers, slot by slot with the value of most windows."""
    own, diagonals = slow_windows(item), defaultdict(list)
    for (p, _), (tokens, slots) in slow_windows(text).items():
        for (q, _), (other, values) in own.items():
            if tokens == other:
                diagonals[p - q].append((q, values, slots))
    covered = set()
    for found in diagonals.values():
        votes = defaultdict(lambda: defaultdict(set))
        for q, values, slots in found:
            for a, b in zip(values, slots):
                votes[a][b].add(q)
        best = {a: max(v, key=lambda b: (len(v[b]), a == b, b)) for a, v in votes.items()}
        covered |= {q for q, values, slots in found if values == slots or all(best[a] == b for a, b in zip(values, slots))}
    return len(covered) / len({p for p, _ in own})


LONG = ("The keeper in Boston counts 3 crates of oranges each morning and then he sends a note about 3 more crates "
        "of oranges to the office in Boston where the clerk writes down the numbers in a ledger every single day")


def test_one_inconsistent_slot_costs_its_own_windows_only(spark):
    texts = [LONG.replace("3 more", "5 more"), LONG.replace("3 crates", "5 crates", 1), LONG.replace("in Boston where", "in Lisbon where"),
             LONG.replace("3", "8").replace("8 more", "9 more"), LONG.replace("3", "8").replace("Boston", "Lisbon"),
             "The sum of 6 and 7 is the same as 5 more than that"]
    items = [(0, LONG), (3, ITEMS[3][1])]
    got = fast_flags(spark, [(i, t, None, None) for i, t in enumerate(texts)], items)
    for doc, hit, found, share in got:
        want = {k: slow_shares(texts[doc], t) for k, t in items}
        assert found == [k for k in want if want[k] >= 0.8] and share == round(max([v for v in want.values() if v >= 0.8], default=0.0), 9)
    assert [hit for _, hit, *_ in got] == [True] * 5 + [False]


def test_sentences_that_begin_with_a_name(spark):
    item = "Tom has 3 apples. Tom buys 4 more apples. How many apples does Tom have now?"
    anna = item.replace("Tom", "Anna")
    texts = [item, anna, anna.replace("4", "9"), "A word before. " + anna, anna.replace("Anna has", "Now Anna has"),
             item.replace("Tom buys", "Anna buys").replace("does Tom", "does Eve"), "Pears cost 3 pence. Plums cost 4 more pence. What do all of them cost?"]
    got = fast_flags(spark, [(i, t, None, None) for i, t in enumerate(texts)], [(0, item)])
    assert [hit for _, hit, *_ in got] == [True] * 5 + [False] * 2 and got[1][3] == 1.0


def test_items_without_windows_match_whole(spark):
    items = [(0, "What is 12 + 7?"), (1, "1 2 3 4 5 6 7 8 9"), (2, "小明有三个苹果吗"), (3, "一天有几个小时?"), (4, "..."), (5, "Why?")]
    texts = ["Say, what is 12 + 7? I ask.", "what is 12 - 7?", "what is 12 + 8?", "0 1 2 3 4 5 6 7 8 9", "1 2 3 4 5 6 7 8 10",
             "前文在此。小明有三个苹果吗?后文在此。", "我们问,一天有几个小时?谁知道", "nothing of it + 7 ...", "so why not"]
    got = fast_flags(spark, [(i, t, None, None) for i, t in enumerate(texts)], items)
    assert [found for _, _, found, _ in got] == [[0], [], [], [1], [], [2], [3], [], [5]]


def test_exact_runs_equal_plain_slices():
    t = D.Template("a b a b c + a b a b c - a", D.Vocabulary())
    for size in (1, 2, 5, 13, 14):
        runs = [tuple(t.whole[i:i + size].tolist()) for i in range(len(t.whole) - size + 1)]
        hashes = t.exact(size).tolist()
        assert len(hashes) == len(runs) and all((a == b) == (x == y) for a, x in zip(hashes, runs) for b, y in zip(hashes, runs))


def test_common_stem_pairs_nothing(spark):
    """300 texts and 200 items that share only the beginning of a question: no match is stored, none is flagged."""
    stem = "which of the following is the best"
    own = lambda kind, i: " ".join(f"{kind}{i}{w}" for w in "abcdefghij")
    docs = spark.createDataFrame([(i, f"{stem} {own('doc', i)}") for i in range(300)] + [(900, f"{stem} {own('item', 7)}")], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"{stem} {own('item', i)}") for i in range(200)], "item_id long, text string")
    stored_rows = {}

    def keep(df, name):
        stored_rows[name] = original(df, name)
        return stored_rows[name]

    original, D.stored = D.stored, keep
    try:
        got = {r.doc_id: r.item_ids for r in D.flag_contaminated(docs, items).where("contaminated").collect()}
    finally:
        D.stored = original
    assert got == {900: [7]}
    assert stored_rows["decontam-matches"].select("key", "row").distinct().count() == 1


def test_worker_vocabulary_is_not_copied_with_the_task():
    from pyspark.cloudpickle import dumps, loads

    def task():
        return D.vocabulary()

    assert loads(dumps(task))() is loads(dumps(task))() is D.vocabulary()


def test_a_text_is_looked_up_in_one_pass():
    """New words between known ones cost no second look-up of the known ones."""
    from zonelake.llm import decontam as D

    class Counted(bytes):
        asked = 0

        def __hash__(self):
            Counted.asked += 1
            return super().__hash__()

        def __eq__(self, other):
            return super().__eq__(other)

    v = D.Vocabulary()
    first = v.look_up([b"alpha", b"beta"])
    again = v.look_up([Counted(b"alpha"), b"new1", Counted(b"beta"), b"new2", Counted(b"alpha")])
    assert Counted.asked == 3
    assert again[[0, 2, 4]].tolist() == first[[0, 1, 0]].tolist() and len(set(again.tolist())) == 4
    assert v.look_up([b"new2", b"new1"]).tolist() == again[[3, 1]].tolist()


def test_window_hashes_do_not_depend_on_how_many_are_usable():
    from zonelake.llm import decontam as D
    t = D.Template("one two three 4 5 6 7 8 9 alpha beta gamma delta epsilon zeta eta theta", D.Vocabulary())
    slots, at, h = t.forms[0]
    tokens = t._form(np.arange(t.n + t.words - 1, dtype=np.uint64), np.ones(t.n, bool))[1]
    for usable in (np.arange(t.n) % 2 == 0, np.arange(t.n) % 4 == 0, np.arange(t.n) % 4 > 0, np.zeros(t.n, bool)):
        where, some = t._form(np.arange(t.n + t.words - 1, dtype=np.uint64), usable)
        assert where.tolist() == np.flatnonzero(usable).tolist() and some.tolist() == tokens[usable].tolist()
    assert len(at) == len(h) == t.usable


MIXED = ["", None, "5", "km of road", "Tom has 5", "km Tom ran. Anna ran 5 km", "+ - *", "1 2 3 4 5 6", "What is 12 + 7?", "日本語 テキスト です", ". , ΑΣ. ΑΣ",
         "a\nb\n\nc d e f.", "Lima is far", "% 5 %", "...", "- 5 -", ITEM, "Intro. " + ITEM, None]


def test_texts_taken_together_equal_single_ones():
    """No window, sentence beginning or unit goes from a text to the next."""
    together = D.Templates(MIXED, D.Vocabulary())
    found = {i: [] for i in range(len(MIXED))}
    for form, places, hashes in together.forms:
        for p, h in zip(places.tolist(), hashes.tolist()):
            found[together.of[p]].append((p - together.starts[together.of[p]], h, together.values(p, form)))
    lone = {i: (size, h) for i, size, h in zip(*(x.tolist() for x in together.ones_without_windows()))}
    for i, text in enumerate(MIXED):
        t = D.Template(text, D.Vocabulary())
        assert sorted(found[i]) == sorted((p, h, t.values(p, form)) for form, at, hashes in t.forms for p, h in zip(at.tolist(), hashes.tolist()))
        assert together.usable[i] == t.usable and together.whole_sizes[i] == len(t.whole)
        assert lone.get(i) == ((len(t.whole), t.exact(len(t.whole)).tolist()[0]) if len(t.whole) and not t.usable else None)
        for size in (1, 2, 5):
            of, position, h = together.runs(size)
            assert h[of == i].tolist() == t.exact(size).tolist() and position[of == i].tolist() == list(range(max(0, len(t.whole) - size + 1)))


def test_short_texts_of_a_batch_are_taken_apart_in_one_pass(spark, monkeypatch):
    """One look-up for an Arrow batch of short texts instead of one a text; a long text has its own."""
    import pyarrow as pa
    passes, cut = [], []
    look_up = D.Vocabulary.look_up
    monkeypatch.setattr(D.Vocabulary, "look_up", lambda self, words: passes.append(len(words)) or look_up(self, words))
    rows = spark.createDataFrame([(1, "x")], "key long, text string")
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, f, schema: cut.append(f))
    D._windows(rows, 5, None, [])
    batch = [f"text {i} of the batch {ITEM}" for i in range(100)]
    out = list(cut[0](iter([pa.record_batch([pa.array(range(100)), pa.array(batch)], names=["key", "text"])])))
    assert passes == [100 * len(batch[0].split())]
    assert set(out[0].column("key").to_pylist()) == set(range(100))
    assert D.together(["a" * D.TOGETHER, "b", None, "c" * D.TOGETHER, "d"]) == [["a" * D.TOGETHER], ["b", None], ["c" * D.TOGETHER], ["d"]]
    assert D.together([]) == []
