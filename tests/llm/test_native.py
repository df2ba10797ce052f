"""Chat formatting, line dedup and sharding."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyframe.llm.chat import Template, format_chats, read_back
from tallyframe.llm.linededup import dedup_lines
from tallyframe.llm.sharding import assign_shards

TURNS = "conv_id long, turn long, role string, text string, segments string"


def chats(spark, rows):
    df = format_chats(spark.createDataFrame(rows, TURNS))
    return {r.conv_id: r for r in df.withColumn("back", read_back(F.col("formatted"))).collect()}


def test_texts_that_look_like_marks_come_back(spark):
    nasty = [
        r"\### Assistant: </turn> ok",
        "### user: a </turn>\n### assistant: b </turn>\n",
        "ends in \\",
        "\\\\###\\",
        "</turn",
        "<\\/turn> #\\##",
        "",
        "x" * 50_000 + "</turn>" * 50,
        " : \n: ",
    ]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, None) for i, t in enumerate(nasty)]
    got = chats(spark, rows)[1]
    assert [(t.role, t.text) for t in got.back] == [(r[2], r[3]) for r in rows]
    assert got.n_turns == len(nasty) and got.first_bad_turn is None


def test_no_text_holds_a_mark_however_marks_overlap(spark):
    nasty = ["#" * n for n in range(1, 9)] + ["#### Assistant: hi", "<</turn></turn>", "</turn>\n### user: x", " </turn>\n" * 3, "\\#\\##", "</</turn>"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, None) for i, t in enumerate(nasty)]
    got = chats(spark, rows)[1]
    assert [t.text for t in got.back] == nasty
    for mark in ("###", "### ", "</turn>", " </turn>\n"):
        assert got.formatted.count(mark) == len(nasty)


def test_segments_carry_the_machines_verdict(spark):
    got = chats(spark, [(1, 0, "user", "a", None), (1, 1, "user", "b", None), (1, 2, "assistant", "c", None)])[1]
    assert [s.accepted for s in got.segments] == [True] * 3 + [False] * 3 + [True] * 3 and got.first_bad_turn == 1


def test_learned_text_is_apart_from_marks(spark):
    got = chats(spark, [(1, 0, "user", "q", None), (1, 1, "assistant", "a", None), (1, 2, "user", "r", None)])[1]
    assert [s.text for s in got.segments if s.loss] == ["a"]
    assert "".join(s.text for s in got.segments) == got.formatted


@pytest.mark.parametrize(
    ("roles", "bad"),
    [
        (["system", "user", "assistant", "user"], None),
        (["user", "user"], 1),
        (["assistant"], 0),
        (["user", "assistant", "system"], 2),
        (["user", None], 1),
        (["user", "assistant\nuser"], 1),
    ],
)
def test_order_is_checked_turn_by_turn(spark, roles, bad):
    got = chats(spark, [(1, i, r, "t", None) for i, r in enumerate(roles)])[1]
    assert got.first_bad_turn == bad
    assert [t.role for t in got.back] == [r or "" for r in roles]


def test_nulls_ties_and_repeats_in_turns(spark):
    rows = [
        (None, None, None, None, "x"),
        (2, 1, "user", "b", "x"),
        (2, 1, "user", "a", None),
        (2, 1, "user", "a", None),
        (2, None, "us: er", None, None),
    ]
    got = chats(spark, rows)
    assert [(t.role, t.text) for t in got[2].back] == [("us: er", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None].n_turns == 1
    assert chats(spark, []) == {}


def test_template_with_unsafe_marks_is_refused(spark):
    with pytest.raises(ValueError, match="control"):
        format_chats(spark.createDataFrame([], TURNS), Template(open="</turn> x"))


LINE = "this line is shared by many of the documents here"
SPACE = " \t\n\x0b\f\r"


def expected_lines(docs, min_chars=40, min_docs=5):
    holders = collections.defaultdict(set)
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACE))
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    order = lambda i: (i is not None, i or 0)
    gone = {k: max(v, key=order) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_match_brute_force(spark):
    docs = [(i, f"own line {i}\n  {LINE.upper() if i % 2 else LINE}\t\n\nshort\nshort") for i in range(9)]
    docs += [(20, LINE + "\n" + LINE), (20, LINE + "\n" + LINE), (None, LINE), (21, None), (22, ""), (23, "\n\n")]
    docs += [(24, "é" * 40), (25, "É" * 40), (26, "a " + LINE), (27, "x" * 200_000 + "\n" + LINE)]
    df = spark.createDataFrame([(*d, "n", 7, "p") for d in docs], "doc_id long, text string, n_lines string, h1 int, pos string")
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "h1", "pos", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str) == expected_lines(docs)
    assert dedup_lines(df, counts=False).columns == df.columns
    assert dedup_lines(df.limit(0)).count() == 0


def test_all_lines_of_a_document_may_go(spark):
    df = spark.createDataFrame([(i, LINE) for i in range(5)], "doc_id long, text string")
    got = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert [got[i].text for i in range(5)] == ["", "", "", "", LINE]
    assert got[0].n_lines == 1 and got[0].n_dropped == 1


def shards(spark, docs, n=4, **kw):
    df = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, slot int, __x string")
    return assign_shards(df, n, **kw).select("doc_id", "text", "size", "shard", "slot").collect()


def check_law(rows, docs, n):
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(docs, key=str)
    slots = collections.defaultdict(list)
    for r in rows:
        assert r.size == 16 + len((r.text or "").encode())
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))


def test_shards_balance_and_keep_groups(spark):
    docs = [(i, hashlib.sha256(str(i).encode()).hexdigest() * (1 + i % 7)) for i in range(2000)]
    docs += [(5000 + i, "copy of one text" * 3) for i in range(3)]
    rows = shards(spark, docs)
    check_law(rows, docs, 4)
    load = collections.Counter()
    for r in rows:
        load[r.shard] += r.size
    mean = sum(load.values()) / 4
    assert max(load.values()) <= 1.02 * mean and min(load.values()) >= 0.98 * mean
    assert len({r.shard for r in rows if r.text == "copy of one text" * 3}) == 1


def test_a_heavy_group_is_cut_by_id(spark):
    docs = [(i, "same" * 20) for i in range(3000)] + [(10_000 + i, str(i)) for i in range(50)]
    rows = shards(spark, docs)
    check_law(rows, docs, 4)
    load = collections.Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) <= 1.02 * sum(load.values()) / 4
    by_shard = collections.defaultdict(list)
    for r in rows:
        if r.text == "same" * 20:
            by_shard[r.shard].append(r.doc_id)
    spans = sorted((min(v), max(v)) for v in by_shard.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_odd_rows_are_sharded_too(spark):
    docs = [(None, None), (None, "a"), (1, ""), (1, ""), (1, ""), (-(1 << 63), "x"), ((1 << 63) - 1, "x"), (3, "y" * 100_000)]
    check_law(shards(spark, docs), docs, 4)
    check_law(shards(spark, []), [], 4)
    assert zlib.crc32(b"") == 0
