"""Fill-in-middle, filter audit and substring dedup against brute force."""

import collections
import hashlib
import itertools
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyframe.llm.audit import AuditSpec, failure_counts, order_audit
from tallyframe.llm.fim import FimSpec, fill_in_middle, frame_texts, stream, unit_ends, with_digests
from tallyframe.llm.substring import Automaton, SubstringSpec, WordHashes, drop_repeated_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
CLASHES = "id string, Form string, FRAMES int, row int, h int, mask int, part string, n int, words string, data string"
CLASH_ROW = ("i", "f", 1, 2, 3, 4, "p", 5, "w", "d")


def table(spark, rows, kinds="doc_id long, text string, lang string"):
    """Rows with more columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, *CLASH_ROW) for r in rows], f"{kinds}, {CLASHES}")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill-in-middle ---------------------------------------------------------------

ODD = [None, "", " ", "\n\t", "one", " one two ", "é ü\x0b中文  字", "holds <P> here", "a <S>", "<M>", "x < P> y <", "a b c"]


def fim_by_hand(doc_id, text, spec):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = [int(sha(f"{spec.seed}:{'' if doc_id is None else doc_id}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= spec.plain_from:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spec.spm_below:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("spec", [FimSpec(), FimSpec(frame_units=2, plain_from=100), FimSpec(seed=7, frame_units=5, spm_below=30)])
def test_fim_equals_cutting_the_whole_text(spark, spec):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(["ab", " ", "\n", "é", "<", "P>", "word "]) for _ in range(rng.randint(1, 80))) for _ in range(150)]
    texts.append("long text é " * 40_000)
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "no id at all", None), (5, "same id", None), (4, "one", None)]
    out = fill_in_middle(frame_texts(table(spark, rows), spec), spec)
    got = collections.Counter()
    for r in out.collect():
        whole = b"".join(stream(r.output)).decode()
        # The frames, one after the other, are one zstandard stream of the text.
        again = zstandard.ZstdDecompressor().stream_reader(b"".join(r.output), read_across_frames=True).read()
        assert again.decode() == whole
        got[(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, whole)] += 1
    want = collections.Counter((i, *fim_by_hand(i, t, spec)) for i, t, _ in rows)
    assert got == want
    digests = collections.Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in with_digests(out, spec).collect())
    assert digests == collections.Counter((i, sha(fim_by_hand(i, t, spec)[-1]), sha(t or "")) for i, t, _ in rows)


def test_fim_decompresses_only_frames_with_a_cut(spark, monkeypatch):
    from tallyframe.llm import fim

    spec = FimSpec(frame_units=3)
    data = " ".join(f"w{i}" for i in range(100)).encode()
    frames = fim.cut_frames(data, 3, zstandard.ZstdCompressor())
    assert [f["units"] for f in frames][-2:] == [99, 100] and frames[-1]["chars"] == len(data)
    opened = []
    plain = zstandard.ZstdDecompressor

    class Counting:
        def __init__(self):
            self.inner = plain()

        def decompress(self, frame):
            opened.append(frame)
            return self.inner.decompress(frame)

    monkeypatch.setattr(fim.zstandard, "ZstdDecompressor", Counting)
    parts, chars = fim.select_parts(frames, 30, 50)  # the first cut lies between frames
    assert len(opened) == 1 and sum(chars) == len(data)
    assert parts[0] == [f["data"] for f in frames[:10]]
    assert list(unit_ends(b" a  b ")) == [2, 5, 6]


def test_fim_of_nothing(spark):
    assert with_digests(fill_in_middle(frame_texts(table(spark, [])))).collect() == []


# ---- filter audit -----------------------------------------------------------------


def audit_by_hand(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = []
    for i, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        upper = sum("A" <= c <= "Z" for c in t)
        bad = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * upper > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and first[t] < i,
        }
        fails.append((i, lang or "", {k for k, v in bad.items() if v}))
    out = {}
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        share = collections.Counter()
        for order in orders:
            left = own
            for step, c in enumerate(order, 1):
                removed = [(i, f) for i, f in left if c in f]
                gone_before = [x for x in own if x not in left]
                left = [(i, f) for i, f in left if c not in f]
                share[c] += len(removed)
                redundant = sum(c in f and bool(f & set(order[: step - 1])) for _, f in own)
                assert redundant == sum(c in f for _, f in gone_before) or len(set(map(str, own))) < len(own)
                out[part, order, step] = (
                    len(left), len(removed), redundant, sum(f == {c} for _, f in own),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed),
                )
        for order in orders:
            for step, c in enumerate(order, 1):
                out[part, order, step] += (share[c],)
    return out


def audit(spark, docs, labels):
    df = table(spark, docs).withColumnsRenamed({"h": "H", "n": "good"})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return order_audit(failure_counts(df, marks, AuditSpec(filter_bits=1 << 16)))


def test_audit_equals_applying_every_order(spark):
    rng = random.Random(1)
    docs = []
    for i in range(160):
        words = [rng.choice(["alpha", "beta", "GAMMA", "delta", "$x", "y|z", f"w{rng.randint(0, 400)}"]) for _ in range(rng.choice([0, 3, 99, 100, 101, 240]))]
        docs.append((i, rng.choice([" ", "\n", " \x0b"]).join(words), rng.choice(["en", "fr", None, ""])))
    docs += [(200 + i, docs[i * 3][1], "en") for i in range(40)]
    docs += [(300, None, "en"), (301, "", "fr"), (302, "É" * 99 + "A" * 11, "de"), (303, "É" * 90 + "A" * 10, "de")]
    docs += [(304, " ".join(f"w{i}" for i in range(100)), "xx"), (None, docs[0][1], "en"), (None, "no id", "en"), (7, "other text", "en")]
    docs += [(308, " ".join(f"w{i % 80}" for i in range(100)), "xx"), (309, " ".join(f"w{i % 79}" for i in range(100)), "xx")]
    docs += [(302, "É" * 99 + "A" * 11, "de"), (400, "long tail " * 20_000, "en"), (401, "long tail " * 20_000, None)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 230, 2)] + [(4, None, 1), (None, 1, 1), (300, None, None)]
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit(spark, docs, labels).collect()}
    assert got == audit_by_hand(docs, labels)


def test_audit_of_nothing(spark):
    assert audit(spark, [], []).collect() == []
    got = audit(spark, [(1, None, None)], []).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}


def test_filters_alone_say_nothing_of_hash_equality(spark, monkeypatch):
    """Two texts under one hash are told apart by the exact comparison."""
    from tallyframe.llm import audit as module

    texts = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "a", 5), (4, "b", 5), (5, "c", 5)], "id long, text string, h long")
    got = module.copies_of_smaller(texts, texts, 1 << 16)
    assert sorted(r.id for r in got.collect()) == [3, 4]


# ---- substring dedup --------------------------------------------------------------


def dedup_by_hand(docs, window):
    starts = collections.Counter()
    split = [(i, WORD.findall(t or "")) for i, t, _ in docs]
    for _, w in split:
        starts.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    out = collections.Counter()
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if starts[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def dedup(spark, docs, spec):
    out = drop_repeated_passages(table(spark, docs).repartition(3), spec).collect()
    for r in out:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    return collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in out)


def passages(seed):
    rng = random.Random(seed)
    pool = [[f"p{p}w{i}" for i in range(rng.randint(30, 90))] for p in range(6)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"{rng.choice('abcdef')}{rng.randint(0, 30)}" for _ in range(rng.randint(0, 40))]
            p = rng.choice(pool)
            a = rng.randint(0, len(p))
            words += p[a : a + rng.randint(0, 70)]
        docs.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(words), None))
    return docs


@pytest.mark.parametrize("anchor_stretches", [64, 2, 0])
def test_substrings_equal_counting_all_windows(spark, anchor_stretches):
    docs = passages(1)
    docs += [(100, None, None), (101, "", None), (102, " \n ", None), (103, "w " * 500, None), (104, "a b c " * 60, None)]
    docs += [(105, docs[3][1], None), (105, docs[4][1], None), (None, docs[5][1], None), (None, "short", None)]
    docs += [(106, "twice " + " ".join(f"u{i}" for i in range(50)), None)] * 2
    docs += [(107, " ".join(f"once{i}" for i in range(35)), None), (108, " ".join(f"é{i}" for i in range(34)), None)]
    spec = SubstringSpec(anchor_stretches=anchor_stretches, shard_words=2_000)
    assert dedup(spark, docs, spec) == dedup_by_hand(docs, 35)


def test_substrings_of_small_windows_and_two_letters(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))), None) for i in range(40)]
    spec = SubstringSpec(window=12, shingle=3, shard_words=100, anchor_stretches=3)
    assert dedup(spark, docs, spec) == dedup_by_hand(docs, 12)


def test_substrings_of_long_texts_and_of_nothing(spark):
    rng = random.Random(2)
    long = [f"w{rng.randint(0, 10**6)}" for _ in range(120_000)]
    docs = [(1, " ".join(long), None), (2, " ".join(long[500:600] + ["x"] * 10 + long[70_000:70_034]), None), (3, "y" * 1_200_000, None)]
    got = {i: (n, gone) for i, n, gone, _ in dedup(spark, docs, SubstringSpec())}
    assert got == {1: (120_000, 100), 2: (144, 100), 3: (1, 0)}
    assert drop_repeated_passages(table(spark, [])).collect() == []


def test_hot_passage_with_unlike_surroundings(spark):
    """Every document holds the passage; what lies around it is its own."""
    common = " ".join(f"c{i}" for i in range(60))
    docs = [(i, f"{' '.join(f'l{i}x{j}' for j in range(40))} {common} {' '.join(f'r{i}x{j}' for j in range(40))}", None) for i in range(200)]
    got = dedup(spark, docs, SubstringSpec(shard_words=1_000, anchor_stretches=16))
    assert got == dedup_by_hand(docs, 35) and all(gone == 60 for _, _, gone, _ in got)


def test_automaton_counts_every_string():
    rng = random.Random(4)
    for _ in range(60):
        texts = [[rng.choice("ab") for _ in range(rng.randint(1, 12))] for _ in range(4)]
        times = [rng.randint(1, 2) for _ in texts]
        machine = Automaton()
        for t, n in zip(texts, times):
            machine.add(t, n)
        machine.finish()
        for least in (1, 2, 3, 5):
            counts = collections.Counter()
            for t, n in zip(texts, times):
                for k in range(len(t) - least + 1):
                    counts[tuple(t[k : k + least])] += n
            for t in texts:
                want = [k + least for k in range(len(t) - least + 1) if counts[tuple(t[k : k + least])] > 1]
                assert machine.repeated_ends(t, least) == want


def test_word_hashes_do_not_depend_on_pieces():
    data = "Alpha beta\tbeta é \x0b alpha  ".encode() * 40 + b"q" * 300 + b" end"
    whole, pieces = WordHashes(), WordHashes(piece=16)
    for a, b in zip(whole(data), pieces(data)):
        assert a.tolist() == b.tolist()
    start, end, h = whole(data)
    words = data.split()
    assert [data[a:b] for a, b in zip(start, end)] == words
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))


def test_specs_out_of_range():
    with pytest.raises(ValueError, match="shingle"):
        SubstringSpec(window=100, shingle=8)
