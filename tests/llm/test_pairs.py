"""MinHash, lattice hashing, decontamination and the components they share, against brute force."""

import random
import re

import numpy as np
import pytest

from tallyframe.llm.components import connected_components
from tallyframe.llm.decontam import MASKS, SPAN, contaminated
from tallyframe.llm.lattice import LatticeSpec, linked_vectors, nearest_e8, roots
from tallyframe.llm.minhash import MinHashSpec, Shingler, near_duplicates


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_sets(docs, n):
    out = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set()
    return out


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def brute_components(docs, n, percent=80):
    sets = shingle_sets(docs, n)
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return groups(ids, links), sets


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.random()}"
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width):
    rng = random.Random(width)
    docs = []
    for base in range(12):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([3, 5, 8, 40, 150, 400]))]
        for copy in range(9):  # from nearly equal to well below the threshold
            docs.append((len(docs) * 3 + 1, " ".join(edited(rng, words, min(len(words) - 1, copy * len(words) // 90)))))
    docs += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, " "), (5004, "One  two\tTHREE"), (5005, "one two three"), (5006, "one")]
    docs += [(6000 + i, "copies of one and the same text that is here many times over") for i in range(60)]
    docs += [(7000, "long text " * 40_000), (7001, "long text " * 40_001)]
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, id int, key string")
    got = {r.doc_id: r for r in near_duplicates(df, MinHashSpec(words=width)).collect()}
    expected, sets = brute_components(docs, width)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicates_across_mixed_buckets(spark):
    """A middle text joins two ends that no star with the smallest id joins."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    docs = [(0, " ".join(edited(rng, words, 9)))]
    for i in range(1, 60):
        docs.append((i, " ".join(edited(rng, words, rng.randint(0, 6)))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, MinHashSpec(words=4)).collect()}
    assert got == brute_components(docs, 4)[0]


def test_near_duplicates_of_texts_longer_than_a_chunk(spark):
    """Most chunks of a mixed bucket hold no text outside its largest component."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    docs = [(0, " ".join(edited(rng, words, 9)))]
    for i in range(1, 30):
        docs.append((i, " ".join(edited(rng, words, rng.randint(0, 12)))))
    pair = [f"v{i}" for i in range(600)]  # share buckets, but are not linked
    docs += [(100, " ".join(pair)), (101, " ".join(pair[:480] + [f"u{i}" for i in range(80)]))]
    expected, _ = brute_components(docs, 4)
    assert expected[100] == 100 and expected[101] == 101 and len(set(expected.values())) > 3
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, MinHashSpec(words=4, chunk=50)).collect()}
    assert got == expected


def test_rows_without_id_or_repeated_are_defined(spark):
    text = "a text of some words that is long enough for shingles"
    rows = [(None, text), (None, None), (4, text), (4, text), (2, text), (9, None), (9, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), MinHashSpec()).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(None, None, True)] * 2 + [(4, 2, False)] * 2 + [(2, 2, True)] + [(9, 9, True)] * 2, key=str
    )
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_are_split_at_ascii_white_space_only():
    s = Shingler(4)
    assert len(s.shingles("a\x1cb c d e")) == 1
    assert set(s.shingles("ÀB a b c")) != set(s.shingles("àb a b c"))
    assert list(s.shingles("A B C D")) == list(s.shingles("a\x0bb\x0cc\rd"))


def test_nearest_lattice_points_are_nearest():
    assert len(roots()) == 240 and np.allclose((roots() ** 2).sum(1), 2)
    x = np.random.default_rng(2).normal(scale=2, size=(500, 8))
    p = nearest_e8(x)
    assert ((2 * p) % 1 == 0).all() and (p.sum(1) % 2 == 0).all()
    whole = (p % 1 == 0).all(1)
    assert (whole | ((p - 0.5) % 1 == 0).all(1)).all()
    best = ((x - p) ** 2).sum(1)
    around = ((x[:, None] - p[:, None] - roots()) ** 2).sum(2).min(1)
    assert (best <= around + 1e-9).all() and best.max() <= 1 + 1e-9


@pytest.mark.parametrize("chunk", [4096, 2])
def test_links_match_brute_force(spark, chunk):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(30):
        base = rng.normal(size=32)
        for _ in range(rng.integers(1, 9)):
            rows.append((base + rng.normal(scale=rng.choice([0.01, 0.1, 0.3]), size=32)).astype(np.float32))
    rows += [rows[0], rows[0] * np.float32(3), -rows[0], rows[5]]
    data = [(7 * i + 3, [float(v) for v in r]) for i, r in enumerate(rows)]
    x = np.array([d[1] for d in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    ids = [d[0] for d in data]
    component = groups(ids, [(ids[a], ids[b]) for a, b in np.argwhere(linked) if a < b])
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [float("inf")] * 32]
    data += [(10_000 + i, v) for i, v in enumerate(odd)] + [(None, data[0][1]), (20_000, data[0][1][:16]), (20_001, [1e30] * 5), (20_002, [1e-30] * 5)]
    df = spark.createDataFrame([(*d, 1, "c") for d in data], "vec_id long, embedding array<float>, label int, node string")
    got = [tuple(r) for r in linked_vectors(df, LatticeSpec(chunk=chunk)).collect()]
    assert len(got) == len(data)
    by_id = {g[0]: g[1:] for g in got}
    for k, i in enumerate(ids):
        assert by_id[i] == (linked[k].sum() - 1, component[i], component[i] == i)
    for i in range(len(odd)):
        assert by_id[10_000 + i] == (0, 10_000 + i, True)
    assert by_id[None] == (0, None, True) and by_id[20_000] == (0, 20_000, True)
    assert by_id[20_001] == (1, 20_001, True) and by_id[20_002] == (1, 20_001, False)
    assert linked_vectors(df.limit(0), LatticeSpec(chunk=chunk)).count() == 0


def test_links_of_a_large_group_are_counted_once(spark):
    """Strips, chunks and cells that share the same pairs."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    x = base + rng.normal(scale=0.22, size=(700, 16))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in linked_vectors(df, LatticeSpec(chunk=300)).collect()}
    component = groups(range(700), [(a, b) for a, b in np.argwhere(near) if a < b])
    missed = sum(near[i].sum() - 1 - got[i][0] for i in range(700)) / (near.sum() - 700)
    assert all(got[i][0] <= near[i].sum() - 1 for i in range(700)) and missed < 1e-3
    assert {i: c for i, (_, c) in got.items()} == {i: component[i] for i in range(700)}


def test_recall_just_above_the_threshold():
    from tallyframe.llm.lattice import cells

    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=(3000, 64))
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * u
    spec = LatticeSpec()
    a, b = cells(x, spec), cells(y, spec)
    step = 1 + spec.blocks * spec.probes
    found = np.zeros(3000, dtype=bool)
    for t in range(spec.tables):
        own = slice(t * step, t * step + 1)
        every = slice(t * step, (t + 1) * step)
        found |= (a[:, own] == b[:, every]).any(1) | (b[:, own] == a[:, every]).any(1)
    assert found.mean() >= 0.999


def test_strangers_of_a_cell_are_not_sent_whole(spark, monkeypatch):
    """Cells so wide that all vectors meet: only those with company by their sketches go on."""
    from tallyframe.llm import lattice

    sent, append = [], lattice.append_columns
    monkeypatch.setattr(lattice, "append_columns", lambda df, *a, **k: sent.append(df.count()) or append(df, *a, **k))
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 64))
    x[297:] = x[0] + rng.normal(scale=0.05, size=(3, 64))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in linked_vectors(df, LatticeSpec(spacing=20.0)).collect()}
    assert sent == [4]
    assert got == {i: (3, 0) if i in (0, 297, 298, 299) else (0, i) for i in range(300)}


@pytest.mark.parametrize("dims", [1, 5, 16, 64, 300])
def test_sketches_of_close_vectors_are_close(dims):
    from tallyframe.llm.lattice import sketch_bound, sketches

    rng = np.random.default_rng(dims)
    x, u = rng.normal(size=(2, 2000, dims))
    x[:100] = np.eye(dims)[rng.integers(0, dims, 100)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
    y = x if dims == 1 else 0.95 * x + np.sqrt(1 - 0.95**2) * u
    apart = sketches(x, LatticeSpec()).astype(int) - sketches(y, LatticeSpec())
    assert (apart**2).sum(1).max() <= sketch_bound(dims, LatticeSpec())


def test_cells_of_two_tables_never_share_a_key():
    from tallyframe.llm.lattice import _cell_key

    points = np.zeros((21, 8))
    points[:, 0] = np.arange(-10, 11) / 2
    keys = [k for table in range(16) for k in _cell_key([points, np.zeros((21, 8))], table, 64).tolist()]
    assert len(set(keys)) == 16 * 21


def test_company_in_cells_matches_brute_force():
    from tallyframe.llm.lattice import _in_company

    rng = np.random.default_rng(3)
    key = np.sort(np.concatenate([rng.integers(0, 300, 900), np.full(700, 7), np.full(66, 1000)]))
    own = rng.random(len(key)) < 0.1
    own[key == 1000] = False
    sketch = rng.integers(-20, 20, (len(key), 4)).astype(np.int8)
    apart = ((sketch[:, None].astype(int) - sketch[None]) ** 2).sum(2)
    near = (apart <= 150) & (key[:, None] == key) & (own[:, None] | own) & ~np.eye(len(key), dtype=bool)
    assert (_in_company(key, own, sketch, 150.0) == near.any(1)).all() and 0 < near.any(1).sum() < len(key)


def test_masks_see_through_two_replaced_words():
    for i in range(13):
        for j in range(13):
            assert any(
                all(s + o not in (i, j) for o in mask) for mask in MASKS for s in range(13 - SPAN + 1)
            )


def words_of(t):
    return re.findall(r"\w+", (t or "").lower())


def brute_contaminated(docs, items):
    out = set()
    for d, t in docs:
        w = words_of(t)
        for i, b in items:
            v = words_of(b)
            size = min(13, len(v))
            allowed = 2 if len(v) >= 13 else 0
            if v and any(
                sum(x != y for x, y in zip(w[p : p + size], v[q : q + size])) <= allowed
                for p in range(len(w) - size + 1)
                for q in range(len(v) - size + 1)
            ):
                out.add((d, i))
    return out


def test_overlaps_match_brute_force(spark):
    rng = random.Random(8)
    make = lambda n: [f"t{rng.randint(0, 400)}" for _ in range(n)]
    items = [(i, " ".join(make(n))) for i, n in enumerate([1, 3, 7, 8, 10, 12, 13, 20, 30, 55])]
    docs = []
    for i, b in items * 12:
        v = b.split()
        for k in rng.sample(range(len(v)), rng.randint(0, min(4, len(v) - 1))):
            v[k] = "zz"
        lo = rng.randint(0, max(0, len(v) - 13))
        part = v[lo : lo + rng.randint(10, 40)]
        docs.append((len(docs), " ".join(make(rng.randint(0, 9)) + part + make(rng.randint(0, 9)))))
    docs += [(900, None), (901, ""), (902, "Begin " * 50_000 + items[8][1].upper().replace(" ", ", ")), (903, items[8][1]), (903, items[8][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, seed int")
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (None, items[8][1]), (99, items[8][1])], "item_id long, text string")
    got = {(r.doc_id, r.item) for r in contaminated(df, bench).collect()}
    assert got == brute_contaminated(docs, items)
    where = {(r.doc_id, r.item): (r.start, r.words) for r in contaminated(df, bench).collect()}
    assert where[(902, 8)] == (50_000, 30) and where[(903, 8)] == (0, 30)


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words"), (None, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert {r.doc_id for r in contaminated(docs, bench).collect()} == {1}
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
