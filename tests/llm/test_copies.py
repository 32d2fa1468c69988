"""Exact and near copies, repeated passages, near vectors and the components behind them."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan
from listing_lake.llm import embeddings, exact_dedup, near_dup, substrings, words
from listing_lake.llm.components import _put_together, components
from listing_lake.llm.tables import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, digest string, hits string, kept string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "d", "h", "k", 1) for i, t in rows], DOCS)


def prose(rng, n, size=4000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


# --- words -----------------------------------------------------------------------------------------


def test_words_and_windows_are_those_of_the_texts():
    rng = random.Random(1)
    texts = [None, "", "  ", "a b  c", "ünï code\x0bx", "a b", "a" * 50 + " b", "  x"] + [" ".join(prose(rng, rng.randrange(30), 5)) for _ in range(200)]
    w = words.split(pa.array(texts)[:])
    seen, windows = {}, {}
    for i, t in enumerate(texts):
        a, b = w.first[i], w.first[i + 1]
        own = WORD.findall(t or "")
        assert [bytes(w.data[s:e]).decode() for s, e in zip(w.starts[a:b], w.ends[a:b])] == own
        for k, h in zip(own, w.hashes[a:b]):
            assert seen.setdefault(k, h) == h
        for k in range(len(own) - 2):
            h = w.windows(3)[a + k]
            assert windows.setdefault(tuple(own[k : k + 3]), h) == h
    assert len(set(seen.values())) == len(seen) and len(set(windows.values())) == len(windows)


def test_sliding():
    x = np.random.default_rng(0).integers(0, 99, 60)
    for width in (1, 2, 7, 18, 60):
        assert all(words.sliding(x, width, np.minimum)[i] == x[i : i + width].min() for i in range(60))


# --- exact -----------------------------------------------------------------------------------------

EXACT = [(1, "a"), (2, "a"), (9, "a"), (3, "b"), (4, None), (5, ""), (6, "A"), (7, "a "), (None, "c"), (None, "c"), (8, "d"), (8, "d"), (None, "e"), (11, "e"), (12, "z" * 400_000), (13, "z" * 400_000)]
KEEP = {1: 9, 2: 9, 9: 9, 3: 3, 4: 5, 5: 5, 6: 6, 7: 7, 8: 8, 11: 11, 12: 13, 13: 13}


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(F.sha2(t, 256), 1, 1), lambda t: F.lit("same")])
def test_exact_classes_hold_when_digests_collide(spark, digest):
    rows = exact_dedup.classes(frame(spark, EXACT), digest=digest).collect()
    assert len(rows) == len(EXACT)
    sizes = Counter(t or "" for _, t in EXACT)
    for r in rows:
        if r.doc_id is not None:
            assert r.keep_id == KEEP[r.doc_id]
            assert r.group_size == sizes[dict((i, t or "") for i, t in EXACT)[r.doc_id]]
    assert sum(r.kept for r in rows) == len(sizes)
    assert sorted(r.keep_id or -1 for r in rows if r.doc_id is None) == [-1, -1, 11]


@pytest.mark.parametrize("batches", [4, 6])
def test_exact_state_spans_micro_batches(spark, monkeypatch, batches):
    seen = []
    fresh = exact_dedup.fresh_path
    monkeypatch.setattr(exact_dedup, "fresh_path", lambda s, label: seen.append((label, fresh(s, label))) or seen[-1][1])
    docs = frame(spark, EXACT * 3).repartition(6)
    rows = exact_dedup.classes(docs, batches=batches).collect()
    sizes = Counter(t or "" for _, t in EXACT)
    assert sorted(r.group_size for r in rows) == sorted(3 * sizes[t or ""] for _, t in EXACT * 3)
    assert sum(r.kept for r in rows) == len(sizes)
    updates = spark.read.parquet(dict(seen)["updates"])
    assert updates.select("batch").distinct().count() >= batches
    # a digest met in several batches was found in the state: its count goes on from there
    assert updates.groupBy("digest").count().filter("count > 1").count() > 0


def test_exact_query_meets_its_state(spark, monkeypatch):
    seen = []
    fresh = exact_dedup.fresh_path
    monkeypatch.setattr(exact_dedup, "fresh_path", lambda s, label: seen.append((label, fresh(s, label))) or seen[-1][1])
    assert exact_dedup.classes(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).count() > 0
    assert spark.read.parquet(dict(seen)["updates"]).select("batch").distinct().count() >= 3


def test_exact_deduplicate(spark):
    docs = frame(spark, EXACT)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert sorted((r.text or "") for r in out.collect()) == sorted({t or "" for _, t in EXACT})
    assert exact_dedup.classes(docs.filter("n > 5")).collect() == []


# --- passages --------------------------------------------------------------------------------------


def brute_repeats(rows, length):
    own = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + length]) for _, w in own for k in range(len(w) - length + 1))
    out = []
    for i, w in own:
        gone = {j for k in range(len(w) - length + 1) if seen[tuple(w[k : k + length])] > 1 for j in range(k, k + length)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(5)
    shared, line = prose(rng, 60), prose(rng, 35)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, " ".join(shared)), (5, "x " * 34), (6, "x " * 36), (7, "y " * 500)]
    for i in range(10, 40):
        body = prose(rng, rng.randrange(10, 200))
        at = rng.randrange(len(body))
        rows.append((i, "  ".join(body[:at] + (shared if i % 3 else line if i % 2 else shared[:34]) + body[at:]) + "\n"))
    once = " ".join(prose(rng, 80))
    rows += [(50, once), (50, once), (None, once + " tail"), (None, None)]
    rows.append((60, " ".join(prose(rng, 300) * 2 + ["é"] + prose(rng, 30_000))))
    return rows


@pytest.mark.parametrize("length", [35, 8, 64])
def test_repeats_against_brute_force(spark, length):
    rows = passages()
    got = substrings.remove_repeats(frame(spark, rows).repartition(5), length)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, length)


def thue_morse(n, one, other):
    """A sequence that no polynomial hash modulo a power of two tells from its complement."""
    return [(one, other)[bin(i).count("1") % 2] for i in range(n)]


def test_repeats_of_words_and_texts_that_polynomials_confuse(spark):
    head = " ".join(prose(random.Random(1), 34))
    rows = [(1, head + " " + "".join(thue_morse(1024, "a", "b"))), (2, head + " " + "".join(thue_morse(1024, "b", "a")))]
    rows += [(3, " ".join(thue_morse(1024, "p", "q"))), (4, " ".join(thue_morse(1024, "q", "p")))]
    got = substrings.remove_repeats(frame(spark, rows), 35).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows, 35)
    assert substrings.remove_repeats(frame(spark, rows).filter("n > 5"), 35).collect() == []
    short = [(1, "".join(thue_morse(1024, "a", "b"))), (2, "".join(thue_morse(1024, "b", "a")))]
    assert all(r["group_size"] == 1 for r in near_dup.classes(frame(spark, short)).collect())
    both = words.split(pa.array([rows[2][1], rows[3][1]]))
    assert len(set(both.whole().tolist())) == len(set(both.whole(second=True).tolist())) == 2


CLASHES = "doc_id long, text string, lang string, source string, of string, _llm_size long, _llm_src int, _llm_file string, _llm_row int, _llm_key string, shards int"


def test_columns_named_like_an_operators_own(spark):
    from listing_lake.llm import mixing, sharding

    rows = [(i, f"some words of text {i % 7} and more of them", "en", f"s{i % 3}", "o", i, 1, "f", 2, "k", 3) for i in range(30)]
    docs = spark.createDataFrame(rows, CLASHES)
    assert exact_dedup.deduplicate(docs).columns == docs.columns and exact_dedup.deduplicate(docs).count() == 7
    assert near_dup.deduplicate(docs).columns == docs.columns
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= set(rows)
    assert sorted(tuple(r)[:11] for r in sharding.shard(docs).collect()) == sorted(rows)


def test_levels_double():
    assert substrings.halves(35) == [18, 35] and substrings.halves(100) == [13, 25, 50, 100] and substrings.halves(5) == [5]


# --- near copies -----------------------------------------------------------------------------------


def bag(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def near_rows():
    rng = random.Random(8)
    rows = []
    for k in range(12):
        base = prose(rng, rng.randrange(40, 300))
        for j in range(6):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 70)):
                own[rng.randrange(len(own))] = "edit" + str(rng.random())
            rows.append((100 * k + j, " ".join(own)))
    rows += [(2000, "one two"), (2001, "one  two"), (2002, "one"), (2003, None), (2004, ""), (2005, "one two three")]
    rows += [(2100, "a b c d e " * 200), (2101, "a b c d e " * 205), (2102, "a b c d e " * 100), (None, rows[0][1]), (5, rows[0][1]), (5, rows[0][1])]
    rows.append((3000, " ".join(prose(rng, 20_000, 10**6))))
    return rows


def test_near_copies_against_brute_force(spark):
    rows = near_rows()
    bags = [bag(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= 0.8]
    assert len(links) > 50
    index = least_reachable(range(len(rows)), links)
    members = {}
    for i, root in index.items():
        members.setdefault(root, []).append(i)
    want = []
    for root, own in members.items():
        ids = [rows[i][0] for i in own]
        want += [(i, min([x for x in ids if x is not None], default=None), len(own)) for i in ids]
    got = near_dup.classes(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.group_size) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in got) == len(members)
    kept = near_dup.deduplicate(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.count() == len(members)
    assert near_dup.classes(frame(spark, rows).filter("n > 5")).collect() == []


@pytest.mark.parametrize("tile", [512, 3])
def test_links_across_groups_of_a_family_are_found(spark, tile):
    """The first document of the family is alike to none; the others make two groups, and one link joins these."""
    rng = random.Random(3)
    base = prose(rng, 200)
    edit = lambda w, at: w[:at] + [f"e{at}{rng.random()}" for _ in range(9)] + w[at + 9 :]
    far = edit(edit(edit(edit(base, 5), 50), 100), 150)
    a = edit(base, 10)
    b = edit(a, 10)
    c = edit(a, 70)
    texts = [far, base, a, b, c, edit(c, 180)]
    bags_ = [bag(" ".join(t)) for t in texts]
    own = [0, 1, 1, 1, 4, 4]
    want = {(min(own[i], own[j]), max(own[i], own[j])) for i in range(6) for j in range(i) if own[i] != own[j] and jaccard(bags_[i], bags_[j]) >= 0.8}
    stars = spark.createDataFrame([(0, n) for n in range(1, 6)], "u long, v long")
    groups = spark.createDataFrame([(n, g) for n, g in enumerate(own)], "node long, component long")
    table = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "node long, text string")
    got = {(min(r), max(r)) for r in near_dup._family_links(stars, groups, table, 0.8, tile).collect()}
    assert got == want and want


def test_groups_are_not_searched_for_links_again(spark, monkeypatch):
    """Where no family has two groups, only the links of near copies pass the components."""
    rng, asked, rows = random.Random(4), [], []
    for k in range(5):
        x = prose(rng, 300)
        rows += [(10 * k + i, " ".join([*x[: 20 * i + 7], f"e{k}-{i}", *x[20 * i + 7 :]])) for i in range(4)]
    monkeypatch.setattr(near_dup, "components", lambda links: asked.append(links.count()) or components(links))
    found = {r.doc_id: (r.class_id, r.group_size) for r in near_dup.classes(frame(spark, rows)).collect()}
    assert found == {i: (i // 10 * 10, 4) for i, _ in rows}
    assert asked[0] >= 15 and asked[1:] == [0, 0]


def test_groups_and_names_are_not_broadcast(spark):
    """Tables that grow with the documents are shuffled, however small they are: each broadcast costs the driver memory."""
    rng = random.Random(6)
    x = prose(rng, 200)
    rows = [(i, " ".join([*x[: 30 * i + 7], f"e{i}", *x[30 * i + 7 :]])) for i in range(4)]
    found = near_dup.classes(frame(spark, rows))
    assert {(r.doc_id, r.class_id, r.group_size) for r in found.collect()} == {(i, 0, 4) for i in range(4)}
    assert "ShuffledHashJoin" in plan(found) and "Broadcast" not in plan(found)


def test_near_copies_are_found_behind_excerpts_of_another_size(spark):
    """Excerpts share the bands of two near copies, and stand first in them, but are too short to be alike to either."""
    rng = random.Random(12)
    rows, pairs = [], []
    for k in range(6):
        x = prose(rng, 400, 10**6)
        y = list(x)
        for at in range(25, 400, 50):
            y[at] = f"edit{k}-{at}"
        a, b = " ".join(x), " ".join(y)
        assert 0.8 <= jaccard(bag(a), bag(b)) < 0.85
        pairs.append((1000 * k, 1000 * k + 1))
        rows += [(1000 * k, a), (1000 * k + 1, b)]
        for j in range(40):
            cut = rng.randrange(300)
            short = " ".join(x[:cut] + x[cut + 100 :])
            assert jaccard(bag(a), bag(short)) < 0.8
            rows.append((1000 * k + 10 + j, short))
    found = {r.doc_id: (r.class_id, r.group_size) for r in near_dup.classes(frame(spark, rows)).collect()}
    for x, y in pairs:
        assert found[x] == found[y] == (x, 2)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    for _ in range(4):
        weight = rng.integers(0, 9, (2, 60))
        real = np.minimum(*weight).sum() / np.maximum(*weight).sum()
        equal = []
        for _ in range(60):
            shingle = rng.integers(0, 2**63, 60).astype(np.uint64)
            doc, at = np.nonzero(weight)
            s = near_dup.signatures(doc, shingle[at], weight[doc, at], 2)
            equal.append((s[0] == s[1]).mean())
        assert abs(np.mean(equal) - real) < 0.03


def test_similarity_of_bags():
    texts = ["a b c d e f a b c d e f", "a b c d e f g", "q", ""]
    doc, x, n = near_dup.bags(words.split(pa.array(texts)))
    cut = np.searchsorted(doc, range(5))
    own = [(x[a:b], n[a:b]) for a, b in zip(cut, cut[1:])]
    for i in range(4):
        for j in range(4):
            assert near_dup.similarity(own[i], own[j]) == pytest.approx(jaccard(bag(texts[i]), bag(texts[j])))


# --- components ------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 420)] + [(5, 5)]
    links += [(rng.randrange(100), rng.randrange(100)) for _ in range(70)]
    want = least_reachable({n for e in links for n in e}, links)
    got = components(spark.createDataFrame(links, "u long, v long"))
    assert {r.node: r.component for r in got.collect()} == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_components_of_stars_take_no_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr("listing_lake.llm.components.written", lambda df, label: made.append(label) or written(df, label))
    stars = spark.createDataFrame([(1, n) for n in range(2, 9)] + [(20, 19), (7, 7)], "u long, v long")
    assert {r.node: r.component for r in components(stars).collect()} == {n: 1 for n in range(1, 9)} | {19: 19, 20: 19}
    assert made == ["edges"]


def test_components_of_a_small_graph_take_no_round(spark, monkeypatch):
    """A path is the worst case of the rounds; its few edges come into one task."""
    made = []
    monkeypatch.setattr("listing_lake.llm.components.written", lambda df, label: made.append(label) or written(df, label))
    path = spark.createDataFrame([(n + 1, n) for n in range(3, 400)], "u long, v long")
    found = components(path)
    assert {r.node: r.component for r in found.collect()} == {n: 3 for n in range(3, 401)}
    assert made == ["edges"] and "Broadcast" not in plan(found)


def test_components_are_written_in_few_files(spark):
    """However many partitions the shuffle has: each file costs every executor two processes where Hadoop has no native library."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "48")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        links = spark.createDataFrame([(n, n - n % 5) for n in range(1, 300)], "u long, v long")
        found = components(links)
        assert {r.node: r.component for r in found.collect()} == {n: n - n % 5 for n in range(300) if n} | {0: 0}
        assert len(found.inputFiles()) <= 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_components_over_many_tasks(spark, monkeypatch):
    """Edges that meet in no task, and come a few at a time, need the rounds."""
    rng, made = random.Random(8), []
    monkeypatch.setattr("listing_lake.llm.components._AT_ONCE", 3)
    monkeypatch.setattr("listing_lake.llm.components._PARTS", 1)
    monkeypatch.setattr("listing_lake.llm.components.written", lambda df, label: made.append(label) or written(df, label))
    links = [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(110)] + [(n + 1, n) for n in range(200, 260)]
    monkeypatch.setattr("listing_lake.llm.components._put_together", lambda e: _put_together(e.repartition(16, "u", "v").sortWithinPartitions("v")))
    got = components(spark.createDataFrame(links, "u long, v long"))
    assert {r.node: r.component for r in got.collect()} == least_reachable({n for e in links for n in e}, links)
    assert len(made) > 2


# --- vectors ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("tile", [4096, 16])
def test_near_vectors_against_brute_force(spark, tile):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 24))
    rows = []
    for i in range(160):
        v = base[i % 12] + rng.normal(size=24) * rng.choice([0.05, 0.1, 0.14])
        rows.append((i, [float(x) for x in v * 10 ** rng.uniform(-3, 3)], int(i % 3)))
    rows += [(200 + i, rows[5][1], rows[5][2]) for i in range(5)] + [(5, rows[5][1], rows[5][2]), (300, rows[5][1], None), (301, None, 1)]
    rows += [(302, [0.0] * 24, 1), (303, [float("nan")] * 24, 1), (304, [None] * 24, 1), (305, [float("inf")] + [1.0] * 23, 1), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [], 1)]
    rows += [(None, rows[8][1], rows[8][2]), (310, [1e300] * 24, 2), (311, [1e-300] * 24, 2)]

    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / max(map(abs, v))
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v, _ in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2]
        and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= 0.98
    ]
    count = Counter(i for e in links for i in e)
    root = least_reachable(range(len(rows)), links)
    ids = {}
    for i, r in root.items():
        ids.setdefault(r, []).append(rows[i][0])
    want = [(rows[i][0], count[i], min([x for x in ids[root[i]] if x is not None], default=None)) for i in range(len(rows))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("x"))
    got = embeddings.links(vectors, 0.98, tile).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert len(links) > 100 and all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.links(vectors.filter("vec_id < 0")).collect() == []


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 40)) * rng.choice([1, 20], (300, 40))
    x /= np.linalg.norm(x, axis=1)[:, None]
    parts, step, error = embeddings._quantised(x)
    near = (parts.astype(float) @ parts.T.astype(float)) * np.outer(step, step)
    bound = (1 + error[:, None]) * error[None, :] + error[:, None] + embeddings._SLACK
    assert (np.abs(near - x @ x.T) <= bound).all()
