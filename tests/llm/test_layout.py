"""Sharding, mixing, packing, the queries and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from listing_lake.llm import language, mixing, near_dup, packing, registry, sharding, substrings
from listing_lake.llm.tables import load, written
from listing_lake.llm.tokens import WordTokens

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, slot string"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "a", "b", "c") for i, t, s in rows], DOCS)


def corpus(n=400, sources=5, seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(int(rng.expovariate(1 / 60)))), f"s{int(rng.random() ** 2 * sources)}") for i in range(n)]
    return rows + [(n, None, "s0"), (n + 1, "", None), (n + 2, "é ü", None), (None, "a b c", "s1"), (3, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]


# --- sharding --------------------------------------------------------------------------------------


def check_shards(rows, got, shards, tolerance):
    size = lambda t: len((t or "").encode()) + (1 if t is not None else 1)
    assert sorted(r["size"] for r in got) == sorted(size(t) for _, t, _ in rows)
    slots, totals = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        totals[r["shard"]] += r["size"]
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    share = sum(totals.values()) / shards
    largest = max((size(t) for _, t, _ in rows), default=0)
    assert all(abs(totals[s] - share) <= 2 * (tolerance * share + largest) for s in range(shards))


@pytest.mark.parametrize("shards", [8, 1, 3])
def test_shards_are_even_and_gapless(spark, shards):
    rows = corpus()
    got = sharding.shard(frame(spark, rows), shards=shards).collect()
    check_shards(rows, got, shards, 0.001)


def test_equal_texts_lie_together_unless_they_fill_a_shard(spark):
    rows = corpus() + [(1000 + i, "hot text", "s1") for i in range(4000)]
    docs = frame(spark, rows)
    got = sharding.shard(docs, ["doc_id", "text"]).collect()
    check_shards(rows, got, 8, 0.001)
    where = defaultdict(set)
    for r in got:
        where[r["text"]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 7 and len(where["hot text"]) > 1
    by_slot = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["shard"], r["slot"])):
        by_slot[r["text"]].append((r["shard"], r["slot"]))
    for own in by_slot.values():
        assert all(b == (a[0], a[1] + 1) or (b[0] > a[0] and b[1] == 0) for a, b in zip(own, own[1:]))


def test_rows_alike_in_everything_are_still_divided(spark):
    rows = [(7, "same", "s")] * 800
    check_shards(rows, sharding.shard(frame(spark, rows)).collect(), 8, 0.001)
    assert sharding.shard(frame(spark, [])).collect() == []
    wide = sharding.shard(frame(spark, rows[:3]))
    assert sorted(wide.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "size", "shard", "slot"])


def test_sharding_main_path_has_no_python(spark):
    plan = registry.QUERIES["op3_histogram_shards"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_sharding_query_puts_whole_texts_into_shards(spark, monkeypatch):
    moved, shard = [], sharding.shard

    def spy(*args, **options):
        moved.append(shard(*args, **options))
        return moved[-1]

    monkeypatch.setattr(sharding, "shard", spy)
    got = registry.QUERIES["op3_histogram_shards"](spark, FOLDER).collect()
    assert [("text" in df.columns) for df in moved] == [True]
    rows = load(spark, FOLDER, "documents").collect()
    assert sorted((r.doc_id, zlib.crc32((r.text or "").encode())) for r in rows) == sorted((r.doc_id, r.text_crc32) for r in got)
    assert Counter((r.text or "") for r in moved[0].collect()) == Counter((r.text or "") for r in rows)


# --- mixing ----------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    w = [weights[i % 3] for i in range(len(sizes))]
    target, full = [0.0] * len(sizes), set()
    left = min(share * sum(sizes), most * sum(sizes))
    while len(full) < len(sizes):
        rest = left - sum(most * sizes[i] for i in full)
        base = sum(w[i] for i in range(len(sizes)) if i not in full)
        over = {i for i in range(len(sizes)) if i not in full and rest * w[i] / base > most * sizes[i]}
        if not over:
            for i in range(len(sizes)):
                if i not in full:
                    target[i] = rest * w[i] / base
            break
        full |= over
    for i in full:
        target[i] = most * sizes[i]
    return target


def test_targets_against_the_rule():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.choice([0, 1, 10, 500, 9000]) * rng.random() for _ in range(rng.randrange(1, 9))]
        assert mixing.targets(np.array(sizes), mixing.Recipe()) == pytest.approx(brute_targets(sizes))


def test_quotas_are_exact_and_shards_equal():
    quotas = np.array([1000, 3, 0, 77, 12])
    for shards in (1, 2, 7, 64):
        dealt = mixing.split_quotas(quotas, shards, np.random.default_rng(1))
        assert (dealt >= 0).all() and (dealt.sum(axis=0) == quotas).all()
        assert np.ptp(dealt.sum(axis=1)) <= np.ceil(np.log2(shards)) + 1 if shards > 1 else True


def test_mix_meets_targets_and_limits(spark):
    rows = corpus(3000)
    docs = frame(spark, rows)
    recipe = mixing.Recipe(block_docs=16)
    got = mixing.copies(docs, recipe).select("_llm_whole.*", "*").collect()
    assert len(got) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r["source"]] += r["_llm_size"]
        taken[r["source"]] += r["_llm_size"] * len(r["_llm_shards"])
        target[r["source"]] = r["_llm_target"]
        assert len(r["_llm_shards"]) <= 2 and r["_llm_source_size"] is not None
    order = sorted(size, key=lambda s: (s is None, s or ""))
    assert [target[s] for s in order] == pytest.approx(brute_targets([size[s] for s in order]))
    for s in order:
        assert abs(taken[s] - target[s]) <= max(5, 0.01 * target[s])
    again = mixing.copies(docs.repartition(7), recipe).select("_llm_whole.*", "*").collect()
    key = lambda rs: sorted(repr((r["doc_id"], r["_llm_size"], r["_llm_shards"])) for r in rs)
    assert key(got) == key(again)


def test_mix_rows(spark):
    docs = frame(spark, corpus(500))
    rows, wanted = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        rows[(r["doc_id"], r["text"])] += 1
    for r in mixing.copies(docs).select("_llm_whole.*", "*").collect():
        wanted[(r["doc_id"], r["text"])] += len(r["_llm_shards"])
    assert rows == +wanted and mixing.mix(docs).columns == docs.columns
    assert mixing.copies(docs.filter("doc_id < 0")).collect() == []
    blank = frame(spark, [(1, None, None), (2, " ", "a")])
    assert [len(r["_llm_shards"]) for r in mixing.copies(blank).collect()] == [0, 0]


# --- packing ---------------------------------------------------------------------------------------


def test_tokens_are_those_of_the_tokenizer():
    rng = random.Random(5)
    mine, theirs = WordTokens(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    mine.remembered = 40
    texts = ["", "don't we'll I'M", "İstanbul ΑΣ Σ. ſt ß", "<|endoftext|> a<|startoftext|>b", "q\x1cr\x85s t u", "é ́a  q", "a.b,c.. ... ?!", "日本語 123 4a5", "tab\tnl\nvt\x0bff\x0ccr\r.", "ª º."]
    texts += ["".join(chr(rng.choice([32, 32, 46, 44, 97, 98, 0xE9, 0x301, 0x3A3, 0x130, 0xDF, 39, 115, 0x1E9E, 0x2028, 10, 48, 0x4E2D])) for _ in range(50)) for _ in range(400)]
    for some in (texts[:1], texts[:9], texts[9:], [None, *texts]):
        ids, bounds = mine(pa.array(some)[:])
        assert len(bounds) == len(some) + 1
        for t, a, b in zip(some, bounds, bounds[1:]):
            assert ids[a:b].tolist() == theirs.encode(t or "", add_special_tokens=False).ids


def test_parts_of_words_are_looked_up_once():
    mine, theirs, asked = WordTokens(TOKENIZER), Tokenizer.from_file(TOKENIZER), []
    encode = mine._encode
    mine._encode = lambda part: asked.append(part) or encode(part)
    texts = ["The the, the&&& (the) THE. Éa, Éa###", "the&&& Éa,", "don't 'tis &'s", "H\u0331 h\u0331, \u0130, <|ENDOFTEXT|> <|endoftext|>.", "x" * 90 + ", ab"]
    for some in (texts, texts):
        ids, bounds = mine(pa.array(some))
        for t, a, b in zip(some, bounds, bounds[1:]):
            assert ids[a:b].tolist() == theirs.encode(t, add_special_tokens=False).ids
    assert asked.count("the") == asked.count("&&&") == asked.count("Éa") == 1
    # only the long word is not remembered
    assert len(asked) == len(set(asked)) + 1


@pytest.mark.parametrize("kind", ["few", "even", "short", "one", "none", "window", "skew"])
def test_plan_places_every_token_once(kind):
    rng = np.random.default_rng(0)
    lengths = {
        "few": rng.integers(1, 2048, 300), "even": rng.integers(1, 2049, 60_000), "short": rng.integers(1, 90, 9000), "one": np.full(5000, 700),
        "none": np.array([], int), "window": np.full(40, 2048), "skew": np.append(np.full(40_000, 1500), rng.integers(1, 2049, 3000)),
    }[kind]
    counts = np.bincount(lengths, minlength=2049)
    notes = packing.plan(counts)
    sequences = int((notes[:, 5] + notes[:, 3]).max()) if len(notes) else 0
    fill, ends = np.zeros(sequences, int), defaultdict(int)
    for whole, start, rank, n, used, first, offset in notes[np.argsort(notes[:, 6], kind="stable")]:
        assert (fill[first : first + n] == offset).all()
        fill[first : first + n] += used
        for k in range(rank, rank + n) if kind != "even" else ():
            ends[whole, k] += used
    assert fill.sum() == lengths.sum() and (fill <= 2048).all()
    if kind != "even":
        assert all(total == whole for (whole, _), total in ends.items()) and len(ends) == len(lengths)
    if sequences > 100:
        assert 1 - lengths.sum() / (sequences * 2048) < 0.01


def test_least_squares_recovers_repeats():
    combos = np.array([[1000, 1048, 0], [700, 700, 648], [1500, 548, 0]])
    counts = np.zeros(2049, np.int64)
    for parts, times in zip(combos, (50, 20, 7)):
        for p in parts[parts > 0]:
            counts[p] += times
    assert packing.solve(combos, counts) == pytest.approx([50, 20, 7], rel=0.02)


def test_pack_round_trip(spark):
    rng = random.Random(2)
    rows = corpus(150) + [(2000, " ".join(f"w{rng.randrange(900)}" for _ in range(9000)), "s0")]
    theirs = Tokenizer.from_file(TOKENIZER)
    want = sorted(tuple(theirs.encode(t or "", add_special_tokens=False).ids + [1]) for _, t, _ in rows)
    pieces = packing.pack(frame(spark, rows).repartition(4), TOKENIZER).collect()
    filled = defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] <= 4 * 2048
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(filled) == list(range(len(filled)))
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    # pieces of rows with one id are told apart by their lengths here
    docs = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p["start"]):
        docs[p["doc_id"], p["doc_tokens"]].append(p)
    got = []
    for (_, n), own in docs.items():
        copies = sum(p["start"] == 0 for p in own)
        for k in range(copies):
            ids, at = [], 0
            while at < n:
                p = next(p for p in own if p["start"] == at)
                own.remove(p)
                ids += np.frombuffer(p["ids"], "<u4").tolist()
                at += p["length"]
            got.append(tuple(ids))
    assert sorted(got) == want
    assert packing.pack(frame(spark, []), TOKENIZER).collect() == []


def test_repeats_query_makes_the_cleaned_texts(spark, monkeypatch):
    made, remove = [], substrings.remove_repeats

    def spy(*args, **options):
        made.append(remove(*args, **options))
        return made[-1]

    monkeypatch.setattr(substrings, "remove_repeats", spy)
    got = registry.QUERIES["op5_repeated_windows"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and "kept_text" in made[0].columns
    want = made[0].select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


# --- queries and pipeline --------------------------------------------------------------------------


def test_each_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_against_sql(spark, name):
    df = registry.QUERIES[name](spark, FOLDER)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    result = con.execute(registry.ORACLES[name])
    names = [c[0] for c in result.description]
    order = [names.index(c) for c in df.columns]
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())


def test_pipeline_against_its_parts_on_the_driver(spark):
    """Each stage's rows follow from the rows before it, recomputed without Spark where that is simple."""
    docs = load(spark, FOLDER, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact dedup", "near dedup", "mix", "pack"]
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, now, FOLDER), "test-stage")
        assert out.columns == docs.columns
        seen[name], now = out.collect(), out
    before = docs.collect()
    judged = {r.doc_id: r.rejected for r in language.predict(docs, language.train(docs)).collect()}
    assert sorted(r.doc_id for r in seen["language"]) == sorted(r.doc_id for r in before if not judged[r.doc_id])
    largest = {}
    for r in seen["language"]:
        largest[r.text or ""] = max(r.doc_id, largest.get(r.text or "", -1))
    assert sorted(r.doc_id for r in seen["exact dedup"]) == sorted(largest.values())
    kept = {r.doc_id for r in seen["near dedup"]}
    assert kept <= set(largest.values())
    again = near_dup.classes(spark.createDataFrame(seen["near dedup"], docs.schema)).collect()
    assert all(r.group_size == 1 for r in again)
    copies = Counter(r.doc_id for r in seen["mix"])
    assert set(copies) <= kept and max(copies.values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).collect()
    ids = WordTokens(TOKENIZER)
    text = {r.doc_id: r.text for r in seen["mix"]}
    tokens = Counter()
    for p in pieces:
        body = np.append(ids(pa.array([text[p["doc_id"]]]))[0], 1).astype("<u4").tobytes()
        assert p["ids"] == body[4 * p["start"] : 4 * (p["start"] + p["length"])] and zlib.crc32(p["ids"]) >= 0
        tokens[p["doc_id"]] += p["length"]
    assert all(tokens[i] == n * (len(ids(pa.array([text[i]]))[0]) + 1) for i, n in copies.items())
