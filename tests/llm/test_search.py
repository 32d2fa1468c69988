"""Ranked search, personal data and token alignment against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from listing_lake.llm import alignment, lexical, personal, registry

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, bag binary, _llm_file string, start int"


def documents(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, None, "s", None, "x", b"y", "z", 1) for i, t in zip(ids, texts)], DOCS)


# ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def own_terms(text):
    return TERM.findall((text or "").translate(CAPITALS))


def ranked(docs, items, top=10):
    bags = [(i, Counter(own_terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(1 for s in sizes if s), sum(sizes)
    holding = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for (doc, bag), size in zip(bags, sizes):
            m = 10 + (90 * size * n) // total if total else 10
            score = 0
            for term in set(own_terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * holding[term] + 1)))
                score += w * ((1000000000 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc, score))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, x[2], x[3]) for r, x in enumerate(scores[:top])]
    return sorted(out, key=repr)


def searched(spark, docs, items, **options):
    frame = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    found = lexical.search(frame, spark.createDataFrame(items, "item_id long, text string, rank int"), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_search_against_brute_force(spark, block_bytes):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Été", "ÉTÉ", "x²", "İi", "naïve"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(80)]
    texts += [None, "", "...", "W1,w1;W1\x00w2", "w3 " * 5000] + [texts[0]] * 30 + ["w5 w6"] * 15
    docs = list(enumerate(texts)) + [(7, texts[7]), (None, texts[9]), (None, texts[9])]
    items = [(1, "W1 w2 w2 w3", 0), (2, "Été x²", 0), (3, None, 0), (4, "", 0), (5, "absent"  , 0), (6, "w5 w6", 0), (None, "w9", 0), (6, texts[0], 0)]
    assert searched(spark, docs, items, block_bytes=block_bytes) == ranked(docs, [x[:2] for x in items])


def test_search_scores_each_class_once(spark):
    docs = documents(spark, ["a b a"] * 50 + ["a a b", "b a a c"])
    bags = lexical._bags(docs, lexical.terms(lexical.pa.array(["a b"]))[0])
    classes = lexical._classes(bags, 52, 157, 10).collect()
    assert sorted(len(r["members"]) for r in classes) == [1, 10]
    assert min(r["members"] for r in classes if len(r["members"]) == 10) == list(range(10))


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a", 0)]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a", 0)]) == []


# personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for hit in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", hit[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in hit[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((hit.start(), order, f"{kind}:{hit.start()}:{hit.end()}"))
    return [x[2] for x in sorted(out)]


HARD = [
    None, "", "a@b", "a@b.c", "é😀 mail: jo.e+x@mail-1.example.com_y@z.org, @x.y a@b..c", "a@b.c.@d.e a%@1.2-.-", "@".join("abcdefg") + ".h.i",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.01.1.0001 1.2.3", "٣.٤ 99999999999999999999.1.1.1 1.1.1.99999999999999999999",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 4111  1111 1111 1111 4111111111111112 0000000000000000000000",
    "+1 (988) 555-2485. +49 30.123456-78) +1 2 ++12345678 +123456789012345678 +5", "+1" + " ." * 50, "+1 234 567 890 4111111111111111",
    "call 😀 4242424242424242 or +44 20 7946 0958, mail x@y.z from 10.0.0.1",
]


def personal_rows(spark, texts):
    found = registry.F.col("spans")
    base = registry.F.filter("spans", lambda x: x["base"])
    df = personal.find(documents(spark, texts)).withColumn("base", personal.written_out(base)).withColumn("all", personal.written_out(found))
    return sorted(df.collect())


def test_personal_data_against_brute_force(spark):
    rng = random.Random(5)
    alphabet = "0123456789019283746.-+@ () ab\né,45🙂"
    texts = HARD + ["".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(300)]
    texts += ["4111111111111111"] * 3 + ["x@y.z 1.2.3.4 " * 2000, "0" * 60_000, "a" * 60_000 + "@", "a." * 30_000, "1." * 30_000, "+1" + "-" * 60_000]
    for row, text in zip(personal_rows(spark, texts), texts):
        want = base_spans(text)
        assert row["base"] == ",".join(want), text[:200]
        kinds = Counter(x.split(":")[0] for x in want)
        assert [row[f"n_{k}"] for k in PATTERNS] == [kinds[k] for k in PATTERNS]


def test_personal_data_added_kinds(spark):
    texts = [
        "konto GB82 WEST 1234 5698 7654 32 ok", "GB82WEST12345698765433", "DE89370400440532013000.", "My SSN is 123-45-6789", "part 123-45-6789",
    ]
    got = [r["all"] for r in personal_rows(spark, texts)]
    assert got == ["iban:6:33", "", "iban:0:22", "ssn:10:21", ""]
    scores = [[s["score"] for s in r["spans"]] for r in personal_rows(spark, texts)]
    assert scores == [[1.0], [], [0.8], [0.6], []]


def test_personal_data_of_nothing(spark):
    assert personal_rows(spark, []) == []


def test_personal_data_plan_is_one_native_stage(spark):
    from conftest import plan

    text = plan(registry.personal_data(spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


# alignment


class Whole:
    """Both tokenizers on whole texts."""

    def __init__(self):
        a, b = map(public_tokenizers.path, registry.ALIGNED)
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        letters = {v: k for k, v in alignment.byte_letters().items()}
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items() if all(c in letters for c in t)}

    def __call__(self, text):
        if not text:
            return [], []
        plain = (" " + text).encode()
        a = [(i, self.a_bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            b.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != plain or b"".join(x for _, x in b) != plain:
            return [], []
        return a, b


def places(tokens):
    out, at = [], 0
    for i, piece in tokens:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def aligned(texts):
    whole, per_doc, counts = Whole(), [], Counter()
    for text in texts:
        a, b = map(places, whole(text))
        links, j = [], 0
        for x in a:
            while j and b[j][1] > x[1] or j == len(b):
                j -= 1
            k = j
            while k < len(b) and b[k][1] < x[2]:
                if b[k][2] > x[1]:
                    links.append((x[0], b[k][0]))
                    j = k
                k += 1
        counts.update(links)
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, lo = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if lo < x[2] <= end) for side in (a, b)))
            lo = end
        per_doc.append((len(a), len(b), links, groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (len_a, len_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups))
        for len_a, len_b, links, groups in per_doc
    ]


TEXTS = [
    None, "", "a", " ", "  ", "\n", "Hello world, it's 2024!", "  two  spaces\n\n next \t tab \r\n end  ", "nbsp  x  y　z\u0085 w  v  u",
    "<|endoftext|> <s> </s> <unk> <0x41>", "lower ▁ eighth", "naïve Été ñandú größe", "日本語のテキスト 中文 한국어", "🙂🙃 👩‍👩‍👧 é", "\x00\x01 \x1c \x1f x", "﻿bom ​ zero",
    "x" * 12_000 + " y", "don't we'll I'm they've", "!!! ... ,,, ((()))", "trailing space ", "trailing newline\n", "it's ok ", "1234567890 3.14 1,000",
    "\U0010ffff", "a  b   c    d", "a \nb \n c", "  lead", "x▁y",
]


def test_alignment_against_brute_force(spark):
    rng = random.Random(9)
    parts = ["the", " ", "  ", "Thing", "é", "\n", ",", "12", "ß", " ", "日本", "'s", "🙂", "\t", "un", "believ", "able"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(150)] + ["same text here"] * 5
    a, b = map(public_tokenizers.path, registry.ALIGNED)
    docs = documents(spark, texts)
    want = aligned(texts)
    for options in ({}, {"held_pairs": 40}, {"held_pairs": 0}):
        got = sorted(alignment.align(docs, a, b, **options).collect())
        assert [tuple(r)[1:] for r in got] == want, options


def test_alignment_in_parts(spark, monkeypatch):
    known = alignment.pair(*map(public_tokenizers.path, registry.ALIGNED))
    texts = alignment.pa.array(["one two three four five six seven", None, "eight nine", ""])
    whole = list(alignment._parts(known.words(texts), texts))
    monkeypatch.setattr(alignment, "PART_WORDS", 2)
    parts = list(alignment._parts(known.words(texts), texts))
    assert len(whole) == 1 and len(parts) > 3
    for field in ("a", "b"):
        ids = [getattr(p, field).ids.tolist() for p in parts]
        assert sum(ids, []) == getattr(whole[0], field).ids.tolist()
    assert sum((p.codes().tolist() for p in parts), []) == whole[0].codes().tolist()


def test_alignment_of_nothing(spark):
    a, b = map(public_tokenizers.path, registry.ALIGNED)
    assert alignment.align(documents(spark, []), a, b).collect() == []
    got = alignment.align(documents(spark, [None, ""], [None, 3]), a, b).collect()
    assert sorted(map(tuple, got), key=repr) == [(3, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_query_digests(spark):
    got = {r["doc_id"]: r for r in registry.aligned_tokens(spark, "/root/testdata/sf0.001").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = sorted(docs)
    for i, want in zip(ids, aligned([docs[i] for i in ids])):
        digest = hashlib.sha256(want[-1].encode()).hexdigest() if want[-1] else ""
        assert tuple(got[i])[1:] == (*want[:-1], digest)
