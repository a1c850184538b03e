"""Filter audit, phrase collocations and harmonic packing against plain Python."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditspine.llm import collocations, filter_audit, harmonic, packing, queries
from creditspine.sources.session import tune

WORDS = public_tokenizers.path("word_bpe_49k.json")
PAD = ("h", 1, 2, 3, "w", 4, "p", 5, 6, "x", 7)
CLASH = "hash string, n int, mask int, id int, words string, key int, part string, fp int, start int, `a.b` string, f int"


def docs(spark, rows):
    """Rows (doc_id, text, lang, source) with further columns of clashing names."""
    tune(spark)
    return spark.createDataFrame([(*r, *PAD) for r in rows], f"doc_id long, text string, lang string, source string, {CLASH}")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --- filter audit ----------------------------------------------------------------------
def plain_audit(rows, marks):
    """Every order applied to every row."""
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, t in marks if t == 1 and i is not None}
    low = {}
    for i, text, _, _ in rows:
        if i is not None:
            low[text or ""] = min(i, low.get(text or "", i))
    per_part = defaultdict(list)
    for i, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > low[text],
        }
        per_part[source or ""].append(({k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part, held in per_part.items():
        shapley = Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = held
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[0]]
                left = [r for r in left if letter not in r[0]]
                failing = sum(letter in r[0] for r in held)
                shapley[letter] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), failing - len(gone),
                              sum(r[0] == {letter} for r in held), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def random_rows(n, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "B", "cé", "dog", "#x", "Tree"]) for _ in range(rng.choice([3, 50, 250]))) for _ in range(n // 3)]
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(300)) for _ in range(5)]
    return [(rng.choice([None, k, k, k, 7]), rng.choice([None, "", *texts]), None, rng.choice([None, "", "s1", "s2"])) for k in range(n)]


def test_audit_against_every_order(spark):
    rows = random_rows(60, 3)
    marks = [(k, k % 2, k % 3 % 2) for k in range(0, 60, 2)] + [(4, 1, 0), (None, 1, 1), (8, None, 1), (900, 1, 1)]
    got = filter_audit.audit(docs(spark, rows), labels(spark, marks))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.select(columns).collect()) == plain_audit(rows, marks)


def test_audit_of_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK", 16)
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", 0)
    rows = [(k, "same text" if k % 3 == 0 else f"text {k}", None, "s") for k in range(300)]
    got = filter_audit.combinations(docs(spark, rows), labels(spark, []))
    assert {(r["mask"], r["n"]) for r in got.collect()} == {(1, 201), (17, 99)}


def test_audit_of_nothing(spark):
    assert filter_audit.audit(docs(spark, []), labels(spark, [])).count() == 0


# --- phrase collocations -------------------------------------------------------------------
def plain_phrases(rows, longest, least, share, top):
    count, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                count.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    often = {p: a for p, a in count.items() if len(p[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, words), a in often.items():
        cuts = [(2_000_000 * a // (count[lang, words[:k]] + count[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(
            other == lang and len(longer) > len(words) and 100 * f >= share * a
            and any(longer[i:i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), f in often.items())
        if not inside:
            out[lang].append((-score, -a, " ".join(words).encode(), count[lang, words[:k]], count[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def phrase_rows(n, seed, size=40):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "cat", "sät", "on", "mat", "x", "ſ", "#1", "\U0001F600"]
    joins = [" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\x0b", " ; "]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice(joins) for _ in range(rng.randrange(size)))
    return [(k, rng.choice([None, "", " ,. ", text(), text(), text()]), rng.choice([None, "und", "en", "de"]), None) for k in range(n)]


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_against_plain_counts(spark, monkeypatch, seed):
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", 0 if seed == 2 else 500_000)
    rows = phrase_rows(150, seed)
    rows += rows[:30]
    want = plain_phrases(rows, 4, 5, 80, 20)
    assert len({w[0] for w in want}) == 3
    assert collected(collocations.collocations(docs(spark, rows), longest=4, least=5, share=80, top=20)) == want


def counts_of(text, lengths, lang="en"):
    """Phrases that the parts of a text give, read back by their positions."""
    seeds = np.array([collocations.language_hash(lang)], dtype=np.uint64)
    both = collocations.Polynomial(0), collocations.Polynomial(1)
    parts = list(collocations.parts_of(text, 0, 1, lengths[-1]))
    blocks = [b for part in parts for b in collocations.hash_block([part], seeds, both, lengths, None)]
    words, got = text.split(), Counter()
    for fp, mark, _, _, pos, size, n in zip(*collocations.count_equal(blocks)):
        phrase = words[pos:pos + size]
        assert collocations.fingerprint(lang, phrase) == (fp.view(np.int64), mark.view(np.int32))
        got[tuple(phrase)] += int(n)
    return got, len(parts)


@pytest.mark.parametrize("lengths", [[1], [2], [3, 4], [1, 2, 3, 4]])
def test_phrases_of_a_long_text_in_small_blocks(monkeypatch, lengths):
    monkeypatch.setattr(collocations, "BLOCK", 64)
    rng = random.Random(5)
    words = rng.choices([b"a", b"bb", b"ccc"], k=500)
    words[100] = b"x" * 700  # longer than a block
    text = b" ".join(words)
    got, parts = counts_of(text, lengths)
    assert got == sum((Counter(zip(*[words[k:] for k in range(n)])) for n in lengths), Counter()) and parts > 5
    assert counts_of(b"y" * 900, [1])[0] == {(b"y" * 900,): 1}


def test_many_fingerprints_equal_single_ones():
    runs = [[b"a"], [b"the", b"cat"], [b"x" * 300, "é".encode(), b"z"], [b"a", b"a", b"a", b"b"]]
    langs = ["en", "de", "", "en"]
    seeds = np.array([collocations.language_hash(n) for n in langs], dtype=np.uint64)
    got = collocations.fingerprints(seeds, runs, (collocations.Polynomial(0), collocations.Polynomial(1)))
    assert list(zip(*(x.tolist() for x in got))) == [collocations.fingerprint(n, r) for n, r in zip(langs, runs)]


def test_colliding_fingerprints_stay_apart(monkeypatch):
    """With fingerprints of 3 bits nearly all phrases collide; the marks tell them apart."""
    phrases = collocations.Polynomial.phrases
    monkeypatch.setattr(collocations.Polynomial, "phrases",
                        lambda self, *a: phrases(self, *a) & np.uint64(7 if self.k == 0 else collocations.MASK))
    words = b"a b a b c d a b".split()
    both = collocations.Polynomial(0), collocations.Polynomial(1)
    blocks = list(collocations.hash_block([(b" ".join(words), 0, 1, 0, 0)], np.array([1], dtype=np.uint64), both, [2], None))
    got = Counter()
    for *_, pos, _, n in zip(*collocations.count_equal(blocks)):
        got[tuple(words[pos:pos + 2])] += int(n)
    assert got == Counter(zip(words, words[1:]))


def test_phrases_of_nothing(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, None, None, None), (2, " ", "en", None)])).count() == 0


def test_scores_beyond_64_bits(spark):
    known = spark.createDataFrame(
        [("en", "a b", 2, 9 * 10**13), ("en", "a", 1, 10**14), ("en", "b", 1, 10**14 + 7)], "lang string, phrase string, words int, f long")
    row = collocations.scored(known).first()
    assert row["score"] == 2_000_000 * 9 * 10**13 // (2 * 10**14 + 7)


# --- harmonic packing ----------------------------------------------------------------------
def check_packed(rows, texts, end_id, capacity):
    """Every id once, in order, in gapless sequences without padding."""
    whole = Tokenizer.from_file(WORDS)
    want = Counter(tuple(whole.encode(t or "", add_special_tokens=False).ids + [end_id]) for t in texts)
    per_sequence = defaultdict(list)
    for r in rows:
        per_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in per_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    assert sum(r["length"] for r in rows) == sum(len(k) * n for k, n in want.items())
    return want


def test_harmonic_on_odd_rows(spark):
    rows = [(1, "The cat", None, None), (1, "The cat", None, None), (None, None, None, None), (2, "", None, None), (3, "x " * 9000, None, None)]
    got = harmonic.pack_documents(docs(spark, rows).repartition(2), WORDS, end_id=2, capacity=256).collect()
    want = check_packed(got, [r[1] for r in rows], 2, 256)
    whole = next(k for k in want if len(k) > 1000)
    pieces = sorted((r for r in got if r["doc_id"] == 3), key=lambda r: r["start"])
    assert np.frombuffer(b"".join(r["ids"] for r in pieces), dtype="<u4").tolist() == list(whole)
    assert harmonic.pack_documents(docs(spark, []), WORDS, end_id=2).count() == 0
    with pytest.raises(ValueError):
        harmonic.pack_documents(docs(spark, rows), WORDS, end_id=2, capacity=100)


def test_harmonic_sequences_can_be_read(spark):
    rows = [(k, " ".join(["word"] * (k % 70)), None, None) for k in range(200)]
    packed = harmonic.pack_documents(docs(spark, rows), WORDS, end_id=2, capacity=64)
    sizes = [(r["length"], len(r["ids"])) for r in packing.sequences(packed.select("sequence_id", "offset", "length", "ids")).collect()]
    assert all(b == 4 * n for n, b in sizes)
    assert sum(n < 64 for n, _ in sizes) <= 6 * packed.rdd.getNumPartitions()


@pytest.mark.parametrize("seed", range(5))
def test_bins_leave_no_padding(seed):
    rng = random.Random(seed)
    bins = harmonic.Bins(128, 0)
    total = 0
    for doc in range(300):
        length = rng.randrange(1, 400)
        at = 0
        for size in harmonic.reciprocal_cuts(length, 128):
            bins.add((doc, at, size, length, b""))
            at += size
        assert at == length
        total += length
    bins.finish()
    fills = Counter()
    for _, _, size, _, _, sequence, offset in bins.placed:
        assert fills[sequence] == offset
        fills[sequence] += size
    assert sum(fills.values()) == total
    assert all(f <= 128 and f & (f - 1) == 0 for f in fills.values())
    assert sum(f < 128 for f in fills.values()) <= 7


def test_harmonic_query_against_tokenizer(spark, folder):
    got = queries.op13_harmonic_packing(spark, folder).collect()
    source = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check_packed(got, source.values(), 2, 4096)
    whole = Tokenizer.from_file(WORDS)
    ids = {d: np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for d, t in source.items()}
    for r in got:
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes())
    starts = defaultdict(list)
    for r in got:
        starts[r["doc_id"]].append((r["start"], r["start"] + r["length"]))
    for spans in starts.values():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0
