"""Queries that SQL cannot express, against plain Python over the same rows."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from checks.compare import differences, oracle_connection
from creditspine.llm import oracles, queries, secret_scan, tokens

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    return {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = oracle_connection(FOLDER)
    assert differences(spark, con, name, queries.QUERIES[name], oracles.ORACLES[name], FOLDER) is None


def test_neighbours_recall_and_scores(spark, vectors):
    got = queries.op1_nearest_neighbours(spark, FOLDER).collect()
    ids = np.array(sorted(vectors))
    x = np.stack([vectors[i] for i in ids])
    hits = total = 0
    for q in [i for i in ids if i % 100 == 0]:
        d = np.sqrt(((x - vectors[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        want = set(ids[np.lexsort((ids, d))[:10]])
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        assert all(math.isclose(r["score"], d[ids == r["vec_id"]][0], rel_tol=1e-12) for r in mine)
        hits += len(want & {r["vec_id"] for r in mine})
        total += 10
    assert hits / total >= 0.9


def scan(text):
    """Base spans and entropy spans, by Python's own regular expressions."""
    base = [(m.start(), 0, m.end()) for m in re.finditer(secret_scan.ASSIGN, text, re.ASCII) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer(secret_scan.ACCESS, text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer(secret_scan.HEX, text) if len(m[0]) >= 16]
    added = []
    for m in re.finditer(secret_scan.CANDIDATE, text):
        word = m[0]
        if word in secret_scan.ALLOWED or any(re.fullmatch(p, word) for p in secret_scan.ALLOWED_PATTERNS):
            continue
        for kind, c in enumerate(secret_scan.CLASSES, start=3):
            if re.fullmatch(c.pattern, word):
                w = word.lower() if c.fold else word
                hot = []
                for end in range(c.window, len(w) + 1):
                    part = w[end - c.window:end]
                    h = -sum(n / c.window * math.log2(n / c.window) for n in (part.count(x) for x in set(part)))
                    if h >= c.bits - 1e-9:
                        hot.append(end)
                if hot:
                    added.append((m.start() + hot[0] - c.window, kind, m.start() + hot[-1]))
                break
    return sorted(base), sorted(added)


def joined(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_secret_spans(spark, docs):
    found = 0
    for r in queries.op2_secret_scan(spark, FOLDER).collect():
        base, added = scan(docs[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert r["spans"] == joined(sorted(base + added))
        found += len(base) + len(added)
    assert found > 0


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, docs):
    prints = {k: simhash(t) for k, t in docs.items()}
    root = {k: k for k in docs}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(docs), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = {r["doc_id"]: r for r in queries.op10_simhash_dedup(spark, FOLDER).collect()}
    assert got.keys() == docs.keys()
    for k, r in got.items():
        assert r["fingerprint"] == f"{prints[k]:016x}"
        assert r["component_id"] == top(k)


def encoded(name, docs, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return {k: [*t.encode(text, add_special_tokens=False).ids, end] for k, text in docs.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_packing(spark, docs):
    want = encoded("word_bpe_49k.json", docs, 1)
    rows = queries.op6_best_fit_packing(spark, FOLDER).collect()
    pieces = {(k, n): ids[a:a + 4096] for k, ids in want.items() for n, a in enumerate(range(0, len(ids), 4096))}
    assert {(r["doc_id"], r["piece"]) for r in rows} == pieces.keys() and len(rows) == len(pieces)
    for r in rows:
        ids = pieces[r["doc_id"], r["piece"]]
        assert (r["start"], r["length"], r["ids_crc32"]) == (4096 * r["piece"], len(ids), crc(ids))
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(map(len, want.values())) / 4096) * 1.01 + 1


def test_records(spark, docs):
    want = encoded("byte_bpe_50k.json", docs, 2)
    got = {r["doc_id"]: r for r in queries.op9_token_records(spark, FOLDER).collect()}
    assert got.keys() == docs.keys()
    start = 0
    for k in sorted(want):
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(want[k]), crc(want[k]))
        start += len(want[k])


def test_language_held_out_accuracy(spark):
    langs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op8_language_id(spark, FOLDER).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in langs[r["doc_id"]]["text"] or ""):
            assert r["lang_pred"] == "und"
    judged = [r for r in rows if r["held_out"] and langs[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == langs[r["doc_id"]]["lang"] for r in judged)
    assert right / len(judged) >= 0.97


def test_pipeline(spark, docs):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    langs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    kept = {r["doc_id"] for r in rows}
    assert kept <= langs.keys() and len(kept) > 0.5 * len(langs)
    fills = {}
    for r in rows:
        fills[r["sequence_id"]] = fills.get(r["sequence_id"], 0) + r["length"]
    assert max(fills.values()) <= 4096


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_odd_texts_are_the_tokenizers(name):
    rng = random.Random(7)
    letters = "ab Z\n\t\x00\x1c'.,!<|>_é ñİǅ１3\xa0　́ßΣ日😀\r$&-"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", "\x00", "\n", " a", "a ", "a\n\nb", "it's don't x'", "word, Word. word!!", "<|endoftext|> a<|endoftext|>.", "é" * 100 + "."]
    whole = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)
    encoder = tokens.Encoder(public_tokenizers.path(name))
    for _ in range(2):  # the second time from memory
        assert encoder.encode_many(texts) == [np.array(w.ids, dtype="<u4").tobytes() for w in whole]
