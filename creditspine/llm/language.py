"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word (a run of letters, lower-cased, with the mark of a word start) has the
probability of all its segmentations into pieces, summed by a forward pass; a
text has the product over its words. The probabilities are fitted by expectation
maximisation over the same lattice, from the words of about ``per_language``
labelled documents of each language, drawn by a hash of the id. The model has one
number per language and piece, bounded by the vocabulary.

Only new words are scored: a task remembers a bounded number of words.

Defined results: a null text or one without letters is ``und`` with score 0, as
is every text if nothing could be learned. Ties go to the first language in code
point order. Rows with null or repeated ids are judged one by one. An empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditspine.llm.common import store

#: Letters, and signs that Python counts as word characters but not as letters or digits, such as fractions and Roman numerals.
RUNS = re.compile(r"[^\W\d_]+")
START = "▁"
#: A longer word is scored in parts of this length.
LONGEST = 40
#: Words that a task remembers.
REMEMBERED = 250_000
#: Probabilities are scaled per character to stay within doubles.
SCALE = 30.0
UNKNOWN = 1e-6
#: Words that go through the lattice at a time.
BATCH = 4096
UND = "und"


def words_of(text: str | None) -> list[str]:
    found = RUNS.findall((text or "").lower())
    if not all(map(str.isalpha, found)):  # a pattern without the signs would look each character up among hundreds of them
        found = [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]
    if any(len(w) > LONGEST for w in found):
        found = [w[k:k + LONGEST] for w in found for k in range(0, len(w), LONGEST)]
    return found


def vocabulary(path: str) -> list[str]:
    """Pieces of letters, with or without the mark of a word start."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.vocab_size()) if not sp.is_control(i) and not sp.is_unknown(i) and not sp.is_byte(i))
    return sorted({p for p in pieces if (p.removeprefix(START) or "a").isalpha() and p == p.lower()})


def lattice(words: list[str], index: dict[str, int], longest: int) -> np.ndarray:
    """(words, length, longest) piece numbers ending at a place; 0 no piece, 1 an unknown character.

    All words have one length, the mark included.
    """
    n, size = len(words[0]), len(words)
    out = np.zeros((n, longest, size), dtype=np.int32)
    get = index.get
    for e in range(1, n + 1):
        for k in range(1, min(e, longest) + 1):
            out[e - 1, k - 1] = [get(w[e - k:e], 0) for w in words]
        single = out[e - 1, 0]
        single[single == 0] = 1
    return out


def by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Positions of words of one length, in batches."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for part in np.split(order, cuts):
        for lo in range(0, len(part), BATCH):
            if len(part):
                yield part[lo:lo + BATCH]


def forward(cells: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(length + 1, words, ...) sums over all segmentations of each prefix; ``p`` gives weights by piece."""
    n, longest, size = cells.shape
    a = np.zeros((n + 1, size, p.shape[1]))
    a[0] = 1.0
    for e in range(1, n + 1):
        for k in range(1, min(e, longest) + 1):
            ids = cells[e - 1, k - 1]
            if ids.any():
                a[e] += a[e - k] * p[ids]
    return a


@dataclass
class Model:
    """``log``-free weights: ``p[piece, language]``, scaled by SCALE per character."""

    languages: list[str]
    pieces: list[str]
    p: np.ndarray
    index: dict[str, int] = field(init=False, repr=False)
    longest: int = field(init=False)

    def __post_init__(self):
        self.index = {piece: k + 2 for k, piece in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces), default=1)

    def scores(self, words: list[str]) -> np.ndarray:
        """(words, languages) log probabilities."""
        marked = [START + w for w in words]
        out = np.empty((len(words), len(self.languages)))
        for part in by_length(marked):
            some = [marked[k] for k in part]
            a = forward(lattice(some, self.index, self.longest), self.p)
            out[part] = np.log(np.maximum(a[-1], 1e-300)) - len(some[0]) * np.log(SCALE)
        return out


def scaled(pieces: list[str], counts: np.ndarray, smooth: float = 50.0) -> np.ndarray:
    """Weights (pieces + 2, languages) from expected counts; row 0 is no piece, row 1 an unknown character."""
    n = len(pieces)
    p = (counts + smooth / n) / (counts.sum(axis=0, keepdims=True) + smooth)
    length = np.array([len(x) for x in pieces], dtype=float)[:, None]
    out = np.zeros((n + 2, counts.shape[1]))
    out[1] = UNKNOWN * SCALE
    out[2:] = p * SCALE ** length
    return out


def expected(words: list[str], weight: np.ndarray, language: np.ndarray, model: Model) -> np.ndarray:
    """Expected piece counts (pieces + 2, languages) over all segmentations of weighted words."""
    counts = np.zeros_like(model.p)
    marked = [START + w for w in words]
    for part in by_length(marked):
        cells = lattice([marked[k] for k in part], model.index, model.longest)
        n, longest, size = cells.shape
        g, w = language[part], weight[part]
        a = np.zeros((n + 1, size))
        b = np.zeros((n + 1, size))
        a[0] = b[n] = 1.0
        for e in range(1, n + 1):
            for k in range(1, min(e, longest) + 1):
                a[e] += a[e - k] * model.p[cells[e - 1, k - 1], g]
        for e in range(n, 0, -1):
            for k in range(1, min(e, longest) + 1):
                b[e - k] += b[e] * model.p[cells[e - 1, k - 1], g]
        whole = np.maximum(a[n], 1e-300)
        for e in range(1, n + 1):
            for k in range(1, min(e, longest) + 1):
                ids = cells[e - 1, k - 1]
                np.add.at(counts, (ids, g), w * a[e - k] * model.p[ids, g] * b[e] / whole)
    return counts


def fit(docs: DataFrame, vocabulary_path: str, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", per_language: int = 300, rounds: int = 3, seed: int = 5) -> Model:
    """Model from rows with ``learn_from``, a text and a language; about ``per_language`` rows of each."""
    labelled = docs.where(F.coalesce(learn_from, F.lit(False)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    per = {r[0]: r[1] for r in labelled.groupBy(F.col(lang_col).cast("string")).agg(F.count(F.lit(1))).collect()}
    languages, pieces = sorted(per), vocabulary(vocabulary_path)
    if not languages:
        return Model([], pieces, np.zeros((len(pieces) + 2, 0)))
    # a row is drawn if its hash falls below the share its language needs
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)), F.lit(seed)), F.lit(1_000_000))
    bound = F.create_map(*[F.lit(x) for k, n in per.items() for x in (k, min(1_000_000, -(-per_language * 1_000_000 // n)))])
    drawn = labelled.where(draw < F.element_at(bound, F.col(lang_col).cast("string")))

    def count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            total = Counter()
            for lang, text in zip(f["lang"], f["text"]):
                total.update((lang, w) for w in words_of(text))
            yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["lang", "word", "n"])

    rows = drawn.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = store(rows.mapInPandas(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    model = Model(languages, pieces, scaled(pieces, np.ones((len(pieces), len(languages)))))
    for _ in range(rounds):
        model = Model(languages, pieces, scaled(pieces, _round(words, model)))
    return model


def _round(words: DataFrame, model: Model) -> np.ndarray:
    """One expectation step on Spark: at most languages x pieces rows come back."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {lang: k for k, lang in enumerate(model.languages)}
        for f in frames:
            got = expected(f["word"].to_list(), f["n"].to_numpy(dtype=float), f["lang"].map(number).to_numpy(), model)
            piece, lang = np.nonzero(got[2:])
            yield pd.DataFrame({"piece": piece, "lang": lang, "n": got[2:][piece, lang]})

    sums = words.mapInPandas(run, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(model.pieces), len(model.languages)))
    counts[sums["piece"].to_numpy(dtype=int), sums["lang"].to_numpy(dtype=int)] = sums["n"].to_numpy()
    return counts


class Scorer:
    """Scores texts, with a bounded memory of words."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.table = np.zeros((0, len(model.languages)))

    def totals(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        new = list({w for words in split for w in words if w not in self.rows})
        if len(self.rows) + len(new) > REMEMBERED:
            self.rows, self.table = {}, self.table[:0]
            new = list({w for words in split for w in words})
        if new:
            at = len(self.table)
            self.table = np.concatenate([self.table, self.model.scores(new)])
            self.rows.update((w, at + k) for k, w in enumerate(new))
        get = self.rows.__getitem__
        out = np.zeros((len(texts), len(self.model.languages)))
        for k, words in enumerate(split):
            if words:
                out[k] = self.table[[*map(get, words)]].sum(axis=0)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text, total in zip(texts, self.totals(texts)):
            if not len(total) or not total.any():
                names.append(UND)
                scores.append(0.0)
                continue
            best = int(np.argmax(total))
            names.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, text, lang_pred, score): ``row`` is a struct of the other columns."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))  # its memory goes with the task
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                names, scores = scorer.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("text"), pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())],
                    names=["row", "text", "lang_pred", "score"])

    out = StructType([rows.schema["row"]]).add("text", "string").add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, out)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with a predicted language, columns as before; only ``und`` goes."""
    out = predict(docs, model, text_col).where(F.col("lang_pred") != UND)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
