"""Secret scan with DataFrame functions only.

Three patterns give base spans. The method adds spans by entropy: a candidate
is a run of token characters; each class is run over its own maximal runs inside
the candidate, so hex glued to other characters (``AUTH=9F86...``) is judged as
hex. A window of the class slides over the run, and the Shannon entropy of the
window, H = log2(w) - sum(c * log2(c)) / w, follows from counts of which only the
entering and the leaving character change. The span reaches from the first to the
last window with enough entropy. Candidates and runs on the allow list (plain
words, numbers, UUIDs, listed strings) are left out.

Base64 runs of 16 to 19 characters have a window and bits of their own, fitted to
them: 89 % of random base64 windows of 16 reach 3.6, as 83 % of 20 reach 3.9.

Positions are code points: the pieces between matches and the matches alternate,
so running lengths place them.

Defined results: a null or empty text has no spans. Every row is scanned, also
repeated ones; ids are carried along as they are. An empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order of their kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16


@dataclass(frozen=True)
class EntropyClass:
    """Characters, window and bits; a run belongs to the first class it is made of and long enough for."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float
    fold: bool = False


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CLASSES = (
    EntropyClass("entropy_hex", "[0-9A-Fa-f]+", "0123456789abcdef", 16, 2.9, True),
    EntropyClass("entropy_base64", "[A-Za-z0-9+/=_-]+", BASE64, 20, 3.9),
    EntropyClass("entropy_base64", "[A-Za-z0-9+/=_-]+", BASE64, 16, 3.6),
)
CANDIDATE = "[A-Za-z0-9+/=_-]{16,}"
ALLOWED_PATTERNS = (
    "[A-Za-z]?[a-z]+", "[A-Z]+", "[0-9_=+/-]+", "[A-Za-z][a-z]*([_/=+-][A-Za-z]?[a-z]*)+",
    "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
)
ALLOWED = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",)
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _located(text: Column, pattern: str) -> Column:
    """Array of (at, match) of all leftmost matches that do not overlap."""
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gap = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(F.slice(gap, F.lit(1), F.size(match)), match, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<at:int,match:string>>)").alias("out"))
    return F.aggregate(
        steps, start,
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + F.length(s["match"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("at"), s["match"].alias("match")))).alias("out"),
        ),
        lambda acc: acc["out"],
    )


def _no_spans() -> Column:
    return F.expr(f"cast(array() as {SPAN})")


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _as_span(kind: int):
    return lambda m: _span(m["at"], kind, m["at"] + F.length(m["match"]))


def base_spans(text: Column) -> Column:
    """The three base kinds; ``kind`` numbers them 0, 1, 2."""
    out = []
    # [0-9a-f]+ of 16 or more characters are the matches of {16,}, and likewise for access keys
    for kind, pattern in ((1, f"AKIA[A-Z0-9]{{{ACCESS_CHARS - 4},}}"), (2, f"[0-9a-f]{{{HEX_CHARS},}}")):
        found = F.transform(_located(text, pattern), _as_span(kind))
        out.append(F.when(text.rlike(pattern), found).otherwise(_no_spans()))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    both = F.zip_with(_located(text, ASSIGN), values, lambda m, v: F.struct(m["at"].alias("at"), m["match"].alias("match"), F.length(v).alias("n")))
    found = F.transform(F.filter(both, lambda m: m["n"] >= ASSIGN_CHARS), _as_span(0))
    out.append(F.when(text.rlike(ASSIGN), found).otherwise(_no_spans()))
    return F.array_sort(F.concat(*out))


def hot_windows(word: Column, c: EntropyClass) -> Column:
    """(first, last) end of the windows with enough entropy, 0 if none; counts change by two per step."""
    w = c.window

    def weight(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(0.0)

    text = F.lower(word) if c.fold else word

    def slot(i: Column) -> Column:
        return F.when(i >= 1, F.instr(F.lit(c.alphabet), text.substr(i, F.lit(1)))).otherwise(0)

    def step(acc: Column, i: Column) -> Column:
        # the characters that enter and leave are looked up once
        return F.transform(F.array(F.struct(slot(i).alias("new"), slot(i - w).alias("old"))), lambda x: moved(acc, i, x))[0]

    def moved(acc: Column, i: Column, x: Column) -> Column:
        come = F.coalesce(F.get(acc["counts"], x["new"]), F.lit(0))
        go = F.coalesce(F.get(acc["counts"], x["old"]), F.lit(0))
        change = (
            F.when(x["new"] == x["old"], 0.0)
            .when(x["old"] == 0, weight(come + 1) - weight(come))
            .otherwise(weight(come + 1) - weight(come) + weight(go - 1) - weight(go))
        )
        counts = F.transform(acc["counts"], lambda n, k: n + F.when(k == x["new"], 1).otherwise(0) - F.when((k == x["old"]) & (k > 0), 1).otherwise(0))
        total = acc["sum"] + change
        hot = (i >= w) & (F.lit(math.log2(w)) - total / w >= F.lit(c.bits - 1e-9))
        return F.struct(
            counts.alias("counts"), total.alias("sum"),
            F.when(hot & (acc["first"] == 0), i).otherwise(acc["first"]).alias("first"),
            F.when(hot, i).otherwise(acc["last"]).alias("last"),
        )

    start = F.struct(F.array_repeat(F.lit(0), len(c.alphabet) + 1).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(0).alias("first"), F.lit(0).alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step,
                       lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _runs(c: EntropyClass, before: tuple[EntropyClass, ...], suppressed: str, allowed):
    """From a candidate to its maximal runs of this class: long enough, not allowed and of no class before it."""
    pattern = f"{c.pattern.removesuffix('+')}{{{c.window},}}"

    def runs(m: Column) -> Column:
        found = F.transform(_located(m["match"], pattern), lambda r: F.struct((m["at"] + r["at"]).alias("at"), r["match"].alias("match")))

        def kept(r: Column) -> Column:
            here = ~r["match"].rlike(suppressed) & ~r["match"].isin(*allowed)
            for d in before:
                here = here & ~(r["match"].rlike(f"^{d.pattern}$") & (F.length(r["match"]) >= d.window))
            return here

        return F.filter(found, kept)
    return runs


def _hot_spans(c: EntropyClass, kind: int):
    """From a match to an array of at most one span."""
    def spans(m: Column) -> Column:
        hot = F.filter(F.array(hot_windows(m["match"], c)), lambda h: h["last"] > 0)
        return F.transform(hot, lambda h: _span(m["at"] + h["first"] - c.window, kind, m["at"] + h["last"]))
    return spans


def entropy_spans(text: Column, classes=CLASSES, allowed=ALLOWED, allowed_patterns=ALLOWED_PATTERNS, first_kind: int = 3) -> Column:
    """Spans of entropy, kinds numbered on from the base kinds."""
    suppressed = "^(?:" + "|".join(allowed_patterns) + ")$"
    words = F.filter(_located(text, CANDIDATE), lambda m: ~m["match"].rlike(suppressed) & ~m["match"].isin(*allowed))
    found = []
    for k, c in enumerate(classes):
        runs = F.flatten(F.transform(words, _runs(c, classes[:k], suppressed, allowed)))
        found.append(F.flatten(F.transform(runs, _hot_spans(c, first_kind + k))))
    return F.when(text.rlike(CANDIDATE), F.concat(*found)).otherwise(_no_spans())


KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))


def span_text(spans: Column, kinds=KINDS) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **entropy) -> DataFrame:
    """(id_col, base, added): sorted arrays of (start, kind, end), end exclusive."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col), base_spans(text).alias("base"), entropy_spans(text, **entropy).alias("added"))
