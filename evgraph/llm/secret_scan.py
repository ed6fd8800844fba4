"""Secret scans: patterns, and a guess-cost dynamic programme over values in a credential context.

A value that follows a credential word is segmented at minimum cost, in bits of guesses, into dictionary words (forwards,
backwards, in other case, or with look-alike characters), dates, repeats of a character or of a short block, straight walks over a
keyboard, the alphabet or digits, and brute-force spans. A value that costs at least `bits` is a secret: the scan adds a span of
kind `guess` over it. Placeholders (`password123`, `aaaaaaaa`, `qwertyuiop`, `1qaz2wsx`), words and short phrases of prose cost few
bits and are left alone. After a colon or an equals sign any value of six characters or more is judged; after `is` only one of
letters and digits together.

What a value is counts, too. A link costs the parts of it that are no words, so one with a key in its query is found; a reference to
a variable or a file (`os.environ['X']`, `process.env.DB_PASSWORD`) costs half of what its words do, and all of its other parts. A
single word that is spelt like those of the world's languages, by the letters that follow each other in the vocabulary of a public
tokenizer for many of them, costs no more than its place in a large lexicon.

The dictionary is the words of a public tokenizer's vocabulary, most common first, after a short list of words that are often
passwords or placeholders. A password of several rare words costs as much as it is worth.

Null and empty texts have no span, and an empty table gives an empty result; very long texts are scanned whole; repeated rows are
scanned each. A `guess` span may overlap base spans: each keeps its own, by start and then by kind. Other columns of the input pass
through `scan` untouched unless they bear the name of a result column, which wins.
"""

from __future__ import annotations

import base64
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Words after which a value counts as a credential; wider than those of ASSIGN.
CONTEXT = re.compile(
    r"""(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|bearer|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key)["']?\x20*(?:[:=]\x20*["']?([^\s"'<>,;]{6,})|\x20is\x20+["']?(?=[^\s"'<>,;]*\d)(?=[^\s"'<>,;]*[a-z])([^\s"'<>,;]{6,}))"""
)

#: Words often found in passwords and in placeholders, most common first.
WORDS = (
    "password passwd pass secret token admin administrator root user login welcome letmein master monkey dragon shadow sunshine "
    "princess football baseball soccer hockey superman batman starwars iloveyou love trustno hello freedom whatever access default "
    "example sample test testing demo changeme change here your mykey key api apikey value string none null undefined true false "
    "public private client server database dev prod local host guest system service account summer winter spring autumn january "
    "february march april may june july august september october november december monday tuesday wednesday thursday friday "
    "saturday sunday michael jordan george charlie thomas andrew daniel jessica ashley michelle amanda jennifer computer internet "
    "google apple orange banana cookie cheese pepper ginger silver golden black white green blue red purple flower tiger lion eagle "
    "horse hunter killer ranger thunder lucky magic happy angel family"
).split()
#: The vocabulary that the dictionary is taken from, and its shortest and longest words.
VOCABULARY, SHORTEST, LONGEST = "word_bpe_49k.json", 3, 20


@lru_cache(maxsize=2)
def dictionary(path: str | None = None) -> dict[str, int]:
    """Ranks of words: those of WORDS, then the whole words of a vocabulary by their number in it."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    whole = (w.removesuffix("</w>") for w in sorted(vocabulary, key=vocabulary.get) if w.endswith("</w>"))
    words = dict.fromkeys([*WORDS, *(w for w in whole if w.isascii() and w.isalpha() and SHORTEST <= len(w) <= LONGEST)])
    return {w: i + 1 for i, w in enumerate(words)}


KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")


def _steps() -> dict[tuple[str, str], tuple[str, ...]]:
    """Of each pair of characters that a straight walk may hold, its directions: six on the keyboard, whose rows are shifted by
    half a key, and up and down in the alphabet and the digits."""
    out: dict[tuple[str, str], tuple[str, ...]] = {}
    for r, row in enumerate(KEYBOARD):
        for c, key in enumerate(row):
            for name, (dr, dc) in {"right": (0, 1), "down": (1, 0), "down-left": (1, -1)}.items():
                if r + dr < len(KEYBOARD) and 0 <= c + dc < len(KEYBOARD[r + dr]):
                    other = KEYBOARD[r + dr][c + dc]
                    out[key, other] = (*out.get((key, other), ()), name)
                    out[other, key] = (*out.get((other, key), ()), "back " + name)
    for row in ("abcdefghijklmnopqrstuvwxyz", "0123456789"):
        for a, b in zip(row, row[1:], strict=False):
            out[a, b] = (*out.get((a, b), ()), "next")
            out[b, a] = (*out.get((b, a), ()), "before")
    return out


STEPS = _steps()
LEET = str.maketrans("@4830$51!7", "aabeossiit")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
#: Bits of where a walk starts and which way it goes; lengths of blocks whose repeats are a segment.
WALK, PERIODS = math.log2(47 * 2), range(2, 9)


def _alphabet(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26)
    return math.log2(33) if c.isascii() else math.log2(100)


def word_bits(said: str, rank: dict[str, int]) -> float:
    """Bits of a string as one dictionary word, infinite if it is none: of its rank, and one for each way it differs from the word."""
    low = said.lower()
    changed = low.translate(LEET)
    best = math.inf
    for word in (low, changed) if low != changed else (low,):
        for back in (0, 1):
            if (r := rank.get(word[::-1] if back else word)) is not None:
                best = min(best, math.log2(r + 1) + back + (said != low) + (word != low))
    return best


class Run:
    """Starts of a repeat or walk at hand that can still be the cheapest, ascending in place and in cost. One that an earlier start
    beats is beaten from there on, as logarithms of lengths draw nearer; one that a later start beats in cost is beaten as well."""

    def __init__(self) -> None:
        self.starts: list[int] = []

    def least(self, best: list[float], fresh: int, end: int, unit: int = 1) -> float:
        """The least cost of what is before a start and of the length from it, with one start more."""
        cheap, least = [], math.inf
        for b in (*self.starts, fresh):
            if (cost := best[b] + math.log2((end - b) // unit)) < least:
                least = cost
                while cheap and best[cheap[-1]] >= best[b]:
                    cheap.pop()
                cheap.append(b)
        self.starts = cheap
        return least


def guess_bits(value: str, rank: dict[str, int] | None = None) -> float:
    """Bits of the cheapest segmentation of a value; each segment but brute force pays one bit more for being chosen.

    Words and dates are bounded, and a run (repeat, walk) of three characters or more, or of two blocks or more, may start and stop
    anywhere within a longer one.
    """
    rank = dictionary() if rank is None else rank
    n, low = len(value), value.lower()
    best = [0.0] + [math.inf] * n
    walks: dict[str, tuple[int, Run]] = {}
    same, blocks = (0, Run()), {p: (0, {}) for p in PERIODS}
    for i in range(n):
        here = best[i]
        best[i + 1] = min(best[i + 1], here + _alphabet(value[i]))
        for size in range(SHORTEST, min(LONGEST, n - i) + 1):
            best[i + size] = min(best[i + size], here + 1 + word_bits(value[i : i + size], rank))
        if (m := DATE.match(value, i)) is not None:
            best[m.end()] = min(best[m.end()], here + 1 + (math.log2(120) if m.end() - i == 4 else math.log2(365 * 120)))
        if not i:
            continue
        if low[i] != low[i - 1]:
            same = (i, Run())
        elif i - same[0] >= 2:
            best[i + 1] = min(best[i + 1], same[1].least(best, i - 2, i + 1) + 1 + _alphabet(value[i]))
        walks = {way: walks.get(way) or (i - 1, Run()) for way in STEPS.get((low[i - 1], low[i]), ())}
        for first, run in walks.values():
            if i - first >= 2:
                best[i + 1] = min(best[i + 1], run.least(best, i - 2, i + 1) + 1 + WALK)
        for p in PERIODS:
            if i < p:
                break
            if low[i] != low[i - p]:
                blocks[p] = (i - p + 1, {})
                continue
            first, phases = blocks[p]
            if i + 1 - 2 * p >= first:  # the last p characters stand at least twice
                run = phases.setdefault((i + 1) % p, Run())
                best[i + 1] = min(best[i + 1], run.least(best, i + 1 - 2 * p, i + 1, p) + 1 + block_bits(low[i + 1 - p : i + 1]))
    return best[n]


@lru_cache(maxsize=4096)
def block_bits(block: str) -> float:
    """Bits of a block that is repeated: brute force, as blocks are short."""
    return sum(map(_alphabet, block))


# Words of code and of links.
CODE = frozenset(
    "env environ getenv process os sys config settings conf cfg self this request req params param args kwargs opts options props vars var context ctx app main index json yaml toml http https www com org net io html php "
    "asp aspx jsp js css py db sql id url uri src lib bin etc usr auth oauth login signin file path dir credentials credential keys secrets tokens passwords vault store get set read load".split()
)
LINK = re.compile(r"(?ai)(?:[a-z][a-z+]*://|www\.)\S+")
REFERENCE = re.compile(r"""(?a)[$@%&*]*[{(]{0,2}\.{0,2}/?[A-Za-z_][A-Za-z_0-9-]*(?:(?:\.|::|->|/|:)[A-Za-z_][A-Za-z_0-9-]*|\[["']?[A-Za-z_0-9.-]*["']?\]?|\(["']?[A-Za-z_0-9.-]*["']?\)?)*[})\]"'`.!?]*""")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+|[^\W\d_a-zA-Z]+")
#: Bits of what kind of name a value is, of a word's place in a large lexicon, and of a letter after two others in natural words.
NAME, LEXICON, NATURAL = 8.0, 20.0, 4.6
MANY = "byte_bpe_multi_50k.tiktoken"


def _parts(value: str, words: float, rank: dict[str, int]) -> float:
    """Bits of the parts of a name: a share of those of words, all of those of others. Names of one or two letters are words."""
    total, chunks = NAME, re.split(r"[\W_]+", value)
    for chunk in chunks:
        parts = PART.findall(chunk)
        each = [0.0 if p.lower() in CODE or p.isalpha() and len(p) < SHORTEST else words * word_bits(p, rank) if word_bits(p, rank) < math.inf else math.inf for p in parts]
        # a chunk with a part that is no word, or of many short ones, is judged as a whole
        total += sum(each) if all(x < math.inf for x in each) and sum(len(p) < SHORTEST for p in parts) <= 1 else guess_bits(chunk, rank)
    return total


@lru_cache(maxsize=2)
def letters(path: str | None = None) -> tuple[dict[str, int], dict[str, int]]:
    """How often three letters, and two before a third, stand in the words of a public vocabulary for many languages."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MANY)
    three: dict[str, int] = {}
    two: dict[str, int] = {}
    with open(path, "rb") as f:
        for line in f:
            word = base64.b64decode(line.split()[0]).decode("utf-8", "replace")
            if (low := word.strip().lower()).isalpha() and len(low) > 2:
                low = f" {low}" if word[0] == " " else low
                for i in range(len(low) - 2):
                    three[low[i : i + 3]] = three.get(low[i : i + 3], 0) + 1
                    two[low[i : i + 2]] = two.get(low[i : i + 2], 0) + 1
    return three, two


def natural_bits(value: str) -> float:
    """Bits of one word in one case, or with a capital, that is spelt like natural ones, or of a few joined by hyphens; else infinite."""
    words = value.rstrip(".!?:)").split("-")
    if len(words) > 1:
        rank = dictionary()
        each = [8.0 if w.isalpha() and len(w) < SHORTEST else min(word_bits(w, rank), natural_bits(w)) for w in words]
        return sum(each) if all(words) else math.inf
    word = words[0]
    if not word.isalpha() or len(word) < 3 or word[1:] != word[1:].lower():
        return math.inf
    three, two = letters()
    low = f" {word.lower()}"
    bits = sum(-math.log2((three.get(low[i : i + 3], 0) + 0.05) / (two.get(low[i : i + 2], 0) + 2.0)) for i in range(len(low) - 2)) / (len(low) - 2)
    return LEXICON if bits < NATURAL else math.inf


def value_bits(value: str) -> float:
    """Bits of a value as the cheapest of what it may be: a password, a link, a reference, a word of some language."""
    rank = dictionary()
    best = min(guess_bits(value, rank), natural_bits(value))
    if LINK.fullmatch(value):
        best = min(best, _parts(value, 0.0, rank))
    elif re.search(r"[A-Za-z0-9](?:[._/]|::|->|\[|\()[A-Za-z_\"')]|^[$%{]", value) and REFERENCE.fullmatch(value):
        best = min(best, _parts(value, 0.5, rank))
    return best


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def guess_spans(text: str, bits: float) -> list[tuple[int, int, str]]:
    return [(*m.span(m.lastindex), "guess") for m in CONTEXT.finditer(text) if value_bits(m[m.lastindex]) >= bits]


def _order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, text: str = "text", bits: float = 36.0) -> DataFrame:
    """Adds `secret_spans`, an array of (kind, start, end) in code points by start, then kind; null texts get none."""
    kept = [c for c in docs.columns if c != "secret_spans"]
    span = "array<struct<kind:string,start:bigint,end:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, text):
                found = [[{"kind": k, "start": a, "end": b} for a, b, k in _order(base_spans(t) + guess_spans(t, bits))] if t else [] for t in batch.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(found, kind)], names=[*kept, "secret_spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "secret_spans")
    return docs.select(*kept).mapInArrow(run, f"{fields}, secret_spans {span}")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each maximal run of overlapping spans replaced by one mark that names the first span's kind."""
    out, at = [], 0
    i = 0
    spans = sorted(spans)
    while i < len(spans):
        a, b, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < b:
            i += 1
            b = max(b, spans[i][1])
        out += [text[at:a], f"[{kind}]"]
        at, i = b, i + 1
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text", bits: float = 36.0) -> DataFrame:
    """The rows with their secrets out of the text, scanned and redacted in one pass; all rows and columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                new = [redact(t, spans) if t and (spans := base_spans(t) + guess_spans(t, bits)) else t for t in batch.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == text else batch.column(n) for n in batch.schema.names], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of `scan`, a row for each document."""

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def only(kind: str):
        return F.filter("secret_spans", lambda s: s["kind"] == kind)

    base = F.filter("secret_spans", lambda s: s["kind"] != "guess")
    counts = [F.size(only(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return docs.select(F.col("doc_id").cast("long"), *counts[:3], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("secret_spans")).alias("spans"), counts[3])
