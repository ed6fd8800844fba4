"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text. A text is cut by each automaton into phrases, each
the longest match of the text from where the last phrase ended; the language that needs the fewest phrases wins, phrases
being weighed by the log of its sample's length, as longer samples give longer matches (the cross-parsing estimate of relative
entropy).

The sample: of each language the distinct texts of least hash, among rows with a letter, as many as it takes; of each a window,
which starts anywhere in it by that hash. At most `sample_chars` normalised characters for each language are used, first evenly
over those texts, then what is left of them in order. Nothing but text and label decides what is learnt, so a language is learnt
however its rows are numbered or repeated. Everything else covers all rows and whole texts. Texts are normalised to lower-case
letters with single spaces for all else.

One parse goes over a whole text. To do many steps at once it is computed in blocks: each block is first parsed as if a phrase began
with it, and then again from the state that the block before really ends in, until both parses are in the same state; from there on
they agree. Blocks don't change any count, and a very long text costs what its length costs.

`und` with a score of 0: null texts, texts without a letter, or no learned language at all. Ties go to the language that
comes first by name. Repeated rows are predicted each and learnt once; an empty table gives an empty result. Other columns pass through, unless
they bear the name of a result column, which wins. A row with a null key is predicted; whether it is learnt from is the caller's
filter (in the query its remainder is null, so it isn't).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

#: Bounds of the fit for each language: normalised characters, rows that they are from where there are so many, and the most rows
#: that are used where texts are short.
SAMPLE_CHARS, SAMPLE_ROWS, MOST_ROWS = 30_000, 200, 3_000
#: Letters beyond which an automaton keeps its edges in a sorted array and not in a table; results don't depend on it.
TABLE = 256
#: Letters that are parsed one after another, many blocks at once; results don't depend on it.
BLOCK = 256
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Of each code point of the first planes: its lower-case letter, or a space."""
    out = np.full(0x20000, 32, np.uint32)
    for c in range(0x20000):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 0x20000 else c
    return out


def _is_letter(code: int) -> bool:
    return unicodedata.category(chr(code))[0] == "L"


def normalise(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, letters lowered and all else as single spaces inside, and how many each has."""
    table = letters()
    raw = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) if t else 0 for t in texts], np.int64)
    far = raw >= len(table)
    codes = table[np.where(far, 0, raw)]
    if far.any():
        codes[far] = [c if _is_letter(int(c)) else 32 for c in raw[far]]
    owner = np.repeat(np.arange(len(texts)), size)
    space = codes == 32
    drop = space.copy()  # a space after a space or at a text's start
    drop[1:] &= space[:-1] | (owner[1:] != owner[:-1])
    last = space.copy()  # and the one at its end
    last[:-1] &= owner[1:] != owner[:-1]
    keep = ~(drop | last)
    codes, owner = codes[keep], owner[keep]
    n = np.bincount(owner, minlength=len(texts))
    # a run of spaces that ends a text leaves its first space: take that off too
    ends = np.cumsum(n)
    trail = np.flatnonzero(n > 0)
    trail = trail[codes[ends[trail] - 1] == 32]
    if len(trail):
        gone = np.ones(len(codes), bool)
        gone[ends[trail] - 1] = False
        codes = codes[gone]
        n[trail] -= 1
    return codes, n


class Automaton:
    """A suffix automaton: of a state and a letter's number, the next state, above END if a phrase ends before.

    A table of states and the sample's own letters, or, where those are many, its edges in order; there are at most three for each
    character, so either is bounded by the sample."""

    END = 1 << 30

    def __init__(self, text: str, alphabet: dict[str, int], most: int | None = None):
        link, length, nexts, last = [-1], [0], [{}], 0
        for c in text:
            cur = len(link)
            link.append(0)
            length.append(length[last] + 1)
            nexts.append({})
            p = last
            while p != -1 and c not in nexts[p]:
                nexts[p][c] = cur
                p = link[p]
            if p != -1:
                q = nexts[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(link)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    nexts.append(dict(nexts[q]))
                    while p != -1 and nexts[p].get(c) == q:
                        nexts[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        own = {c: i for i, c in enumerate(sorted(set(text)))}
        # one more column for unknown letters and one more state after one: such a letter is a phrase of its own
        width, lost = len(own) + 1, len(link)
        self.width = width
        self.own = np.full(len(alphabet) + 1, width - 1, np.int32)
        for c, i in own.items():
            self.own[alphabet[c]] = i
        root = np.full(width, lost | self.END, np.int32)
        for c, state in nexts[0].items():
            root[own[c]] = state | self.END
        self.root = root
        if len(own) <= (TABLE if most is None else most):
            table = np.tile(root, (len(link) + 1, 1))
            table[0] &= ~np.int32(self.END)
            for state, edges in enumerate(nexts):
                for c, to in edges.items():
                    table[state, own[c]] = to
            self.table = table.reshape(-1)
        else:
            self.table = None
            pairs = sorted((state * width + own[c], to) for state, edges in enumerate(nexts) for c, to in edges.items())
            pairs.append((width - 1, lost))  # at the start no phrase ends before an unknown letter either
            pairs.sort()
            self.keys, self.to = (np.array(x, kind) for x, kind in zip(zip(*pairs, strict=True), (np.int64, np.int32), strict=True))
        self.bits = float(np.log2(max(2, len(text))))

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[state * self.width + letter]
        key = state.astype(np.int64) * self.width + letter
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], self.root[letter])


class Model:
    def __init__(self, samples: tuple[tuple[str, str], ...], most: int | None = None):
        self.names = [k for k, _ in samples]
        chars = sorted({c for _, text in samples for c in text})
        alphabet = {c: i for i, c in enumerate(chars)}
        self.codes = np.full(0x110000, len(chars), np.int32)
        for c, i in alphabet.items():
            self.codes[ord(c)] = i
        self.automata = [Automaton(text, alphabet, most) for _, text in samples]

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that each language needs for each text, [language, text], and the texts' normalised lengths."""
        points, n = normalise(texts)
        total = np.zeros((len(self.names), len(texts)))
        if not len(points):
            return total, n
        blocks = -(-n // BLOCK)
        owner = np.repeat(np.arange(len(n)), blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        size = np.minimum(n[owner] - inside * BLOCK, BLOCK)
        start = (np.cumsum(n) - n)[owner] + inside * BLOCK
        order = np.argsort(-size, kind="stable")  # longest first: blocks that have ended leave at the end
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        following = np.full(len(order), -1)  # of each block the next one of its text
        more = np.flatnonzero(owner[1:] == owner[:-1])
        following[place[more]] = place[more + 1]
        size, start, owner = size[order], start[order], owner[order]
        codes = self.codes[points]
        for a, automaton in enumerate(self.automata):
            total[a] = (n > 0) + np.bincount(owner, self.ended(automaton, automaton.own[codes], start, size, following), len(n))
        return total, n

    @staticmethod
    def ended(automaton: Automaton, codes: np.ndarray, start: np.ndarray, size: np.ndarray, following: np.ndarray) -> np.ndarray:
        """How many phrases end within each block, before one of its letters, in the one parse of its text."""
        bits = Automaton.END - 1
        longest = int(size[0])
        live = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
        states, counts = np.zeros((longest, len(size)), np.int32), np.zeros((longest, len(size)), np.int16)
        state, count = np.zeros(len(size), np.int32), np.zeros(len(size), np.int16)
        for k in range(longest):
            m = live[k]
            to = automaton.step(state[:m], codes[start[:m] + k])
            count[:m] += (to >> 30).astype(np.int16)
            state[:m] = to & bits
            states[k, :m], counts[k, :m] = state[:m], count[:m]
        alone, total, end = count, count.copy(), state
        todo = following[following >= 0]
        begin = end[np.flatnonzero(following >= 0)]
        while len(todo):
            changed = []
            at, now, seen, k = todo, begin.copy(), np.zeros(len(todo), np.int16), 0
            while len(at):
                to = automaton.step(now, codes[start[at] + k])
                seen = seen + (to >> 30).astype(np.int16)
                now = to & bits
                same, over = now == states[k, at], size[at] == k + 1
                done = at[same]
                total[done] = seen[same] + alone[done] - counts[k, done]
                # a block that an earlier round left in another state than its own is back in its own
                back = done[end[done] != states[size[done] - 1, done]]
                end[back] = states[size[back] - 1, back]
                apart = over & ~same
                total[at[apart]] = seen[apart]
                moved = at[apart][end[at[apart]] != now[apart]]
                end[at[apart]] = now[apart]
                changed += [back, moved]
                on = ~(same | over)
                at, now, seen, k = at[on], now[on], seen[on], k + 1
            changed = np.concatenate(changed)
            changed = changed[following[changed] >= 0]
            todo, begin = following[changed], end[changed]
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        total, n = self.phrases(texts)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cost = total * np.array([[a.bits] for a in self.automata])
        best = cost.argmin(axis=0)
        low = cost.min(axis=0)
        rest = cost.copy()
        rest[best, np.arange(len(texts))] = np.inf
        second = rest.min(axis=0) if len(self.names) > 1 else np.full(len(texts), np.inf)
        score = np.where(n > 0, np.where(np.isinf(second), 1.0, 1.0 - low / np.maximum(second, 1e-9)), 0.0)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)], np.clip(score, 0.0, 1.0)


@lru_cache(maxsize=1)
def model(samples: tuple[tuple[str, str], ...]) -> Model:
    """The model of a worker, which it keeps from task to task."""
    return Model(samples)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_chars: int = SAMPLE_CHARS, sample_rows: int = SAMPLE_ROWS, most_rows: int = MOST_ROWS) -> tuple[tuple[str, str], ...]:
    """A bounded sample of each language's text, which is all that a model is made from: `sample_chars` characters of `sample_rows`
    texts, or of more of them where those are short. Hashes and lengths of at most `most_rows` texts for each label come to the
    driver, and windows of those that are used, twice as long as needed, as white space and the like go. Labels without a letter in
    any text are none. The number of labels isn't bounded: each is a model of its own, which every worker holds, as it holds the
    hashes of the texts that are used."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    # the least hashes are cut before they are shuffled, so a label of most rows is as light as any
    least = rows.groupBy("lang", "h").agg(F.max(F.length("text")).alias("size")).withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("i") <= most_rows)
    by: dict[str, list[tuple[int, int]]] = {}
    for r in least.select("lang", "h", "size").orderBy("lang", "h").collect():
        by.setdefault(r["lang"], []).append((r["h"], r["size"]))
    chosen = []
    for name, found in by.items():
        enough = np.searchsorted(np.cumsum([min(size, 300) for _, size in found]), 1.5 * sample_chars) + 1
        found = found[: max(sample_rows, int(enough))]
        window = 2 * -(-sample_chars // len(found)) + 200
        chosen += [(name, h, window) for h, _ in found]
    if not chosen:
        return ()
    wanted = labelled.sparkSession.createDataFrame(chosen, "lang string, h long, window int")
    first = (F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - F.col("window") + 1, F.lit(1))) + 1).cast("int")
    windows: dict[str, list[str]] = {}
    for r in rows.join(F.broadcast(wanted), ["lang", "h"]).groupBy("lang", "h").agg(F.min(F.col("text").substr(first, F.col("window"))).alias("text")).orderBy("lang", "h").collect():
        windows.setdefault(r["lang"], []).append(r["text"])
    out = []
    for name, texts in sorted(windows.items()):
        codes, n = normalise(texts)
        starts = np.cumsum(n) - n
        even = np.minimum(n, max(1, sample_chars // len(texts) - 1))
        spare = np.maximum(0, sample_chars - np.sum(even + 1) - np.concatenate([[0], np.cumsum(n - even)[:-1]]))
        parts = [codes[a : a + size].astype("<u4").tobytes().decode("utf-32-le") for a, size in zip(starts, even + np.minimum(spare, n - even), strict=True) if size]
        if joined := " ".join(parts)[:sample_chars].strip():
            out.append((name, joined))
    return tuple(out)


def predict(docs: DataFrame, samples: tuple[tuple[str, str], ...], text: str = "text") -> DataFrame:
    """Adds `lang_pred` and `score`."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(samples)
        for whole in batches:
            for batch in slices(whole, text, 1 << 20):
                names, scores = own.predict(batch.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(run, schema)
