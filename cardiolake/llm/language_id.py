"""Language identification with spans of mixed-language text.

Training counts character n-grams (1 to 3, with word edges) of each language's
texts in hashed tables of fixed size, over all training documents, and how
many words of each script a language has. Words are runs of letters. For a text:

* the script of a word (by Unicode ranges) narrows its candidate languages to
  those with at least ``SHARE`` of their training words in that script (all
  languages, if there is none);
* each word has a log-probability under each candidate;
* Viterbi decoding over the words, with a price ``SWITCH`` for changing
  language, labels every word; equal neighbours form the spans.

``lang_pred`` is the language with the most letters in its spans (the smaller
name wins a tie) and ``score`` its share of the letters. Null text, and text
without a letter, is ``und`` with score 0, as is every text if nothing was
learned. Every language is learned (the model holds 128 KB for each).
Rows without a language are not learned from; rows that repeat a
doc_id are labelled alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import fold, map_rows, read_table, settle

SIZES = (1, 2, 3)
BUCKETS = 1 << 15
SWITCH, SHARE, SMOOTH = 12.0, 0.01, 0.3
#: Languages whose counts come to the driver at once, and cells (letter, language) scored at once.
TOGETHER, CELLS = 200, 1 << 24
#: Letters of texts labelled together, and words of a stretch that is decoded in one go.
LETTERS, STRETCH = 1 << 20, 256
#: Code points looked up for being a letter; those above count as none.
TOP = 0x33000
#: First code points of script ranges, ascending, with their script; fixed values.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0x20000, "han"),
]
STARTS = np.array([s for s, _ in SCRIPTS])
NAMES = sorted({n for _, n in SCRIPTS})
SCRIPT_AT = np.array([NAMES.index(n) for _, n in SCRIPTS])


@dataclass
class Words:
    """The words of a text as arrays; ``x`` holds letters, and 0 for anything else (one 0 at either end)."""

    x: np.ndarray
    starts: np.ndarray     # place of each word's first letter in x
    stops: np.ndarray      # behind its last letter
    scripts: np.ndarray    # number of the script of its first letter


class Letters:
    def __init__(self):
        self.is_letter = np.fromiter((chr(i).isalpha() for i in range(TOP)), bool, TOP)
        self.is_letter[0xD800:0xE000] = False

    def __call__(self, text: str | None, lowered: bool = False) -> Words:
        low = (text or "") if lowered else (text or "").lower()
        x = np.frombuffer(f"\0{low}\0".encode("utf-32-le"), "<u4")
        ok = self.is_letter[np.minimum(x, TOP - 1)]
        x = np.where(ok, x, 0)
        step = np.diff(ok.astype(np.int8))
        starts, stops = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
        scripts = SCRIPT_AT[np.searchsorted(STARTS, x[starts], side="right") - 1]
        return Words(x, starts, stops, scripts)


def grams(x: np.ndarray):
    """For each size, the table place of the n-gram that starts at each place of ``x``; ``BUCKETS`` where
    there is none (an n-gram may begin or end with a word's edge but not hold one inside)."""
    for n in SIZES:
        m = len(x) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = (h ^ x[k:m + k].astype(np.uint32)) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        ok = (x[:m] != 0) | (x[n - 1:] != 0)
        for k in range(1, n - 1):
            ok &= x[k:m + k] != 0
        if n == 2:
            ok = (x[:m] != 0) | (x[1:] != 0)
        yield np.where(ok, (h & np.uint32(BUCKETS - 1)).astype(np.int32), BUCKETS)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray      # (place, language): log-probability; a last row of zeros
    allowed: np.ndarray    # (script, language): candidates

    def reader(self) -> "Reader":
        return Reader(self)


class Reader:
    def __init__(self, model: Model):
        self.m, self.letters = model, Letters()

    def scores(self, w: Words) -> np.ndarray:
        """(word, language): log-probabilities; -1e6 for languages the script rules out."""
        at, many = w.starts - 1, len(self.m.languages)
        # a word owns the places from the edge before it; what follows its last letter is 0 or the next word's edge
        hashes, out, step = list(grams(w.x)), [], max(1, CELLS // many)
        first = 0
        while first < len(at):  # words whose places fit, at least one
            last = max(first + 1, int(np.searchsorted(at, at[first] + step)))
            lo, hi = int(at[first]), int(at[last]) if last < len(at) else len(w.x)
            total = np.zeros((hi - lo, many), np.float32)
            for h in hashes:
                part = h[lo:hi]
                total[:len(part)] += self.m.table[part]
            out.append(np.add.reduceat(total, at[first:last] - lo, axis=0))
            first = last
        out = out[0] if len(out) == 1 else np.concatenate(out)
        return np.where(self.m.allowed[w.scripts], out, np.float32(-1e6))

    def spans(self, text: str | None) -> list[tuple[str, int, int, int]]:
        """(language, first, stop, letters): spans of the lower-cased text in code points."""
        w = self.letters(text)
        if not len(w.starts) or not self.m.languages:
            return []
        out: list[list] = []
        for k, a, b in zip(viterbi(self.scores(w)).tolist(), (w.starts - 1).tolist(), (w.stops - 1).tolist(), strict=True):
            if out and out[-1][0] == k:
                out[-1][2], out[-1][3] = b, out[-1][3] + b - a
            else:
                out.append([k, a, b, b - a])
        return [(self.m.languages[k], a, b, n) for k, a, b, n in out]

    def labels(self, texts: list[str | None]) -> list[tuple[str, float, int]]:
        """(language, share of letters, number of spans) of each text; some are looked at together."""
        out = [("und", 0.0, 0)] * len(texts)
        most = max(1, min(LETTERS, CELLS // max(1, 4 * len(self.m.languages))))
        group, size = [], 0
        for i, t in enumerate(texts if self.m.languages else []):
            if t:
                group.append(i)
                size += len(t)
                if size >= most:
                    self._label(texts, group, out)
                    group, size = [], 0
        if group:
            self._label(texts, group, out)
        return out

    def _label(self, texts: list[str | None], group: list[int], out: list) -> None:
        low = [texts[i].lower() for i in group]
        w = self.letters("\0".join(low), lowered=True)  # the separator is no letter
        if not len(w.starts):
            return
        ends = np.cumsum([len(t) + 1 for t in low]) + 1  # in x, which has one place before the first text
        text = np.searchsorted(ends, w.starts, side="right")
        first = np.searchsorted(text, np.arange(len(group)))
        count = np.diff(np.append(first, len(text)))
        many = len(self.m.languages)
        path = paths(self.scores(w), first, count)
        letters = np.bincount(text * many + path, weights=w.stops - w.starts,
                              minlength=len(group) * many).reshape(len(group), many)
        best, total = letters.argmax(axis=1), letters.sum(axis=1)
        change = (path[1:] != path[:-1]) & (text[1:] == text[:-1])
        spans = 1 + np.bincount(text[1:][change], minlength=len(group))
        for j in np.flatnonzero(total).tolist():
            out[group[j]] = (self.m.languages[best[j]], float(letters[j, best[j]] / total[j]), int(spans[j]))

    def label(self, text: str | None) -> tuple[str, float, int]:
        return self.labels([text])[0]


def paths(score: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """``viterbi`` of many texts, each given by its first word and number of words.

    Texts are cut into stretches of at most ``STRETCH`` words, and all stretches go forward together, a word
    at a time. A text of several stretches goes twice: first from each language it may come in with, which
    gives the best language at every cut, and then with these fixed.
    """
    k, path = score.shape[1], np.empty(len(score), np.int64)
    parts = -(-count // STRETCH)
    text = np.repeat(np.arange(len(count)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start, size = first[text] + nth * STRETCH, np.minimum(STRETCH, count[text] - nth * STRETCH)
    enter, leave = np.full(len(text), -1), np.full(len(text), -1)  # languages before and at the end of a stretch
    several = np.flatnonzero(parts[text] > 1)
    if len(several):
        gain = np.empty((len(several), k, k))
        for some in _batches(size[several], k * k):
            at = several[some]
            value = np.where(np.eye(k, dtype=bool) | (nth[at] == 0)[:, None, None], 0.0, -np.inf)
            gain[some] = _forward(score, start[at], size[at], value, switch)
        ends = np.append(np.flatnonzero(nth[several] == 0), len(several))
        for lo, hi in zip(ends, ends[1:]):
            best, came = gain[lo][0], []
            for g in gain[lo + 1:hi]:
                total = best[:, None] + g
                came.append(total.argmax(axis=0))
                best = total.max(axis=0)
            at = int(best.argmax())
            for j in range(hi - 1, lo, -1):
                leave[several[j]] = at
                at = enter[several[j]] = int(came[j - lo - 1][at])
            leave[several[lo]] = at
    for some in _batches(size, STRETCH * k // 4 + 1):
        n, steps = len(some), int(size[some[0]])
        value = np.where((enter[some] < 0)[:, None] | (enter[some][:, None] == np.arange(k)), 0.0, -np.inf)
        back = np.empty((steps, n, k), bool), np.empty((steps, n), np.int32)
        value = _forward(score, start[some], size[some], value, switch, back)
        at = np.where(leave[some] >= 0, leave[some], value.argmax(axis=1))
        active = _active(size[some])
        for i in range(steps - 1, -1, -1):
            a = active[i]
            path[start[some[:a]] + i] = at[:a]
            at[:a] = np.where(back[0][i, np.arange(a), at[:a]], at[:a], back[1][i, :a])
    return path


def _batches(size: np.ndarray, cells: int):
    """Places of the stretches, longest first, in batches of so many cells each."""
    order = np.argsort(-size, kind="stable")
    step = max(1, CELLS // cells)
    return [order[lo:lo + step] for lo in range(0, len(order), step)]


def _active(size: np.ndarray) -> np.ndarray:
    """How many of the stretches (longest first) have a word at each step."""
    return np.searchsorted(-size, -np.arange(size[0]), side="left")


def _forward(score, start, size, value, switch, back=None):
    """Values of the languages behind each stretch (longest first), from those before it: [n, k] or [n, from, k]."""
    for i, a in enumerate(_active(size).tolist()):
        v = value[:a]
        top = v.argmax(axis=-1)
        moved = np.take_along_axis(v, top[..., None], axis=-1) - switch
        if back is not None:
            back[0][i, :a], back[1][i, :a] = v >= moved, top
        s = score[start[:a] + i]
        value[:a] = np.maximum(v, moved) + (s if v.ndim == 2 else s[:, None])
    return value


def viterbi(score: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Likeliest language of each word when a change costs ``switch``.

    Without search where the leader (best over all words, so no single language
    gains on it there) keeps them all. A path that leaves it for k stretches of
    one language each pays for at least k - 1 changes, and for k = 1 for one unless
    it gains nothing. So it is enough that no stretch gains more than
    ``switch / 2``; or that no run of words gains more than ``switch`` over the
    leader even with free changes among the others.
    """
    n, k = score.shape
    lead = int(score.sum(axis=0).argmax())
    gain = np.cumsum(score - score[:, lead:lead + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain[:-1]]), axis=0)
    most = float((gain - low).max())
    if most <= switch / 2:
        return np.full(n, lead)
    if most <= switch:
        others = np.delete(score, lead, axis=1).max(axis=1) - score[:, lead]
        free = np.cumsum(others, dtype=np.float64)
        if float((free - np.minimum.accumulate(np.concatenate([[0.0], free[:-1]]))).max()) <= switch:
            return np.full(n, lead)
    value, back = score[0].astype(np.float64), np.empty((n, k), np.int16 if k < 1 << 15 else np.int32)
    own = np.arange(k)
    for i in range(1, n):
        top = int(value.argmax())
        moved = value[top] - switch
        back[i] = np.where(value >= moved, own, top)
        value = np.maximum(value, moved) + score[i]
    path = np.empty(n, np.int64)
    path[-1] = int(value.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all rows of ``docs`` that have a language; the model is small and of fixed size per language."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())  # a row for each language
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    at = {x: i for i, x in enumerate(languages)}

    def make():
        letters = Letters()
        total: dict[int, np.ndarray] = {}

        def each(c):
            by: dict[int, list[str]] = {}
            for t, lang in zip(c["text"], c["lang"], strict=True):
                if lang in at and t:
                    by.setdefault(at[lang], []).append(t)
            for k, texts in by.items():
                w = letters("\n".join(texts))
                table = total.setdefault(k, np.zeros(BUCKETS + 1 + len(NAMES), np.int64))
                for h in grams(w.x):
                    table[:BUCKETS + 1] += np.bincount(h, minlength=BUCKETS + 1)
                table[BUCKETS + 1:] += np.bincount(w.scripts, minlength=len(NAMES))
            return []
        each.close = lambda: [(k, int(p), int(t[p])) for k, t in total.items() for p in np.flatnonzero(t)]
        return each

    # at most (BUCKETS + scripts + 1) rows per language, of TOGETHER languages at once
    counts = (map_rows(rows, make, "k int, place int, n long", rows_per_output=200)
              .groupBy("k", "place").agg(F.sum("n").alias("n")))
    if len(languages) > TOGETHER:
        counts = settle(counts)
    logs, scripts = np.zeros((BUCKETS + 1, len(languages)), np.float32), np.zeros((len(NAMES), len(languages)))
    for lo in range(0, len(languages), TOGETHER):
        hi = min(lo + TOGETHER, len(languages))
        some = (counts if len(languages) <= TOGETHER else counts.where(F.col("k").between(lo, hi - 1))).toPandas()
        table = np.zeros((BUCKETS + 1 + len(NAMES), hi - lo))
        table[some["place"].to_numpy(dtype=int), some["k"].to_numpy(dtype=int) - lo] = some["n"].to_numpy(dtype=float)
        seen, scripts[:, lo:hi] = table[:BUCKETS], table[BUCKETS + 1:]
        logs[:BUCKETS, lo:hi] = np.log((seen + SMOOTH) / (seen.sum(axis=0) + SMOOTH * BUCKETS))
    allowed = scripts >= np.maximum(1, SHARE * scripts.sum(axis=0))
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, logs, allowed)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, lang_pred, score, n_spans."""
    def make():
        reader = model.reader()
        return lambda c: [(i, *x) for i, x in zip(c["doc_id"], reader.labels(c["text"]), strict=True)]

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), make,
                    "doc_id long, lang_pred string, score double, n_spans int", rows_per_output=500)


def language_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span: doc_id, lang, start, stop (code points), letters."""
    def make():
        reader = model.reader()
        return lambda c: [(i, *s) for i, t in zip(c["doc_id"], c["text"], strict=True) for s in reader.spans(t)]

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), make,
                    "doc_id long, lang string, start int, stop int, letters int", rows_per_output=500)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir)
    model = fit(docs.where(fold("doc_id", 4) != 2))
    return (identify(docs, model).withColumn("held_out", fold("doc_id", 4) == 2)
            .select("doc_id", "held_out", "lang_pred", "score", "n_spans"))


QUERIES = {"op2_language_id": op2_language_id}
ORACLE: dict[str, str] = {}
