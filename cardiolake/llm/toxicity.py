"""Toxicity by noisy-channel deobfuscation.

A character language model (letter trigrams, hashed into tables of fixed size)
is counted over all documents. Text is read as words; a word that may hide
another (digits or signs that stand for letters, letters set apart, letters
repeated) opens a lattice, however long it is and however few letters it has;
only numbers and dates do not. Each sign may be any letter it stands for or be
dropped, a separator may be nothing or a word's end, and a run of equal letters
may be one or two. A word is read with and without the signs at its edges.
Viterbi decoding takes the likeliest path under the language model, and the
restored words are scored along with the words of the text, by the reading that
weighs most.

Score: features are words and, of longer words, the first 4, 5 and 6
characters, once per document. From the labelled training documents (a sample of at most
``MOST_LABELLED``, by hash of the id, so that its ids can be broadcast) a feature
has a smoothed log-likelihood ratio, toxic against clean; those in at least
``LEAST`` toxic documents with a ratio of at least ``RATIO`` make the lexicon (the
sample bounds it). A document's log-odds are the prior plus, for every distinct
word, its strongest feature.

A word of digits alone is decoded if it may spell a whole lexicon word. It weighs
what that word does, less the price ``BY_DIGITS`` of such a spelling and less how
often the number stands in clean training texts, where it is just a number.

Null and empty texts have no features: their score is the prior. Labels other
than 0 and 1 are no labels; an id with several labels is toxic if one is 1.
Without a toxic training document every score is 0. Rows that repeat a doc_id
are scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import add_column, fold, map_rows, read_table, settle, stored

THRESHOLD = 0.7
LEAST, RATIO, MOST_LABELLED = 5, 50.0, 200_000
#: Share of the spellings of a word that use digits alone.
BY_DIGITS = 0.02
FLUSH = 300_000
#: Readings up to this length are decoded once and kept; longer ones (rare and seldom repeated) are decoded each time.
KEPT = 64
#: Letters a sign may stand for. Fixed values.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "#": "h",
         "*": "aeiou", "¡": "i", "§": "s"}
WORD = re.compile(r"[^\W\d_]+")
#: What may hide a word: a letter three times in a row, or letters set apart.
REPEAT = re.compile(r"([^\W\d_])\1\1")
SET_APART = re.compile(r"(?<![^\W_])[^\W_](?:[\s.\-_*'·,/\\|~]{1,2}[^\W_]){2,}(?![^\W_])")
EDGE = " .,;:?\"'()[]{}<>|-_~`"
#: The edges that stand for no letter.
MARKS = "".join(c for c in EDGE if c not in SIGNS)
#: Words of digits alone.
DIGITS = re.compile(r"(?<![^\W])\d{2,}(?![^\W])")
#: Numbers, dates and times open no lattice (digits alone may: see ``spellings``).
NUMBER = re.compile(r"[-+#$£€(]{0,2}\d+(?:[-.,:/()'–]{1,2}\d+)*[%+$£€)]{0,2}")
#: Sizes of the hashed tables of the language model and of the feature filter: fixed, whatever the corpus.
BUCKETS, FILTER = 1 << 16, 1 << 20
#: Fixed odd multipliers of the trigram hash.
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: Letters added for each letter of a lexicon word, as a share of the corpus.
FAVOUR = 0.0005


def features(word: str) -> list[str]:
    """The word and its beginnings. A beginning stands for a stem with an ending of two letters or more,
    else a plain word would lend its weight to every word that it nearly begins."""
    n = len(word)
    return [word, *[f"{word[:k]}~" for k in (4, 5, 6) if n > k + 1]]


def suspects(text: str) -> set[tuple[str, ...]]:
    """Pieces of a lower-case text that may hide a word, each as its readings: with and without signs at the edges."""
    out = set()
    for token in set(text.split()):
        if token.isalpha():
            if REPEAT.search(token):
                out.add((token,))
            continue
        whole = token.strip(MARKS)
        core = token.strip(EDGE)
        if not NUMBER.fullmatch(core):
            readings = dict.fromkeys((whole, core, core.rstrip("!*%&$#+")))
            out.add(tuple(r for r in readings if r and (not r.isalpha() or REPEAT.search(r))))
    for m in SET_APART.finditer(text):
        if WORD.search(m.group()):
            # of the separators, these two are also signs
            out.add(tuple(dict.fromkeys((m.group(), m.group().replace("*", "-").replace("|", "-")))))
    out.discard(())
    return out


class Decoder:
    """Viterbi over the lattice of a suspect under the trigram table."""

    def __init__(self, tri: np.ndarray, bi: np.ndarray):
        self.tri, self.bi, self.known = tri, bi, {}

    def _cost(self, a: str, b: str, c: str) -> float:
        """-log P(c | a, b), smoothed."""
        x = self.known.get((a, b, c))
        if x is None:
            x = -math.log((self.tri[bucket(a, b, c)] + 0.2) / (self.bi[bucket("", a, b)] + 8.0))
            self.known[a, b, c] = x
        return x

    def lattice(self, token: str) -> list[list[str]]:
        """Alternatives per place; an alternative is a string of 0 to 2 letters, or a space: the end of a word."""
        out, i = [], 0
        while i < len(token):
            c, j = token[i], i + 1
            while j < len(token) and token[j] == c:
                j += 1
            n = j - i
            if c.isalpha():
                out.append([c] if n == 1 else [c, c * 2] if n > 2 else [c * 2, c])
            else:
                letters = SIGNS.get(c, "")
                if not letters:
                    out.append(["", " "])
                elif n > 1:
                    out.append(["", *[x for x in letters], *[x * 2 for x in letters]])
                elif c.isdigit():
                    out.append(list(letters))
                else:
                    out.append([*letters, ""])
            i = j
        return out

    def __call__(self, token: str) -> str:
        # state: the last two letters; value: (cost, restored as a chain from its end)
        states: dict[tuple[str, str], tuple[float, tuple | None]] = {("", ""): (0.0, None)}
        for options in self.lattice(token):
            new: dict[tuple[str, str], tuple[float, tuple | None]] = {}
            for (a, b), (cost, done) in states.items():
                for option in options:
                    x, y, c = a, b, cost
                    if option == " ":
                        c += 0.5 + (self._cost(a, b, "") if b else 0.0)
                        x = y = ""
                    else:
                        for ch in option:
                            c += self._cost(x, y, ch)
                            x, y = y, ch
                        if not option:
                            c += 0.5
                    if (x, y) not in new or c < new[x, y][0]:
                        new[x, y] = (c, (done, option) if option else done)
            states = new
        chain = min((c + (self._cost(a, b, "") if b else 0.0), i, w) for i, ((a, b), (c, w)) in enumerate(states.items()))[2]
        out = []
        while chain:
            chain, option = chain
            out.append(option)
        return "".join(reversed(out))


def bucket(a: str, b: str, c: str) -> int:
    """Place of a trigram in the table; "" is a word's edge."""
    x, y, z = (ord(v) if v else 0 for v in (a, b, c))
    return ((x * MIX[0] + y * MIX[1] + z * MIX[2]) & 0xFFFFFFFF) >> 16


@dataclass
class Model:
    prior: float                    # log-odds of a text without features
    lexicon: dict[str, float]       # feature -> log-likelihood ratio
    tri: np.ndarray                 # counts of hashed letter trigrams
    bi: np.ndarray                  # and of their first two letters
    numbers: dict[str, float] = field(default_factory=dict)  # digits that may spell a lexicon word -> weight as that word

    def scorer(self):
        decode, lexicon, known = Decoder(self.tri, self.bi), self.lexicon, {}
        prior, hidden, numbers = self.prior, {}, self.numbers

        def best(word: str) -> float:
            return max((lexicon.get(f, 0.0) for f in features(word)), default=0.0)

        def restored(reading: str) -> tuple[tuple[str, float], ...]:
            """The words a reading decodes to that weigh something, with their weight."""
            x = hidden.get(reading)
            if x is None:
                each = {w: max([0.0, *(lexicon.get(f, 0.0) for f in features(w) if len(f) != 5 or f[-1] != "~")])
                        for w in WORD.findall(decode(reading))}
                x = tuple((w, v) for w, v in each.items() if v)
                if len(reading) <= KEPT:
                    hidden[reading] = x
            return x

        def score(text: str | None) -> float:
            low = (text or "").lower()
            got = set(WORD.findall(low))
            if len(known) > FLUSH:
                known.clear()
            total = 0.0
            for w in got:
                x = known.get(w)
                if x is None:
                    x = known[w] = best(w)
                total += x
            if lexicon:
                if len(hidden) > FLUSH:
                    hidden.clear()
                for readings in suspects(low):
                    total += max(sum(v for w, v in restored(r) if w not in got) for r in readings)
                if numbers:
                    for token in set(DIGITS.findall(low)):
                        v = numbers.get(token, 0.0)
                        if v > 0 and (w := decode(token)) in lexicon and w not in got:
                            total += v
            return 0.0 if prior < -100 else 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, prior + total))))

        return score


def spellings(lexicon: dict[str, float]) -> dict[str, str]:
    """Digits that spell a whole lexicon word -> the word (of several, the one with the largest ratio)."""
    digits: dict[str, str] = {}
    for d, letters in SIGNS.items():
        if d.isdigit():
            for x in letters:
                digits[x] = digits.get(x, "") + d
    out: dict[str, str] = {}
    for w in sorted(lexicon, key=lambda w: (lexicon[w], w)):
        if len(w) > 1 and all(x in digits for x in w):  # two letters have two digits each, so spellings are few
            out.update(("".join(p), w) for p in product(*(digits[x] for x in w)))
    return out


def number_weights(clean: DataFrame, lexicon: dict[str, float]) -> dict[str, float]:
    """Weight of each number that may spell a lexicon word: less where clean texts hold the number."""
    words = spellings(lexicon)
    if not words:
        return {}

    def make():
        def each(c):
            seen = Counter(x for t in c["text"] for x in set(DIGITS.findall((t or "").lower())) if x in words)
            return list(seen.items())
        return each

    rows = map_rows(clean.select("text"), make, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    often = {r["token"]: r["n"] for r in rows.collect()}  # at most the spellings of the lexicon
    return {d: lexicon[w] + math.log(BY_DIGITS) - math.log((often.get(d, 0) + 0.5) / 0.5) for d, w in words.items()}


def toxic_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic): the number of texts it stands in or, if fewer, of different words it stands
    behind. Copies and near copies of a text add no such words, so their rare words do not look like insults."""
    def make():
        seen: set = set()
        texts: Counter = Counter()

        def drain():
            out = [(f, zlib.crc32(b.encode()), None) for f, b in seen] + [(f, None, n) for f, n in texts.items()]
            seen.clear()
            texts.clear()
            return out

        def each(c):
            out = []
            for t in c["text"]:
                before, own = "", set()
                for w in WORD.findall((t or "").lower()):
                    own.update([(f, before) for f in features(w)])
                    before = w
                seen.update(own)
                texts.update({f for f, _ in own})
                if len(seen) > FLUSH:
                    out += drain()
            return out
        each.close = drain
        return each

    return (map_rows(rows, make, "feature string, before long, n long", rows_per_output=200)
            .groupBy("feature", "before").agg(F.sum("n").alias("n"))
            .groupBy("feature").agg(F.least(F.count("before"), F.sum("n")).alias("toxic")))


def _counted(rows: DataFrame, name: str, passing: np.ndarray | None = None) -> DataFrame:
    """(feature, <name>): in how many texts a feature occurs, combined within tasks.

    ``passing`` marks hash places whose features are counted; others are left out.
    """
    def make():
        counts: Counter = Counter()

        def drain():
            out = list(counts.items())
            counts.clear()
            return out

        def each(c):
            out = []
            for t in c["text"]:
                got = set()
                for w in set(WORD.findall((t or "").lower())):
                    got.update(features(w))
                counts.update(got if passing is None else [f for f in got if passing[_place(f)]])
                if len(counts) > FLUSH:
                    out += drain()
            return out
        each.close = drain
        return each

    return (map_rows(rows, make, f"feature string, {name} long", rows_per_output=200)
            .groupBy("feature").agg(F.sum(name).alias(name)))


def _place(feature: str) -> int:
    return zlib.crc32(feature.encode()) & (FILTER - 1)


def letter_counts(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashed counts of letter trigrams over all texts, and of the letter pairs before each letter."""
    def make():
        letter = np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000)
        total = np.zeros((2, BUCKETS), np.int64)

        def each(c):
            low = " ".join([t for t in c["text"] if t]).lower()
            x = np.frombuffer(f"  {low} ".encode("utf-32-le"), "<u4")
            x = np.where(letter[np.minimum(x, 0xFFFF)], x, 0).astype(np.uint32)
            a, b, z = x[:-2], x[1:-1], x[2:]
            use = (b != 0) | (z != 0)
            a, b, z = np.where(b == 0, 0, a)[use], b[use], z[use]
            m = [np.uint32(v) for v in MIX]
            total[0] += np.bincount((a * m[0] + b * m[1] + z * m[2]) >> np.uint32(16), minlength=BUCKETS)
            total[1] += np.bincount((a * m[1] + b * m[2]) >> np.uint32(16), minlength=BUCKETS)
            return []

        def close():
            return [(k, int(i), int(total[k, i])) for k in (0, 1) for i in np.flatnonzero(total[k])]
        each.close = close
        return each

    rows = (map_rows(docs.select(F.col(text_col).alias("text")), make, "kind int, place int, n long", rows_per_output=200)
            .groupBy("kind", "place").agg(F.sum("n").alias("n")).collect())  # at most 2 * BUCKETS rows
    out = np.zeros((2, BUCKETS))
    for r in rows:
        out[r["kind"], r["place"]] = r["n"]
    return out[0], out[1]


def favoured(tri: np.ndarray, bi: np.ndarray, lexicon: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """The counts with the lexicon counted in, so that a sign is read as the letter a lexicon word needs."""
    tri, bi = tri.copy(), bi.copy()
    add = 1 + FAVOUR * tri.sum() / max(1, len(lexicon)) ** 0.5
    for w in lexicon:
        letters = ["", "", *w.removesuffix("~"), *([] if w.endswith("~") else [""])]
        for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
            tri[bucket(a, b, c)] += add
            bi[bucket("", a, b)] += add
    return tri, bi


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", folds: int = 3, held_out: int = 1) -> DataFrame:
    """(text, toxic) of the labelled documents outside the held-out fold."""
    y = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
         .where("toxic IN (0, 1) AND _id IS NOT NULL").where(fold("_id", folds) != held_out)
         .groupBy("_id").agg(F.max("toxic").alias("toxic"))
         .orderBy(F.xxhash64("_id"), "_id").limit(MOST_LABELLED))
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return d.join(F.broadcast(y), "_id").select("text", "toxic")  # at most MOST_LABELLED ids and labels


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> Model:
    # read several times: a table of at most MOST_LABELLED texts instead of a scan of all documents each time
    rows = stored(training_rows(docs, labels, id_col, text_col, **options))
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    tri, bi = letter_counts(docs, text_col)
    if not toxic:
        return Model(-1000.0, {}, tri, bi)
    often = settle(toxic_counts(rows.where("toxic = 1")).where(F.col("toxic") >= LEAST))
    passing = np.zeros(FILTER, bool)
    places = often.select((F.crc32(F.encode("feature", "UTF-8")) % FILTER).cast("int").alias("p")).distinct()
    passing[places.toPandas()["p"].to_numpy(dtype=np.int64)] = True  # at most FILTER rows
    others = _counted(rows.where("toxic = 0"), "clean", passing)
    ratio = F.log(((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) / ((F.col("clean") + 0.5) / F.lit(clean + 1.0)))
    strong = (often.join(others, "feature", "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
              .withColumn("ratio", ratio).where(F.col("ratio") >= math.log(RATIO))
              .select("feature", "ratio").collect())  # features of LEAST texts or more of the bounded sample
    lexicon = {r["feature"]: r["ratio"] for r in strong}
    return Model(math.log((toxic + 0.5) / (clean + 0.5)), lexicon, *favoured(tri, bi, lexicon),
                 number_weights(rows.where("toxic = 0"), lexicon))


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score column; all other columns pass through."""
    def make():
        score = model.scorer()
        return lambda c: [score(t) for t in c]

    return add_column(docs, make, text_col, score_col, "double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns."""
    name = "_toxic_score"
    while name in docs.columns:
        name += "_"
    return scored(docs, model, text_col, name).where(F.col(name) < threshold).drop(name)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir)
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE: dict[str, str] = {}
