"""Language-model scoring by the likelihood of a subword lattice.

The pieces of an existing vocabulary weight all segmentations of a text, and a
forward recursion in log space sums them: the score is the log10 of the text's
marginal probability. Pieces carry unigram log-probabilities, estimated from
how often they stand in the training documents' words (segmented by the
vocabulary's own scores), smoothed so that every piece and every byte has some.
No piece crosses a space, so the lattice of a text is that of its words in a
row: a text's score is the sum over its words, each with the choice to go on, and
the choice to end. A word is one piece that begins words and any number of others,
so the likelihoods of all words sum to 1, and so do those of all texts.

The base columns come from word counts of the whole training part (lower-cased
A-Z, words ``[^\\x20\\x09-\\x0D]+``, then one end). Counts of at most
``FREQUENT`` words are given to every task; all other words of a document meet
their counts in a shuffle join, a row for each different word of a document.

Null counts as empty text: one token, the end. Rows may repeat a doc_id. An
empty training part gives c = 0, N = 0, V = 0 for all; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import attach, fold, map_rows, read_table, stored, words
from cardiolake.llm.pieces import MARK, Model, default_model

FREQUENT, FLUSH, CACHE = 1 << 17, 200_000, 150_000
SMOOTH = 0.5
LN10 = math.log(10)
#: Words longer than this are summed one by one, with the pieces of so many places looked up at once.
LONG, PLACES = 64, 1 << 14


def word_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c) over all texts, combined within tasks. Words are bytes."""
    def make():
        seen: Counter = Counter()

        def drain():
            out = list(seen.items())
            seen.clear()
            return out

        def each(c):
            for t in c["text"]:
                seen.update(words(t))
            return drain() if len(seen) > FLUSH else []
        each.close = drain
        return each

    return (map_rows(train.select(F.col(text_col).alias("text")), make, "word binary, c long", rows_per_output=500)
            .groupBy("word").agg(F.sum("c").alias("c")))


def frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[int, dict[bytes, int]]:
    """(least count, {word: count}): the words at or above a power of two, chosen so that they are at most ``most``."""
    steps = counts.groupBy(F.floor(F.log2("c")).cast("int").alias("e")).agg(F.count("*").alias("n")).collect()
    total, least = 0, None
    for e, n in sorted(((r["e"], r["n"]) for r in steps), reverse=True):  # at most 63 rows
        if total + n > most:
            break
        total, least = total + n, 1 << e
    if least is None:
        return 1 << 62, {}
    return least, {bytes(r["word"]): r["c"] for r in counts.where(F.col("c") >= least).collect()}


def piece_log10(counts: DataFrame, blob: bytes) -> list[float]:
    """log10 probability of each piece of the vocabulary."""
    def make():
        lib = Model(blob).library
        total = np.zeros(lib.get_piece_size(), np.int64)

        def each(c):
            ids = lib.encode([MARK + w.decode() for w in c["word"]])
            size = [len(x) for x in ids]
            if sum(size):
                total[:] += np.bincount(np.concatenate([np.array(x, np.int64) for x in ids]),
                                        weights=np.repeat(c["c"], size), minlength=len(total)).astype(np.int64)
            return []
        each.close = lambda: [(int(i), int(total[i])) for i in np.flatnonzero(total)]
        return each

    rows = map_rows(counts, make, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a vocabulary at most
    size = Model(blob).library.get_piece_size()
    n = np.full(size, SMOOTH)
    for r in rows:
        n[r["id"]] += r["n"]
    return np.log10(n / n.sum()).tolist()


class Lattice:
    """Marginal log10 probability of words: all segmentations, summed from left to right.

    Words of one length go through the recursion together: place by place, each
    piece that starts there carries the sum up to its start to its end. Pieces
    are found by a 64-bit hash of their characters in two tables. A long word goes
    alone, whole: its pieces are looked up for many places together, and sums are
    handed on from block to block for as many places as the longest piece has.
    """

    PRIME = np.uint64(0x100000001B3)
    BITS = 20

    def __init__(self, blob: bytes, log10: list[float]):
        lib = Model(blob).library
        self.byte = np.zeros(256)
        piece: dict[str, float] = {}
        for i, p in enumerate(log10):
            if lib.is_byte(i):
                self.byte[int(lib.id_to_piece(i)[3:5], 16)] = p
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                piece[lib.id_to_piece(i)] = p * LN10
        self.longest = max(map(len, piece), default=1)
        for text in list(piece):  # a beginning of a piece says that it may go on
            for k in range(1, len(text)):
                piece.setdefault(text[:k], -math.inf)
        self.keys = [np.zeros(1 << self.BITS, np.uint64) for _ in range(2)]
        self.logs = [np.full(1 << self.BITS, -np.inf) for _ in range(2)]
        by: dict[int, list[str]] = {}
        for text in piece:
            by.setdefault(len(text), []).append(text)
        h, logs = [], []
        for n, texts in by.items():
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.uint64)
            x = np.zeros(len(texts), np.uint64)
            for j in range(n):
                x = self._step(x, codes[:, j])
            h.append(x)
            logs.append(np.array([piece[t] for t in texts]))
        h, logs = np.concatenate(h), np.concatenate(logs)
        for k in range(2):  # what finds its place taken goes to the second table
            at = self._place(h, k)
            self.keys[k][at] = h
            self.logs[k][at] = logs
            out = self.keys[k][at] != h
            h, logs = h[out], logs[out]
        self.rest: dict[int, float] = dict(zip(h.tolist(), logs.tolist(), strict=True))

    def _step(self, h: np.ndarray, ch: np.ndarray) -> np.ndarray:
        h = (h ^ (ch + np.uint64(0x9E3779B97F4A7C15))) * self.PRIME
        return h ^ (h >> np.uint64(29))

    def _place(self, h, k):
        return (h * np.uint64(0xBF58476D1CE4E5B9 if k else 0x94D049BB133111EB)) >> np.uint64(64 - self.BITS)

    def _lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is it a piece or its beginning, natural log of its probability)."""
        at = self._place(h, 0)
        found, p = self.keys[0][at] == h, self.logs[0][at]
        miss = np.flatnonzero(~found)
        at = self._place(h[miss], 1)
        also = self.keys[1][at] == h[miss]
        found[miss[also]], p[miss[also]] = True, self.logs[1][at[also]]
        for key, value in self.rest.items():
            same = h == np.uint64(key)
            found[same], p[same] = True, value
        return found, p

    def spelled(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of characters spelled by their bytes."""
        each, at = np.unique(codes, return_inverse=True)
        return np.array([self.byte[list(chr(int(x)).encode())].sum() for x in each])[at].reshape(codes.shape)

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        by: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            if len(t) > LONG:
                out[i] = self._long(np.frombuffer(t.encode("utf-32-le"), "<u4").astype(np.uint64))
            else:
                by.setdefault(len(t), []).append(i)
        for n, rows in by.items():
            if n:
                for lo in range(0, len(rows), 4096):
                    part = rows[lo:lo + 4096]
                    codes = np.frombuffer("".join([texts[i] for i in part]).encode("utf-32-le"), "<u4").reshape(-1, n)
                    out[part] = self._sums(codes.astype(np.uint64))
        return out

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        m, n = codes.shape
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0
        spell, codes = self.spelled(codes).T * LN10, np.ascontiguousarray(codes.T)
        for i in range(n):
            alpha[i + 1] = np.logaddexp(alpha[i + 1], alpha[i] + spell[i])
            live, h = np.arange(m), np.zeros(m, np.uint64)
            for j in range(i + 1, n + 1):
                h = self._step(h, codes[j - 1][live])
                found, p = self._lookup(h)
                live, h, p = live[found], h[found], p[found]
                if not len(live):
                    break
                hit = p > -np.inf
                to = live[hit]
                alpha[j, to] = np.logaddexp(alpha[j, to], alpha[i, to] + p[hit])
        return alpha[n] / LN10

    def _long(self, codes: np.ndarray) -> float:
        n, scale = len(codes), 0.0
        sums = [1.0] + [0.0] * self.longest  # times e ** scale, from the block's first place on
        for lo in range(0, n, PLACES):
            size = min(PLACES, n - lo)
            live, h = np.arange(size), np.zeros(size, np.uint64)
            starts, stops, logs = [live], [live + 1], [self.spelled(codes[lo:lo + size]) * LN10]
            for k in range(self.longest):
                live, h = live[live + k < n - lo], h[live + k < n - lo]
                found, p = self._lookup(h := self._step(h, codes[lo + live + k]))
                live, h, p = live[found], h[found], p[found]
                if not len(live):
                    break
                hit = p > -np.inf
                starts.append(live[hit])
                stops.append(live[hit] + k + 1)
                logs.append(p[hit])
            at = np.concatenate(starts)
            order = np.argsort(at, kind="stable")
            sums += [0.0] * size
            for i, j, p in zip(at[order].tolist(), np.concatenate(stops)[order].tolist(),
                               np.exp(np.concatenate(logs))[order].tolist(), strict=True):
                if sums[i] < 1e-150 and (top := max(sums[i:i + self.longest + 1])) < 1e-100:
                    for x in range(i, i + self.longest + 1):
                        sums[x] /= top
                    scale += math.log(top)
                sums[j] += sums[i] * p
            sums = sums[size:]
        return (math.log(sums[0]) + scale) / LN10


def score_documents(docs: DataFrame, train: DataFrame, model_path: str | None = None, id_col: str = "doc_id",
                    text_col: str = "text", carry: dict | None = None) -> DataFrame:
    """Per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score (and the ``carry`` columns).

    ``docs`` must come from files or a checkpoint: rows are told apart by scan position.
    """
    with open(model_path or default_model(), "rb") as f:
        blob = f.read()
    spark = docs.sparkSession
    counts = stored(word_counts(train, text_col))
    ends = train.count()
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    n_train = (sums[0] or 0) + ends
    n_kinds = sums[1] + (1 if ends else 0)
    least, known = frequent(counts)
    # at most FREQUENT words and one number for each piece
    shared = spark.sparkContext.broadcast((known, piece_log10(counts, blob)))
    room = math.log10(n_train + n_kinds + 1)
    # after every word a text ends or goes on: with them the scores of all texts sum to 1 at most
    p_stop = (ends + 1) / (n_train + 2)
    stop, go_on = math.log10(p_stop), math.log10(1 - p_stop)
    extra = list(carry or {})
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                      F.col(text_col).alias("text"), *[c.alias(n) for n, c in (carry or {}).items()])
    kinds = dict(src.dtypes)

    def make():
        common, log10 = shared.value
        lattice, score_of = Lattice(blob, log10), {}
        gain_of = {w: math.log10(c + 1) for w, c in common.items()}

        def each(c):
            if len(score_of) > CACHE:
                score_of.clear()
            texts = [Counter(words(t)) for t in c["text"]]
            new = list({w for t in texts for w in t if w not in score_of})
            score_of.update(zip(new, lattice([MARK + w.decode() for w in new]), strict=True))
            out = []
            for k, tokens in enumerate(texts):
                n, hit, base, total = 1, int(ends > 0), math.log10(ends + 1), stop
                row = c["row"][k]
                for w, tf in tokens.items():
                    n += tf
                    total += tf * (score_of[w] + go_on)
                    x = gain_of.get(w)
                    if x is None:
                        out.append((row, w, tf, None, None, None, None, None, *[None] * len(extra)))
                    else:
                        hit += tf
                        base += tf * x
                # the document itself, under a key that spreads: no word holds white space
                out.append((row, b" %d" % row, None, c["doc_id"][k], n, hit, base - n * room, float(total),
                            *[c[x][k] for x in extra]))
            return out
        return each

    flat = map_rows(src, make, "row long, word binary, tf long, doc_id long, n_tokens long, hit long, base double, "
                    "score double" + "".join(f", {x} {kinds[x]}" for x in extra), rows_per_output=400)
    met = attach(flat, counts.where(F.col("c") < least), "word", "left")
    more = [F.max(x).alias(x) for x in extra]
    out = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("score").alias("score"),
        (F.max("hit") + F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.col("tf"))), F.lit(0))).alias("n_known"),
        (F.max("base") + F.coalesce(F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)), F.lit(0.0))).alias("base_score"), *more)
    return out.select("doc_id", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                      "base_score", "score", *extra)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir)
    out = score_documents(docs, docs.where(fold("doc_id", 7) != 2), carry={"held_out": fold("doc_id", 7) == 2})
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op10_lm_scoring": op10_lm_scoring}
ORACLE: dict[str, str] = {}
