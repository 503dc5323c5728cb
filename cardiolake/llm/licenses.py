"""License scans: fuzzy search for short notices.

Texts are lower-cased (A-Z) and read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

* Base: every place where the words of a ``PHRASES`` entry stand consecutively.
* Fuzzy: a ``NOTICES`` entry may differ by ``edits`` character edits. It is cut
  into ``edits + 1`` pieces; by the pigeonhole principle any such match holds one
  piece unchanged, so one automaton over all pieces finds every candidate place.
  The regex library then matches the notice with bounded errors (best match)
  in a window around each piece, no wider than a match can reach; of matches that
  overlap the best one stays, and the other's window is searched again without it.
  So the work grows with the number of pieces found, however many notices stand
  together. The matches are reported as spans of the text.

Labels are the base labels and those of the matched notices. Null counts as
empty text: no words, no labels, score 0. score: 1 with a base phrase, otherwise
the largest share of unchanged characters of a matched notice, otherwise 0.
"""

from __future__ import annotations

import bisect
import heapq
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import map_rows, read_table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Fixed phrases and labels of the base.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices: text (words, lower case), label, edits allowed.
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("the mit license", "mit", 1),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("the apache software license", "apache", 2),
    ("this work is licensed under the gnu general public license", "gpl", 5),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 2),
    ("gnu affero general public license", "agpl", 2),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("bsd 3 clause license", "bsd", 1),
    ("bsd 2 clause license", "bsd", 1),
    ("licensed under cc by", "cc", 1),
    ("creative commons attribution", "cc", 2),
    ("creative commons zero", "cc0", 1),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5),
    ("boost software license", "boost", 2),
    ("permission to use copy modify and or distribute this software", "isc", 5),
]
#: Windows whose match a task remembers; emptied when full.
KNOWN = 50_000
SPANS = "array<struct<label:string,start:int,stop:int,first_word:long,edits:int,base:boolean>>"


def pieces(text: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): ``edits + 1`` pieces of nearly equal length that cover the text."""
    n, k = len(text), edits + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, phrases=None, notices=None):
        import ahocorasick
        import regex

        self.known: dict = {}
        self.phrases = {tuple(p.encode().split()): label for p, label in (PHRASES if phrases is None else phrases).items()}
        self.notices = [(t, label, e, regex.compile(f"(?b)(?:{regex.escape(t)}){{e<={e}}}"))
                        for t, label, e in (NOTICES if notices is None else notices)]
        at: dict[str, list[tuple[int, int]]] = {}
        for k, (t, _, e, _) in enumerate(self.notices):
            for offset, piece in pieces(t, e):
                at.setdefault(piece, []).append((k, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in at.items():
            self.seeds.add_word(piece, (len(piece), uses))
        if at:
            self.seeds.make_automaton()

    def __call__(self, text: str | None):
        """(n_words, spans): a span is (label, start, stop, first_word, edits, base), offsets in code points."""
        data = (text or "").encode().lower()
        tokens = WORD.findall(data)
        if not tokens:
            return 0, []
        found = []
        for phrase, label in self.phrases.items():
            if phrase[-1] not in data:
                continue
            for i in _places(tokens, phrase):
                found.append((label, i, i + len(phrase), 0, True))
        if self.notices:
            found += self._fuzzy(tokens)
        if not found:
            return len(tokens), []
        ends = [m.span() for m in WORD.finditer(data)]
        chars = _code_points(data, {ends[f[1]][0] for f in found} | {ends[f[2] - 1][1] for f in found})
        return len(tokens), sorted((label, chars[ends[i][0]], chars[ends[j - 1][1]], i, e, base)
                                   for label, i, j, e, base in found)

    def _fuzzy(self, tokens):
        line = b" ".join(tokens).decode()
        # the best match around each seed, in a window that holds every match with this seed in its place
        queues: dict[int, list] = {}
        for end, (size, uses) in self.seeds.iter(line):
            start = end - size + 1
            for k, offset in uses:
                t, _, e, _ = self.notices[k]
                lo, hi = max(0, start - offset - e), min(len(line), start - offset + len(t) + e)
                if m := self._around(k, line, lo, hi, start, end + 1):
                    queues.setdefault(k, []).append((*m, lo, hi, start, end + 1))
        hits = {}
        for k, queue in queues.items():
            for edits, s, z in self._apart(k, line, queue):
                key = (self.notices[k][1], s, z)
                hits[key] = min(edits, hits.get(key, edits))
        if not hits:
            return []
        # offsets of the joined line back to word numbers
        starts, at = [], 0
        for w in tokens:
            starts.append(at)
            at += len(w.decode()) + 1
        out = []
        for (label, s, t), e in hits.items():
            i = bisect.bisect_right(starts, s) - 1
            j = bisect.bisect_left(starts, t)
            out.append((label, i, max(j, i + 1), e, False))
        return out

    def _around(self, k: int, line: str, lo: int, hi: int, a: int, b: int):
        """(edits, start, stop) of the best match within ``lo..hi`` that touches the seed ``a..b``, or None.

        Windows repeat (a notice set many times): results are kept by the window's text.
        """
        key = (k, a - lo, b - lo, line[lo:hi])
        if key in self.known:
            found = self.known[key]
        else:
            if len(self.known) > KNOWN:
                self.known.clear()
            text, _, e, pattern = self.notices[k]
            x, y, found = 0, hi - lo, None
            while y - x >= len(text) - e and (m := pattern.search(key[3], x, y)):
                if m.start() < b - lo and m.end() > a - lo:
                    found = (sum(m.fuzzy_counts), m.start(), m.end())
                    break
                x, y = (m.end(), y) if m.end() <= a - lo else (x, m.start())
            self.known[key] = found
        return found and (found[0], found[1] + lo, found[2] + lo)

    def _apart(self, k: int, line: str, queue: list):
        """Matches that do not overlap, best first; one that a better one cuts into is looked for in what is left."""
        heapq.heapify(queue)
        starts, stops = [], []  # of the matches taken, ascending
        seen = set()
        while queue:
            edits, s, z, lo, hi, a, b = heapq.heappop(queue)
            i = bisect.bisect_right(stops, s)
            if i == len(starts) or starts[i] >= z:
                starts.insert(i, s)
                stops.insert(i, z)
                yield edits, s, z
                continue
            i = bisect.bisect_right(stops, a)  # free room around the seed
            left, right = (stops[i - 1] if i else 0), (starts[i] if i < len(starts) else len(line))
            lo, hi = max(lo, left), min(hi, right)
            if b <= hi and (lo, hi, a) not in seen and (m := self._around(k, line, lo, hi, a, b)):
                seen.add((lo, hi, a))
                heapq.heappush(queue, (*m, lo, hi, a, b))


def _places(tokens, phrase):
    """Word numbers where ``phrase`` starts."""
    out, i = [], -1
    first, n = phrase[0], len(phrase)
    while True:
        try:
            i = tokens.index(first, i + 1)
        except ValueError:
            return out
        if tuple(tokens[i:i + n]) == phrase:
            out.append(i)


def _code_points(data: bytes, offsets: set[int]) -> dict[int, int]:
    out, last, count = {}, 0, 0
    for o in sorted(offsets):
        count += len(data[last:o].decode())
        out[o], last = count, o
    return out


def notices_of(table: DataFrame, text_col: str = "text", label_col: str = "label", edits_col: str = "edits") -> list:
    """Notices from a table (words in lower case, label, edits allowed): a list for ``scan_licenses``.

    Every task holds the automaton over all notices, so the table is a vocabulary of thousands, not data.
    """
    rows = table.select(F.col(text_col), F.col(label_col), F.col(edits_col).cast("int")).where(
        F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).collect()
    out = []
    for text, label, edits in rows:
        words = b" ".join(WORD.findall(text.encode().lower())).decode()
        if words:
            out.append((words, label, min(max(edits or 0, 0), len(words) - 1)))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict | None = None, notices: list | None = None) -> DataFrame:
    """Per input row: doc_id, n_words, spans (label, start, stop, first_word, edits, base)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        scan = Scanner(phrases, notices)

        def each(c):
            out = []
            for i, t in zip(c["doc_id"], c["text"], strict=True):
                n, spans = scan(t)
                out.append((i, n, [dict(zip(("label", "start", "stop", "first_word", "edits", "base"), s, strict=True))
                                   for s in spans]))
            return out
        return each

    return map_rows(src, make, f"doc_id long, n_words long, spans {SPANS}")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    size = F.create_map(*[x for label in sorted({n[1] for n in NOTICES}) for x in (
        F.lit(label), F.lit(max(len(n[0]) for n in NOTICES if n[1] == label)))])
    best = F.array_max(F.transform("spans", lambda s: F.when(s["base"], F.lit(1.0)).otherwise(
        1 - s["edits"] / F.greatest(F.try_element_at(size, s["label"]), s["stop"] - s["start"]))))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
                        F.coalesce(best, F.lit(0.0)).alias("score"))


QUERIES = {"op6_license_scan": op6_license_scan}
ORACLE: dict[str, str] = {}
