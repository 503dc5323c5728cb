"""Fill-in-the-middle transformation with a sparse exception index.

A text is cut at two unit boundaries into prefix, middle and suffix, which are
put back together in another order behind sentinels. Cuts are found on the
UTF-8 bytes; ``Offsets`` turns byte offsets into code-point offsets and back.
It records the multibyte characters alone (position and excess bytes), so an
ASCII stretch of any length costs nothing and is plain arithmetic:

    byte = code point + excess bytes of the multibyte characters before it

Units are tokens (``[A-Za-z]+|[^A-Za-z]``, over code points) or, with
``unit="char"``, code points. Cuts, form and order follow hash numbers of the
row's id and a seed, so any task gives the same result for a row.

Null text counts as empty; empty texts and texts that hold a sentinel stay
``plain``. A null id hashes like an empty one, rows that repeat an id are cut
by the same numbers, an empty table gives an empty result, and extra columns
are ignored. No sentinel can arise across a seam, as none begins with the
character another one ends with; so ``restore`` finds the parts again.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import map_rows, read_table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred texts so many are cut; of a hundred cut ones so many have the suffix first.
CUT_RATE, SPM_RATE = 90, 20


class Offsets:
    """Byte and code-point offsets of one text, by its multibyte characters alone."""

    def __init__(self, raw: np.ndarray):
        """``raw``: the text's UTF-8 bytes."""
        lead = np.flatnonzero(raw >= 0xC0)
        size = raw[lead]
        #: Bytes beyond the first of all multibyte characters up to and with this one.
        self.excess = np.cumsum(1 + (size >= 0xE0).astype(np.int64) + (size >= 0xF0))
        self.at_byte = lead
        self.at_char = lead.copy()
        self.at_char[1:] -= self.excess[:-1]
        self.n_chars = len(raw) - (int(self.excess[-1]) if len(lead) else 0)

    def _before(self, places: np.ndarray, offsets) -> np.ndarray:
        k = np.searchsorted(places, offsets, side="left")
        return np.where(k > 0, self.excess[np.maximum(k, 1) - 1], 0) if len(places) else np.zeros_like(k)

    def bytes_of(self, chars):
        """Byte offsets of code-point offsets."""
        return np.asarray(chars) + self._before(self.at_char, chars)

    def chars_of(self, at):
        """Code-point offsets of byte offsets that begin a character (or end the text)."""
        return np.asarray(at) - self._before(self.at_byte, at)


def token_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which the tokens ``[A-Za-z]+|[^A-Za-z]`` begin."""
    low = raw | 0x20
    letter = (low >= 0x61) & (low <= 0x7A) & (raw < 0x80)
    start = (raw & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(row_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 of a row."""
    h = sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str | None, row_id: int | None, seed: int = 1, unit: str = "token",
              cut_rate: int = CUT_RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, bytes, tuple | None]:
    """(units, form, output, spans); spans are the code-point and byte cuts (c1, c2, b1, b2), None if plain."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    offsets = Offsets(raw)
    starts = token_starts(raw) if unit == "token" else None
    n = len(starts) if unit == "token" else offsets.n_chars
    h1, h2, h3, h4 = draws(row_id, seed)
    if not data or PREFIX in data or SUFFIX in data or MIDDLE in data or h3 % 100 >= cut_rate:
        return n, "plain", data, None
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    if unit == "token":
        b1, b2 = (int(starts[c]) if c < n else len(data) for c in cuts)
        c1, c2 = (int(x) for x in offsets.chars_of(np.array([b1, b2])))
    else:
        c1, c2 = cuts
        b1, b2 = (int(x) for x in offsets.bytes_of(np.array(cuts)))
    before, middle, after = data[:b1], data[b1:b2], data[b2:]
    if h4 % 100 < spm_rate:
        return n, "spm", SUFFIX + after + PREFIX + before + MIDDLE + middle, (c1, c2, b1, b2)
    return n, "psm", PREFIX + before + SUFFIX + after + MIDDLE + middle, (c1, c2, b1, b2)


def restore(output: bytes, form: str) -> bytes:
    """The original text of an output and its form."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"no {form} output")
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == "psm" else two + middle + one


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   unit: str = "token", cut_rate: int = CUT_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Per row: doc_id, n, form, output (the transformed text) and the cuts prefix_chars, middle_chars,
    prefix_bytes, middle_bytes (null if plain)."""
    def make():
        def each(c):
            out = []
            for i, t in zip(c["doc_id"], c["text"], strict=True):
                n, form, output, at = transform(t, i, seed, unit, cut_rate, spm_rate)
                c1, c2, b1, b2 = at or (None,) * 4
                cuts = (c1, c2 - c1, b1, b2 - b1) if at else (None,) * 4
                out.append((i, n, form, output.decode(), *cuts))
            return out
        return each

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), make,
                    "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long, "
                    "prefix_bytes long, middle_bytes long", rows_per_output=200)


def restored(done: DataFrame, output_col: str = "output", form_col: str = "form", name: str = "restored") -> DataFrame:
    """``done`` with the original text rebuilt from ``output`` and ``form`` alone (DataFrame functions)."""
    out, form = F.col(output_col), F.col(form_col)
    first = F.when(form == "psm", F.lit(PREFIX.decode())).otherwise(F.lit(SUFFIX.decode()))
    second = F.when(form == "psm", F.lit(SUFFIX.decode())).otherwise(F.lit(PREFIX.decode()))
    at2 = F.locate(SUFFIX.decode(), out, 2), F.locate(PREFIX.decode(), out, 2)
    at = F.when(form == "psm", at2[0]).otherwise(at2[1])  # code points, from 1
    mid = F.expr(f"locate('{MIDDLE.decode()}', {output_col}, 2)")
    one = F.substring(out, F.length(first) + 1, at - F.length(first) - 1)
    two = F.substring(out, at + F.length(second), mid - at - F.length(second))
    middle = F.substring(out, mid + F.lit(len(MIDDLE)), F.length(out))
    return done.withColumn(name, F.when(form == "plain", out).when(form == "psm", F.concat(one, middle, two))
                           .otherwise(F.concat(two, middle, one)))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored(fill_in_middle(read_table(spark, sf_dir))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {"op12_fill_middle": op12_fill_middle}
ORACLE = {"op12_fill_middle": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tok
  FROM documents),
n AS (
  SELECT doc_id, text, tok, CAST(len(tok) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t),
c AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(list_slice(tok, 1, least(h1 % (n + 1), h2 % (n + 1))), '') AS p,
         array_to_string(list_slice(tok, least(h1 % (n + 1), h2 % (n + 1)) + 1, greatest(h1 % (n + 1), h2 % (n + 1))), '') AS m,
         array_to_string(list_slice(tok, greatest(h1 % (n + 1), h2 % (n + 1)) + 1, n), '') AS s
  FROM n)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""}
