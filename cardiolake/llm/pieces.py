"""SentencePiece encoding and decoding with byte spans of the original text.

The normaliser is run here: at each place the longest prefix found in the
model's compiled character map (a double-array trie) is replaced, else one
character is copied; white space is escaped and the dummy prefix put in front
as the model says. Every normalised byte remembers the original byte it came
from, so a piece is projected to the span of the original text that made it.

The library, with its own normaliser switched off, segments the whole normalised
text; results equal ``SentencePieceProcessor.encode`` and ``decode`` (tests
compare them).

Null counts as empty text, which has the begin and end ids alone.
"""

from __future__ import annotations

import struct
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.llm.common import map_rows, read_table

MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = 4 if kind == 5 else 8
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class CharMap:
    """The compiled map: a little-endian size, trie units of 32 bits, then the replacement texts."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size:] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """(length, offset of the replacement) of the longest key that starts at ``at``."""
        units = self.units
        if not units:
            return None
        node, best = 0, None
        unit = units[node]
        node ^= _offset(unit)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1 and node < len(units):
                best = i - at + 1, units[node] & 0x7FFFFFFF
        return best

    def text(self, offset: int) -> bytes:
        return self.texts[offset:self.texts.index(b"\0", offset)]


def _offset(unit: int) -> int:
    """Where a node's children start, relative to it (format of the double array)."""
    return (unit >> 10) << ((unit & 512) >> 6)


class Model:
    """A model file: its normaliser settings, and the library with its own normaliser switched off."""

    def __init__(self, blob: bytes):
        import sentencepiece

        spec = {}
        for number, value in _fields(blob):
            if number == 3:
                spec = dict(_fields(value))
        self.map = CharMap(spec.get(2, b""))
        self.dummy_prefix = bool(spec.get(3, 1))
        self.strip = bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))
        # a message put behind another overrides its fields: no map, no prefix, no stripping
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob + b"\x1a\x06\x12\x00\x18\x00\x20\x00")
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """(normalised text, origin): origin[i] is the original byte of normalised byte i, with the
        length of the original at the end; None stands for the identity behind the dummy prefix."""
        if not self.map.units and not self.strip:
            if not text:
                return "", None
            out = text.replace(" ", MARK) if self.escape else text
            return ((MARK if self.escape else " ") if self.dummy_prefix else "") + out, None
        data = text.encode()
        out, origin, at = [], [], 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found:
                size, put = found[0], self.map.text(found[1])
            else:
                size = 1
                while at + size < len(data) and data[at + size] & 0xC0 == 0x80:
                    size += 1
                put = data[at:at + size]
            for k, byte in enumerate(put):
                out.append(byte)
                origin.append(at if found else at + k)
            at += size
        if self.strip:  # leading, trailing and repeated spaces
            keep = [i for i, b in enumerate(out) if b != 32 or (i and out[i - 1] != 32)]
            while keep and out[keep[-1]] == 32:
                keep.pop()
            out, origin = [out[i] for i in keep], [origin[i] for i in keep]
        if self.dummy_prefix and out:
            out, origin = [32, *out], [origin[0], *origin]
        if self.escape:
            origin = [o for b, o in zip(out, origin, strict=True) for _ in range(3 if b == 32 else 1)]
        norm = bytes(out).decode()
        return norm.replace(" ", MARK) if self.escape else norm, np.array([*origin, len(data)], dtype=np.int64)


class Encoder:
    """Text -> (ids as little-endian 32-bit integers, ends of the pieces in normalised bytes, decoded text)."""

    def __init__(self, blob: bytes):
        self.model = Model(blob)
        self.width = np.zeros(self.model.library.get_piece_size(), np.int64)  # of pieces met so far, -1 for unknown

    def _widths(self, norm: str, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes under each id."""
        lib = self.model.library
        for i in np.unique(ids[self.width[ids] == 0]).tolist():
            self.width[i] = 1 if lib.is_byte(i) else -1 if lib.is_unknown(i) else len(lib.id_to_piece(i).encode())
        out = self.width[ids]
        if (out < 0).any():  # a run of characters without piece: as long as the library says
            out = np.array([len(x.surface.encode()) for x in lib.encode(norm, out_type="immutable_proto").pieces], np.int64)
        return out

    def __call__(self, text: str | None) -> tuple[bytes, np.ndarray, np.ndarray | None, str]:
        """(ids with begin and end, piece ends in normalised bytes, origin, decoded text)."""
        m = self.model
        norm, origin = m.normalise(text or "")
        found = m.library.encode(norm)
        ids = np.array([m.begin, *found, m.end], "<u4")
        ends = np.cumsum(self._widths(norm, ids[1:-1]), dtype=np.int64)
        decoded = m.library.decode(found)
        if m.dummy_prefix and decoded.startswith(" "):
            decoded = decoded[1:]
        return ids.tobytes(), ends, origin, decoded

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(id, first, last): each piece with its span [first, last) of the original UTF-8 bytes."""
        ids, ends, origin, _ = self(text)
        first, last = self.project(text, ends, origin)
        return list(zip(np.frombuffer(ids, "<u4")[1:-1].tolist(), first.tolist(), last.tolist(), strict=True))

    def project(self, text: str | None, ends: np.ndarray, origin: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        m, data = self.model, (text or "").encode()
        if not len(ends):
            return ends, ends
        if origin is None:  # identity: only escaped spaces (3 bytes for 1) and the prefix move offsets
            if m.escape:
                raw = np.frombuffer(data, np.uint8)
                width = np.where(raw == 32, 3, 1)
                grown = np.concatenate([[0], np.cumsum(width)]) + (3 if m.dummy_prefix else 0)
            else:
                grown = np.arange(len(data) + 1) + (1 if m.dummy_prefix else 0)
            last = np.maximum(np.searchsorted(grown, ends, side="right") - 1, 0)
        else:
            last = origin[np.minimum(ends, len(origin) - 1)]
        return np.concatenate([[0], last[:-1]]), last


def encode(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")) -> DataFrame:
    """Per input row: doc_id and the columns named in ``keep``.

    n_tokens; ids (binary, little-endian unsigned 32-bit, begin and end included); starts, stops
    (int arrays: byte spans of the pieces between begin and end); decoded; and the digests
    ids_sha256, decoded_sha256, spans_sha256 (stops as little-endian 32-bit integers).
    The model file (0.5 MB) travels with the task.
    """
    with open(model_path or default_model(), "rb") as f:
        blob = f.read()
    kinds = {"n_tokens": "long", "ids": "binary", "starts": "array<int>", "stops": "array<int>", "decoded": "string",
             "ids_sha256": "string", "decoded_sha256": "string", "spans_sha256": "string"}
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spans = bool({"starts", "stops", "spans_sha256"} & set(keep))

    def make():
        run = Encoder(blob)

        def each(c):
            out = []
            for i, t in zip(c["doc_id"], c["text"], strict=True):
                ids, ends, origin, decoded = run(t)
                first, last = run.project(t, ends, origin) if spans else (None, None)
                value = {"n_tokens": lambda: len(ids) // 4, "ids": lambda: ids, "starts": lambda: first.tolist(),  # noqa: B023
                         "stops": lambda: last.tolist(), "decoded": lambda: decoded,  # noqa: B023
                         "ids_sha256": lambda: sha256(ids).hexdigest(),  # noqa: B023
                         "decoded_sha256": lambda: sha256(decoded.encode()).hexdigest(),  # noqa: B023
                         "spans_sha256": lambda: sha256(last.astype("<u4").tobytes()).hexdigest()}  # noqa: B023
                out.append((i, *[value[k]() for k in keep]))
            return out
        return each

    return map_rows(src, make, "doc_id long, " + ", ".join(f"{k} {kinds[k]}" for k in keep), rows_per_output=500)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir))


QUERIES = {"op7_sentencepiece": op7_sentencepiece}
ORACLE: dict[str, str] = {}
