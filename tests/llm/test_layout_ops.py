"""Sharding, license scan, encoding, mixing and fingerprints against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cardiolake.llm import fingerprint as P, licenses as C, mixing as X, pieces as E, sharding as H

from tests.llm.conftest import rows_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(seed=1, n=120):
    rng = random.Random(seed)
    out = [" ".join(rng.choice(["the", "Mit", "license", "ñandú", "a.", "x\ny", "wörter!", "日本"]) for _ in range(rng.randint(0, 80)))
           for _ in range(n)]
    return [*out, None, "", " \t ", out[0], out[0], "long " * 20_000]


def test_shards_are_even_and_gapless(make_docs):
    texts = texts_of()[:-1]
    docs = make_docs(texts, ids=[None if i == 5 else i // 2 for i in range(len(texts))])
    got = H.shard_rows(docs).collect()
    assert len(got) == len(texts)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    load = [sum(r["size"] for r in by[k]) for k in range(8)]
    assert max(load) - min(load) <= max(r["size"] for r in got)
    size = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == size
    assert H.shard_rows(docs.limit(0)).count() == 0


def test_map_versions(spark, tmp_path):
    rng = random.Random(2)
    load = {s: rng.randint(1, 1000) for s in range(H.SLOTS)}
    first = H.first_map()
    second = H.rebalanced(first, load, 8)
    path = str(tmp_path / "map")
    H.save_map(spark, first, 0, path)
    H.save_map(spark, second, 1, path)
    assert H.load_map(spark, path) == (1, second) and H.load_map(spark, path, 0) == (0, first)
    per = [sum(load[s] for s in range(H.SLOTS) if second[s] == k) for k in range(8)]
    assert max(per) - min(per) <= 2
    grown = H.rebalanced(second, load, 9)
    moved = [s for s in range(H.SLOTS) if grown[s] != second[s]]
    assert sum(load[s] for s in moved) < 0.2 * sum(load.values())
    with pytest.raises(Exception):
        H.save_map(spark, first, 1, path)


def test_runs_store_their_maps_and_go_on_from_the_newest(make_docs, tmp_path):
    path = str(tmp_path / "maps")
    docs, more = make_docs(texts_of(3)), make_docs(texts_of(3) + texts_of(4))
    places = lambda rows: {r["virtual_slot"]: r["shard"] for r in rows}
    spark = docs.sparkSession
    assert H.newest_map(spark, path) is None
    first = H.shard_rows(docs, maps=path).collect()
    assert {r["map_version"] for r in first} == {1} and H.load_map(spark, path)[0] == 1
    assert H.shard_rows(docs, maps=path).collect() and H.load_map(spark, path)[0] == 1  # no move, no version
    grown = H.shard_rows(more, shards=9, maps=path).collect()
    version, placing = H.load_map(spark, path)
    assert version == 2 and {r["map_version"] for r in grown} == {2}
    assert all(placing[s] == k for s, k in places(grown).items()) and 8 in places(grown).values()
    assert all(H.load_map(spark, path, 1)[1][s] == k for s, k in places(first).items())
    assert {r["map_version"] for r in H.shard_rows(more, placing=H.first_map(), version=4).collect()} == {5}


def test_the_query_stores_its_map(make_docs, spark, tmp_path):
    make_docs(texts_of(6)).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [H.op4_sharding(spark, str(tmp_path)).select("doc_id", "shard", "slot", "map_version").collect() for _ in range(2)]
    assert sorted(rows[0], key=repr) == sorted(rows[1], key=repr) and {r["map_version"] for r in rows[0]} == {1}


def brute_license(text):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = word.findall((text or "").translate({65 + i: 97 + i for i in range(26)}))
    found = [(i, label) for p, label in C.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base_and_fuzzy(spark, make_docs, tmp_path):
    texts = texts_of() + ["MIT\nLicense mit license", "general public  license", "the Apache-License!",
                          "Released under the M1T licence. All", "gnu genral public license", "mit licens", "mit x license",
                          "Ünder mit license"]
    make_docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in C.op6_license_scan(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_license(t), t
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    fuzzy = {t: got[i]["labels"] for i, t in enumerate(texts)}
    assert fuzzy["Released under the M1T licence. All"] == "mit" and fuzzy["gnu genral public license"] == "gpl"
    assert fuzzy["mit x license"] == ""


def test_pigeonhole_misses_no_bounded_match():
    import regex

    rng = random.Random(3)
    scan = C.Scanner({}, [("released under the mit license", "mit", 3)])
    target = "released under the mit license"
    for _ in range(300):
        s = list(target)
        for _ in range(rng.randint(0, 5)):
            k, i = rng.randrange(3), rng.randrange(len(s))
            if k == 0:
                s[i] = rng.choice("abcxyz")
            elif k == 1:
                del s[i]
            else:
                s.insert(i, rng.choice("abcxyz"))
        text = f"some words {''.join(s)} and more"
        line = " ".join(w.decode() for w in C.WORD.findall(text.encode()))
        want = regex.search(f"(?b)(?:{regex.escape(target)}){{e<=3}}", line) is not None
        assert bool(scan(text)[1]) == want, text
        for label, a, b, *_ in scan(text)[1]:
            assert label == "mit" and 0 <= a < b <= len(text)


def test_license_spans_of_neighbours_are_all_found():
    """Worse matches before, between and behind better ones; windows that start before the ones seen earlier."""
    scan = C.Scanner({}, [("the mit license", "mit", 1)])
    text = "the mjt license the mit license the mit licens the mit license tha mit license"
    assert [text[s[1]:s[2]] for s in scan(text)[1]] == ["the mjt license", "the mit license", "the mit licens",
                                                        "the mit license", "tha mit license"]
    target = "released under the mit license"
    scan, rng = C.Scanner({}, [(target, "mit", 3)]), random.Random(5)
    for _ in range(100):
        parts = []
        for _ in range(4):
            w = list(target)
            for i in rng.sample([i for i, c in enumerate(w) if c != " "][1:-1], rng.randint(0, 3)):
                w[i] = "z"
            parts.append("".join(w))
        assert len(scan(" xx ".join(parts))[1]) == 4, parts


def test_license_spans_point_into_the_text():
    n, spans = C.Scanner()("Ünïcode: the MIT License.")
    assert n == 4 and ("mit", 13, 24, 2, 0, True) in spans


def test_encoding_equals_the_library(make_docs):
    texts = texts_of(4, 60) + ["  Hello  world\n\n x▁y \x00 é", "日本語 text 😀 ends  ", "▁", "  ", " <s> </s> <unk>", "a▁▁b", "\n",
                               "".join(map(chr, range(32, 600)))]
    sp = sentencepiece.SentencePieceProcessor(model_file=E.default_model())
    got = {r["doc_id"]: r for r in E.encode(make_docs(texts), keep=(
        "n_tokens", "ids", "decoded", "starts", "stops", "ids_sha256", "decoded_sha256")).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        r = got[i]
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == sp.decode(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        data = (t or "").encode()
        assert len(r["starts"]) == len(ids) - 2 and r["starts"][1:] == r["stops"][:-1]
        assert b"".join(data[a:b] for a, b in zip(r["starts"], r["stops"], strict=True)) == data
    assert E.encode(make_docs([])).count() == 0


def trie(entries):
    """A compiled character map for the test: each node's children lie in a block of 256 units of its own."""
    nodes, ends = {"": 0}, {}
    for key, offset in entries:
        raw = key.encode("latin-1")
        for k in range(1, len(raw) + 1):
            nodes.setdefault(raw[:k].decode("latin-1"), len(nodes))
        ends[key] = offset
    block = {name: (k + 1) << 8 for name, k in nodes.items()}
    units = [0] * ((len(nodes) + 2) << 8)
    place = {"": 0}
    for name in sorted(nodes, key=len):
        if name:
            place[name] = block[name[:-1]] ^ ord(name[-1])
        at = place[name]
        jump = at ^ block[name]
        low = (jump >> 8 << 10 | 512) if jump & 0xFF == 0 else jump << 10
        units[at] = low | (256 if name in ends else 0) | (ord(name[-1]) if name else 0)
        if name in ends:
            units[block[name]] = 0x80000000 | ends[name]
    return units


def test_character_map_takes_the_longest_prefix_and_keeps_origins():
    import struct

    texts = b"fi\0x\0long\0"
    lig = "ﬁ".encode().decode("latin-1")
    units = trie([(lig, 0), ("ab", 3), ("abc", 5)])
    blob = struct.pack(f"<I{len(units)}I", 4 * len(units), *units) + texts
    m = E.CharMap(blob)
    assert m.longest(b"abcd", 0) == (3, 5) and m.text(5) == b"long"
    assert m.longest(b"abd", 0) == (2, 3) and m.longest(b"axx", 0) is None
    model = E.Model(open(E.default_model(), "rb").read())
    model.map = m
    norm, origin = model.normalise("ﬁn abcd")
    assert norm == "▁fin▁longd"
    assert origin.tolist() == [0, 0, 0, 0, 0, 3, 4, 4, 4, 5, 5, 5, 5, 8, 9]


def test_mixing_meets_targets(make_docs):
    rng = random.Random(5)
    texts = [" ".join("w%d" % rng.randrange(99) for _ in range(rng.randint(0, 400))) for _ in range(300)] + [None, "", " a "]
    names = ["b", "a", None, "Z", "é", "tiny"]
    sources = [names[min(5, int(rng.random() ** 2 * 6))] for _ in texts]
    ids = [None if i == 7 else i for i in range(len(texts))]
    docs = make_docs(texts, ids, sources=sources)
    got = X.mix_counts(docs).collect()
    size = [len(WORDS.findall(t or "")) for t in texts]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted(
        (ids[i] is None, ids[i] or 0, size[i]) for i in range(len(texts)))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    total = {}
    for s, n in zip(sources, size, strict=True):
        total[s] = total.get(s, 0) + n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    aim = dict(zip(order, X.targets([(s, total[s]) for s in order]), strict=True))
    assert abs(sum(aim.values()) - 1.5 * sum(size)) < 1e-6 and all(aim[s] <= 2 * total[s] + 1e-9 for s in aim)
    for s in order:
        mine = [r for r in got if r["source"] == s]
        assert {(r["source_size"], r["target"]) for r in mine} == {(total[s], aim[s])}
        assert abs(sum(r["taken"] for r in mine) - aim[s]) <= X.BLOCK
    again = X.mix_counts(docs)
    assert rows_of(again, "doc_id", "taken") == sorted(((r["doc_id"], r["taken"]) for r in got), key=repr)


def test_mixed_documents_hold_the_words_taken(make_docs):
    rng = random.Random(6)
    texts = [" ".join("w%d" % rng.randrange(99) for _ in range(rng.randint(1, 300))) for _ in range(80)] + [None]
    docs = make_docs(texts, sources=[rng.choice("ab") for _ in texts])
    taken = dict(rows_of(X.mix_counts(docs), "doc_id", "taken"))
    out = X.mix_documents(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        assert r["n_chars"] == len(r["text"])
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {i: n for i, n in taken.items() if n}
    assert X.mix_documents(docs.limit(0)).count() == 0 and X.mix_counts(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 1025])
def test_permutations(n):
    a, b = (X.permuted(np.arange(n), n, k) for k in (1, 2))
    assert sorted(a.tolist()) == sorted(b.tolist()) == list(range(n))
    assert n < 64 or a.tolist() != b.tolist()


def test_fingerprints_and_edited_texts(make_docs, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_RANGE", 16)
    texts = [t.replace("a.", "a. \n") if t else t for t in texts_of(7)]
    ids = [None if i == 3 else 1000 - 3 * i for i in range(len(texts))]
    got = {r["doc_id"]: r for r in P.edited_with_next(make_docs(texts, ids)).collect()}
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, -(ids[i] or 0)))
    prints = {}
    for at, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        k = len(t) // 3
        r = got[ids[i]]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    lone = P.edited_with_next(make_docs(["one. two. three"])).first()
    assert lone["near_next"] == 1.0
    assert P.edited_with_next(make_docs([])).count() == 0
    twice = P.edited_with_next(make_docs(["a", "b", "a"], [1, 1, 1])).collect()
    assert len(twice) == 3


def test_fingerprint_is_homomorphic(spark):
    a, b = "one. two.\nthree", "four\ntwo."
    df = spark.createDataFrame([(a, b, f"{b}\n{a}", "three\none. two.")], "a string, b string, both string, turned string").select(
        *[P.fingerprint(F.col(c)).alias(c) for c in ("a", "b", "both", "turned")])
    r = df.select(P.combined("a", "b").alias("sum"), "both", P.removed("both", "b").alias("less"), "a", "turned",
                  P.likeness(F.col("a"), F.col("turned")).alias("one"), P.as_hex(F.col("a")).alias("hex")).first()
    assert r["sum"] == r["both"] and r["less"] == r["a"] == r["turned"] and r["one"] == 1.0
    assert len(r["hex"]) == P.LANES * P.BITS // 4


def test_likeness_estimates_the_shared_part_at_any_length(spark):
    rows = []
    for n in (60, 300, 1500, 4000):
        p = [f"{n} sentence {i}." for i in range(n)]
        for keep in (0.0, 1 / 3, 2 / 3, 0.9):
            k = round(keep * n)
            rows.append((n, k / n, " ".join(p), " ".join(p[:k] + [f"{n} other {i}." for i in range(n - k)])))
    got = spark.createDataFrame(rows, "n int, kept double, a string, b string").select(
        "n", "kept", P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b"))).alias("near")).collect()
    for r in got:  # three standard errors
        assert abs(r["near"] - r["kept"]) <= 3 * (1 - r["kept"] ** 2) / P.LANES ** 0.5, r
    assert min(r["near"] for r in got if r["kept"] > 0.6) > max(r["near"] for r in got if r["kept"] == 0)


def test_every_paragraph_fills_all_lanes(spark):
    one = spark.range(1).select(P.fingerprint(F.lit("one paragraph")).alias("p"), P.fingerprint(F.lit("")).alias("z"),
                                P.signs(P.fingerprint(F.lit("one paragraph"))).alias("s")).first()
    assert all(one["p"]) and not any(one["z"]) and {abs(x) for x in one["s"]} == {1.0}
