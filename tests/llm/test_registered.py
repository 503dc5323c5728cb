"""Registered queries and the pipeline on small tables, against brute force or their own laws."""

import itertools
import math
import os
import random
import re
import string
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardiolake.llm import (fingerprint as P, language_id as L, licenses as C, lm_scoring as S, minhash_dedup as M, mixing as X,
                            registry, sharding as H, toxicity as T)
from cardiolake.llm.common import components

from tests.llm.conftest import rows_of
from tests.llm.test_dedup import brute_components, corpus


def sf_of(tmp_path, docs, labels=None):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    if labels is not None:
        labels.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def crc(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


# ------------------------------------------------------------------------- components


def test_components_of_random_graphs_in_many_tasks(spark, monkeypatch):
    from cardiolake.llm import common

    monkeypatch.setattr(common, "EDGES", 40)  # several tasks, whose stars overlap
    rng = random.Random(2)
    for n, m in ((60, 40), (400, 330)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n, n + 150)]
        root = {}

        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in edges:
            if a != b:
                a, b = sorted((top(a), top(b)))
                root[b] = a
        got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long").repartition(8)), "node", "root"))
        assert got == {x: top(x) for x in root}


# ------------------------------------------------------------------- 1: near duplicates


def test_op1_query_equals_brute_force(spark, make_docs, tmp_path):
    texts = corpus(5)
    rng = random.Random(7)
    ids = rng.sample(range(10_000), len(texts) - 3) + [None, 7, 7]
    got = M.op1_minhash_dedup(spark, sf_of(tmp_path, make_docs(texts, ids=ids)))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    null = 10**9  # a null id is the last
    want = brute_components(texts, [null if i is None else i for i in ids], 4)
    named = sorted([tuple(None if x == null else x for x in r) for r in want], key=repr)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == named
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is r.component_id is None) for r in got.collect())


# ----------------------------------------------------------------------- 2: languages


def test_paths_of_many_texts_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(1)
    for together in (1 << 24, 50):
        monkeypatch.setattr(L, "CELLS", together)
        monkeypatch.setattr(L, "STRETCH", 7)  # texts of up to seven stretches
        count = rng.integers(0, 45, 60)
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        score = rng.normal(0, 5, (int(count.sum()), 4))
        got = L.paths(score, first, count, 6.0)
        for a, n in zip(first, count, strict=True):
            if n:
                part, one = score[a:a + n], L.viterbi(score[a:a + n], 6.0)

                def worth(path):
                    return part[np.arange(n), path].sum() - 6.0 * int((path[1:] != path[:-1]).sum())

                assert math.isclose(worth(got[a:a + n]), worth(one))


def test_op2_query_columns_ties_and_repeats(spark, make_docs, tmp_path):
    en, de = "the house and the garden are small", "das haus und der garten sind klein"
    texts, langs = [en, de] * 20, ["en", "de"] * 20
    texts += [None, "", "123 !?", en, en, "x" * 200_000 + " " + de]
    langs += [None, "en", None, None, None, None]
    ids = [*range(len(texts) - 4), 500, 501, 501, 502]
    got = L.op2_language_id(spark, sf_of(tmp_path, make_docs(texts, ids=ids, langs=langs)))
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(texts) and all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by[40] == by[41] == by[500][:0] + [("und", 0.0)] and by[500] == [("und", 0.0)]
    assert by[501][0] == by[501][1] and by[501][0][0] == "en"
    assert all(0 <= s <= 1 for v in by.values() for _, s in v)
    same = make_docs(["aa bb"] * 4, langs=["x", "y", "x", "y"])  # a perfect tie: the smaller name
    model = L.fit(same)
    assert {r.lang_pred for r in L.identify(same, model).collect()} == {"x"}
    assert L.identify(make_docs([]), model).count() == 0


def test_labels_do_not_depend_on_what_stands_beside_a_text(make_docs, monkeypatch):
    docs = make_docs(["the house is small", "das haus ist klein", "ΑΣ σας και", "Straße İstanbul"] * 5, langs=["en", "de", "el", "tr"] * 5)
    reader = L.fit(docs).reader()
    texts = ["the haus", "", None, "ΟΔΟΣ", "İ", "das house ist\0small", "klein " * 50] * 3
    together = reader.labels(texts)
    monkeypatch.setattr(L, "LETTERS", 1)
    assert together == reader.labels(texts) == [reader.label(t) for t in texts]


# ----------------------------------------------------------------------- 3: toxicity


def test_decoder_takes_the_cheapest_path():
    rng = np.random.default_rng(5)
    tri, bi = rng.integers(0, 60, T.BUCKETS).astype(float), rng.integers(30, 200, T.BUCKETS).astype(float)
    decode = T.Decoder(tri, bi)

    def cost(path):
        total, a, b = 0.0, "", ""
        for option in path:
            if option == " ":
                total += 0.5 + (decode._cost(a, b, "") if b else 0.0)
                a = b = ""
                continue
            for ch in option:
                total += decode._cost(a, b, ch)
                a, b = b, ch
            if not option:
                total += 0.5
        return total + (decode._cost(a, b, "") if b else 0.0)

    for _ in range(150):
        token = "".join(rng.choice(list("ab1$3-*oo!lll"), size=rng.integers(1, 7)))
        options = decode.lattice(token)
        best = min(cost(p) for p in itertools.product(*options))
        found = decode(token)
        mine = min(cost(p) for p in itertools.product(*options) if "".join(p) == found)
        assert math.isclose(best, mine), token


def test_digits_alone_are_decoded_and_numbers_stay_numbers(spark, make_docs):
    rng = random.Random(4)
    plain = ["garden", "window", "river", "bridge", "market", "winter"]
    toxic = [f"{rng.choice(plain)} ab{chr(97 + i % 26)}{chr(97 + i // 26)} sleaze {i} {rng.choice(plain)}" for i in range(80)]
    clean = [f"{rng.choice(plain)} {rng.choice(plain)} about 553 and {i}" for i in range(400)]
    texts = toxic + clean
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(len(texts))], "doc_id long, toxic int")
    model = T.fit(make_docs(texts), labels)
    assert "sleaze" in model.lexicon
    assert T.spellings({"sleaze": 4.0, "bogs": 3.0, "x": 1.0}) == {
        "513423": "sleaze", **{f"{b}0{g}5": "bogs" for b in "68" for g in "69"}}
    assert model.numbers["513423"] < model.lexicon["sleaze"]
    score = model.scorer()
    assert score("a garden 513423 here") > score("a garden 713429 here")
    often = T.number_weights(make_docs([f"number 513423 of {i}" for i in range(300)]), model.lexicon)
    assert often["513423"] < 0 < model.lexicon["sleaze"]  # clean texts hold the number
    assert score("about 553 and 12") < T.THRESHOLD


def test_op3_query_labels_repeats_and_empty_texts(spark, make_docs, tmp_path):
    rng = random.Random(9)
    plain = ["garden", "window", "river", "bridge", "market", "winter"]
    texts = [" ".join(rng.choice(plain) for _ in range(6)) + f" x{chr(97 + i % 26)}{chr(97 + i // 26)}"
             + (" blarghead" if i % 4 == 0 else "") for i in range(240)]
    texts += ["", None, texts[0], "bl4rgh3ad garden"]
    ids = [*range(242), 0, 900]
    rows = [(i, int(i % 4 == 0)) for i in range(240)] + [(5, 1), (4, 0), (7, None), (8, 3), (None, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    got = T.op3_toxicity(spark, sf_of(tmp_path, make_docs(texts, ids=ids), labels)).collect()
    assert len(got) == len(texts)
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == 1 for i in range(0, 240, 4)) and by[900].predicted == 1
    assert sum(by[i].predicted for i in range(240) if i % 4) == 0
    assert by[240].score == by[241].score and len({r.score for r in got if r.doc_id == 0}) == 1


# ----------------------------------------------------------------------- 4: sharding


def test_op4_query_sizes_law_and_lost_write(spark, make_docs, tmp_path):
    rng = random.Random(1)
    texts = [None, "", "é漢"] + ["w" * rng.randint(0, 400) for _ in range(900)]
    ids = [None, *range(1, len(texts) - 1), 5]
    path = sf_of(tmp_path, make_docs(texts, ids=ids))
    got = H.op4_sharding(spark, path).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    held = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert max(held) - min(held) <= 0.05 * sum(held) / 8
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    # a write that was lost leaves a folder without data
    maps = str(tmp_path / "maps")
    os.makedirs(f"{maps}/version=1/_temporary")
    os.makedirs(f"{maps}/version=oops")
    assert H.newest_map(spark, maps) is None
    docs = spark.read.parquet(f"{path}/documents.parquet")
    one = H.shard_rows(docs, maps=maps).collect()
    assert {(r.from_version, r.map_version) for r in one} == {(0, 2)} and H.versions(spark, maps) == ([2], 2)
    os.makedirs(f"{maps}/version=3")
    grown = H.shard_rows(docs, shards=9, maps=maps)
    assert {(r.from_version, r.map_version) for r in grown.collect()} == {(2, 4)}
    again = H.shard_rows(docs, shards=9, maps=maps).collect()
    assert {r.map_version for r in again} == {4}
    # equal input from an equal map gives equal rows
    keys = ("doc_id", "size", "shard", "slot")
    assert sorted((tuple(r[k] for k in keys) for r in again), key=repr) == rows_of(grown, *keys)
    placing = H.load_map(spark, maps, 2)[1]
    alike = [rows_of(H.shard_rows(docs, shards=9, placing=placing, version=2), *keys) for _ in range(2)]
    assert alike[0] == alike[1] == rows_of(grown, *keys)


def test_a_taken_number_is_passed_over(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "maps")
    seen = iter([([], 0), ([1], 1)])
    H.save_map(spark, H.first_map(), 1, path)  # another writer was faster
    monkeypatch.setattr(H, "versions", lambda *_: next(seen))
    assert H.store_map(spark, H.first_map(), path) == 2


# ----------------------------------------------------------------------- 6: licenses


def test_repeated_notices_take_time_in_proportion():
    scan = C.Scanner()
    for text in ("the mjt license ", "gnu genral public license ", "permission to any person free of charge "):
        scan(text)
        began = time.process_time()
        n, spans = scan(text * 10_000)
        assert time.process_time() - began < 4.0, text
        if "person" not in text:
            assert len({s[1] for s in spans if s[0] == ("mit" if "mjt" in text else "gpl")}) == 10_000


def test_notices_from_a_table(spark, make_docs):
    table = spark.createDataFrame([("The Beer-Ware License!", "beer", 2), ("wtfpl", "wtfpl", None), (None, "x", 1), ("  ", "y", 1)],
                                  "text string, label string, edits int")
    notices = C.notices_of(table)
    assert notices == [("the beer ware license", "beer", 2), ("wtfpl", "wtfpl", 0)]
    got = C.scan_licenses(make_docs(["under the beer waare licence", "WTFPL", "mit license"]), notices=notices).collect()
    labels = {r.doc_id: {s.label for s in r.spans} for r in got}
    assert labels == {0: {"beer"}, 1: {"wtfpl"}, 2: {"mit"}}
    assert C.scan_licenses(make_docs([])).count() == 0


# ------------------------------------------------------------------------- 8: mixing


def independent_targets(sizes):
    """Targets by water filling: raise the level of all open sources until their share is used."""
    total, w = 1.5 * sum(sizes), [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    lo, hi = 0.0, 2.0 * total + 1
    for _ in range(300):
        mid = (lo + hi) / 2
        if sum(min(mid * x, 2 * n) for x, n in zip(w, sizes, strict=True)) < total:
            lo = mid
        else:
            hi = mid
    return [min(lo * x, 2.0 * n) for x, n in zip(w, sizes, strict=True)]


def test_op8_query_meets_independent_targets(spark, make_docs, tmp_path):
    rng = random.Random(3)
    names = ["b", "A", None, "ä", "c"]
    share = [0.5, 0.02, 0.2, 0.18, 0.1]
    sources = rng.choices(range(5), share, k=700)
    texts = [" ".join(["w"] * rng.randint(0, 300)) for _ in sources] + [None]
    sources = [*[names[i] for i in sources], "b"]
    path = sf_of(tmp_path, make_docs(texts, sources=sources))
    got, again = (X.op8_mixing(spark, path).collect() for _ in range(2))
    keys = ("doc_id", "size", "source_size", "target", "taken")
    assert sorted(tuple(r[k] for k in keys) for r in got) == sorted(tuple(r[k] for k in keys) for r in again)
    size = {i: len((t or "").split()) for i, t in enumerate(texts)}
    order = sorted(names, key=lambda s: (s is None, s or ""))
    held = [sum(size[i] for i, s in enumerate(sources) if s == name) for name in order]
    aim = dict(zip(order, independent_targets(held), strict=True))
    taken = dict.fromkeys(names, 0)
    for r in got:
        s = sources[r.doc_id]
        assert r.size == size[r.doc_id] and r.taken <= 2 * r.size
        assert r.source_size == held[order.index(s)] and math.isclose(r.target, aim[s], rel_tol=1e-9)
        taken[s] += r.taken
    assert all(abs(taken[s] - aim[s]) <= X.BLOCK for s in names)


def test_halves_draw_the_same_from_any_range():
    whole = list(X.halves([1, 2], 0, 5000, 0, 300_000, 1))
    parts = [r for lo, hi, first, n in X.halves([1, 2], 0, 5000, 0, 300_000, 70) for r in X.halves([1, 2], lo, hi, first, n, 1)]
    assert sorted(whole) == sorted(parts)
    assert sum(n for *_, n in whole) == 300_000
    at = 0
    for lo, hi, first, n in sorted(whole):
        assert hi == lo + 1 and first == at
        at += n
    counts = np.zeros(5000)
    for lo, _, _, n in whole:
        counts[lo] = n
    # multinomial: mean 60, variance near 60
    assert 50 < counts.var() < 70 and abs(counts[:2500].sum() - 150_000) < 5 * 274


# -------------------------------------------------------------------- 9: fingerprints


M64 = (1 << 64) - 1


def _rotl(x, r):
    return ((x << r) | (x >> (64 - r))) & M64


def test_fingerprint_equals_an_independent_sum(spark):
    """Hashes of paragraphs and of (hash, lane) by the xxhash library, summed by hand."""
    import xxhash

    text = "First one. Second one!\nThird one? Second one!\n\n  \nFirst one."
    units = [u.strip(" ") for u in re.split(P.PARAGRAPH, text) if u.strip(" ")]
    total = [0] * P.LANES
    for u in units:
        h = xxhash.xxh64_intdigest(u.encode(), seed=42)
        for lane in range(P.LANES):
            # a long under seed 42, then the int lane under that hash as seed, as Spark chains its columns
            x = _hash_int(lane, _hash_long(h, 42))
            wide = x & (((1 << P.BITS) - 1) >> P.SIGN_BITS << P.SIGN_BITS)
            total[lane] = (total[lane] + wide + 1 - 2 * (x & 1)) & P.MASK
    got = spark.createDataFrame([(text,)], "t string").select(P.fingerprint(F.col("t")).alias("p")).first()["p"]
    assert got == total


P1, P2, P3, P4, P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _avalanche(h):
    h = (h ^ (h >> 33)) * P2 & M64
    h = (h ^ (h >> 29)) * P3 & M64
    return h ^ (h >> 32)


def _hash_long(x, seed):
    h = (seed + P5 + 8) & M64
    h ^= _rotl(x * P2 & M64, 31) * P1 & M64
    return _avalanche((_rotl(h, 27) * P1 + P4) & M64)


def _hash_int(x, seed):
    h = (seed + P5 + 4) & M64
    h ^= x * P1 & M64
    return _avalanche((_rotl(h, 23) * P2 + P3) & M64)


@pytest.mark.parametrize("rows, limits", [(16, 2048), (4, 8), (2, 3)])
def test_next_documents_over_two_levels_of_ranges(make_docs, monkeypatch, rows, limits):
    monkeypatch.setattr(P, "ROWS_PER_RANGE", rows)
    monkeypatch.setattr(P, "LIMITS", limits)
    rng = random.Random(rows)
    n = 150
    ids = [None if rng.random() < 0.05 else rng.randrange(-500, 500) for _ in range(n)]
    texts = [None if i % 40 == 3 else "".join(rng.choice(string.ascii_letters) for _ in range(rng.randint(0, 30))) + f" {i}" for i in range(n)]
    docs = make_docs(texts, ids=ids).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = P.with_next(docs.withColumn("_tie", F.xxhash64("text")), ["doc_id", "text"], "doc_id").collect()
    tie = {r.text: r._tie for r in got}
    order = sorted(range(n), key=lambda i: (ids[i] is None, -(ids[i] or 0), tie[texts[i] or ""]))
    want = sorted((repr(ids[i]), texts[i] or "", texts[j] or "") for i, j in zip(order, order[1:] + order[:1], strict=True))
    assert sorted((repr(r.doc_id), r.text, r.next.text) for r in got) == want


# ------------------------------------------------------------------------ 10: scoring


def test_scores_of_all_texts_sum_to_one_at_most(spark, make_docs):
    words = ["a", "b", "ab", "ba"]
    rng = random.Random(1)
    train = make_docs([" ".join(rng.choice(words) for _ in range(rng.randint(0, 2))) for _ in range(200)])
    texts = [" ".join(p) for k in range(4) for p in itertools.product(["a", "b", "aa", "ab", "ba", "bb"], repeat=k)]
    got = S.score_documents(make_docs(texts), train).collect()
    share = [0.0] * 4
    for r in got:
        share[r.n_tokens - 1] += 10 ** r.score
    assert len(got) == len(texts) and 0.2 < sum(share) <= 1.0
    # the end's share is that of the training texts' ends among all choices
    ends, total = train.count(), sum(len((r.text or "").split()) + 1 for r in train.collect())
    assert math.isclose(share[0], (ends + 1) / (total + 2), rel_tol=1e-9)


def test_op10_query_folds_and_columns(spark, make_docs, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "a A b"] + [" ".join(rng.choice(["x", "y", "zebra", "ÄB", "q%d" % rng.randrange(30)]) for _ in range(9))
                                  for _ in range(80)]
    ids = [*range(len(texts) - 1), 3]
    got = S.op10_lm_scoring(spark, sf_of(tmp_path, make_docs(texts, ids=ids)))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def tokens(t):
        return [*(t or "").encode().lower().split(), b"</s>"]

    counts = {}
    for i, t in zip(ids, texts, strict=True):
        if crc(i, 7) != 2:
            for w in tokens(t):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, crc(i, 7) == 2, len(tokens(t)), sum(w in counts for w in tokens(t)), n,
                   round(sum(math.log10((counts.get(w, 0) + 1) / (n + 1 * (v + 1))) for w in tokens(t)), 6))
                  for i, t in zip(ids, texts, strict=True))
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.collect()) == want
    assert all(r.score < 0 for r in got.collect())


# ------------------------------------------------------------------------- pipeline


def test_pipeline_end_to_end(spark, make_docs, tmp_path):
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    texts = [prose(rng.randint(20, 60)) for _ in range(150)]
    bad = [f"{prose(12)} blarghead {prose(6)}" for _ in range(30)]
    copies = [texts[i].replace(" ", "  ") for i in range(10)]  # equal but for spaces: the longer original stays
    near = [texts[i] + " tail" for i in range(10, 20)]
    every = texts + bad + copies + near + [None, "", texts[30]]
    n = len(every)
    sources = [rng.choice(["a", "b", None]) for _ in every]
    docs = make_docs(every, ids=[*range(n - 1), 30], sources=sources)
    labels = spark.createDataFrame([(i, int(150 <= i < 180)) for i in range(0, 180)], "doc_id long, toxic int")
    path = sf_of(tmp_path, docs, labels)

    seen, frames = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / f"out-{name}")
        stage(spark, seen, path).write.parquet(out)
        seen = frames[name] = spark.read.parquet(out)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "encoding"]
    for name in ("toxicity", "exact_dedup", "near_dedup", "mixing"):
        assert frames[name].columns == docs.columns, name
    ids = {name: sorted(r.doc_id for r in f.select("doc_id").collect()) for name, f in frames.items() if name != "encoding"}
    # toxicity by the labels that may be learned
    assert not set(ids["toxicity"]) & set(range(150, 180)) and len(ids["toxicity"]) == n - 30
    # exact copies by white space deleted, longest original first, then smallest id
    groups = {}
    for r in frames["toxicity"].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    assert ids["exact_dedup"] == sorted(min(g)[1] for g in groups.values())
    # near copies: the smallest id of each component stays
    rows = frames["exact_dedup"].collect()
    comp = brute_components([r.text for r in rows], [r.doc_id for r in rows], 5)
    assert ids["near_dedup"] == sorted({c for *_, c in comp})
    # the mix: words of the kept documents only, within the targets
    kept = {r.doc_id: r for r in frames["near_dedup"].collect()}
    words = {}
    for r in frames["mixing"].collect():
        assert r.doc_id in kept
        words[kept[r.doc_id].source] = words.get(kept[r.doc_id].source, 0) + len((r.text or "").split())
    whole = sum(len((r.text or "").split()) for r in kept.values())
    assert 0.9 * 1.5 * whole <= sum(words.values()) <= 1.1 * 1.5 * whole
    assert frames["encoding"].count() == frames["mixing"].count()
    # the same through run()
    assert rows_of(corpus_pipeline.run(spark, path), "doc_id", "n_tokens", "ids_sha256") == rows_of(
        frames["encoding"], "doc_id", "n_tokens", "ids_sha256")


def test_pipeline_of_empty_tables(spark, make_docs, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert corpus_pipeline.run(spark, sf_of(tmp_path, make_docs([]), labels)).count() == 0


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLE) <= set(registry.QUERIES)
