"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import pytest

from cardiolake.llm import exact_dedup as X, minhash_dedup as M
from cardiolake.llm.common import components

from tests.llm.conftest import rows_of

SPACE = re.compile(r"[\x20\x09-\x0D]")


def noise(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(n))


def corpus(seed=1):
    """Copies, spacing variants, near copies in a chain, a passage many texts share, odd cases."""
    rng = random.Random(seed)
    out = [None, "", " \t\n", "one", "one two three", "One two  three", " ", "É É É É É"]
    base = noise(rng, 60).split(" ")
    for i in range(40):  # a family larger than RARE is made by the big test below
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(1000)
        out.append(" ".join(w))
    shared = noise(rng, 30)
    out += [f"{noise(rng, 40)} {shared} {noise(rng, 40)}" for _ in range(30)]
    out += [noise(rng, rng.randint(1, 200)) for _ in range(30)]
    out += [out[i] for i in range(0, len(out), 7)]
    out.append(noise(rng, 30_000))
    out.append(out[-1] + " tail")
    return out


def brute_components(texts, ids, k, num=80):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= num * (len(a) + len(b) - n):
                    root[find(i)] = find(j)
    least = {}
    for i in range(len(texts)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [(ids[i], len(sets[i]), least[find(i)]) for i in range(len(texts))]


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_dedup_equals_brute_force(make_docs, shingle):
    texts = corpus()
    ids = random.Random(3).sample(range(10_000), len(texts))
    got = rows_of(M.near_dedup(make_docs(texts, ids), shingle=shingle), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(texts, ids, shingle), key=repr)


def test_near_dedup_of_a_large_family(make_docs, monkeypatch):
    """A family far beyond RARE takes the block path and still equals brute force."""
    rng = random.Random(9)
    base = noise(rng, 60).split(" ")
    texts = []
    for _ in range(230):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(100_000)
        texts.append(" ".join(w))
    texts += [f"{' '.join(base[:30])} {noise(rng, 60)}" for _ in range(80)]
    ids = rng.sample(range(10_000), len(texts))
    got = rows_of(M.near_dedup(make_docs(texts, ids), shingle=4), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(texts, ids, 4), key=repr)


def _own_values(template, text):
    """Of the retained hashes of ``text``, how many the template does not hold."""
    s = M.Shingler(4)
    return len(set(s(text.encode().split())[:M.LISTS].tolist()) - set(s(template.encode().split()).tolist()))


@pytest.mark.parametrize("copies,least", [(90, 10), (0, 13)])
def test_near_dedup_of_a_template_with_own_text(make_docs, copies, least):
    """Texts that hold a template and a fifth of their own words are linked to it alone. Kept are those
    whose smallest hashes are their own more often than most: with a large family, and without one."""
    rng = random.Random(11)
    template = max((noise(rng, 203) for _ in range(500)), key=lambda x: M.Shingler(4)(x.encode().split())[11])
    texts, unlucky = [template], 0
    for _ in range(40_000):
        if unlucky == 4 and len(texts) > copies:
            break
        text = f"{template} {noise(rng, 50)}"
        own = _own_values(template, text) if unlucky < 4 else 0
        unlucky += own >= least
        if own >= least or len(texts) <= copies:
            texts.append(text)
    assert unlucky == 4
    texts += [noise(rng, 100) for _ in range(5)]
    ids = rng.sample(range(10_000), len(texts))
    got = rows_of(M.near_dedup(make_docs(texts, ids), shingle=4), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(texts, ids, 4), key=repr)


def test_near_dedup_empty_null_ids_and_stage(make_docs):
    assert M.near_dedup(make_docs([])).count() == 0
    docs = make_docs(["a b c d e f", "a b c d e f", None, ""], [None, None, 4, None])
    assert M.near_dedup(docs).count() == 4
    left = M.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == 3


def test_exact_dedup_equals_brute_force(make_docs):
    texts = corpus(2) + ["x y", "xy", "x  y", "xy"]
    ids = random.Random(4).sample(range(10_000), len(texts))
    norm = [SPACE.sub("", t or "") for t in texts]
    want = []
    for i, h in enumerate(norm):
        group = [j for j in range(len(texts)) if norm[j] == h]
        keep = min(group, key=lambda j: (-len(texts[j] or ""), ids[j]))
        want.append((ids[i], ids[keep], len(group), keep == i, hashlib.sha256(h.encode()).hexdigest()))
    got = rows_of(X.exact_dedup(make_docs(texts, ids)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=repr)


def test_clashing_identifiers_are_found_and_lengthened(make_docs):
    """One-byte identifiers clash; the operator verifies them and still gives exact groups."""
    rng = random.Random(5)
    texts = [noise(rng, 3) for _ in range(400)]
    docs = make_docs(texts)
    assert not X.identifiers_hold(docs, digest_bytes=1)
    assert X.identifiers_hold(docs)
    got = X.exact_dedup(docs, digest_bytes=1)
    assert got.where("group_size > 1").count() == len(texts) - len([t for t in texts if sum(
        SPACE.sub("", t) == SPACE.sub("", u) for u in texts) == 1])


def test_chunks_follow_the_content():
    rng = random.Random(6)
    data = noise(rng, 20_000).encode()
    parts = X.chunks(data)
    assert b"".join(parts) == data and max(map(len, parts)) <= X.MOST
    assert all(len(p) >= X.LEAST for p in parts[:-1])
    moved = set(X.chunks(b"in front " * 9 + data)) & set(parts)
    assert len(moved) > 0.8 * len(parts)
    assert X.chunks(b"") == [] and X.chunks(b"a") == [b"a"]


def test_exact_dedup_empty_repeats_and_stage(make_docs):
    assert X.exact_dedup(make_docs([])).count() == 0
    docs = make_docs(["a b", "a b", "ab", None, ""], [7, 7, 1, 3, None])
    got = X.exact_dedup(docs)
    assert got.where("kept").count() == 2 and got.where("group_size = 3 AND keep_id = 7").count() == 3
    left = X.drop_exact_copies(docs)
    assert left.columns == docs.columns and rows_of(left, "doc_id") == [(3,), (7,)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (300, 299), (299, 300)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes_meet_their_components_in_one_join(spark, tmp_path, monkeypatch):
    """The table of classes and components is read twice and must not be joined twice."""
    from cardiolake.llm import minhash_dedup as MD

    plans, store = {}, MD.stored

    def noted(df):
        plans[tuple(df.columns)] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df)

    monkeypatch.setattr(MD, "stored", noted)
    text = " ".join(f"w{i}" for i in range(40))
    spark.createDataFrame([(1, text), (2, f"{text} more"), (3, "something else altogether, and longer"), (4, None)],
                          "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    got = MD.near_dedup(spark.read.parquet(f"{tmp_path}/d")).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True)]
    assert plans["cls", "component_id", "_rep"].count("Join ") == 1
