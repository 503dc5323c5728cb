"""Vectors near-dedup, fill-in-the-middle and importance resampling against brute force."""

import math
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cardiolake.llm import fill_middle as FM, importance as IM, lattice_dedup as LD
from tests.llm.conftest import rows_of

# ------------------------------------------------------------------ 11: lattice


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def brute_links(x, threshold=0.9):
    """(links, component) of each row of a matrix; rows are named by their number."""
    u = unit(x)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    name = np.arange(len(x))
    while True:
        new = np.array([min([name[i], *name[near[i]]]) for i in range(len(x))])
        if (new == name).all():
            return near.sum(1), name
        name = new


@pytest.fixture
def make_vectors(spark, tmp_path):
    count = [0]

    def make(rows, kind="float"):
        count[0] += 1
        path = str(tmp_path / f"vec{count[0]}")
        schema = f"vec_id long, embedding array<{kind}>, label int, cls string, cid string, cell string"
        spark.createDataFrame([(i, v, 0, "c", "d", "e") for i, v in rows], schema).write.parquet(path)
        return spark.read.parquet(path)

    return make


def test_nearest_point_of_e8_is_the_nearest():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 8)) * 2
    p = LD.nearest(x)
    both = np.concatenate([p[:, None], p[:, None] + LD.MOVES], axis=1)  # all Voronoi neighbours of the answer
    d = ((x[:, None] - both) ** 2).sum(-1)
    assert (d[:, 0] <= d.min(1) + 1e-12).all()
    twice = p * 2
    assert (twice == np.rint(twice)).all() and ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all()
    assert (p.sum(1) % 2 == 0).all()
    assert len(LD.MOVES) == 240 and ((LD.MOVES ** 2).sum(1) == 2).all()


def test_cells_of_a_vector_do_not_depend_on_the_batch():
    u = unit(np.random.default_rng(4).normal(size=(300, 64)))
    grid = LD.Lattice(64, 4, 4, 1, 1.75, 11)
    own, probed = grid.cells(u)
    for i in (0, 7, 299):
        one, more = grid.cells(u[i:i + 1])
        assert (one == own[i]).all() and (more == probed[i]).all()
    assert (probed != own[:, :, None]).all()


def planted(rng, cos, n, size=64):
    x = unit(rng.normal(size=(n, size)))
    z = rng.normal(size=(n, size))
    z = unit(z - (z * x).sum(1, keepdims=True) * x)
    return np.concatenate([x, cos * x + math.sqrt(1 - cos * cos) * z])


@pytest.mark.parametrize("cos, least", [(0.905, 0.93), (0.93, 0.98), (0.97, 1.0)])
def test_recall_of_planted_pairs(make_vectors, cos, least):
    x = planted(np.random.default_rng(5), cos, 600)
    got = {r.vec_id: r for r in LD.near_vectors(make_vectors([(i, v.tolist()) for i, v in enumerate(x)], "double")).collect()}
    links, _ = brute_links(x)
    assert all(got[i].n_links <= links[i] for i in got)
    found = sum(r.n_links for r in got.values()) / links.sum()
    assert found >= least, found


def test_families_links_and_components_equal_brute_force(make_vectors, monkeypatch):
    monkeypatch.setattr(LD, "BLOCK", 60)  # a family fills several blocks of a cell
    rng = np.random.default_rng(6)
    heart, other = unit(rng.normal(size=(2, 32)))
    family = unit(heart + rng.normal(size=(250, 32)) * 0.03)
    chain = unit(other + np.cumsum(rng.normal(size=(40, 32)) * 0.035, axis=0))  # ends are not linked directly
    x = np.concatenate([family, chain, unit(rng.normal(size=(100, 32)))]).astype(np.float32)
    x = x[rng.permutation(len(x))]
    x = np.concatenate([x, x[:30], x[:30]])  # exact copies
    links, name = brute_links(x.astype(float))
    got = LD.near_vectors(make_vectors([(i, v.tolist()) for i, v in enumerate(x)]), tables=6, probes=8, width=2.0)
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == sorted(
        ((i, int(links[i]), int(name[i]), bool(name[i] == i)) for i in range(len(x))), key=repr)


def test_two_lattice_blocks_and_more_tables_than_a_mark_word(make_vectors):
    x = planted(np.random.default_rng(8), 0.96, 150)
    got = LD.near_vectors(make_vectors([(i, v.tolist()) for i, v in enumerate(x)], "double"), tables=9, probes=6, blocks=2,
                          width=2.5)
    links, name = brute_links(x)
    assert rows_of(got, "vec_id", "n_links", "component_id") == sorted(
        ((i, int(links[i]), int(name[i])) for i in range(len(x))), key=repr)


def test_vectors_without_a_direction_ids_and_lengths(make_vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0, 3.0]), (3, [2.0, 4.0, 6.0]), (3, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (9, None), (8, []),
            (7, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (4, [nan, 2.0, 3.0]), (2, [inf, 2.0, 3.0]), (1, [1.0, 2.0]),
            (0, [-1.0, -2.0, -3.0]), (11, [1e200, 2e200, 3e200]), (12, [0.0, 1e-300]), (13, [-0.0, 1e-300])]
    got = rows_of(LD.near_vectors(make_vectors(rows, "double")), "vec_id", "n_links", "component_id", "kept")
    assert got == sorted([(5, 4, 3, False), (3, 4, 3, True), (3, 4, 3, True), (None, 4, 3, False), (11, 4, 3, False),
                          (12, 1, 12, True), (13, 1, 12, False),
                          *[(i, 0, i, True) for i in (9, 8, 7, 6, 4, 2, 1, 0)]], key=repr)
    assert LD.near_vectors(make_vectors([])).count() == 0
    alone = LD.near_vectors(make_vectors([(None, [1.0])])).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in alone] == [(None, 0, None, True)]


def test_no_pair_below_the_threshold(make_vectors):
    x = planted(np.random.default_rng(9), 0.8999, 300)
    assert LD.near_vectors(make_vectors([(i, v.tolist()) for i, v in enumerate(x)], "double")).agg(
        F.sum("n_links")).first()[0] == 0


# ------------------------------------------------------------ 12: fill in middle


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZ é漢😀\n<>PSM")), max_size=60))
def test_offsets_are_those_of_the_encoded_text(text):
    data = text.encode()
    index = FM.Offsets(np.frombuffer(data, np.uint8))
    places = list(range(len(text) + 1))
    want = [len(text[:i].encode()) for i in places]
    assert index.bytes_of(np.array(places)).tolist() == want
    assert index.chars_of(np.array(want)).tolist() == places
    assert index.n_chars == len(text)
    assert len(index.at_byte) == sum(ord(c) > 127 for c in text)  # only multibyte characters are recorded
    tokens = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    assert FM.token_starts(np.frombuffer(data, np.uint8)).tolist() == [want[i] for i in tokens]


def brute_fim(text, doc_id):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    h = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    c1, c2 = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:c1]), "".join(tokens[c1:c2]), "".join(tokens[c2:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def hexed(text):
    return sha256(text.encode()).hexdigest()


def test_fill_middle_query_equals_brute_force(spark, make_docs, tmp_path):
    texts = [None, "", "a", "<P>", "x<S", "S> y <", "<<P", "Wörter und 漢字 😀 mixed\nlines", "ab" * 5000 + "é" * 3000,
             "12 <M> 3", "\u0000\u007f\u0080 z"] + [f"text {i} with ü {i * i} words < P > S" for i in range(60)]
    ids = [None, *range(1, len(texts))]
    ids[5] = ids[6] = 77  # repeated ids
    docs = make_docs(texts, ids=ids)
    docs.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    got = FM.op12_fill_middle(spark, str(tmp_path / "sf"))
    want = []
    for i, t in zip(ids, texts, strict=True):
        n, form, c1, c2, out = brute_fim(t, i)
        want.append((i, n, form, c1, c2, hexed(out), hexed(t or "")))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert rows_of(got, *got.columns) == sorted(want, key=repr)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}


def test_fill_middle_by_characters_and_restore(make_docs):
    texts = ["Größe 漢字 " * 3, "ab", "é"]
    out = FM.fill_in_middle(make_docs(texts), unit="char", cut_rate=100, spm_rate=50).collect()
    for r in out:
        text = texts[r.doc_id]
        assert r.n == len(text)
        assert FM.restore(r.output.encode(), r.form).decode() == text
        assert len(text[:r.prefix_chars].encode()) == r.prefix_bytes
        assert len(text[r.prefix_chars:r.prefix_chars + r.middle_chars].encode()) == r.middle_bytes
    assert FM.fill_in_middle(make_docs([])).count() == 0


# --------------------------------------------------------- 13: importance


def brute_importance(docs, target, longest=1, buckets=10_000, least=20, percent=10, scale=1000, seed=2024):
    def words(t):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def features(t):
        w = words(t)
        return [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for rows, total in ((docs, s), (target, t)):
        for _, text in rows:
            for b in features(text):
                total[b] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(scale * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-scale * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def corpus(rng, n):
    vocab = [f"w{i}" for i in range(300)] + ["Ünder", "漢字", "a-b", "X9"]
    lines = [" ".join(rng.choice(vocab, size=rng.integers(0, 12))) for _ in range(80)]
    return ["\n".join(rng.choice(lines, size=rng.integers(1, 8))) for _ in range(n)]


@pytest.mark.parametrize("longest", [1, 3])
def test_importance_equals_brute_force(make_docs, longest):
    rng = np.random.default_rng(10)
    texts = [None, "", "\n\n \n", "one", "x\ny\nz", "a\n\n\nb", "\n".join(["same line here"] * 500), *corpus(rng, 120)]
    ids = [None, *range(1, len(texts))]
    target = corpus(rng, 15)
    got = IM.importance_sample(make_docs(texts, ids=ids), make_docs(target), longest=longest, percent=30)
    want = brute_importance(list(zip(ids, texts)), list(enumerate(target)), longest, percent=30)
    assert rows_of(got, "doc_id", "n_features", "weight", "score", "rank") == want
    assert sum(r[4] is not None for r in want) > 10


def test_importance_query_columns_repeats_and_empty_tables(spark, make_docs, tmp_path):
    rng = np.random.default_rng(11)
    texts = corpus(rng, 60)
    docs = make_docs(texts + texts[:5], ids=[*range(60), *range(5)])  # rows repeat
    target = spark.createDataFrame([(0, None), (1, "w1 w2")], "item_id long, text string")
    for df, name in ((docs, "documents"), (target, "benchmark")):
        df.write.parquet(str(tmp_path / "sf" / f"{name}.parquet"))
    got = IM.op13_importance(spark, str(tmp_path / "sf"))
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    pairs = [*enumerate(texts), *enumerate(texts[:5])]
    want = brute_importance(pairs, [(0, None), (1, "w1 w2")])
    assert [r[:4] for r in rows_of(got, "doc_id", "n_features", "weight", "score", "rank")] == [r[:4] for r in want]
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == sum(r[4] is not None for r in want)
    empty = make_docs([])
    assert IM.importance_sample(empty, docs).count() == 0
    none = IM.importance_sample(docs, empty).collect()  # no target: weights follow from the documents
    assert len(none) == 65 and len({r.weight for r in none}) > 1
