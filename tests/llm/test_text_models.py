"""Language, toxicity and language-model scoring: held-out accuracy and brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cardiolake.llm import language_id as L, lm_scoring as S, toxicity as T
from cardiolake.llm.pieces import MARK, default_model

from tests.llm.conftest import rows_of

SYLLABLES = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ber", "ein"], "cc": ["про", "ста", "ни", "ва"]}


def words_in(lang, rng, n):
    return [("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))) for _ in range(n)]


@pytest.fixture
def languages(make_docs):
    rng = random.Random(1)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(200)]
    texts = [" ".join(words_in(x, rng, rng.randint(3, 60))) for x in langs]
    return make_docs(texts, langs=langs), langs


def test_language_on_held_out_documents(languages):
    docs, langs = languages
    model = L.fit(docs.where("doc_id % 2 = 0"))
    got = dict(rows_of(L.identify(docs, model), "doc_id", "lang_pred"))
    held = [i for i in range(len(langs)) if i % 2]
    assert sum(got[i] == langs[i] for i in held) >= 0.98 * len(held)


def test_spans_of_mixed_text_and_odd_cases(languages, make_docs):
    docs, _ = languages
    model = L.fit(docs)
    rng = random.Random(2)
    first, second = " ".join(words_in("aa", rng, 30)), " ".join(words_in("bb", rng, 20))
    odd = make_docs([f"{first}. {second}", None, "", "123 !!", "ПРОСТАНИ", first * 200], ids=[0, 1, 2, 3, 4, None])
    spans = [tuple(r)[1:4] for r in L.language_spans(odd.where("doc_id = 0"), model).collect()]
    assert [s[0] for s in spans] == ["aa", "bb"] and spans[1][1] == len(first) + 2
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4] == ("cc", 1.0) and got[None] == ("aa", 1.0)
    assert got[0][0] == "aa" and 0.4 < got[0][1] < 0.9
    assert L.identify(odd.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in L.identify(odd, L.fit(odd)).collect()} == {"und"}


def test_every_language_is_learned(make_docs, monkeypatch):
    """More than 200 languages, each of its own words; the rarer ones are told apart too, also in small batches."""
    rng = random.Random(8)
    names = [f"l{i:03d}" for i in range(230)]
    own = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(4)] for _ in names]
    docs = make_docs([" ".join(w * (1 if i % 2 else 2)) for i, w in enumerate(own)] + [" ".join(w) for w in own[:200]],
                     langs=names + names[:200])
    model = L.fit(docs)
    got = dict(rows_of(L.identify(docs, model), "doc_id", "lang_pred"))
    assert [got[i] for i in range(len(names))] == names
    letters, reader = L.Letters()(" ".join(own[0] + own[229])), model.reader()
    whole = reader.scores(letters)
    monkeypatch.setattr(L, "CELLS", 3000)
    assert np.allclose(whole, reader.scores(letters), atol=1e-3)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, k = int(rng.integers(1, 7)), 3
        score, price = rng.normal(0, 4, (n, k)), float(rng.uniform(0.5, 6))
        paths = np.stack(np.meshgrid(*[range(k)] * n, indexing="ij"), -1).reshape(-1, n)
        worth = [sum(score[i, p[i]] for i in range(n)) - price * sum(p[1:] != p[:-1]) for p in paths]
        own = L.viterbi(score, price)
        assert math.isclose(sum(score[i, own[i]] for i in range(n)) - price * int((own[1:] != own[:-1]).sum()), max(worth))


def test_viterbi_without_the_leader():
    """Two languages that each win one stretch, by less than a change costs, against a third that leads."""
    assert L.viterbi(np.array([[0.0, 10, -15], [0, -15, 10]]), 12.0).tolist() == [1, 2]
    rng = np.random.default_rng(4)
    for _ in range(200):
        n, k = int(rng.integers(2, 7)), 4
        score, price = rng.normal(0, 6, (n, k)), float(rng.uniform(4, 16))
        paths = np.stack(np.meshgrid(*[range(k)] * n, indexing="ij"), -1).reshape(-1, n)
        worth = score[np.arange(n), paths].sum(axis=1) - price * (paths[:, 1:] != paths[:, :-1]).sum(axis=1)
        own = L.viterbi(score, price)
        assert math.isclose(score[np.arange(n), own].sum() - price * int((own[1:] != own[:-1]).sum()), worth.max())


INSULTS = ["blarghead", "snotface", "dimwitten", "clodpole"]


@pytest.fixture
def toxic(spark, make_docs):
    rng = random.Random(3)
    texts, labels = [], []
    for i in range(420):
        w = words_in(rng.choice(["aa", "bb"]), rng, rng.randint(5, 40))
        bad = rng.random() < 0.3
        if bad:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        texts.append(" ".join(w))
        labels.append((i, int(bad)))
    return make_docs(texts), spark.createDataFrame(labels, "doc_id long, toxic int"), labels


def test_toxicity_on_held_out_and_disguised_documents(toxic, make_docs):
    docs, labels, truth = toxic
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in T.scored(docs.select("doc_id", "text"), model).collect()}
    held = [(i, y) for i, y in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= T.THRESHOLD) == bool(y) for i, y in held) >= 0.98 * len(held)
    rng = random.Random(4)
    plain = words_in("aa", rng, 20)
    hidden = [" ".join([*plain, x]) for x in ("sn0tf4ce", "s n o t f a c e", "snooootfaaaace", "$notface!", "s.n.o.t.f.a.c.e",
                                              "cl0dp0le", "BLARGHEAD", "sn*tface")]
    clean = [" ".join([*plain, x]) for x in ("2024-01-03", "a b c", "kaaaa", "x1y2z3", "***")] + [None, "", "!" * 500]
    odd = make_docs([*hidden, *clean])
    score = {r["doc_id"]: r["_toxic"] for r in T.scored(odd, model, score_col="_toxic").collect()}
    assert all(score[i] >= T.THRESHOLD for i in range(len(hidden))), score
    assert all(score[i] < T.THRESHOLD for i in range(len(hidden), len(hidden) + len(clean))), score
    left = T.drop_toxic(odd, model)
    assert left.columns == odd.columns and left.count() == len(clean)


def test_toxicity_of_signs_long_runs_and_spaced_sentences(toxic, make_docs):
    docs, labels, _ = toxic
    model = T.fit(docs, labels)
    rng = random.Random(4)
    plain = words_in("aa", rng, 20)
    spaced = " ".join("".join(["toka", "snotface", *words_in("aa", rng, 30)]))
    assert len(spaced) > 80
    hidden = [" ".join([*plain, x]) for x in (
        "5n07f4(3", "(10dp01e", "d1mwi773n", "$n07f4c3!!", "snotf" + "a" * 80 + "ce", "t o k a s n o t f a c e t o k a",
        "toka.toka.snotface", "toka-" * 20 + "sn0tface")] + [spaced]
    clean = [" ".join([*plain, x]) for x in ("2024-01-03", "$1,000.50", "+1-555-123-4567", "10:30", "1 2 3 4", "455", "k a t o m i",
                                              "t0ka", "ka!!", "(mito)", "#rami", "ka" * 3000 + "1", "1a" * 3000)]
    score = {r["doc_id"]: r["score"] for r in T.scored(make_docs([*hidden, *clean]).drop("score"), model).collect()}
    assert all(score[i] >= T.THRESHOLD for i in range(len(hidden))), score
    assert all(score[i] < T.THRESHOLD for i in range(len(hidden), len(hidden) + len(clean))), score


def test_toxicity_reads_a_disguise_whatever_came_before(toxic):
    """A restored word that one text also holds plainly still counts in the next text."""
    docs, labels, _ = toxic
    score = T.fit(docs, labels).scorer()
    alone = T.fit(docs, labels).scorer()("kato sn0tface")
    score("kato snotface sn0tface")
    assert score("kato sn0tface") == alone > score("kato")


def test_toxicity_without_labels(spark, make_docs):
    docs = make_docs(["a b", None], [None, 2])
    none = spark.createDataFrame([(2, None), (None, 1)], "doc_id long, toxic int")
    assert rows_of(T.scored(docs.select("doc_id", "text"), T.fit(docs, none)), "score") == [(0.0,), (0.0,)]
    assert T.scored(docs.limit(0), T.fit(docs.limit(0), none)).count() == 0


def test_lm_base_equals_brute_force(make_docs, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(words_in(rng.choice(list(SYLLABLES)), rng, rng.randint(0, 30))) for _ in range(60)]
    texts += [None, "", " \n", "É é A a", "w" * 700, texts[0], "new-word"]
    docs = make_docs(texts)
    split = [(t or "").encode().lower().split() for t in texts]
    train = [i for i in range(len(texts)) if i % 7 != 2]
    c = Counter(w for i in train for w in split[i])
    c[b"\0end"] = len(train)
    n, v = sum(c.values()), len(c)
    for most in (S.FREQUENT, 3, 0):  # all counts with the tasks, a few, none
        monkeypatch.setattr(S.frequent, "__defaults__", (most,))
        got = {r["doc_id"]: r for r in S.score_documents(docs, docs.where("doc_id % 7 != 2")).collect()}
        assert len(got) == len(texts)
        for i, w in enumerate(split):
            w = [*w, b"\0end"]
            r = got[i]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
            assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
            assert r["score"] <= 0


def test_lattice_sums_all_segmentations():
    with open(default_model(), "rb") as f:
        blob = f.read()
    rng = np.random.default_rng(1)
    log10 = np.log10(rng.dirichlet(np.ones(32000))).tolist()
    lattice = S.Lattice(blob, log10)
    lib = S.Model(blob).library
    piece = {lib.id_to_piece(i): log10[i] for i in range(32000) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}
    byte = {int(lib.id_to_piece(i)[3:5], 16): log10[i] for i in range(32000) if lib.is_byte(i)}

    def total(w):
        if not w:
            return 1.0
        out = 0.0
        for k in range(1, len(w) + 1):
            if w[:k] in piece:
                out += 10 ** piece[w[:k]] * total(w[k:])
        return out + 10 ** sum(byte[b] for b in w[0].encode()) * total(w[1:])

    texts = [MARK + "the", MARK + "hello", MARK + "été", MARK + "日本", MARK, "x"]
    assert np.allclose(lattice(texts), [math.log10(total(t)) for t in texts])


def test_lattice_of_long_words_is_not_cut(monkeypatch):
    """Words of several lengths, far over 256 characters, against a plain recursion; scores of documents use whole words."""
    with open(default_model(), "rb") as f:
        blob = f.read()
    rng = random.Random(2)
    log10 = np.log10(np.random.default_rng(1).dirichlet(np.ones(32000))).tolist()
    lattice = S.Lattice(blob, log10)
    lib = S.Model(blob).library
    piece = {lib.id_to_piece(i): log10[i] for i in range(32000) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}
    byte = {int(lib.id_to_piece(i)[3:5], 16): log10[i] for i in range(32000) if lib.is_byte(i)}
    longest = max(map(len, piece))

    def total(w):
        sums = [0.0]
        for j in range(1, len(w) + 1):
            ways = [sums[j - 1] + sum(byte[b] for b in w[j - 1].encode())]
            ways += [sums[i] + piece[w[i:j]] for i in range(max(0, j - longest), j) if w[i:j] in piece]
            top = max(ways)
            sums.append(top + math.log10(sum(10 ** (x - top) for x in ways)))
        return sums[-1]

    texts = [MARK + "".join(rng.choice(["the", "ing", "ation", "é", "日", "q", "----"]) for _ in range(n))
             for n in (0, 1, 5, 40, 41, 90, 200, 700, 701, 3)]
    assert max(map(len, texts)) > 1000
    assert np.allclose(lattice(texts), [total(t) for t in texts], rtol=1e-9)
    monkeypatch.setattr(S, "PLACES", 50)
    assert np.allclose(lattice(texts), [total(t) for t in texts], rtol=1e-9)


def test_lm_scores_whole_words(make_docs):
    docs = make_docs(["ab" * 5, "international" * 40])
    with open(default_model(), "rb") as f:
        blob = f.read()
    got = {r["doc_id"]: r["score"] for r in S.score_documents(docs, docs).collect()}
    lattice = S.Lattice(blob, S.piece_log10(S.word_counts(docs), blob))
    end = (2 + 1) / (4 + 2)  # two ends among four tokens; a word goes on, then the text ends
    assert math.isclose(got[1], lattice([MARK + "international" * 40])[0] + math.log10(1 - end) + math.log10(end), rel_tol=1e-9)


def test_lm_empty_tables(make_docs):
    docs = make_docs(["a b", None])
    assert S.score_documents(docs.limit(0), docs).count() == 0
    got = S.score_documents(docs, docs.limit(0)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}
