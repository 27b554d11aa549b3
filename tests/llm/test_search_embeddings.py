"""Lexical search, whitening and near-dedup of embeddings against brute force, and their edge rows."""

import math
import re

import numpy as np
import pytest

from ebbline.llm import embedding_caps, embedding_whitening, lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


# lexical search -----------------------------------------------------------------------------------------


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranks(docs, items, k):
    counted = [(i, terms_of(t)) for i, t in docs]
    counted = [(i, t) for i, t in counted if t]
    many, length = len(counted), sum(len(t) for _, t in counted)
    df = {}
    for _, t in counted:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms_of(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, t in counted:
            m = 100 - 50 + (50 * len(t) * many) // length
            score = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * t.count(x)) // (1000 * t.count(x) + 20 * m)) for x in terms if x in df)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


DOCS = [
    (1, "the cat sat on the mat"), (2, "The CAT_sat on-the mat"), (2, "The CAT_sat on-the mat"), (None, "cat ÄÖÜ 日本語 😀"), (3, None), (4, ""), (5, " .,;\n\t_"), (6, "rare " * 3000 + "cat"), (7, "dog"), (8, "dog"), (9, "dog " * 40),
    (10, "İstanbul ıI K k 中文"), (11, "mat mat mat"), (12, "123 4 the"), (None, "dog"),
]
ITEMS = [(1, "cat mat the"), (2, "DOG"), (3, None), (4, ""), (5, "nothing here matches"), (None, "rare 日本語"), (6, "cat"), (6, "dog"), (7, "ÄÖÜ äöü K"), (8, "cat cat cat " * 500)]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_ranks_are_those_of_brute_force(spark, k):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS], "doc_id long, text string, score string, rank int")
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, n int")
    got = sorted((tuple(r) for r in lexical_search.rank_documents(docs, items, k=k).collect()), key=repr)
    assert got == brute_ranks(DOCS, ITEMS, k)
    assert lexical_search.rank_documents(docs.limit(0), items).count() == 0
    assert lexical_search.rank_documents(docs, items.limit(0)).count() == 0


def test_small_shards_and_blocks_change_no_rank(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 30), p=np.arange(60, 0, -1) / 1830))) for i in range(400)] + [(1000 + i, "w1 w2 w3") for i in range(30)]
    asked = [(i, " ".join(rng.choice(words, 6))) for i in range(12)]
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", 40)
    monkeypatch.setattr(lexical_search, "BLOCK_PAIRS", 20)
    monkeypatch.setattr(lexical_search, "FIRST_READS", 8)
    got = lexical_search.rank_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(asked, "item_id long, text string"), k=10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_ranks(rows, asked, 10)


def test_best_positions_stop_before_the_end():
    """One list ends high, so most of the other is never read; direct accesses carry its best position on."""
    n, size = np.full(4000, 20), 2
    tfs = np.ones((4000, 2), np.int64)
    tfs[:60] = 30
    shard = lexical_search.Shard(n, np.arange(0, 8001, 2), np.tile([0, 1], 4000), tfs.ravel(), 4000, 80_000, size)
    docs, scores, reads = shard.best(np.array([0, 1]), np.array([5, 7]), 50, np.zeros(0, np.int64))
    assert reads < 4000 and set(docs[np.argsort(-scores)[:50]]) <= set(range(60))


# whitening ----------------------------------------------------------------------------------------------


def brute_white(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    c = (n * x - total) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, ((n * x - total) ** 2).sum(axis=1), c @ v / np.sqrt(e), e / np.trace(c.T @ c / n)


def test_whitening_is_that_of_an_eigensolver(spark, monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((700, 12)) * np.array([5, 4.5, 4, 3, 2, 1.5, 1.2, 1, 0.9, 0.1, 0.05, 0.01])
    rows = [(i, v.tolist(), 1.0) for i, v in enumerate(data)]
    bad = [(900, None, 0.0), (901, [1.0] * 11 + [None], 0.0), (902, [float("nan")] + [0.0] * 11, 0.0), (903, [float("inf")] * 12, 0.0), (904, [1.0, 2.0], 0.0), (905, [], 0.0), (None, data[0].tolist(), 0.0), (5, data[5].tolist(), 0.0)]
    monkeypatch.setattr(embedding_whitening, "FAN_IN", 2)
    monkeypatch.setattr(embedding_whitening, "BLOCK_ROWS", 50)
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, whitened double").repartition(7)
    got = embedding_whitening.whiten(df).toPandas()
    n, deviation, white, explained = brute_white([*data, data[0], data[5]])
    assert set(got.n) == {n} and len(got) == 8 * n and got.identity_error.max() < 1e-12
    first = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened").loc[range(700)].to_numpy()
    assert np.abs(first * np.sign((first * white[:700]).sum(axis=0)) - white[:700]).max() < 1e-9
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert got[got.component == 1].set_index("vec_id").deviation.loc[range(600, 700)].tolist() == deviation[600:700].tolist()
    assert embedding_whitening.whiten(df.where("vec_id = 7")).count() == 0 and embedding_whitening.whiten(df.limit(0)).count() == 0


def test_few_directions_give_few_components(spark):
    rows = [(i, [float(i % 5), float(i % 5), 1.0, float(i % 3)]) for i in range(60)]
    got = embedding_whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas()
    assert sorted(set(got.component)) == [1, 2] and got.identity_error.max() < 1e-12 and abs(got.groupby("component").explained.first().sum() - 1) < 1e-12


def matrices():
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((10, 10)))[0]
    yield "random", rng.standard_normal((300, 40))
    yield "graded", rng.standard_normal((300, 20)) * 10.0 ** -np.arange(20)
    yield "low rank", rng.standard_normal((200, 4)) @ rng.standard_normal((4, 30))
    yield "few rows", rng.standard_normal((3, 30))
    yield "repeated values", np.diag([5, 5, 5, 3, 3, 1, 1, 1e-5, 1e-9, 0]) @ turn
    yield "all equal", turn
    yield "falls apart", np.eye(12) * 3
    yield "one column", rng.standard_normal((9, 1))
    yield "zero", np.zeros((9, 4))


@pytest.mark.parametrize("name,x", list(matrices()))
def test_bidiagonal_solver(name, x):
    d = x.shape[1]
    r = np.zeros((d, d))
    part = np.linalg.qr(x, mode="r")
    r[: len(part)] = part
    values, basis = embedding_whitening.directions(r, d)
    want = np.linalg.svd(x, compute_uv=False)
    want = np.concatenate([want, np.zeros(d - len(want))])
    assert np.abs(values - want).max() <= 1e-13 * max(want.max(), 1e-300)
    k = basis.shape[1]
    assert k == (want > d * np.finfo(float).eps * want.max()).sum()
    if k:
        assert np.abs(basis.T @ basis - np.eye(k)).max() < 1e-12
        assert np.linalg.norm(r.T @ (r @ basis) - basis * values[:k] ** 2) <= 1e-12 * values[0] ** 2


# near-dedup ---------------------------------------------------------------------------------------------


def brute_links(rows, t=0.95):
    ids, vectors = zip(*rows)
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i]), np.array(vectors[j])
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= t:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min((x for x in (least.get(find(i)), d) if x is not None), default=None)
    return sorted(((d, links[i], least[find(i)], d == least[find(i)]) for i, d in enumerate(ids)), key=repr)


def family(rng, size, d, spread):
    v = rng.standard_normal(d)
    return [(v / np.linalg.norm(v) + spread * rng.standard_normal(d) / math.sqrt(d)).tolist() for _ in range(size)]


@pytest.mark.parametrize("d", [2, 5, 48])
def test_near_embeddings_are_those_of_brute_force(spark, d, monkeypatch):
    rng = np.random.default_rng(d)
    vectors = [*family(rng, 40, d, 0.05), *family(rng, 30, d, 0.2), *family(rng, 12, d, 0.01), *rng.standard_normal((60, d)).tolist()]
    vectors += [vectors[0]] * 20 + [[3 * x for x in vectors[1]]]
    rows = [(1000 - i, v) for i, v in enumerate(vectors)] + [(5, None), (6, []), (7, [0.0] * d), (8, [1.0] * (d - 1) + [None]), (9, [float("nan")] * d), (None, vectors[0]), (None, vectors[-30]), (990, vectors[3]), (1, [1.0] * (d + 1)), (2, [1.0] * (d + 1))]
    monkeypatch.setattr(embedding_caps, "GROUP_BLOCK", 16)
    monkeypatch.setattr(embedding_caps, "FILTER_BLOCK", 16)
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, embedding array<double>, node int, n_links string").repartition(5)
    got = sorted((tuple(r) for r in embedding_caps.near_embeddings(df).collect()), key=repr)
    assert got == brute_links(rows)
    assert embedding_caps.near_embeddings(df.limit(0)).count() == 0


def test_list_decoding_finds_every_exceeding_filter():
    caps = embedding_caps.Caps(24, 500)
    rng = np.random.default_rng(4)
    x = embedding_caps.unit(rng.standard_normal((80, 24)))
    for code in range(len(caps.signs)):
        turned, half = caps.rotated(x, code), caps.wide // 2
        assert np.allclose(np.linalg.norm(turned, axis=1), 1)
        every = (turned[:, :half] @ caps.blocks[code, 0])[:, :, None] + (turned[:, half:] @ caps.blocks[code, 1])[:, None, :]
        every = every.reshape(len(x), -1)
        height = np.minimum(caps.height, -np.partition(-every, caps.least - 1, axis=1)[:, caps.least - 1])
        rows, filters = caps.decode(x, code)
        assert np.array_equal(np.bincount(rows, minlength=len(x)), (every >= height[:, None]).sum(axis=1))
        assert len(np.unique(np.stack([rows, filters]), axis=1).T) == len(rows)


@pytest.mark.parametrize("cosine,least", [(0.95, 0.998), (0.97, 0.999)])
def test_recall_of_filters_at_the_threshold(cosine, least):
    """Share of pairs at this cosine that meet in a filter with sketches near enough."""
    caps, rng, d = embedding_caps.Caps(64, 50_000), np.random.default_rng(6), 64
    one = embedding_caps.unit(rng.standard_normal((3000, d)))
    side = rng.standard_normal((3000, d))
    side = embedding_caps.unit(side - (side * one).sum(axis=1)[:, None] * one)
    two = cosine * one + math.sqrt(1 - cosine**2) * side
    (a, f), (b, g) = caps.filters(one), caps.filters(two)
    near = np.bitwise_count((caps.sketches(one) ^ caps.sketches(two)).view(np.uint64)).sum(axis=1) <= embedding_caps.sketch_limit(0.95)
    met = [bool(np.intersect1d(f[a[i] : a[i + 1]], g[b[i] : b[i + 1]]).size) for i in range(len(one))]
    assert (np.array(met) & near).mean() >= least


def test_filters_of_random_vectors_stay_small():
    caps = embedding_caps.Caps(64, 20_000)
    x = embedding_caps.unit(np.random.default_rng(8).standard_normal((20_000, 64)))
    _, filters = caps.filters(x)
    assert len(filters) / len(x) < 30 and np.unique(filters, return_counts=True)[1].max() < 1000
