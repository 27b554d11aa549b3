"""The corpus operators against brute force, round trips and edge cases."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbline.llm import arrays, carried, components, exact_dedup, language_id, media_jpeg, mixing, ngram_join, queries, sentencepiece_dropout, sharding, toxicity, url_filter, warc_audit

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997}" for i in range(60_000))

#: nulls in every column, empty, blank and very long texts, ties and repeated rows, a clashing extra column
ROWS = [
    (1, "Hello World", "en", "a"), (2, "hello world", "en", "a"), (2, "hello world", "en", "a"), (None, "HELLO world", None, None), (3, None, "de", "b"), (4, "", None, "b"), (5, "   \n\t ", "fr", None), (6, LONG, "en", "a"), (7, LONG + " tail", "en", "a"),
    (8, "ÄÖÜ 日本語 😀 ▁ <s>", "xx", "c"), (9, "one", "en", "a"), (10, "quote \" open", "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 0.5, "x") for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long, score double, block string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(arrays.WORD_PATTERN, (text or "").lower())


# exact dedup ------------------------------------------------------------------------------------------


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_dedup(docs, none):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs).collect()), key=repr)
    want = []
    for i, t, *_ in ROWS:
        same = [j for j, u, *_ in ROWS if low(u) == low(t)]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(none).count() == 0
    kept = [r.doc_id for r in exact_dedup.keep_first(docs).collect()]
    assert sorted(kept) == [2, 4, 5, 6, 7, 8, 9, 10]
    gone = exact_dedup.exact_dedup(docs, withdrawn=docs.where("doc_id = 1")).where("text_sha256 = sha2('hello world', 256)").collect()
    assert len(gone) == 4 and not any(r.kept for r in gone) and all(r.group_size is None for r in gone)


def test_cuckoo_index_grows_and_deletes():
    index = exact_dedup.CuckooIndex(buckets=2)
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(30_000)), np.uint64).reshape(-1, 4)
    values = np.stack([np.arange(30_000), *np.ones((3, 30_000), np.int64)], axis=1)
    for a in range(0, 30_000, 700):
        assert (index.find(keys[a : a + 700]) < 0).all()
        index.add(keys[a : a + 700], values[a : a + 700])
    value_of = lambda k: index.values[index.rows.reshape(-1)[index.find(k)], 0]
    assert index.resizes > 3 and (value_of(keys) == values[:, 0]).all() and index.false_hits < 300
    assert index.delete(keys[::2]).all() and not index.delete(keys[:1]).any()
    assert (index.find(keys[::2]) < 0).all() and (value_of(keys[1::2]) == values[1::2, 0]).all()
    index.add(keys[:10], values[:10] * [5, 1, 1, 1])
    assert value_of(keys[:10]).tolist() == [5 * i for i in range(10)]
    assert index.values[index.rows.reshape(-1)[index.find(keys[:10])], 2].tolist() == [1, 2] * 5  # the deleted ones begin anew
    alike = keys[:50].copy()
    alike[:, 0] += np.uint64(1)  # the same fingerprints and buckets, other texts
    assert (index.find(alike) < 0).all()


# n-gram join ------------------------------------------------------------------------------------------


def brute_join(rows, t=0.8):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and len(a & b) >= t * len(a | b)):
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min((x for x in (least.get(find(i)), d) if x is not None), default=None)
    return [(d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows)]


def test_ngram_join(docs, none, spark):
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(docs).collect()], key=repr)
    assert got == sorted(brute_join([r[:2] for r in ROWS]), key=repr)
    assert ngram_join.ngram_join(none).count() == 0
    assert sorted(r.doc_id for r in ngram_join.keep_one(docs).collect()) == [1, 3, 6, 8, 9, 10]


def test_ngram_join_on_a_family_beyond_one_block(spark, monkeypatch):
    """Near copies whose links span several blocks, chained so that the ends are not linked."""
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 4)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[i:], *(f"x{k}" for k in range(i))])) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(df).collect())
    assert got == sorted(brute_join(rows))


def test_ngram_join_cuts_large_groups_by_size(spark, monkeypatch):
    """Growing texts, each linked with the nearest sizes only; 4 of 5 n-grams (exactly 0.8) link still."""
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 3)
    monkeypatch.setattr(ngram_join, "choose_bands", lambda *_: (200, 1))
    word = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(word[: 8 + 2 * i])) for i in range(48)] + [(100 + i, " ".join(word[: 4 + n])) for i, n in enumerate((4, 5, 20, 25, 64, 80, 100))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(df).collect())
    assert got == sorted(brute_join(rows))
    members = spark.createDataFrame([(i, 0, 1, n) for i, n in enumerate([10, 10, 10, 12, 12, 100, 120, 5000])], "node long, root long, size long, n long")
    placed = {r.node: r for r in ngram_join._place(members, 0.8).collect()}
    assert placed[7].others == [placed[7].block] and not set(placed[0].others) & set(placed[5].others)
    assert placed[6].block in placed[5].others and all(r.block in r.others for r in placed.values())


def test_null_and_repeated_ids_name_texts_of_their_own(spark):
    """Unlike texts of null ids, and of one id, are classes of their own; near copies are found whatever their ids."""
    word = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    rows = [(None, word("a")), (None, word("b")), (None, word("b") + " end"), (None, word("c") + " end"), (3, word("c")), (5, word("d")), (5, word("e")), (5, word("e")), (6, word("d") + " end"), (7, word("e") + " end"), (None, ""), (8, word("f")), (8, word("f") + " end")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(df).collect()], key=repr)
    assert got == sorted(brute_join(rows), key=repr)
    kept = sorted([(r.doc_id, r.text.removesuffix(" end")) for r in ngram_join.keep_one(df).collect()], key=repr)
    assert kept == sorted([(None, word("a")), (None, word("b")), (None, ""), (3, word("c")), (5, word("d")), (5, word("e")), (8, word("f"))], key=repr)


def test_bands_reach_the_recall():
    for t, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        b, r = ngram_join.choose_bands(t, recall)
        assert 1 - (1 - t**r) ** b >= recall and b * r <= 256


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (102, 101), (200, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}


# sentencepiece ----------------------------------------------------------------------------------------


def test_sentencepiece_without_dropout_is_the_model(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_dropout.MODEL)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()] + ["  a  b ", "日本 😀", "a" * 300, "\n\n"]
    enc = sentencepiece_dropout.Encoder()
    ids, at = enc.encode(texts, np.zeros(len(texts), np.uint64))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == model.encode(texts)


def test_sentencepiece_round_trip(docs, none):
    for p in (0.0, 0.3, 1.0):
        enc = sentencepiece_dropout.encode_column(docs, keep=[F.col("doc_id"), F.coalesce("text", F.lit("")).alias("want")], dropout=p, seed=5)
        back = sentencepiece_dropout.decode_column(enc)
        assert back.where("text = want").count() == len(ROWS)
    assert sentencepiece_dropout.encode_column(none, keep=[F.col("doc_id")]).count() == 0


def test_dropout_varies_by_seed_and_not_by_run():
    texts, keys = ["the international conversation about tokenization " * 5], np.zeros(1, np.uint64)
    run = lambda seed: sentencepiece_dropout.Encoder(dropout=0.3, seed=seed).encode(texts, keys)[0].tolist()
    assert run(1) == run(1) and run(1) != run(2)


def test_every_occurrence_draws_for_itself():
    """The occurrences' segmentations are those of single merges under their own keys, and there are many."""
    encoder = sentencepiece_dropout.Encoder(dropout=0.1, seed=3)
    words = ["understanding", "of", "straightforwardness", "Zürich", "understanding"]
    keys = np.arange(2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ids, borders = encoder.encode([" ".join(words)] * 2000, keys)
    v, want = encoder.vocabulary, []
    for key in keys[:300]:
        for place, word in enumerate(words):
            own = arrays.mix64(arrays.mix64(np.array([key]) ^ encoder.key) + np.uint64(place) * np.uint64(0xD6E8FEB86659FD93))[0]
            symbols = encoder._symbols(np.array([ord(c) for c in " " + word]))
            want.extend(sentencepiece_dropout.merge_long(v, symbols, own, 0.1).tolist())
    assert ids[: borders[300]].tolist() == want
    one, b = encoder.encode(["of"] * 20_000, np.arange(20_000, dtype=np.uint64))
    whole = (np.diff(b) == 1).mean()
    ways = {tuple(ids[x:y].tolist()) for x, y in zip(borders, borders[1:])}
    assert 0.7 < whole < 0.95 and len(ways) > 500


def test_long_words_merge_as_short_ones():
    enc = sentencepiece_dropout.Encoder(dropout=0.2, seed=3)
    word = "abcabcabdthe" * 3
    symbols = enc._symbols(np.frombuffer(word.encode("utf-32-le"), np.uint32))
    key = np.array([12345], np.uint64)
    one, _ = sentencepiece_dropout.merge_words(enc.vocabulary, symbols[None, :], np.array([len(word)]), key, 0.2)
    assert one[0][one[0] >= 0].tolist() == sentencepiece_dropout.merge_long(enc.vocabulary, symbols, key[0], 0.2).tolist()


# media ------------------------------------------------------------------------------------------------


def test_jpeg_round_trip_and_features(docs, none):
    got = media_jpeg.read_media(media_jpeg.write_media(docs, keep=[F.col("doc_id"), F.coalesce("text", F.lit("")).alias("t")])).collect()
    assert len(got) == len(ROWS)
    for r in got:
        raw = media_jpeg.payload_of(r.t.encode())
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32, r.problem) == (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), None)
    assert media_jpeg.write_media(none, keep=[F.col("doc_id")]).count() == 0


def test_jpeg_any_bytes_and_broken_files(spark):
    rng = np.random.default_rng(0)
    payloads = [media_jpeg.payload_of(p) for p in (b"", bytes(range(256)) * 2, rng.bytes(5000), b"\xff" * 700, b"\0" * 63 + b"x" + b"\0" * 200)]
    files = media_jpeg.encode(payloads)
    for p, (_, c) in zip(payloads, media_jpeg.decode(files)):
        assert c.reshape(-1)[: len(p)].astype(np.int8).tobytes() == p
    broken = [(0, files[2]), (1, files[2][:-900]), (2, b"no jpeg"), (3, None), (4, files[2][:300] + b"\0\0\0" + files[2][303:])]
    got = {r.i: r for r in media_jpeg.read_media(spark.createDataFrame(broken, "i int, media binary")).collect()}
    assert got[0].problem is None and all(got[i].problem for i in (1, 2, 3))


def test_jpeg_without_restarts_and_with_three_components():
    """A hand-made scan: one interval, two-by-one luminance blocks and two chroma blocks an MCU."""
    dc, dcl = media_jpeg.codes_of(media_jpeg.DC_COUNTS, media_jpeg.DC_SYMBOLS)
    ac, acl = media_jpeg.codes_of(media_jpeg.AC_COUNTS, media_jpeg.AC_SYMBOLS)
    values = [[8, 16, -8, 0], [24, 40, 8, 4]]  # luminance, luminance, chroma, chroma of two MCUs
    bits, last = "", [0, 0, 0]
    for mcu in values:
        for comp, v in zip((0, 0, 1, 2), mcu):
            diff, last[comp] = v - last[comp], v
            size = abs(diff).bit_length()
            bits += f"{dc[size]:0{dcl[size]}b}" + (f"{diff if diff > 0 else diff + (1 << size) - 1:0{size}b}" if size else "")
            bits += f"{ac[0]:0{acl[0]}b}"
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")
    seg = media_jpeg._segment
    f = b"\xff\xd8" + seg(0xDB, b"\0" + b"\x01" * 64) + seg(0xC0, b"\x08\0\x08\0\x20\x03\x01\x21\0\x02\x11\0\x03\x11\0") + seg(0xC4, b"\0" + bytes(media_jpeg.DC_COUNTS) + bytes(media_jpeg.DC_SYMBOLS)) + seg(0xC4, b"\x10" + bytes(media_jpeg.AC_COUNTS) + bytes(media_jpeg.AC_SYMBOLS)) + seg(0xDA, b"\x03\x01\0\x02\0\x03\0\0\x3f\0") + scan + b"\xff\xd9"
    parsed, c = media_jpeg.decode([f])[0]
    assert c[:, 0].tolist() == [8, 16, -8, 0, 24, 40, 8, 4]
    assert media_jpeg.thumbnail(parsed, c).tolist() == [[129, 130, 131, 133]]


# language, toxicity -----------------------------------------------------------------------------------


def test_language_id(docs, none, spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(table)
    found = language_id.identify(table, model, keep=[F.col("doc_id"), F.col("lang")])
    assert found.where("lang = lang_pred").count() / found.count() > 0.98
    edge = {r.doc_id: r for r in language_id.identify(docs, model, keep=[F.col("doc_id")]).collect()}
    assert edge[3].lang_pred == edge[4].lang_pred == edge[5].lang_pred == "und" and 0 <= edge[6].score <= 1
    assert language_id.identify(none, model, keep=[F.col("doc_id")]).count() == 0
    assert language_id.identify(docs, language_id.train(none), keep=[F.col("doc_id")]).where("lang_pred <> 'und'").count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_is_the_edit_distance():
    terms = [toxicity.Term("idiot"), toxicity.Term("scum"), toxicity.Term("worthless"), toxicity.Term("lowei", True)]
    auto = toxicity.build(terms)
    rng = np.random.default_rng(1)
    words = {"idiot", "idoit", "idio", "scum", "scom", "wortless", "worthles", "wrthlss", "loweiheit", "loeiheit", "zzz"}
    for t in terms:
        for _ in range(300):
            w = list(t.text)
            for _ in range(rng.integers(0, 4)):
                k = rng.integers(0, len(w) + 1)
                w[k : k + rng.integers(0, 2)] = ["", "x", "e", "i"][rng.integers(0, 4)]
            words.add("".join(w))
    words = sorted(w for w in words if w)
    tokens = toxicity.Tokens([" ".join(words)])
    got = auto.run(tokens.points, tokens.starts, tokens.ends)
    for w, g in zip(words, got):
        near = [(min(distance(w[:n], t.text) for n in range(len(w) + 1)) if t.stem else distance(w, t.text)) for t in terms]
        fits = [d for d, t in zip(near, terms) if d <= toxicity.allowed_errors(t.text)]
        assert (g >= 0) == bool(fits), w


def test_quotation_counts_less():
    terms = [toxicity.Term("idiot")]
    matcher = toxicity.Matcher(toxicity.Model(terms, toxicity.build(terms)))
    x, hits = matcher.features(toxicity.Tokens(["you are an idiot", 'she said "an idiot" there', "nothing here", "an id1ot"]))
    assert hits.tolist() == [1, 1, 0, 1] and x[0, 0] > x[1, 0] > 0 and x[2, 0] == 0 and x[0, 0] > x[3, 0] > 0


def test_toxicity_held_out(spark, docs, none):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op1_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in got)
    assert hit / sum(r.toxic for r in got) > 0.85 and hit / sum(r.predicted for r in got) > 0.9
    model = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_texts(docs, model, keep=[F.col("doc_id")]).where("score between 0 and 1").count() == len(ROWS)
    assert toxicity.score_texts(none, model).count() == 0
    scored = toxicity.score_texts(docs, model)
    assert scored.columns == [*docs.columns, "_score", "predicted", "hits"] and scored.where("score = 0.5 and _score < 0.5").count() == len(ROWS)


# sharding, URLs, mixing, WARC -------------------------------------------------------------------------


def test_lookup_table_is_even_stable_and_moves_little():
    shards = [f"s{i}" for i in range(20)]
    a = sharding.lookup_table(shards, 4099)
    n = np.bincount(a)
    assert n.max() - n.min() <= 1
    names = np.array(shards)[a]
    assert (names == np.array(shards[::-1])[sharding.lookup_table(shards[::-1], 4099)]).all()
    less = np.array(shards[:-1])[sharding.lookup_table(shards[:-1], 4099)]
    kept = names != "s19"
    assert (names[kept] == less[kept]).mean() > 0.8
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 4099)
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 4096)


def test_sharding(docs, none):
    got = sharding.shard_rows(docs, "doc_id", ["a", "b", "c"], slots=101)
    table = sharding.lookup_table(["a", "b", "c"], 101)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, "abc"[table[slot]])
    assert sharding.shard_rows(none, "doc_id", ["a"]).count() == 0


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"), ("https://example.net/de", "example.net", "/de", "net/", "block"), ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        ("http://www.example.com/de/casino", "www.example.com", "/de/casino", "example.com/de/", "block"), ("http://x.org/fr/spam", "x.org", "/fr/spam", "org/fr/", "allow"), ("http://spam-farm.example.com/x", "spam-farm.example.com", "/x", None, "block"), ("http://spammer.example.com/free", "spammer.example.com", "/free", None, "allow"),
        ("http://free-bets.example.com", "free-bets.example.com", "", None, "block"), ("http://free-free.example.com", "free-free.example.com", "", None, "allow"), ("http://x.net", "x.net", "", None, "allow"), ("http://x.com:80/a#b?c", "x.com:80", "/a", None, "allow"),
    ],
)
def test_urls(spark, url, host, path, rule, verdict):
    r = url_filter.filter_urls(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_mixing_budget_and_repetition(spark, none, docs):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = {}
    for _, t, s in rows:
        tokens[s] = tokens.get(s, 0) + len(t.split())
    total = sum(tokens.values())
    got = {r.source: r.t for r in mixing.mix_sources(df, repetition=1.5, seed=3).groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    assert max(got[s] / tokens[s] for s in tokens) < 1.52 and abs(sum(got.values()) - total) < 7 * len(tokens)
    cover = mixing.mix_sources(df, budget="cover", repetition=2.0, seed=3, columns=True)
    assert cover.select("doc_id").distinct().count() == 3000 and cover.columns == df.columns
    assert max(r["count"] for r in cover.groupBy("doc_id").count().collect()) <= 3
    flat = mixing.mix_sources(df, entropy=10.0).groupBy("source").agg(F.sum("tokens").alias("t")).collect()
    assert max(r.t for r in flat) - min(r.t for r in flat) < 10
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(docs, budget="cover", repetition=4.0, columns=True).columns == docs.columns


def test_warc_audit_finds_exactly_the_damage(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}" if i % 5 else None, "ü" * (i % 90) if i % 7 else None, 1) for i in range(3000)] + [(None, None, None, 2)] * 2 + [(None, "http://y", "z", 1), (7, "u", "other", 1), (7, "u", "more", 1)], "page_id long, url string, html string, file int")
    records = warc_audit.to_records(pages)
    assert records.count() == 3005
    both = records.withColumn("copy", warc_audit.damaged("record_id", "record"))
    m = warc_audit.manifest_of(both, replicas={"one": "record", "two": "copy"})
    rows = {(r.file, r.seq): r for r in m.collect()}
    assert len(rows) == 3004  # the repeated row is one record, other contents of one id are records of their own
    want = {k for k, r in rows.items() if r.one_hash != r.two_hash}
    got = {(r.file, r.seq): r.status for r in warc_audit.audit(m).collect()}
    assert {k for k, s in got.items() if s != "ok"} == want and len(want) > 20 and set(got) == set(rows)
    assert set(got.values()) == {"ok", "changed", "short", "missing"}
    for k, r in rows.items():
        assert got[k] == ("ok" if r.one_hash == r.two_hash else "missing" if r.two_hash is None else "short" if r.two_held < r.one_held else "changed")
    assert warc_audit.audit(m.withColumns({"two_hash": F.col("one_hash"), "two_held": F.col("one_held")})).where("status <> 'ok'").count() == 0
    assert warc_audit.audit(m.limit(0)).count() == 0
    spans = m.selectExpr("file", "offset", "offset + length as stop").orderBy("file", "offset").collect()
    assert all(b.offset == (a.stop if a.file == b.file else 0) for a, b in zip(spans, spans[1:]))


def test_warc_audit_of_replicas_kept_apart(spark, monkeypatch):
    """A replica with a longer and an extra record; many files, so that the join alone picks the nodes."""
    monkeypatch.setattr(warc_audit, "FILE_RECORDS", 20)
    monkeypatch.setattr(warc_audit, "PUSHED_FILES", 2)
    records = spark.range(400).selectExpr("id as record_id", "encode(concat('body ', id), 'UTF-8') as record")
    m = warc_audit.manifest_of(records)
    place = m.select("record_id", "file", "seq").join(records, "record_id")
    one = place.where("record_id <> 3").select("file", "seq", "record")
    two = place.select("file", "seq", F.when(F.col("record_id") % 50 == 1, F.concat("record", F.lit(b"!"))).otherwise(F.col("record")).alias("record"))
    held = m.join(warc_audit.holdings(one, "one"), ["file", "seq"], "left").join(warc_audit.holdings(two, "two"), ["file", "seq"], "left")
    got = {r.record_id: r.status for r in warc_audit.audit(held).collect()}
    assert got == {i: "extra" if i == 3 else "long" if i % 50 == 1 else "ok" for i in range(400)}


# arrays, pipeline -------------------------------------------------------------------------------------


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = ["", "a b", "x" * 10, "É à-b_c 9", None, " . "]
    data, offsets = arrays.utf8(pa.array(texts))
    starts, ends, counts = arrays.word_spans(data, offsets)
    want = [re.findall(arrays.WORD_PATTERN, t or "") for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == [w for ws in want for w in ws]
    h = arrays.span_hashes(data, starts, ends)
    flat = [w for ws in want for w in ws]
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == before
        out.write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        kept[name] = docs
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in kept.items()}
    tox = {r.doc_id: r.text for r in kept["toxicity"].collect()}
    largest = {}
    for i, t in tox.items():
        largest[low(t)] = max(i, largest.get(low(t), -1))
    assert sorted(ids["exact_dedup"]) == sorted(largest.values())
    want = brute_join([(i, tox[i]) for i in sorted(ids["exact_dedup"])])
    assert sorted(ids["ngram_jaccard"]) == sorted(i for i, c, _ in want if i == c)
    assert set(ids["mixing"]) == set(ids["ngram_jaccard"]) and len(ids["sentencepiece"]) == len(ids["mixing"])
    back = sentencepiece_dropout.decode_column(kept["sentencepiece"].drop("n_tokens"))
    assert all(r.text == tox[r.doc_id] for r in back.select("doc_id", "text").collect())


def test_pipeline_on_edge_rows(docs, none, spark):
    for d in (docs, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            d = stage(spark, d, SF)
            d.count()
            d = spark.createDataFrame(d.collect(), d.schema)


def test_every_operator_is_registered():
    names = queries.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(queries.oracle_sql()) <= set(names) and os.path.exists(sentencepiece_dropout.MODEL)


# clashing and dotted names, copies, weights --------------------------------------------------------------


@pytest.fixture(scope="module")
def clashing(spark):
    columns = "doc_id long, text string, lang_pred string, score double, tokens string, n_tokens int, n_bytes string, media string, width int, shard string, slot string, kept int, key string, source string, lang string, `a.b` int, `text.x` string"
    rows = [(i, t, "l", 0.5, "t", i, "n", "m", 3, "s", "o", 1, "k", s, "en", 7, "d") for i, t, s in [(1, "one two", "a"), (2, None, "b"), (2, None, "b"), (None, "", None), (3, "drei vier", "a")]]
    return spark.createDataFrame(rows, columns)


def plain(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_operators_keep_clashing_and_dotted_columns(clashing, spark):
    names, own = clashing.columns, [carried.named(c) for c in clashing.columns]
    want = plain(clashing, names)
    model = language_id.train(spark.createDataFrame([(i, f"{w} " * 30, w) for i, w in enumerate(["one", "drei"])], "doc_id long, text string, lang string"))
    found = language_id.identify(clashing, model, keep=own)
    assert found.columns == [*names, "_lang_pred", "_score"] and plain(found, names) == want
    encoded = sentencepiece_dropout.encode_column(clashing, keep=own)
    assert encoded.columns == [*names, "_tokens"] and plain(encoded, names) == want
    decoded = sentencepiece_dropout.decode_column(encoded, tokens_col="_tokens")
    assert decoded.columns == [*names, "_n_tokens", "_text"] and plain(decoded, names) == want
    assert all(r["_text"] == (r["text"] or "") for r in decoded.collect())
    stored = media_jpeg.write_media(clashing, keep=own)
    assert stored.columns == [*names, "_n_bytes", "_media"]
    read = media_jpeg.read_media(stored, media_col="_media")
    assert read.columns[: len(names) + 3] == [*names, "_n_bytes", "_width", "height"] and plain(read, names) == want
    placed = sharding.shard_rows(clashing, "doc_id", ["a", "b"], slots=101)
    assert placed.columns == [*names, "_slot", "_shard"] and plain(placed, names) == want
    scored = toxicity.score_texts(clashing, toxicity.Model([], toxicity.build([])))
    assert scored.columns == [*names, "_score", "predicted", "hits"] and plain(scored, names) == want
    mixed = mixing.mix_sources(clashing, budget="cover", repetition=2.0, columns=True)
    assert mixed.columns == names and set(plain(mixed, names)) == set(want)


def test_pipeline_stages_with_clashing_and_dotted_columns(clashing, spark):
    d = clashing
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        d = stage(spark, d, SF)
        assert k == 4 or d.columns == clashing.columns
        d = spark.createDataFrame(d.collect(), d.schema)
    assert d.columns == ["doc_id", "source", "lang", "tokens", "n_tokens"]


def test_copies_of_a_document_are_encoded_differently(spark):
    text = "the understanding of straightforward internationalization of conversational interfaces " * 20
    docs = spark.createDataFrame([(7, text, "s", "en")] * 4 + [(None, text, "s", "en")] * 2, "doc_id long, text string, source string, lang string")
    rows = corpus_pipeline.encode(spark, docs, SF).collect()
    assert len({tuple(r.tokens) for r in rows}) == 6
    assert {r.text for r in sentencepiece_dropout.decode_column(spark.createDataFrame(rows).drop("n_tokens")).collect()} == {text}


def test_weight_alone_decides_a_url(spark):
    urls = ["http://a.com/betting/lotto", "http://a.com/betting/free", "http://a.com/prize/free", "http://a.com/prize/winner", "http://a.com/prize/winner/free", "http://a.com/betting"]
    rows = sorted(url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect())
    assert [(r.verdict, r.soft_hits, r.soft_weight) for r in rows] == [("block", 2, 3.2), ("block", 2, 2.0), ("allow", 2, 1.2), ("allow", 2, 1.6), ("block", 3, 2.0), ("allow", 1, 1.6)]
    table = spark.createDataFrame([("Lotto", False, 0.2), ("lotto", None, 0.1), ("betting", False, 1.7), ("prize", True, None), (None, True, 1.0), ("", True, 1.0)], "term string, strict boolean, weight double")
    rows = sorted(url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), terms=table).collect())
    assert [r.verdict for r in rows] == ["allow", "allow", "block", "block", "block", "allow"]


def test_a_group_beyond_the_limit_loses_no_link(spark, monkeypatch):
    """Texts chained by one passage, and families among them: the group is banded again at the real parameters."""
    rng = np.random.default_rng(9)
    words = np.array([f"w{i}" for i in range(3000)])
    passage, rows = list(rng.choice(words, 25)), []
    for f in range(400):
        base = list(rng.choice(words, 30))
        for k in range(int(rng.integers(1, 5))):
            t = base + passage
            for at in rng.choice(len(t), int(rng.integers(0, 2)), replace=False):
                t[at] = str(rng.choice(words))
            rows.append((len(rows), " ".join(t)))
    monkeypatch.setattr(ngram_join, "GROUP_BLOCKS", 1)
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 100)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(brute_join(rows))
