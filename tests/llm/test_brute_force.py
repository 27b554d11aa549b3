"""Operators that SQL cannot express, against plain Python written for the purpose."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbline.llm import arrays, language_id, media_jpeg, mixing, ngram_join, sentencepiece_dropout, sharding, toxicity, url_filter
from tests.llm.test_operators import brute_join, distance, words_of

SF = "/root/testdata/sf0.001"


# sentencepiece: merge-dropout by plain loops -----------------------------------------------------------


def plain_segments(pieces: dict, word: str, skipped) -> list[str]:
    """Best-scored adjacent pair first, leftmost among equals; ``skipped`` decides a candidate by its span."""
    parts, at = list(word), list(range(len(word) + 1))
    while True:
        best = None
        for k in range(len(parts) - 1):
            made = parts[k] + parts[k + 1]
            if made in pieces and not skipped(at[k], at[k + 1], at[k + 2]):
                if best is None or pieces[made] > pieces[parts[best] + parts[best + 1]]:
                    best = k
        if best is None:
            return parts
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
        del at[best + 1]


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_merge_dropout_is_that_of_plain_loops(dropout):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_dropout.MODEL)
    pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    encoder = sentencepiece_dropout.Encoder(dropout=dropout, seed=11)
    text = "the understanding of straightforward tokenization the the in an international internationalization-and-localization-of-conversational-interfaces of the"
    keys = np.arange(40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ids, borders = encoder.encode([text] * len(keys), keys)
    ways = set()
    for n, key in enumerate(keys):
        want = []
        for place, word in enumerate(text.split(" ")):
            own = arrays.mix64(arrays.mix64(np.array([key]) ^ encoder.key) + np.uint64(place) * np.uint64(0xD6E8FEB86659FD93))

            def skipped(a, b, c):
                return bool(sentencepiece_dropout.dropped(own, np.array([a]), np.array([b]), np.array([c]), dropout)[0])

            want += plain_segments(pieces, "▁" + word, skipped)
        got = [model.id_to_piece(int(i)) for i in ids[borders[n] : borders[n + 1]]]
        assert got == want
        ways.add(tuple(got))
    assert len(ways) > 30


# language id: out-of-place distance by hand -------------------------------------------------------------


def plain_ranks(text: str) -> dict[str, int]:
    counts: dict[str, int] = {}
    run = ""
    for c in text.lower() + " ":
        if c.isalpha():
            run += c
            continue
        marked = f"|{run}|" if run else ""
        for n in range(1, language_id.MAX_N + 1):
            for k in range(len(marked) - n + 1):
                g = marked[k : k + n]
                if g != "|":
                    counts[g] = counts.get(g, 0) + 1
        run = ""
    return counts


def test_language_distance_is_the_plain_one(spark):
    rows = [(1, "der hund und die katze und der mann gehen in den wald hinein", "de"), (2, "the dog and the cat and the man go into the wood together", "en"), (3, "le chien et le chat et les hommes vont dans la forêt ensemble", "fr"), (4, "der baum und das haus", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df)
    counts = {lang: {} for lang in ("de", "en", "fr")}
    for _, t, lang in rows:
        for g, n in plain_ranks(t).items():
            counts[lang][g] = counts[lang].get(g, 0) + n
    code = {ord(c): i + 2 for i, c in enumerate(map(chr, model.letters))}

    def packed(g: str) -> int:
        out = 0
        for c in g:
            out = (out << language_id.BITS) | (0 if c == "|" else code.get(ord(c), 1))
        return out | (len(g) << (4 * language_id.BITS))

    # ties go by the n-grams' codes, in profiles and texts alike
    ranked = {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], packed(x[0])))][: language_id.LANGUAGE_RANKS] for lang, c in counts.items()}
    tests = ["der mann und die katze", "the man and the cat in the wood", "les hommes et le chat dans la forêt", "katze cat chat", "x", "zzz qqq"]
    got = {r.text: r for r in language_id.identify(spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "doc_id long, text string"), model, keep=[F.col("text")]).collect()}
    for t in tests:
        mine = [g for g, _ in sorted(plain_ranks(t).items(), key=lambda x: (-x[1], packed(x[0])))][: language_id.TEXT_RANKS]
        apart = {}
        for lang, r in ranked.items():
            place = {packed(g): i for i, g in enumerate(r)}
            apart[lang] = sum(min(abs(place[packed(g)] - i), language_id.LANGUAGE_RANKS) if packed(g) in place else language_id.LANGUAGE_RANKS for i, g in enumerate(mine))
        order = sorted(apart, key=lambda x: (apart[x], x))
        assert got[t].lang_pred == order[0]
        best, second = apart[order[0]], apart[order[1]]
        assert got[t].score == pytest.approx(0.5 + 0.5 * (second - best) / max(second, 1))


def test_language_sample_is_bounded_by_language(spark):
    rows = [(i, f"der hund nummer {i} und die katze", "de") for i in range(3000)] + [(5000 + i, "the dog and the cat", "en") for i in range(3)] + [(9000, None, "fr"), (9001, "le chat", None)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=100)
    assert model.names == ["de", "en"]  # the rare language is not lost among the frequent one's rows


# media --------------------------------------------------------------------------------------------------


def test_thumbnail_hashes_are_those_of_single_images():
    rng = np.random.default_rng(5)
    texts = [b"", b"a" * 63, rng.bytes(64), rng.bytes(9 * 64), rng.bytes(100 * 64), bytes(range(256)) * 7, b"lorem ipsum " * 400]
    found = media_jpeg.decode(media_jpeg.encode([media_jpeg.payload_of(t) for t in texts]))
    together = media_jpeg.thumbnail_hashes(found)
    for (parsed, c), got in zip(found, together):
        image = [[min(255, max(0, round(float(c[y * parsed.across + x, 0]) * parsed.quant[parsed.components[0][3]] / 8 + 128))) for x in range(parsed.across)] for y in range(parsed.down)]
        cells: dict = {}
        for y, row in enumerate(image):
            for x, v in enumerate(row):
                cells.setdefault((min(y * 8 // parsed.down, 7), min(x * 8 // parsed.across, 7)), []).append(v)
        whole = sum(map(sum, image)) / (parsed.down * parsed.across)
        means = [sum(cells[k]) / len(cells[k]) if (k := (y, x)) in cells else whole for y in range(8) for x in range(8)]
        middle = sum(means) / 64
        bits = "".join("1" if m > middle + 1e-9 else "0" for m in means)
        near = sum(abs(m - middle) < 1e-6 for m in means)  # cells at the mean itself may round either way
        assert bin(int(got, 16) ^ int(bits, 2)).count("1") <= near
        assert got == media_jpeg.average_hash(media_jpeg.thumbnail(parsed, c))


def test_single_block_path_is_the_general_one(monkeypatch):
    rng = np.random.default_rng(6)
    files = media_jpeg.encode([media_jpeg.payload_of(p) for p in (b"", rng.bytes(5000), b"\xff" * 300, b"abc" * 500, b"\0" * 640)])
    fast = media_jpeg.decode(files)
    # a table that no scan uses sends the same scans through the general decoder
    extra = b"\xff\xc4\x00\x14\x03" + bytes([1] + [0] * 15) + b"\x00"
    slow = media_jpeg.decode([f[:2] + extra + f[2:] for f in files])
    for (_, a), (_, b) in zip(fast, slow):
        assert (a == b).all()


def test_media_in_stretches_is_media_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    payloads = [media_jpeg.payload_of(p) for p in (b"", rng.bytes(9000), b"abc" * 1500, b"\xff" * 700, "größer ".encode() * 900)]
    whole = media_jpeg.encode(payloads)
    want = [c for _, c in media_jpeg.decode(whole)]
    for blocks in (1, 7, 64):
        monkeypatch.setattr(media_jpeg, "STRETCH", blocks)
        assert media_jpeg.encode(payloads) == whole
        assert all((a == b).all() for a, (_, b) in zip(want, media_jpeg.decode(whole)))


# sharding -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n, slots", [(1, 101), (7, 101), (10, 997)])
def test_lookup_table_is_filled_in_turns(n, slots):
    shards = [f"node-{(k * 37) % 100}" for k in range(n)]

    def h(name, salt):
        return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")

    wishes = {s: [(h(s, "offset") % slots + j * (h(s, "skip") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards}
    assert all(sorted(w) == list(range(slots)) for w in wishes.values())
    owner: dict[int, str] = {}
    while len(owner) < slots:
        for s in sorted(shards):
            free = next((w for w in wishes[s] if w not in owner), None)
            if free is not None:
                owner[free] = s
    assert [shards[k] for k in sharding.lookup_table(shards, slots)] == [owner[i] for i in range(slots)]


# URL terms ------------------------------------------------------------------------------------------------


def test_url_weights_by_plain_search(spark):
    terms = [url_filter.Term("bad", True), url_filter.Term("free", False, 0.5), url_filter.Term("win", False, 0.5), url_filter.Term("bet", False, 1.5), url_filter.Term("bet-now", False, 1.0), url_filter.Term("free", False, 0.25)]
    urls = [None, "", "http://bad.com/", "http://notbad.com/bad_", "http://x.com/FREE-win", "http://x.com/free/bet", "http://x.com/bet-now", "http://x.com/bet/bet/bet", "http://x.com/freebet", "x free win bet", "HTTP://X.COM/BAD", "http://x.com/ßbetß/free"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] * 2 + [(None, "http://x.net/", "clash")], "page_id long, url string, host string")
    weight = {t.text: max(u.weight for u in terms if u.text == t.text) for t in terms}

    def stands(u, t):
        return any(u[k : k + len(t)] == t and not (k and u[k - 1].isascii() and u[k - 1].isalnum()) and not (u[k + len(t) : k + len(t) + 1].isascii() and u[k + len(t) : k + len(t) + 1].isalnum()) for k in range(len(u)))

    got = url_filter.filter_urls(df, terms=terms).collect()
    assert len(got) == len(urls) * 2 + 1
    for r in got:
        u = (urls[r.page_id] or "" if r.page_id is not None else "http://x.net/").translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
        soft = [t for t in ("free", "win", "bet", "bet-now") if stands(u, t)]
        strict = int(stands(u, "bad"))
        assert (r.strict_hits, r.soft_hits, r.soft_weight) == (strict, len(soft), sum(weight[t] for t in soft)), u
        if r.rule is None:
            assert r.verdict == ("block" if strict or (len(soft) > 1 and r.soft_weight >= 2) else "allow")
    assert url_filter.filter_urls(df.limit(0)).count() == 0


# toxicity -------------------------------------------------------------------------------------------------


def plain_features(model, text: str):
    """The features of one text by loops over its words."""
    low = text.lower()
    words, run = [], None
    for i, c in enumerate(low + " "):
        if c.isalnum():
            run = i if run is None else run
        elif run is not None:
            words.append((run, low[run:i]))
            run = None
    hits = []
    for n, (place, w) in enumerate(words):
        found = []
        for k, t in enumerate(model.terms):
            ways = [w[:m] for m in range(len(w) + 1)] if t.stem else [w]
            errors = min(distance(x, t.text) for x in ways)
            if errors <= toxicity.allowed_errors(t.text):
                found.append((errors, k))
        if not found:
            continue
        errors, k = min(found)
        line = low.rfind("\n", 0, place) + 1
        before = low[line:place]
        quoted = before.count('"') % 2 == 1 or sum(before.count(c) for c in "“«„") > sum(before.count(c) for c in "”»")
        reported = any(x in toxicity.REPORTING for _, x in words[max(0, n - toxicity.NEAR) : n])
        addressed = any(x in toxicity.ADDRESS for _, x in words[max(0, n - toxicity.NEAR) : n + toxicity.NEAR + 1])
        weight = model.terms[k].weight * model.fuzzy**errors * (0.4 if quoted else 1) * (0.7 if reported else 1) * (1.2 if addressed and not quoted else 1)
        hits.append((n, w, weight, k, errors))
    total = sum(h[2] for h in hits)
    window = max((sum(h[2] for h in hits if a <= h[0] < a + toxicity.WINDOW) for a in [h[0] for h in hits]), default=0.0)
    distinct = len({h[1] for h in hits if h[2] > 0})
    return [math.log1p(total), math.log1p(window), math.log1p(distinct), math.log1p(100 * total / max(1, len(words)))], hits


def test_toxicity_features_are_those_of_plain_loops(spark):
    terms = [toxicity.Term("idiot", weight=2.0), toxicity.Term("moron", weight=3.0), toxicity.Term("worthless", weight=1.5), toxicity.Term("pathet", True, 2.5), toxicity.Term("scum", weight=4.0)]
    model = toxicity.Model(terms, toxicity.build(terms))
    filler = " ".join(f"word{i}" for i in range(40))
    texts = [
        "", "nothing at all", "you are an idiot", 'He said "you idiot" to them\nand an idiot', "idoit moron w0rthless patheticly pathtic scum scam", f"scum {filler} moron idiot {filler} worthless", "“idiot” and idiot, « moron » or moron",
        "she wrote that the moron called one two three four five six idiot", "idiot " * 50, "ıdiot İdiot ÏDIOT idiot's id-iot", "„scum” scum “ moron\nmoron ” idiot",
    ]
    x, hits = toxicity.Matcher(model).features(toxicity.Tokens(texts))
    for k, t in enumerate(texts):
        want, found = plain_features(model, t)
        assert hits[k] == len(found) and x[k] == pytest.approx(want), t
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None), (1, texts[1])], "doc_id long, text string")
    for r in toxicity.score_texts(df, model).collect():
        want, _ = plain_features(model, r.text or "")
        score = 1 / (1 + math.exp(-(model.intercept + float(np.dot(want, model.slopes)))))
        assert r.score == pytest.approx(score) and r.predicted == int(score >= 0.7)


def test_automaton_names_term_and_errors():
    terms = [toxicity.Term("idiot"), toxicity.Term("moron"), toxicity.Term("worthless"), toxicity.Term("pathet", True)]
    auto = toxicity.build(terms)
    words = sorted({"idiot", "idoit", "diot", "idiots", "moran", "mormon", "worthles", "wrthles", "worthlessly", "patheticness", "pathticness", "xpathet", "pthet", "mroon", "zzz"})
    tokens = toxicity.Tokens([" ".join(words)])
    for w, g in zip(words, auto.run(tokens.points, tokens.starts, tokens.ends)):
        fits = []
        for k, t in enumerate(terms):
            errors = min(distance(w[:n], t.text) for n in range(len(w) + 1)) if t.stem else distance(w, t.text)
            if errors <= toxicity.allowed_errors(t.text):
                fits.append((errors, k))
        assert (g & 3, g >> 2) == min(fits) if fits else g < 0, w


# mixing -----------------------------------------------------------------------------------------------------


def test_entropy_below_the_natural_one_is_met(spark):
    df = spark.createDataFrame([(i, "w " * 10, s) for i, s in enumerate(["a"] * 60 + ["b"] * 30 + ["c"] * 10)], "doc_id long, text string, source string")
    totals = df.groupBy("source").agg(F.sum(mixing.n_tokens()).alias("tokens"), F.count("*").alias("docs"))
    for target in (0.4, 1.0, 1.4):
        a = mixing.find_exponent(totals, budget=1000.0, entropy=target)
        w = [s**a for s in (0.6, 0.3, 0.1)]
        assert -sum(x / sum(w) * math.log2(x / sum(w)) for x in w) == pytest.approx(target, abs=1e-6)
        assert (a > 1) == (target < 1.2)
    drawn = mixing.mix_sources(spark.createDataFrame([(None, "a b", "x"), (None, "c", "x"), (1, "d", "y"), (1, "d", "y"), (1, "d", None)], "doc_id long, text string, source string"), repetition=4.0, budget="cover", columns=True).collect()
    assert {(r.doc_id, r.text, r.source) for r in drawn} == {(None, "a b", "x"), (None, "c", "x"), (1, "d", "y"), (1, "d", None)}
    assert sum(r.source == "y" for r in drawn) >= 2


# n-gram join: measured recall -------------------------------------------------------------------------------


def test_recall_on_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(docs).collect()}
    want = {d: (c, n) for d, c, n in brute_join([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])}
    links = sum(n for _, n in want.values())
    assert links > 100 and sum(got[d][1] for d in want) / links >= 0.999
    assert sum(got[d] == want[d] for d in want) / len(want) >= 0.999


# pipeline: columns that bear the operators' own names ---------------------------------------------------------


def test_pipeline_keeps_every_column_by_value(spark):
    own = "score predicted hits _text _key block node root tokens _source _id epoch kept keep_id text_id class_id".split()
    base = spark.read.parquet(f"{SF}/documents.parquet")
    docs = base.select("*", *[F.concat(F.lit(c + ":"), F.col("doc_id").cast("string")).alias(c) for c in own])
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [*base.columns, *own]
        rows = docs.collect()
        assert rows and all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in own)
        docs = spark.createDataFrame(rows, docs.schema)
    assert len(words_of(rows[0].text)) >= 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() == len(rows)
