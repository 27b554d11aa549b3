"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context windows.

The lexicon has whole words and stems.  It is a small seed list plus what a
bounded sample of labelled rows shows.  One deterministic automaton accepts
every word within a term's edit distance (1 from five letters on, 2 from nine);
it is the subset construction over pairs (trie node, errors so far), and all
distinct words of a chunk run through its table in step.

A hit weighs what its term weighs, less if it stands in quotation marks or
after a reporting word, more if a second person is near.  Sums over the text
and over windows of words feed a logistic regression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import chunk_ranges, span_hashes, utf8
from .carried import Carried
from .storage import cut, scratch

# Seed lexicon, reporting words and words that address a person.
SEED = ("clown", "disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
REPORTING = ("called", "quote", "quoted", "quoting", "said", "says", "wrote", "writes", "sagte", "schrieb", "disait", "dijo")
ADDRESS = ("you", "your", "yours", "u", "ur", "dich", "dein", "toi", "ton", "tu", "usted", "vous")

#: Labelled rows that training reads at most (about), of either class.
TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
#: Share of the sample's toxic texts that a lexicon entry must be found in, and how many entries may explain a text.
LEAST_SHARE, ENOUGH = 0.004, 4
STEM_LETTERS = (4, 8)
WINDOW, NEAR = 30, 6
FEATURES = 4
_MARKS = {"straight": '"', "open": "“«„", "close": "”»"}


def allowed_errors(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass
class Term:
    text: str
    stem: bool = False
    weight: float = 3.0


@dataclass
class Automaton:
    """classes: code point -> symbol class; table: state x class -> state; found: term * 4 + errors at a word's end, -1 none; over: nothing can change any more."""

    classes: dict[int, int]
    table: np.ndarray
    found: np.ndarray
    over: np.ndarray

    def run(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Result of every word; all advance in step and leave once decided."""
        lookup = np.zeros(max(int(points.max(initial=0)), max(self.classes, default=0)) + 1, np.int32)
        for cp, k in self.classes.items():
            lookup[cp] = k
        state = np.ones(len(starts), np.int32)
        live, at = np.flatnonzero(ends > starts), 0
        while len(live):
            s = self.table[state[live], lookup[points[starts[live] + at]]]
            state[live] = s
            at += 1
            live = live[~self.over[s] & (starts[live] + at < ends[live])]
        return self.found[state]


def build(terms: list[Term]) -> Automaton:
    """Intersect the terms' trie with Levenshtein automata, by subset construction.

    A state is a set of (node, errors), with the least errors of each node; a
    stem's end is kept as a node of its own that stays whatever follows.
    """
    children: list[dict[str, int]] = [{}]
    ends: dict[int, int] = {}
    reach = [0]
    for k, term in enumerate(terms):
        node = 0
        reach[0] = max(reach[0], allowed_errors(term.text))
        for c in term.text:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                reach.append(0)
            node = children[node][c]
            reach[node] = max(reach[node], allowed_errors(term.text))
        ends.setdefault(node, k)
    letters = sorted({c for t in terms for c in t.text})
    classes = {ord(c): i + 1 for i, c in enumerate(letters)}

    def close(items: dict[int, int]) -> frozenset:
        """Letters that the word leaves out; stems that are complete."""
        todo = list(items)
        while todo:
            node = todo.pop()
            e = items[node]
            if node < 0:
                continue
            for nxt in children[node].values():
                if e + 1 <= reach[nxt] and items.get(nxt, 99) > e + 1:
                    items[nxt] = e + 1
                    todo.append(nxt)
        stems = []
        for node, e in items.items():
            if node >= 0 and node in ends and terms[ends[node]].stem and e <= allowed_errors(terms[ends[node]].text):
                stems.append((e, ends[node]))
        stems += [(e, -1 - node) for node, e in items.items() if node < 0]
        items = {n: e for n, e in items.items() if n >= 0}
        if stems:
            e, k = min(stems)
            items[-1 - k] = e
        return frozenset(items.items())

    start = close({0: 0})
    number = {frozenset(): 0, start: 1}
    todo, rows = [start], {0: [0] * (len(letters) + 1)}
    while todo:
        now = todo.pop()
        row = []
        for c in [None, *letters]:
            after: dict[int, int] = {}

            def put(node, e):
                if node < 0 or e <= reach[node]:
                    if after.get(node, 99) > e:
                        after[node] = e

            for node, e in now:
                if node < 0:
                    put(node, e)
                    continue
                put(node, e + 1)
                for letter, nxt in children[node].items():
                    put(nxt, e if letter == c else e + 1)
            nxt = close(after)
            if nxt not in number:
                number[nxt] = len(number)
                todo.append(nxt)
            row.append(number[nxt])
        rows[number[now]] = row
    table = np.array([rows[i] for i in range(len(number))], np.int32)
    found, over = np.full(len(number), -1, np.int64), np.zeros(len(number), bool)
    over[0] = True
    for items, i in number.items():
        best = [(e, -1 - node if node < 0 else ends[node]) for node, e in items if node < 0 or (node in ends and e <= allowed_errors(terms[ends[node]].text))]
        if best:
            e, k = min(best)
            found[i] = k * 4 + e
        over[i] |= len(items) > 0 and all(node < 0 for node, _ in items)
    return Automaton(classes, table, found, over)


@dataclass
class Model:
    terms: list[Term]
    automaton: Automaton
    fuzzy: float = 0.5
    #: weight of spelling variants that training has seen, by the hash of the word
    variants: dict[int, float] = field(default_factory=dict)
    intercept: float = -3.0
    slopes: np.ndarray = field(default_factory=lambda: np.array([0.4, 0.8, 0.8, 0.0]))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.intercept + features @ self.slopes, -30, 30)))


_TABLES: dict = {}


def _word_table() -> np.ndarray:
    if "word" not in _TABLES:
        _TABLES["word"] = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
    return _TABLES["word"]


class Tokens:
    """Words of a chunk of texts: code points, spans, hashes and each word's text."""

    def __init__(self, texts: list[str]):
        low = [t.lower() for t in texts]
        self.points = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
        self.borders = np.concatenate([[0], np.cumsum(lengths)])
        edge = np.diff(_word_table()[self.points].astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        self.text = np.searchsorted(self.borders, self.starts, "right") - 1
        self.hashes = span_hashes(self.points, self.starts, self.ends)
        self.counts = np.bincount(self.text, minlength=len(texts))

    def word(self, i: int) -> str:
        return self.points[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")


def _hash_words(words) -> np.ndarray:
    return Tokens(["\n".join(words)]).hashes if words else np.zeros(0, np.uint64)


class Matcher:
    """Hits of chunks of texts; remembers the words it has decided."""

    MOST = 2_000_000

    def __init__(self, model: Model):
        self.model = model
        self.known, self.result = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.reporting, self.address = np.sort(_hash_words(REPORTING)), np.sort(_hash_words(ADDRESS))

    def hits(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are hits, and their results (term * 4 + errors)."""
        words, example, where = np.unique(tokens.hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.MOST:
            self.known, self.result = self.known[:0], self.result[:0]
        seat = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        inside = seat < len(self.known)
        new[inside] = self.known[seat[inside]] != words[inside]
        if new.any():
            found = self.model.automaton.run(tokens.points, tokens.starts[example[new]], tokens.ends[example[new]])
            self.known, self.result = np.insert(self.known, seat[new], words[new]), np.insert(self.result, seat[new], found)
            seat = np.searchsorted(self.known, words)
        result = (self.result[seat] if len(words) else np.zeros(0, np.int64))[where]
        at = np.flatnonzero(result >= 0)
        return at, result[at]

    def weights(self, tokens: Tokens, at: np.ndarray, result: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each hit before and after its context."""
        m = self.model
        own = np.array([t.weight for t in m.terms])
        plain = own[result >> 2] * np.where(result & 3, m.fuzzy ** (result & 3), 1.0)
        for i in np.flatnonzero((result & 3) > 0):
            plain[i] = min(plain[i], m.variants.get(int(tokens.hashes[at[i]]), plain[i]))
        points, place = tokens.points, tokens.starts[at]
        lines = np.flatnonzero(points == 10)
        line = lines[np.searchsorted(lines, place) - 1]
        straight = np.cumsum(points == ord('"'))
        depth = np.cumsum(np.isin(points, [ord(c) for c in _MARKS["open"]])) - np.cumsum(np.isin(points, [ord(c) for c in _MARKS["close"]]))
        quoted = ((straight[place] - straight[line]) % 2 == 1) | (depth[place] - depth[line] > 0)
        low = np.maximum(at - NEAR, np.searchsorted(tokens.text, tokens.text[at], "left"))
        high = np.minimum(at + NEAR + 1, np.searchsorted(tokens.text, tokens.text[at], "right"))

        def near(table, a, b):
            marks = np.concatenate([[0], np.cumsum(_member(tokens.hashes, table))])
            return marks[b] - marks[a] > 0

        factor = np.where(quoted, 0.4, 1.0) * np.where(near(self.reporting, low, at), 0.7, 1.0) * np.where(near(self.address, low, high) & ~quoted, 1.2, 1.0)
        return plain, plain * factor

    def features(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(texts x FEATURES, hits per text): log of the whole evidence, log of the best window, distinct words hit, log of evidence per 100 words."""
        n = len(tokens.counts)
        out, hits = np.zeros((n, FEATURES)), np.zeros(n, np.int64)
        at, result = self.hits(tokens)
        if not len(at):
            return out, hits
        _, weight = self.weights(tokens, at, result)
        text = tokens.text[at]
        hits = np.bincount(text, minlength=n)
        total = np.bincount(text, weights=weight, minlength=n)
        sums = np.concatenate([[0.0], np.cumsum(weight)])
        stop = np.minimum(np.searchsorted(at, at + WINDOW), np.searchsorted(text, text, "right"))
        window = np.zeros(n)
        np.maximum.at(window, text, sums[stop] - sums[np.arange(len(at))])
        some = weight > 0
        pair = np.unique(text[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ tokens.hashes[at[some]], return_index=True)[1]
        distinct = np.bincount(text[some][pair], minlength=n)
        out[:, 0], out[:, 1], out[:, 2] = np.log1p(total), np.log1p(window), np.log1p(distinct)
        out[:, 3] = np.log1p(100.0 * total / np.maximum(tokens.counts, 1))
        return out, hits


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _pieces(batches, column: str):
    for batch in batches:
        k = batch.schema.get_field_index(column)
        _, offsets = utf8(batch.column(k))
        for a, b in chunk_ranges(offsets):
            part = batch.slice(a, b - a)
            yield part, [v or "" for v in part.column(k).to_pylist()]


def _forms(word: str):
    """The word and the stems it may bear."""
    yield word + "$"
    for k in range(STEM_LETTERS[0], min(STEM_LETTERS[1], len(word)) + 1):
        yield word[:k]


def _sample(docs: DataFrame, labels: DataFrame, text_col: str) -> tuple[DataFrame, dict]:
    """Distinct labelled texts, about TOXIC_ROWS and CLEAN_ROWS of them at most, by hash; and the share taken of each class."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    size = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, most / max(1, size.get(k, 0))) for k, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))}
    buckets = 1 << 20
    under = F.when(F.col("toxic") == 1, int(share[1] * buckets)).otherwise(int(share[0] * buckets))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) < under)
    rows = docs.where(F.col(text_col).isNotNull()).select("doc_id", F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most about 12,000 rows
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))  # one text an id, so that repeated ids add no rows
    return cut(rows.groupBy(F.xxhash64("text").alias("_same")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("_same"), "toxic-sample"), share


def learn_terms(sample: DataFrame, counts: dict) -> list[Term]:
    """Seed terms, and words and stems that stand out in the toxic texts of the sample.

    An entry must help at least LEAST_SHARE of the toxic texts (three at least),
    of those that fewer than ENOUGH entries explain, so there are ENOUGH / LEAST_SHARE
    learned entries at most.  Counts are of the bounded sample, all of its forms.
    """
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    terms = {t: Term(t) for t in SEED}
    if not n_toxic or not n_clean:
        return list(terms.values())
    least = max(3, int(LEAST_SHARE * n_toxic))

    def forms(batches):
        for _, texts in _pieces(batches, "text"):
            seen: dict[str, int] = {}
            for t in texts:
                for f in {f for w in set(_words(t)) for f in _forms(w)}:
                    seen[f] = seen.get(f, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["form", "n"])

    toxic = sample.where("toxic = 1").mapInArrow(forms, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    often = {r["form"]: r["n"] for r in toxic.collect()}
    wanted = sample.sparkSession.sparkContext.broadcast(set(often))

    def clean_forms(batches):
        for _, texts in _pieces(batches, "text"):
            seen: dict[str, int] = {}
            for t in texts:
                for f in {f for w in set(_words(t)) for f in _forms(w)} & wanted.value:
                    seen[f] = seen.get(f, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["form", "n"])

    clean = {r["form"]: r["n"] for r in sample.where("toxic = 0").mapInArrow(clean_forms, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).collect()}
    good = {}
    for form, n in often.items():
        other = clean.get(form, 0)
        expected = n_toxic * (n + other) / (n_toxic + n_clean)
        ratio = ((n + 0.5) / n_toxic) / ((other + 0.5) / n_clean)
        if n > expected and (n - expected) ** 2 / expected > 30 and ratio >= 4:
            good[form] = (n, other)
    # a stem says no more than the word, or the longer stem, that makes it up
    keep = sample.sparkSession.sparkContext.broadcast(set(good))

    def members(batches):
        for _, texts in _pieces(batches, "text"):
            found = [sorted({f for w in set(_words(t)) for f in _forms(w)} & keep.value) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["forms"])

    texts = [set(r["forms"]) for r in sample.where("toxic = 1").mapInArrow(members, "forms array<string>").collect()]
    holders: dict[str, set[int]] = {f: set() for f in good}
    for i, forms_of in enumerate(texts):
        for f in forms_of:
            holders[f].add(i)
    covered = [0] * len(texts)
    order = sorted(good, key=lambda f: (-(good[f][0] / n_toxic - 2 * good[f][1] / n_clean), not f.endswith("$"), -len(f), f))
    chosen: list[str] = []
    for f in order:
        bare = f.rstrip("$")
        if any(bare.startswith(c) or (not f.endswith("$") and c.startswith(bare)) for c in (x.rstrip("$") for x in chosen)):
            continue
        fresh = [i for i in holders[f] if covered[i] < ENOUGH]
        if len(fresh) < least:
            continue
        for i in holders[f]:
            covered[i] += 1
        chosen.append(f)
    for f in chosen:
        terms[f.rstrip("$")] = Term(f.rstrip("$"), not f.endswith("$"))
    return list(terms.values())


def _words(text: str) -> list[str]:
    tokens = Tokens([text])
    points, spans = tokens.points, zip(tokens.starts.tolist(), tokens.ends.tolist())
    whole = points.tobytes().decode("utf-32-le", "surrogatepass")
    return [whole[a:b] for a, b in spans]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> tuple[float, np.ndarray]:
    """Newton's method with a ridge on the slopes; slopes of evidence are kept from turning negative."""
    z = np.hstack([np.ones((len(x), 1)), x])
    free = np.ones(z.shape[1], bool)
    beta = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ beta, -30, 30)))
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        gradient = z.T @ (y - p) - penalty * beta
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.zeros_like(beta)
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        beta = beta + np.clip(step, -5, 5)
        negative = (beta < 0) & (np.arange(len(beta)) > 0)
        if negative.any():
            beta[negative], free[negative] = 0.0, False
        elif np.abs(step).max() < 1e-7:
            break
    return float(beta[0]), beta[1:]


def train(docs: DataFrame, labels: DataFrame, *, text_col: str = "text") -> Model:
    """Lexicon, weights and regression from a sample of labelled rows, about TOXIC_ROWS and CLEAN_ROWS at most.

    Rows without a label or text are left out, equal texts count once.  Without
    both classes, the seed lexicon and the default coefficients stand.
    """
    with scratch(docs.sparkSession):
        return _trained(*_sample(docs, labels, text_col))


def _trained(sample: DataFrame, share: dict) -> Model:
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    terms = learn_terms(sample, counts)
    model = Model(terms, build(terms))
    if not counts.get(1) or not counts.get(0):
        return model

    def spelled(batches):
        matcher = Matcher(model)
        for part, texts in _pieces(batches, "text"):
            tokens = Tokens(texts)
            at, result = matcher.hits(tokens)
            toxic = np.array(part.column(part.schema.get_field_index("toxic")).to_pylist(), np.int64)
            mark = toxic[tokens.text[at]]
            yield pa.RecordBatch.from_arrays([pa.array(tokens.hashes[at].view(np.int64)), pa.array(result), pa.array(mark)], names=["word", "result", "toxic"])

    seen = sample.mapInArrow(spelled, "word long, result long, toxic long")
    seen = seen.groupBy("word", "result").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).collect()  # words near the lexicon in the sample only
    by_term = np.zeros((len(terms), 2))
    fuzzy = np.array([1.0, 1.0])
    for r in seen:
        k, errors = r["result"] >> 2, r["result"] & 3
        if errors == 0:
            by_term[k] += (r["t"], r["c"])
        else:
            fuzzy += (min(r["t"], 3), min(r["c"], 3))

    def odds(t, c):
        return float(np.clip(np.log(((t + 0.5) / counts[1]) / ((c + 0.5) / counts[0])), 0.0, 6.0))

    for k, term in enumerate(terms):
        if by_term[k].sum() > 0:
            term.weight = odds(*by_term[k])
    model.fuzzy = float(np.clip(fuzzy[0] / fuzzy.sum(), 0.05, 0.8))
    model.variants = {r["word"] & 0xFFFFFFFFFFFFFFFF: odds(r["t"], r["c"]) for r in seen if r["result"] & 3}

    def measured(batches):
        matcher = Matcher(model)
        for part, texts in _pieces(batches, "text"):
            x, _ = matcher.features(Tokens(texts))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("toxic")).cast(pa.int32()), *(pa.array(x[:, k]) for k in range(FEATURES))], names=["toxic", *(f"x{k}" for k in range(FEATURES))])

    rows = sample.mapInArrow(measured, "toxic int, " + ", ".join(f"x{k} double" for k in range(FEATURES))).toPandas()
    model.intercept, model.slopes = fit_logistic(rows[[f"x{k}" for k in range(FEATURES)]].to_numpy(), rows["toxic"].to_numpy(float))
    model.intercept += float(np.log(share[0] / share[1]))  # the classes were taken at different shares
    return model


OUTPUT = ("score", "predicted", "hits")


def score_texts(docs: DataFrame, model: Model, *, keep: list[Column] | None = None, text_col: str = "text", threshold: float = 0.7, names: tuple[str, str, str] = OUTPUT) -> DataFrame:
    """``keep`` columns (None: all), then score, predicted, hits (or ``names``) for every row of ``docs``; whole texts.

    Kept columns are never replaced: where one bears such a name already, the
    output has underscores before its own.  Null and empty texts, and texts
    without a hit, have the score of no evidence.  Repeated rows score alike, and
    equal scores are equal whatever the order; an empty table gives no rows.
    """
    # the model is shipped by value with the function: its terms (bounded by learn_terms) and their automaton
    carried = Carried(docs, keep)
    narrow = carried.narrow(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = Carried.schema(narrow, f"`{names[0]}` double, `{names[1]}` int, `{names[2]}` int")

    def run(batches):
        matcher = Matcher(model)
        for part, texts in _pieces(batches, "text"):
            x, hits = matcher.features(Tokens(texts))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(hits.astype(np.int32))], names=["kept", *names])

    return carried.restored(narrow.mapInArrow(run, kind))
