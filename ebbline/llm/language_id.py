"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (1 to 4 letters, word borders
included) in order of frequency.  A text gets the language whose profile its
own most frequent n-grams are least out of place in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import chunk_ranges, utf8
from .carried import Carried
from .storage import cut, scratch

#: Profile lengths, of a language and of a text; labelled rows of each language that training reads at most (about).
LANGUAGE_RANKS, TEXT_RANKS, TRAIN_ROWS, MOST_LANGUAGES = 1000, 300, 2000, 1000
MAX_N, BITS = 4, 15
#: Letters beyond the most frequent ones in training share one code.
ALPHABET = (1 << BITS) - 3
UNKNOWN = "und"

_LETTERS: list = []


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def code_points(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, a 0 around each, and the texts' borders."""
    low = [t.lower() for t in texts]
    joined = "\0" + "\0".join(low) + "\0"
    lengths = np.fromiter((len(t) + 1 for t in low), dtype=np.int64, count=len(low))
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Packed n-grams of letter codes (0: word border), -1 where a border stands inside or alone."""
    size = max(0, len(codes) - n + 1)
    out, inner = codes[:size].astype(np.int64), np.ones(size, dtype=bool)
    for k in range(1, n):
        nxt = codes[k : k + size]
        if k < n - 1:
            inner &= nxt != 0
        out = (out << BITS) | nxt
    bare = (codes[:size] == 0) if n == 1 else (codes[:size] == 0) & (codes[n - 1 : n - 1 + size] == 0) if n == 2 else None
    if bare is not None:
        inner &= ~bare
    return np.where(inner, out | (n << (4 * BITS)), -1)


def _codes(points: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    return alphabet[points]


def _alphabet(letters: list[int]) -> np.ndarray:
    """Code of every code point: 0 no letter, 2... the given letters, 1 any other letter."""
    out = letter_table().astype(np.int32)
    for i, cp in enumerate(letters[:ALPHABET]):
        out[cp] = i + 2
    return out


def _pieces(batch, column: str):
    """Lists of texts of about a megabyte."""
    values = batch.column(batch.schema.get_field_index(column))
    _, offsets = utf8(values)
    for a, b in chunk_ranges(offsets):
        yield a, b, [v or "" for v in values.slice(a, b - a).to_pylist()]


def text_profile(own: np.ndarray, most: int = TEXT_RANKS) -> np.ndarray:
    """The most frequent n-grams of one text, ties by code."""
    own = np.sort(own)
    new = np.empty(len(own), dtype=bool)
    new[:1] = True
    np.not_equal(own[1:], own[:-1], out=new[1:])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(own)))
    return own[at][np.argsort(-counts, kind="stable")[:most]]


class Profiles:
    """Rank tables of the learned languages."""

    def __init__(self, letters: list[int], ranked: dict[str, list[int]]):
        self.letters = letters
        self.names = sorted(ranked)
        every = sorted({g for r in ranked.values() for g in r})
        self.keys = np.array(every or [-2], dtype=np.int64)
        self.ranks = np.full((len(self.keys), max(1, len(self.names))), -1, dtype=np.int32)
        place = {g: i for i, g in enumerate(every)}
        for k, name in enumerate(self.names):
            for r, g in enumerate(ranked[name]):
                self.ranks[place[g], k] = r

    def predict(self, profile: np.ndarray) -> tuple[str, float]:
        """The nearest language and how much nearer it is than the next: 0.5 (no difference) to 1."""
        if not len(profile) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.keys, profile), len(self.keys) - 1)
        known = self.keys[at] == profile
        ranks = np.where(known[:, None], self.ranks[at], -1)
        mine = np.arange(len(profile))[:, None]
        apart = np.where(ranks >= 0, np.minimum(np.abs(ranks - mine), LANGUAGE_RANKS), LANGUAGE_RANKS).sum(axis=0)
        order = np.argsort(apart, kind="stable")
        best = int(apart[order[0]])
        rest = int(apart[order[1]]) if len(order) > 1 else LANGUAGE_RANKS * len(profile)
        return self.names[order[0]], 0.5 + 0.5 * (rest - best) / max(rest, 1)


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS, key: Column | None = None) -> Profiles:
    """Profiles of every language in ``docs``.

    About ``rows`` rows of each language are read, those with the least hash of
    ``key`` (the id's if None): a documented bound, not a cut of any text, and a
    rare language is read whole.  Equal texts of a language count once.  Of more
    than MOST_LANGUAGES values of the column, those of the most rows (the first
    by name among equals) are learned.  Rows with null text or language are left
    out; rows of a null id are drawn by their text.  Letters and n-grams are counted in
    the tasks and summed by Spark; the driver receives a count and the top ranks
    of each language only.
    """
    key = key if key is not None else F.coalesce(F.col("doc_id").cast("string"), F.col(text_col))
    marked = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r["n"] for r in marked.groupBy(lang_col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), lang_col).limit(MOST_LANGUAGES).collect()}
    if not sizes:
        return Profiles([], {})
    with scratch(docs.sparkSession):
        return _trained(marked, sizes, key, rows, text_col, lang_col)


def _trained(marked: DataFrame, sizes: dict, key: Column, rows: int, text_col: str, lang_col: str) -> Profiles:
    buckets = 1 << 20
    share = F.create_map(*[F.lit(v) for lang, n in sorted(sizes.items()) for v in (lang, buckets if n <= rows else max(1, buckets * rows // n))])
    sample = marked.where(F.pmod(F.xxhash64(key), F.lit(buckets)) < share[F.col(lang_col)])
    sample = sample.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sample = cut(sample.groupBy("lang", F.xxhash64("text").alias("_same")).agg(F.min("text").alias("text")).select("text", "lang"), "language-sample")

    def letters(batches):
        for batch in batches:
            for _, _, texts in _pieces(batch, "text"):
                points, _ = code_points(texts)
                found, counts = np.unique(points[letter_table()[points]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["letter", "n"])

    top = sample.mapInArrow(letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter").limit(ALPHABET).collect()
    alphabet_letters = [r["letter"] for r in top]

    def count(batches):
        alphabet = _alphabet(alphabet_letters)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b, texts in _pieces(batch, "text"):
                points, borders = code_points(texts)
                codes = _codes(points, alphabet)
                for lang in sorted(set(langs[a:b])):
                    parts = [codes[borders[i - a] : borders[i - a + 1] + 1] for i in range(a, b) if langs[i] == lang]
                    codes_of = np.concatenate(parts)
                    every = np.concatenate([grams(codes_of, n) for n in range(1, MAX_N + 1)])
                    found, counts = np.unique(every[every >= 0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("r", rank).where(F.col("r") <= LANGUAGE_RANKS).orderBy("lang", "r").collect()
    ranked: dict[str, list[int]] = {}
    for r in best:
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(alphabet_letters, ranked)


def identify(docs: DataFrame, profiles: Profiles, *, text_col: str = "text", keep: list[Column] = ()) -> DataFrame:
    """``keep`` columns, lang_pred, score for every row of ``docs``; whole texts.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text if nothing was learned.  Ties go to the first language by name.
    Repeated rows give equal results; an empty table gives none.  Kept columns
    may have any name; lang_pred and score get underscores before them where a
    kept column bears theirs.
    """
    model = profiles  # shipped by value with the function: at most LANGUAGE_RANKS entries a language
    carried = Carried(docs, keep)
    narrow = carried.narrow(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        alphabet = _alphabet(model.letters)
        for batch in batches:
            for a, b, texts in _pieces(batch, "text"):
                points, borders = code_points(texts)
                codes = _codes(points, alphabet)
                every = [grams(codes, n) for n in range(1, MAX_N + 1)]
                names, scores = [], []
                for i in range(b - a):
                    lo, hi = borders[i], borders[i + 1] + 1
                    own = np.concatenate([e[lo : hi - n] for n, e in enumerate(every)])
                    name, score = model.predict(text_profile(own[own >= 0]))
                    names.append(name)
                    scores.append(score)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["kept", "lang_pred", "score"])

    return carried.restored(narrow.mapInArrow(run, Carried.schema(narrow, "lang_pred string, score double")))
