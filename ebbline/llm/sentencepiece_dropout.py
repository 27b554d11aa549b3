"""SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary comes from a public SentencePiece BPE model; merging is done
here.  Each word starts as single characters; the agenda holds its adjacent
pairs that form a piece, and the best-scored pair is merged first.  With
dropout, a keyed hash of (seed, row id, place of the word, span) decides for each
candidate once whether it is skipped, so every occurrence draws for itself.
A word's merging without dropout is remembered, with its candidates; occurrences
that skip none of these share it, all others are merged one by one.  All words
of a chunk advance in step: one merge per word and turn, in numpy.

Pieces of this kind of model hold the space mark at their start only, so words
(with the space marks before them) merge independently of each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import mix64, span_hashes, text_chunks
from .carried import Carried, named

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: A word beyond this many characters is merged with an agenda of its own instead of in step with others.
LONG_WORD = 48
#: Rank of pairs that form no piece, worse than any.
NO_PIECE = 1 << 30
#: Words of which a task remembers the segmentation.
MOST_WORDS = 1_000_000


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, -1, np.int64)
        self.special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        spelled = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif i not in self.special:
                spelled[piece] = i
        if (self.byte_ids < 0).any():
            raise ValueError("a model with byte fallback is needed")
        score = np.array([model.get_score(i) for i in range(n)])
        self.order = np.argsort(-score, kind="stable")  # ids from the best score on; a rank is a place among them
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)
        # symbols: ids of pieces, and beyond them characters that are no piece
        self.n = n
        self.single = {p: i for p, i in spelled.items() if len(p) == 1}
        pairs = {}
        for piece, i in spelled.items():
            for k in range(1, len(piece)):
                a, b = spelled.get(piece[:k]), spelled.get(piece[k:])
                if a is not None and b is not None:
                    pairs[(a << 21) | b] = i
        # open addressing over the pairs, each entry key and rank in one number: one gather finds most of them
        bits = max(4, int(len(pairs) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.entries = np.full(1 << bits, -1, np.int64)
        keys = np.array(sorted(pairs), np.int64)
        entries = (keys << 20) | self.rank[np.array([pairs[k] for k in keys.tolist()], np.int64)]
        at = self._slot(keys)
        while len(at):  # the first of each free slot goes in, the others try the next one
            free = np.flatnonzero(self.entries[at] < 0)
            goes = free[np.unique(at[free], return_index=True)[1]]
            self.entries[at[goes]] = entries[goes]
            stay = np.ones(len(at), bool)
            stay[goes] = False
            at, entries = (at[stay] + 1) & ((1 << bits) - 1), entries[stay]
        texts = []
        for i, piece in enumerate(self.pieces):
            texts.append(b"" if i in self.special else bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(MARK, " ").encode())
        self.bytes_of = np.frombuffer(b"".join(texts), np.uint8)
        self.byte_from = np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that two symbols form, NO_PIECE if none."""
        key = (a << 21) | b  # symbols that are no piece are beyond n, so no entry has them
        at = self._slot(key)
        seen = self.entries[at]
        out = np.where((seen >> 20) == key, seen & 0xFFFFF, NO_PIECE)
        open_ = np.flatnonzero((seen >= 0) & (out == NO_PIECE))
        size = len(self.entries) - 1
        at = at[open_]
        while len(open_):
            at = (at + 1) & size
            seen = self.entries[at]
            hit = (seen >> 20) == key[open_]
            out[open_[hit]] = seen[hit] & 0xFFFFF
            more = (seen >= 0) & ~hit
            open_, at = open_[more], at[more]
        return out


_LOADED: dict[str, Vocabulary] = {}


def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary of a model file, read once by each worker process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def keyed(seed: int) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(str(seed).encode(), digest_size=8).digest(), "big"))


def _span_hash(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix64(((start.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)) + np.uint64(1))


def _skips(key: np.ndarray, span: np.ndarray, dropout: float) -> np.ndarray:
    return (mix64(span ^ key) >> np.uint64(11)).astype(np.float64) < dropout * 2.0**53


def dropped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidate that joins [start, middle) and [middle, end) of the word of this key is skipped."""
    return _skips(key, _span_hash(start, middle, end), dropout)


def _code(row, start, middle, end):
    return (((row << 6 | start) << 6) | middle) << 6 | end


def merge_words(vocabulary: Vocabulary, symbols: np.ndarray, lengths: np.ndarray, keys: np.ndarray, dropout: float, offered: list | None = None, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all words, in rows with -1 in between, and their numbers.

    ``symbols`` has a row per word, padded with -1; ``keys`` a hash per word.
    Candidates are looked up once, when a merge makes them; a turn takes the
    best of each word, the leftmost among equals.  ``offered`` collects the codes
    of all candidates looked up without dropout; ``first`` has the ranks of the
    neighbours that the words begin with, if they are known.
    """
    n, width = symbols.shape
    sym = symbols.ravel().copy()
    after, before = np.tile(np.arange(1, width + 1, dtype=np.int32), n), np.tile(np.arange(-1, width - 1, dtype=np.int32), n)
    rank = np.full(n * width, NO_PIECE, np.int32)

    def offer(word, at, nxt, found):
        """Put the pairs of these neighbours on the agenda, where they have a piece and are not skipped."""
        rank[at] = found
        if dropout > 0 or offered is not None:
            ok = np.flatnonzero(found < NO_PIECE)
            word, at, nxt = word[ok], at[ok], nxt[ok]
            row = word * width
            if dropout > 0:
                rank[at[dropped(keys[word], at - row, nxt - row, after[nxt], dropout)]] = NO_PIECE
            else:
                offered.append(_code(word, at - row, nxt - row, after[nxt]))

    if width > 1 and first is None:
        at = np.flatnonzero(np.tile(np.arange(width), n) + 1 < np.repeat(lengths, width))
        offer(at // width, at, at + 1, vocabulary.merged(sym[at], sym[at + 1]))
    elif width > 1:
        at = np.flatnonzero(first.ravel() < NO_PIECE)
        offer(at // width, at, at + 1, first.ravel()[at])
    table, live = rank.reshape(n, width), np.flatnonzero(lengths > 1)
    while len(live):
        part = table[live] if len(live) < n else table
        at = live * width + part.argmin(axis=1)
        best = rank[at]
        some = best < NO_PIECE
        live, at, best = live[some], at[some], best[some]
        row = live * width
        gone = row + after[at]
        sym[at], sym[gone] = vocabulary.order[best], -1
        rank[at] = rank[gone] = NO_PIECE
        far = after[gone]
        after[at] = far
        inner, left = far < lengths[live], before[at]
        nxt, prior = (row + far)[inner], left >= 0
        before[nxt] = (at - row)[inner]
        begin, end = np.concatenate([at[inner], (row + left)[prior]]), np.concatenate([nxt, at[prior]])
        offer(np.concatenate([live[inner], live[prior]]), begin, end, vocabulary.merged(sym[begin], sym[end]))
    out = sym.reshape(n, width)
    return out, (out >= 0).sum(axis=1)


def merge_long(vocabulary: Vocabulary, symbols: np.ndarray, key: np.uint64, dropout: float) -> np.ndarray:
    """One long word, with a heap as its agenda and links between the symbols."""
    import heapq

    n = len(symbols)
    sym, before, after = symbols.copy(), np.arange(n) - 1, np.arange(n) + 1
    stop = np.arange(n) + 1
    heap = []

    def offer(left):
        found = vocabulary.merged(sym[left], sym[after[left]])
        ok = found < NO_PIECE
        if dropout > 0:
            ok &= ~dropped(np.full(len(left), key), left, after[left], stop[after[left]], dropout)
        for i, best in zip(left[ok].tolist(), found[ok].tolist()):
            heapq.heappush(heap, (best, i, int(after[i]), int(stop[after[i]])))

    offer(np.arange(n - 1))
    while heap:
        best, i, j, end = heapq.heappop(heap)
        if sym[i] < 0 or sym[j] < 0 or after[i] != j or stop[j] != end or stop[i] != j:
            continue
        sym[i], sym[j] = vocabulary.order[best], -1
        stop[i], after[i] = end, after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(np.array([i]))
        if before[i] >= 0:
            offer(np.array([before[i]]))
    return sym[sym >= 0]


class Encoder:
    """Encodes chunks of texts; ids are those of the model, losslessly decodable."""

    def __init__(self, path: str = MODEL, *, dropout: float = 0.0, seed: int = 0):
        self.vocabulary = vocabulary_of(path)
        self.dropout, self.key = dropout, keyed(seed)
        self.table = None
        self._forget()

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbol of each code point: a piece of one character, else n + code point (bytes later)."""
        if self.table is None:
            self.table = np.arange(0x110000, dtype=np.int64) + self.vocabulary.n
            for c, i in self.vocabulary.single.items():
                self.table[ord(c)] = i
            self.table[ord(" ")] = self.vocabulary.single.get(MARK, self.table[ord(MARK)])
            # a space mark of the text itself is spelled in bytes, so that it does not come back as a space
            self.table[ord(MARK)] = self.vocabulary.n + ord(MARK)
            self.seat = np.zeros(len(self.table) + self.vocabulary.n, np.int64)
        return self.table[points]

    def _forget(self) -> None:
        self.known, self.at, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.span, self.span_at, self.spans = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _pairs(self, symbols: np.ndarray) -> np.ndarray:
        """Rank of the piece that each symbol forms with the next one.

        A chunk of few different symbols has each pair looked up once.
        """
        present = np.zeros(len(self.seat), bool)
        present[symbols] = True
        here = np.flatnonzero(present)
        k = len(here)
        if k * k > len(symbols):
            found = self.vocabulary.merged(symbols[:-1], symbols[1:])
        else:
            self.seat[here] = np.arange(k)
            code = self.seat[symbols]
            found = self.vocabulary.merged(np.repeat(here, k), np.tile(here, k)).astype(np.int32)[code[:-1] * k + code[1:]]
        return np.append(found, NO_PIECE).astype(np.int32)

    def _each(self, symbols: np.ndarray, pairs: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray, dropout: float, chosen: np.ndarray, offered: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merged symbols of the chosen words, where among them each word's lie (0 for the other words), and how many.

        ``symbols`` ends with -1 and ``pairs`` with NO_PIECE, which stand behind the end of every word.
        ``offered`` collects (words, number of their candidates, span hashes) of words that are not long.
        """
        number, at, flat, total = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), [np.zeros(0, np.int32)], 0
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, LONG_WORD)):
            band = chosen[(sizes[chosen] > low) & (sizes[chosen] <= high)]
            for a in range(0, len(band), 4096):
                part = band[a : a + 4096]
                codes: list | None = None if offered is None else [np.zeros(0, np.int64)]
                column = np.arange(high)[None, :]
                at_part = np.where(column < sizes[part][:, None], starts[part][:, None] + column, len(symbols) - 1)
                done, count = merge_words(self.vocabulary, symbols[at_part], sizes[part], keys[part], dropout, codes, pairs[at_part])
                flat.append(done[done >= 0].astype(np.int32))
                number[part], at[part] = count, total + np.cumsum(count) - count
                total += int(count.sum())
                if offered is not None:
                    every = np.sort(np.concatenate(codes))
                    offered.append((part, np.bincount(every >> 18, minlength=len(part)), _span_hash((every >> 12) & 63, (every >> 6) & 63, every & 63)))
        for i in chosen[sizes[chosen] > LONG_WORD]:
            done = merge_long(self.vocabulary, symbols[starts[i] : starts[i] + sizes[i]], keys[i], dropout)
            flat.append(done.astype(np.int32))
            number[i], at[i] = len(done), total
            total += len(done)
        return np.concatenate(flat), at, number

    def _merged(self, words: np.ndarray, symbols: np.ndarray, pairs: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Seats of the distinct words, merged without dropout; words seen before are not merged again.

        ``at`` and ``number`` say where in ``ids`` a seat's symbols lie, ``span_at`` and ``spans`` where in
        ``span`` its candidates do.
        """
        if len(self.known) > MOST_WORDS:
            self._forget()
        seat = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        inside = seat < len(self.known)
        new[inside] = self.known[seat[inside]] != words[inside]
        fresh = np.flatnonzero(new)
        if len(fresh):
            offered: list | None = [] if self.dropout > 0 else None
            # under dropout, occurrences of long words are merged one by one
            flat, at, number = self._each(symbols, pairs, starts, sizes, np.zeros(len(words), np.uint64), 0.0, fresh if offered is None else fresh[sizes[fresh] <= LONG_WORD], offered)
            spans, span_at, held, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [self.span], len(self.span)
            for part, count, span in offered or ():
                spans[part], span_at[part] = count, total + np.cumsum(count) - count
                total += len(span)
                held.append(span)
            at += len(self.ids)
            self.ids, self.span = np.concatenate([self.ids, flat]), np.concatenate(held)
            where = seat[fresh]
            self.known = np.insert(self.known, where, words[fresh])
            self.at, self.number = np.insert(self.at, where, at[fresh]), np.insert(self.number, where, number[fresh])
            self.span_at, self.spans = np.insert(self.span_at, where, span_at[fresh]), np.insert(self.spans, where, spans[fresh])
            seat = np.searchsorted(self.known, words)
        return seat

    def _skipping(self, seat: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether each occurrence skips a candidate of its word's merging without dropout."""
        out = np.zeros(len(seat), bool)
        for a in range(0, len(seat), 16_384):
            part, key = seat[a : a + 16_384], keys[a : a + 16_384]
            count = self.spans[part]
            owner = np.repeat(np.arange(len(part)), count)
            take = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count - self.span_at[part], count)
            out[a + owner[_skips(key[owner], self.span[take], self.dropout)]] = True
        return out

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their borders.  ``keys`` (a hash per text) and a word's place key its dropout."""
        v = self.vocabulary
        joined = "".join(" " + t for t in texts)  # the model's dummy prefix
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        first = np.concatenate([[0], np.cumsum(lengths)])
        space = points == 32
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        opens[first[:-1]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(points))
        size = ends - starts
        symbols = self._symbols(points)
        pairs = self._pairs(symbols) if len(symbols) else np.zeros(0, np.int32)
        pairs[ends - 1] = NO_PIECE
        symbols, pairs = np.append(symbols, -1), np.append(pairs, np.int32(NO_PIECE))
        owner = np.searchsorted(first, starts, "right") - 1
        word = span_hashes(points, starts, ends)
        distinct, example, where = np.unique(word, return_index=True, return_inverse=True)
        seat = self._merged(distinct, symbols, pairs, starts[example], size[example])[where]
        at, counts, merged = self.at[seat], self.number[seat], self.ids
        if self.dropout > 0:
            inner = np.arange(len(starts)) - np.searchsorted(owner, owner)
            own = mix64(mix64(keys[owner].astype(np.uint64) ^ self.key) + inner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            alone = self._skipping(seat, own) | (size > LONG_WORD)
            flat, at_own, number = self._each(symbols, pairs, starts, size, own, self.dropout, np.flatnonzero(alone))
            at, counts = np.where(alone, at_own + len(merged), at), np.where(alone, number, counts)
            merged = np.concatenate([merged, flat])
        total = np.cumsum(counts)
        take = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - counts, counts) + np.repeat(at, counts)
        out = merged[take].astype(np.int64)
        per_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        odd = np.flatnonzero(out >= v.n)
        if len(odd):  # characters that are no piece: their bytes
            text_of = np.repeat(np.arange(len(texts)), per_text)
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in (out[odd] - v.n).tolist()]
            widths = np.ones(len(out), np.int64)
            widths[odd] = [len(s) for s in spelled]
            place = np.cumsum(widths) - widths
            grown = np.zeros(int(widths.sum()), np.int64)
            grown[place] = out
            raw = np.frombuffer(b"".join(spelled), np.uint8)
            inner = np.arange(len(raw)) - np.repeat(np.cumsum(widths[odd]) - widths[odd], widths[odd])
            grown[np.repeat(place[odd], widths[odd]) + inner] = v.byte_ids[raw]
            per_text = np.bincount(text_of, weights=widths, minlength=len(texts)).astype(np.int64)
            out = grown
        return out.astype(np.int32), np.concatenate([[0], np.cumsum(per_text)])


def decode(vocabulary: Vocabulary, ids: np.ndarray, borders: np.ndarray) -> list[bytes]:
    """UTF-8 bytes of each text: the pieces' bytes without the dummy prefix."""
    ids = ids.astype(np.int64)
    begin, width = vocabulary.byte_from[ids], vocabulary.byte_from[ids + 1] - vocabulary.byte_from[ids]
    total = np.concatenate([[0], np.cumsum(width)])
    take = np.arange(int(total[-1])) - np.repeat(total[:-1], width) + np.repeat(begin, width)
    raw = vocabulary.bytes_of[take].tobytes()
    out = []
    for a, b in zip(total[borders[:-1]], total[borders[1:]]):
        piece = raw[a:b]
        out.append(piece[1:] if piece[:1] == b" " else piece)
    return out


def encode_column(docs: DataFrame, *, keep: list, path: str = MODEL, dropout: float = 0.1, seed: int = 0, id_col: str | Column = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` columns and tokens (array of ids) of every whole text.

    A word's segmentation depends on the seed, the row's id, the word's place and
    the word, so runs are repeatable and every occurrence draws for itself.  With dropout 0 the ids are the
    model's own.  A null text counts as empty; an empty text has the ids of the
    dummy prefix; characters outside the vocabulary, control-token strings and
    the space mark itself are spelled so that decoding gives them back.  Null ids
    count as one id.  Repeated rows are encoded alike (``id_col`` may be an
    expression that tells them apart); no rows give no rows.  Kept columns may
    have any name; tokens gets underscores before it where one is called so.
    """
    carried = Carried(docs, keep)
    narrow = carried.narrow(F.xxhash64(F.lit(seed), F.col(id_col) if isinstance(id_col, str) else id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        encoder = Encoder(path, dropout=dropout, seed=seed)
        for part, _, _ in text_chunks(batches):
            keys = part.column(part.num_columns - 2).to_numpy(zero_copy_only=False).view(np.uint64)
            ids, borders = encoder.encode(part.column(part.num_columns - 1).to_pylist(), keys)
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.ListArray.from_arrays(borders.astype(np.int32), pa.array(ids))], names=["kept", "tokens"])

    return carried.restored(narrow.mapInArrow(run, Carried.schema(narrow, "tokens array<int>")))


def decode_column(encoded: DataFrame, *, path: str = MODEL, tokens_col: str = "tokens") -> DataFrame:
    """The other columns of ``encoded``, n_tokens and text, from its tokens; null tokens give a null text.

    n_tokens and text get underscores before them where another column bears their name.
    """
    carried = Carried(encoded, [named(c) for c in encoded.columns if c != tokens_col])
    ordered = carried.narrow(named(tokens_col).alias("tokens"))

    def run(batches):
        vocabulary = vocabulary_of(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                tokens = part.column(part.num_columns - 1)
                lengths = np.array([0 if n is None else n for n in tokens.value_lengths().to_pylist()], np.int64)
                ids = tokens.flatten().to_numpy(zero_copy_only=False)
                texts = decode(vocabulary, ids, np.concatenate([[0], np.cumsum(lengths)]))
                null = tokens.is_null().to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([None if x else int(n) for x, n in zip(null, lengths)], pa.int32()), pa.array([None if x else t.decode("utf-8", "replace") for x, t in zip(null, texts)], pa.string())], names=["kept", "n_tokens", "text"]
                )

    return carried.restored(ordered.mapInArrow(run, Carried.schema(ordered, "n_tokens int, text string")))
