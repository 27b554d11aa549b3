"""Baseline JPEG media columns: write, parse, Huffman-decode, thumbnails and hashes.

The writer stores a byte payload without loss: every 8x8 block carries 64
bytes as its quantised coefficients (a byte is read as a signed number, the
quantisation table is all ones), so a standard baseline decoder gets the same
coefficients back.  Each block is a restart interval of its own.  That lets the
reader decode all intervals of many files in step, one symbol per interval and
turn, in numpy; files without restart intervals are one interval each.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import text_chunks
from .carried import Carried, named

# The format's example Huffman table for luminance DC (code counts per length, then symbols).
DC_COUNTS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_SYMBOLS = tuple(range(12))
BLOCK = 64
#: Blocks that are coded or decoded at once, so that the numpy temporaries of a very long text stay small.
STRETCH = 1 << 14


def _ac_table() -> tuple[tuple[int, ...], tuple[int, ...]]:
    """A table for byte payloads: 7-bit values first, then end of block, then all other run/size symbols."""
    short = [0x07, 0x06, 0x00, 0x08, 0x05]
    rest = [(run << 4) | size for run in range(16) for size in range(1, 11)] + [0xF0]
    rest = [s for s in rest if s not in short]
    counts = [0] * 16
    for length in (1, 2, 3, 4, 5):
        counts[length - 1] = 1
    counts[13 - 1] = len(rest)  # 2**13 * 2**-5 = 256 codes are free at this length
    return tuple(counts), tuple(short + rest)


AC_COUNTS, AC_SYMBOLS = _ac_table()


def zigzag() -> np.ndarray:
    """Natural index of the k-th coefficient of the zigzag scan."""
    order = sorted(range(BLOCK), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8))
    return np.array(order)


def codes_of(counts, symbols) -> tuple[np.ndarray, np.ndarray]:
    """Canonical code and length of each symbol (0 length: none)."""
    code, at = 0, 0
    codes, lengths = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            codes[symbols[at]], lengths[symbols[at]] = code, length
            code += 1
            at += 1
        code <<= 1
    return codes, lengths


def lookup_of(counts, symbols) -> np.ndarray:
    """For the next 16 bits, symbol << 8 | length; 0 where no code fits."""
    out = np.zeros(1 << 16, np.int32)
    codes, lengths = codes_of(counts, symbols)
    for s in symbols:
        n = int(lengths[s])
        a = int(codes[s]) << (16 - n)
        out[a : a + (1 << (16 - n))] = (s << 8) | n
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def shape_of(blocks: int) -> tuple[int, int]:
    """Blocks across and down, about a square."""
    across = max(1, int(np.ceil(np.sqrt(blocks))))
    return across, -(-blocks // across)


def _header(across: int, down: int, payload: int) -> bytes:
    return (
        b"\xff\xd8"
        + _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0")
        + _segment(0xFE, b"payload=%d" % payload)
        + _segment(0xDB, b"\0" + b"\x01" * BLOCK)
        + _segment(0xC0, b"\x08" + (8 * down).to_bytes(2, "big") + (8 * across).to_bytes(2, "big") + b"\x01\x01\x11\0")
        + _segment(0xC4, b"\x00" + bytes(DC_COUNTS) + bytes(DC_SYMBOLS))
        + _segment(0xC4, b"\x10" + bytes(AC_COUNTS) + bytes(AC_SYMBOLS))
        + _segment(0xDD, b"\0\x01")
        + _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")
    )


def _token_tables() -> tuple[np.ndarray, np.ndarray]:
    """Bits and width of each token: AC at run << 8 | byte, DC at 4096 + byte; a value's own bits follow its code."""
    value = np.arange(256, dtype=np.int64)
    value = np.where(value > 127, value - 256, value)
    size = np.array([abs(int(v)).bit_length() for v in value])
    own = np.where(value < 0, value - 1, value) & ((1 << size) - 1)
    bits, widths = np.zeros(17 * 256, np.int64), np.zeros(17 * 256, np.int64)
    for group, (counts, symbols) in enumerate([(AC_COUNTS, AC_SYMBOLS)] * 16 + [(DC_COUNTS, DC_SYMBOLS)]):
        codes, lengths = codes_of(counts, symbols)
        symbol = size + (group << 4 if group < 16 else 0)
        bits[group * 256 : group * 256 + 256] = (codes[symbol] << size) | own
        widths[group * 256 : group * 256 + 256] = lengths[symbol] + size
    return bits.astype(np.uint64), widths.astype(np.int32)


_TOKENS: list = []


def _scans(coefficients: np.ndarray, number: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of all blocks, each an interval with its restart marker, and where each block ends.

    ``number`` counts the blocks of a file; its ``last`` one has no marker.
    """
    if not _TOKENS:
        _TOKENS.extend(_token_tables())
    token_bits, token_widths = _TOKENS
    ac_code, ac_len = codes_of(AC_COUNTS, AC_SYMBOLS)
    flat = coefficients.reshape(-1).view(np.uint8)
    there = flat != 0
    there[::BLOCK] = True  # every block has a DC token, whatever its value
    at = np.flatnonzero(there).astype(np.int32)
    opens = np.flatnonzero((at & (BLOCK - 1)) == 0)
    run = np.empty(len(at), np.int32)
    run[0] = 0
    np.subtract(at[1:], at[:-1], out=run[1:])
    run[1:] -= 1
    run[opens] = 0
    code = ((run & 15) << 8) | flat[at]
    code[opens] = flat[at[opens]] + np.int32(4096)
    token, width = token_bits[code], token_widths[code]
    skips = run >> 4
    whole_width = width + skips * np.int32(ac_len[0xF0])
    closes = np.append(opens[1:], len(at)) - 1
    short = closes[(at[closes] & (BLOCK - 1)) < BLOCK - 1]
    whole_width[short] += np.int32(ac_len[0])
    ends = np.cumsum(whole_width, dtype=np.int64)
    begins = ends - whole_width
    block_bits = ends[closes] - begins[opens]
    whole = (block_bits + 7) // 8
    start = np.concatenate([[0], np.cumsum(whole)])
    base = start[:-1] * 8 - begins[opens]
    per = closes - opens + 1
    shift_all = np.repeat(base, per)
    place = begins + shift_all + skips * np.int32(ac_len[0xF0])
    tokens, widths, places = [token], [width], [place]
    if skips.any():
        where = np.repeat(np.flatnonzero(skips), skips[skips > 0])
        turn = np.arange(len(where)) - np.searchsorted(where, where)
        tokens.append(np.full(len(where), ac_code[0xF0], np.uint64))
        widths.append(np.full(len(where), ac_len[0xF0], np.int32))
        places.append(begins[where] + shift_all[where] + turn * ac_len[0xF0])
    if len(short):
        tokens.append(np.full(len(short), ac_code[0], np.uint64))
        widths.append(np.full(len(short), ac_len[0], np.int32))
        places.append(ends[short] + shift_all[short] - ac_len[0])
    pad = whole * 8 - block_bits
    some = pad > 0
    tokens.append(((1 << pad[some]) - 1).astype(np.uint64))
    widths.append(pad[some].astype(np.int32))
    places.append(start[:-1][some] * 8 + block_bits[some])
    token, width, place = np.concatenate(tokens), np.concatenate(widths), np.concatenate(places)
    word = place >> 5
    wide = token << (64 - (place & 31) - width).astype(np.uint64)
    size32 = int(start[-1] // 4 + 3)
    packed = np.bincount(word, weights=(wide >> np.uint64(32)).astype(np.float64), minlength=size32)
    packed += np.bincount(word + 1, weights=(wide & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size32)
    raw = packed.astype(np.uint64).astype(">u4").view(np.uint8)[: start[-1]]
    marks = np.where(last, 0, 2)
    # a stuffed zero after each FF, and a restart marker after each block but a file's last
    stuffed = np.flatnonzero(raw == 0xFF)
    gaps = np.zeros(len(raw) + 1, np.int8)
    gaps[stuffed + 1] += 1
    gaps[start[1:]] += marks.astype(np.int8)
    place = np.cumsum(gaps, dtype=np.int32)
    place += np.arange(len(raw) + 1, dtype=np.int32)
    out = np.zeros(int(place[-1]), np.uint8)
    out[place[:-1]] = raw
    after = place[start[1:]] - marks  # place after each block's last byte
    marked = np.flatnonzero(~last)
    out[after[marked]] = 0xFF
    out[after[marked] + 1] = 0xD0 + (number[marked] & 7)
    return out, after + marks


def encode(payloads: list[bytes]) -> list[bytes]:
    """A JPEG for each payload; its length is a positive multiple of 64."""
    shapes = [shape_of(len(p) // BLOCK) for p in payloads]
    first = np.concatenate([[0], np.cumsum([a * d for a, d in shapes])])
    values = np.zeros((int(first[-1]), BLOCK), np.int8)
    flat = values.reshape(-1)
    for p, at in zip(payloads, first):
        if len(p) % BLOCK or not p:
            raise ValueError("a payload's length must be a positive multiple of 64")
        flat[at * BLOCK : at * BLOCK + len(p)] = np.frombuffer(p, np.int8)
    number = np.arange(len(values)) - np.repeat(first[:-1], np.diff(first))
    last = np.zeros(len(values), bool)
    last[first[1:] - 1] = True
    pieces, ends, at = [], [np.zeros(0, np.int64)], 0
    for a in range(0, len(values), STRETCH):
        scan, end = _scans(values[a : a + STRETCH], number[a : a + STRETCH], last[a : a + STRETCH])
        pieces.append(scan.tobytes())
        ends.append(end + at)
        at += len(scan)
    data, borders = b"".join(pieces), np.concatenate([[0], np.concatenate(ends)[first[1:] - 1]])
    return [_header(a, d, len(p)) + data[borders[i] : borders[i + 1]] + b"\xff\xd9" for i, (p, (a, d)) in enumerate(zip(payloads, shapes))]


class Parsed:
    """What the markers of one file say, and where its scan lies."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("no start of image")
        self.tables, self.quant, self.interval, self.comment = {}, {}, 0, b""
        self.components = None
        at = 2
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("a marker was expected")
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xC0:
                if body[0] != 8:
                    raise ValueError("samples are not of 8 bits")
                self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
                self.components = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(body[5])]
            elif marker in (0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF):
                raise ValueError("not baseline")
            elif marker == 0xC4:
                while body:
                    counts = tuple(body[1:17])
                    self.tables[body[0]] = (counts, tuple(body[17 : 17 + sum(counts)]))
                    body = body[17 + sum(counts) :]
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = int.from_bytes(body[1:3], "big") if wide else body[1]
                    body = body[1 + BLOCK * (1 + wide) :]
            elif marker == 0xDD:
                self.interval = int.from_bytes(body, "big")
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xDA:
                if self.components is None or body[0] != len(self.components):
                    raise ValueError("the scan must hold all components")
                chosen = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
                self.selectors = [(chosen[c[0]] >> 4, 0x10 | (chosen[c[0]] & 15)) for c in self.components]
                self.scan = at
                break
        most_h, most_v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        if len(self.components) == 1:
            most_h = most_v = 1
            self.components = [(self.components[0][0], 1, 1, self.components[0][3])]
        self.across, self.down = -(-self.width // (8 * most_h)), -(-self.height // (8 * most_v))
        self.units = [k for k, c in enumerate(self.components) for _ in range(c[1] * c[2])]


def _steps_of(look: np.ndarray, dc: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the next 16 bits: value, coefficients to go on (129 at the end of block) and bits used; 0 bits if 16 do not settle it."""
    seen = np.arange(1 << 16)
    width, symbol = look & 255, look >> 8
    size = symbol & 15
    run = np.zeros_like(symbol) if dc else symbol >> 4
    bits = (seen >> np.maximum(16 - width - size, 0)) & ((1 << size) - 1)
    value = np.where((size > 0) & (bits < (1 << size) >> 1), bits - (1 << size) + 1, bits)
    go = np.where((size == 0) & (run < 15) & (not dc), 129, run + 1)
    used = np.where((width > 0) & (width + size <= 16), width + size, 0)
    return value.astype(np.int16), go.astype(np.int32), used.astype(np.int64)


def _single_blocks(out, window, bit, end, first, dc_look, ac_look) -> None:
    """Decode intervals of one block each: all their DC values, then the AC coefficients in step."""
    base, k = first * BLOCK, np.zeros(len(bit), np.int64)
    tables = {True: _steps_of(dc_look, True), False: _steps_of(ac_look, False)}
    dc = True
    while len(base):
        value, go, used = tables[dc]
        at = np.minimum(bit >> 3, len(window) - 1)
        seen = window[at] << (bit & 7).astype(np.uint64)
        key = (seen >> np.uint64(48)).astype(np.int64)
        v, step, n = value[key], go[key], used[key]
        slow = np.flatnonzero(n == 0)
        if len(slow):
            entry = (dc_look if dc else ac_look)[key[slow]]
            width, size = entry & 255, (entry >> 8) & 15
            if (width == 0).any():
                raise ValueError("no such Huffman code")
            bits = ((seen[slow] << width.astype(np.uint64)) >> (np.uint64(63) - size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
            v[slow] = np.where((size > 0) & (bits < (1 << size) >> 1), bits - (1 << size) + 1, bits)
            n[slow] = width + size
        k += step
        bit = bit + n
        # an end of block and a run of 16 zeros write a zero where a zero stands
        out[base + np.minimum(k, BLOCK) - 1] = v
        dc = False
        over = k >= BLOCK
        if over.any():
            if ((k > BLOCK) & (k < 129)).any():
                raise ValueError("a coefficient lies outside its block")
            if (bit[over] > end[over]).any():
                raise ValueError("the scan is too short")
            keep = ~over
            base, k, bit, end = base[keep], k[keep], bit[keep], end[keep]


def _window(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; the last eight places have none."""
    out = np.zeros(len(data) - 8, np.uint64)
    for k in range(8):
        out |= data[k : len(data) - 8 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def decode(files: list[bytes]) -> list[tuple[Parsed, np.ndarray]]:
    """Parsed markers and coefficients (blocks in scan order, zigzag order within) of each file.

    Intervals of all files are decoded in step; a wrong code or a short scan is an error.
    """
    parsed = [Parsed(f) for f in files]
    tables: dict[tuple, int] = {}
    lanes_from, lanes_to, lane_units, lane_first, lane_file = [], [], [], [], []
    pieces, at, blocks = [], 0, 0
    for n, (p, f) in enumerate(zip(parsed, files)):
        raw = np.frombuffer(f, np.uint8)[p.scan :]
        ff = np.flatnonzero(raw[:-1] == 0xFF)
        nxt = raw[ff + 1]
        stop = ff[(nxt == 0xD9)]
        stop = int(stop[0]) if len(stop) else len(raw)
        ff, nxt = ff[ff < stop], nxt[ff < stop]
        restart = ff[(nxt >= 0xD0) & (nxt <= 0xD7)]
        drop = np.zeros(stop, bool)
        drop[ff[nxt == 0] + 1] = True
        drop[restart] = drop[restart + 1] = True
        dropped = np.flatnonzero(drop)
        borders, size = restart - np.searchsorted(dropped, restart), stop - len(dropped)
        starts, ends = np.concatenate([[0], borders]), np.concatenate([borders, [size]])
        mcus = p.across * p.down
        per = p.interval or mcus
        if len(starts) != -(-mcus // per):
            raise ValueError("the number of restart intervals is wrong")
        count = np.full(len(starts), per)
        count[-1] = mcus - per * (len(starts) - 1)
        pieces.append(raw[:stop][~drop])
        lanes_from.append(starts + at)
        lanes_to.append(ends + at)
        lane_units.append(count * len(p.units))
        lane_first.append(blocks + np.arange(len(starts)) * per * len(p.units))
        lane_file.append(np.full(len(starts), n))
        at += size
        blocks += mcus * len(p.units)
        for t in p.tables.values():
            tables.setdefault(t, len(tables))
    data = np.concatenate([*pieces, np.full(16, 0xFF, np.uint8)])
    looks = np.stack([lookup_of(*t) for t in tables])
    most = max(len(p.units) for p in parsed)
    which = np.zeros((len(parsed), most, 2), np.int64)
    component = np.zeros((len(parsed), most), np.int64)
    for n, p in enumerate(parsed):
        for u, c in enumerate(p.units):
            which[n, u] = [tables[p.tables[s]] for s in p.selectors[c]]
            component[n, u] = c
    per_mcu = np.array([len(p.units) for p in parsed])
    bit = np.concatenate(lanes_from) * 8
    end = np.concatenate(lanes_to) * 8
    units, first, file = np.concatenate(lane_units), np.concatenate(lane_first), np.concatenate(lane_file)
    out = np.zeros(blocks * BLOCK + BLOCK, np.int16)
    sizes = [p.across * p.down * len(p.units) for p in parsed]
    if most == 1 and len(tables) == 2 and (units == 1).all():
        for a in range(0, len(bit), STRETCH):
            part = slice(a, a + STRETCH)
            at, to = int(bit[a]) // 8, int(end[part][-1]) // 8
            _single_blocks(out, _window(data[at : to + 16]), bit[part] - 8 * at, end[part] - 8 * at, first[part], looks[which[0, 0, 0]], looks[which[0, 0, 1]])
        return list(zip(parsed, np.split(out[: blocks * BLOCK].reshape(-1, BLOCK), np.cumsum(sizes)[:-1])))
    window = _window(data)
    done, k = np.zeros(len(bit), np.int64), np.zeros(len(bit), np.int64)
    dc = np.zeros((len(bit), int(component.max()) + 1), np.int64)
    live = np.arange(len(bit))
    plain = most == 1
    while len(live):
        b, kk, f = bit[live], k[live], file[live]
        unit = 0 if plain else done[live] % per_mcu[f]
        seen = window[np.minimum(b >> 3, len(window) - 1)] << (b & 7).astype(np.uint64)
        is_dc = kk == 0
        entry = looks[np.where(is_dc, which[f, unit, 0], which[f, unit, 1]), (seen >> np.uint64(48)).astype(np.int64)]
        width, symbol = entry & 255, entry >> 8
        if (width == 0).any():
            raise ValueError("no such Huffman code")
        size = symbol & 15
        run = np.where(is_dc, 0, symbol >> 4)
        bits = ((seen << width.astype(np.uint64)) >> (np.uint64(63) - size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
        value = np.where((size > 0) & (bits < (1 << size) >> 1), bits - (1 << size) + 1, bits)
        bit[live] = b + width + size
        if is_dc.any():
            c = component[f, unit]
            dc[live[is_dc], (c if np.ndim(c) == 0 else c[is_dc])] += value[is_dc]
            value = np.where(is_dc, dc[live, c], value)
        ends = ~is_dc & (size == 0) & (run != 15)
        place = kk + run
        if (place[~ends] >= BLOCK).any():
            raise ValueError("a coefficient lies outside its block")
        write = ~ends & (is_dc | (size > 0))
        out[((first[live] + done[live]) * BLOCK + place)[write]] = value[write]
        full = ends | (place >= BLOCK - 1)
        k[live] = np.where(full, 0, place + 1)
        done[live] += full
        over = done[live] >= units[live]
        if over.any():
            if (bit[live[over]] > end[live[over]]).any():
                raise ValueError("the scan is too short")
            live = live[~over]
    out = out[: blocks * BLOCK].reshape(-1, BLOCK)
    return list(zip(parsed, np.split(out, np.cumsum(sizes)[:-1])))


def thumbnail(parsed: Parsed, coefficients: np.ndarray) -> np.ndarray:
    """Mean luminance of each 8x8 block, from the DC coefficients alone: 0 to 255."""
    _, h, v, q = parsed.components[0]
    own = coefficients.reshape(-1, len(parsed.units), BLOCK)[:, : h * v, 0].astype(np.float64)
    grid = own.reshape(parsed.down, parsed.across, v, h).transpose(0, 2, 1, 3).reshape(parsed.down * v, parsed.across * h)
    return np.clip(np.rint(grid * parsed.quant[q] / 8.0 + 128.0), 0, 255).astype(np.uint8)


def average_hash(image: np.ndarray, side: int = 8) -> str:
    """64 bits as hex: whether each of side x side cell means is above the mean of all."""
    rows = np.minimum((np.arange(image.shape[0]) * side) // image.shape[0], side - 1)
    cols = np.minimum((np.arange(image.shape[1]) * side) // image.shape[1], side - 1)
    cell = (rows[:, None] * side + cols[None, :]).ravel()
    n = np.bincount(cell, minlength=side * side)
    total = np.bincount(cell, weights=image.ravel().astype(np.float64), minlength=side * side)
    mean = np.where(n > 0, total / np.maximum(n, 1), image.mean())
    return f"{int(''.join('1' if x else '0' for x in mean > mean.mean()), 2):0{side * side // 4}x}"


def thumbnail_hashes(decoded: list[tuple[Parsed, np.ndarray]]) -> list[str]:
    """``average_hash`` of every file's thumbnail; files of one component are taken together."""
    if any(len(p.units) > 1 for p, _ in decoded):
        return [average_hash(thumbnail(*d)) for d in decoded]
    across, down = (np.array([getattr(p, k) for p, _ in decoded]) for k in ("across", "down"))
    n = across * down
    file = np.repeat(np.arange(len(decoded)), n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    a, d = across[file], down[file]
    cell = file * BLOCK + np.minimum(inner // a * 8 // d, 7) * 8 + np.minimum(inner % a * 8 // a, 7)
    scale = np.array([p.quant[p.components[0][3]] for p, _ in decoded]) / 8.0
    light = np.clip(np.rint(np.concatenate([c[:, 0] for _, c in decoded]) * scale[file] + 128.0), 0, 255)
    total, count = np.bincount(cell, weights=light, minlength=len(decoded) * BLOCK), np.bincount(cell, minlength=len(decoded) * BLOCK)
    whole = np.bincount(file, weights=light) / n
    mean = np.where(count > 0, total / np.maximum(count, 1), np.repeat(whole, BLOCK)).reshape(-1, BLOCK)
    bits = np.packbits(mean > mean.mean(axis=1, keepdims=True), axis=1)
    return [row.tobytes().hex() for row in bits]


def payload_of(text: bytes) -> bytes:
    """The bytes with zeros up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % BLOCK if text else BLOCK)


def write_media(docs: DataFrame, *, keep: list, text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_bytes and media (a JPEG that holds the UTF-8 text without loss; null as empty).

    A payload beyond 4 GB does not fit a JPEG's sides; Spark's rows end before that.
    Kept columns may have any name; n_bytes and media get underscores before
    them where a kept column bears theirs.
    """
    carried = Carried(docs, keep)
    narrow = carried.narrow(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for part, data, offsets in text_chunks(batches, most=1 << 17):  # small, for the processor's cache
            raw = data.tobytes()
            texts = [raw[offsets[i] : offsets[i + 1]] for i in range(part.num_rows)]
            media = encode([payload_of(t) for t in texts])
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["kept", "n_bytes", "media"])

    return carried.restored(narrow.mapInArrow(run, Carried.schema(narrow, "n_bytes long, media binary")))


def read_media(media: DataFrame, *, media_col: str = "media") -> DataFrame:
    """The other columns of ``media`` and width, height, thumbnail_hash, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256.

    All of it comes from the stored bytes.  Files with a payload comment give
    the payload's figures; of other baseline files these are null.  A null or
    broken file gives nulls and its error in ``problem``.  Without rows there
    is no result.  Figures get underscores before their names where another
    column of ``media`` bears them.
    """
    carried = Carried(media, [named(c) for c in media.columns if c != media_col])
    ordered = carried.narrow(named(media_col).alias("media"))
    added = "width int, height int, thumbnail_hash string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, problem string"

    def figures(f: bytes, parsed, coefficients, thumb: str) -> tuple:
        payload = (None, None, None)
        if parsed.comment.startswith(b"payload="):
            own = coefficients.reshape(-1)[: int(parsed.comment[8:])].astype(np.int8).tobytes()
            payload = (len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-BLOCK:]))
        return parsed.width, parsed.height, thumb, *payload, len(f), hashlib.sha256(f).hexdigest(), None

    def one(f) -> tuple:
        try:
            found = decode([f])
            return figures(f, *found[0], thumbnail_hashes(found)[0])
        except (ValueError, IndexError, KeyError, TypeError) as problem:
            return (None,) * 6 + ((len(f), hashlib.sha256(f).hexdigest()) if f is not None else (None, None)) + (str(problem) or "null",)

    def run(batches):
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for part, _, _ in text_chunks(batches, "media"):
            files = part.column(part.num_columns - 1).to_pylist()
            try:
                found = decode(files)
                rows = [figures(f, *d, h) for f, d, h in zip(files, found, thumbnail_hashes(found))]
            except (ValueError, IndexError, KeyError, TypeError):
                rows = [one(f) for f in files]  # one of them is broken: each for itself
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=["kept", *(x.split()[0] for x in added.split(", "))])

    return carried.restored(ordered.mapInArrow(run, Carried.schema(ordered, added)))
