"""FLAC media columns: texts as 8-bit samples, stored losslessly and read back.

A stream is mono, 8 bits a sample, in blocks of ``BLOCK`` samples and a shorter last one, with a seek
point for every frame. A frame's subframe is a fixed or a computed linear predictor with Rice-coded
residuals. Coding and decoding work on all frames of a batch of rows at once: frames of one length are
the lanes of one array, and each step codes or decodes one sample of every lane. The decoder also
reads constant and verbatim subframes, escaped partitions and wasted bits, verifies both checksums of
every frame, and finds frames by their sync codes where a stream has no seek table.

Defined results: a null text is empty; an empty text is one pad of ``PAD`` blanks. Equal texts have
equal streams. Repeated rows get a row each. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, texts_of

PAD, BLOCK, RATE, PARTS = 192, 1152, 8000, 3
LPC_ORDER, LPC_BITS = 4, 12
_SIZES = {192: 1, 576: 2, 1152: 3, 2304: 4, 4608: 5, **{256 << i: 8 + i for i in range(8)}}


# ---- checksums --------------------------------------------------------------------------------


@functools.cache
def _table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    out = []
    for i in range(256):
        v = i << (bits - 8)
        for _ in range(8):
            v = ((v << 1) ^ poly if v & top else v << 1) & mask
        out.append(v)
    return np.array(out, np.uint32)


def crc8(data: bytes) -> int:
    t, v = _table(0x07, 8), 0
    for b in data:
        v = int(t[v ^ b])
    return v


def crc16_lanes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-16 of many byte ranges of ``data``, one byte of each range a step."""
    t = _table(0x8005, 16)
    order = np.argsort(-lengths, kind="stable")
    s, n = starts[order], lengths[order]
    v = np.zeros(len(s), np.uint32)
    active = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")
    for i, k in enumerate(active):
        c = v[:k]
        v[:k] = ((c << 8) & 0xFFFF) ^ t[(c >> 8) ^ data[s[:k] + i]]
    out = np.empty_like(v)
    out[order] = v
    return out


def _utf8_number(n: int) -> bytes:
    if n < 0x80:
        return bytes([n])
    tail = []
    lead = 0x3F
    while n > lead:
        tail.append(0x80 | (n & 0x3F))
        n >>= 6
        lead >>= 1
    return bytes([(~(2 * lead + 1) & 0xFF) | n, *reversed(tail)])


# ---- encoding ---------------------------------------------------------------------------------


def _predictors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best predictor of each lane: (kind, order, residuals, quantised coefficients, shifts).

    Kind 8 + order is fixed, kind 32 + order - 1 computed. Residuals keep the lanes' width; the first
    ``order`` of them are not coded.
    """
    lanes, n = x.shape
    best_cost = np.full(lanes, np.inf)
    kind, order = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    res = np.zeros((lanes, n), np.int32)
    d = x.astype(np.int32)
    for k in range(3):
        if k:
            d = np.concatenate([np.zeros((lanes, 1), np.int32), np.diff(d, axis=1)], axis=1)
        cost = np.abs(d[:, 4:]).sum(1)
        m = cost < best_cost
        best_cost[m], kind[m], order[m], res[m] = cost[m], 8 + k, k, d[m]
    # linear prediction from the autocorrelation, Levinson-Durbin on all lanes at once
    f = x.astype(np.float32)  # sums of squares of 8 bits are exact enough
    p = LPC_ORDER
    r = np.stack([(f[:, j:] * f[:, : n - j]).sum(1) for j in range(p + 1)])
    err, a = r[0] * 1.0001 + 1e-3, np.zeros((p, lanes))
    for i in range(p):
        k = (r[i + 1] - (a[:i] * r[i:0:-1]).sum(0)) / err
        a[:i] = a[:i] - k * a[:i][::-1]
        a[i] = k
        err = err * (1 - k * k)
    peak = np.maximum(np.abs(a).max(0), 1e-9)
    shift = np.clip(LPC_BITS - 2 - np.floor(np.log2(peak)).astype(np.int64), 0, 15)
    lim = 1 << (LPC_BITS - 1)
    q = np.clip(np.rint(a * 2.0**shift), -lim, lim - 1).astype(np.int64)
    xi = x.astype(np.int32)  # 4 products of 8 and 12 bits fit
    pred = np.zeros((lanes, n - p), np.int32)
    for j in range(p):
        pred += q[j].astype(np.int32)[:, None] * xi[:, p - 1 - j : n - 1 - j]
    e = xi[:, p:] - (pred >> shift.astype(np.int32)[:, None])
    m = np.abs(e).sum(1) * 1.0 + 8 * p < best_cost * 0.995
    kind[m], order[m] = 32 + p - 1, p
    res[m, p:] = e[m]
    return kind, order, res, q, shift


def _encode_lanes(x: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """Frames of one block length: ``x`` is lanes x samples (signed 8 bits)."""
    lanes, n = x.shape
    kind, order, res, q, shift = _predictors(x)
    parts, part = 1 << PARTS, n >> PARTS
    u = (res << 1) ^ (res >> 31)
    u[np.arange(n)[None, :] < order[:, None]] = 0
    coded = np.full((lanes, parts), part)
    coded[:, 0] -= order
    by_part = u.reshape(lanes, parts, part)
    total = by_part.sum(2)
    guess = np.floor(np.log2(np.maximum(total / coded, 1))).astype(np.int64)
    best, k = None, np.zeros((lanes, parts), np.int64)
    for c in (guess - 1, guess, guess + 1):
        c = np.clip(c, 0, 14)
        cost = (by_part >> c[:, :, None]).sum(2) + coded * (c + 1)
        if best is None:
            best, k = cost, c
        else:
            m = cost < best
            best, k = np.where(m, cost, best), np.where(m, c, k)
    # frame headers; a 16-bit length follows where no code exists
    heads = []
    for num in numbers:
        h = bytes([0xFF, 0xF8, (_SIZES.get(n, 7) << 4) | 0, 0x02]) + _utf8_number(int(num)) + (b"" if n in _SIZES else struct.pack(">H", n - 1))
        heads.append(h + bytes([crc8(h)]))
    lpc = kind >= 32
    head_bits = np.array([8 * len(h) for h in heads])
    sub = 8 + 8 * order + np.where(lpc, 9 + LPC_BITS * order, 0)
    # where every code of every lane starts
    idle = np.arange(n)[None, :] < order[:, None]
    kk = np.repeat(k.astype(np.int32), part, axis=1)
    length = (u >> kk) + 1 + kk
    length[idle] = 0
    total = length.copy()
    total[:, ::part] += 4  # each partition's parameter
    ends = np.cumsum(total, axis=1, dtype=np.int32)
    body = head_bits + sub + 6
    size = (body + ends[:, -1] + 7) // 8 + 2
    base = np.concatenate([[0], np.cumsum(size)])
    at0 = base[:-1] * 8
    words = np.zeros(int(base[-1]) // 4 + 2)  # sums of disjoint bits, so each stays under 2**32

    def put(last: np.ndarray, value: np.ndarray) -> None:
        """Add ``value`` (of up to 16 bits) so that its lowest bit is bit ``last``."""
        nonlocal words
        v = value.astype(np.uint64) << (np.uint64(31) - (last & 31).astype(np.uint64))
        w = last >> 5
        words += np.bincount(w, (v & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words))
        high = v >> np.uint64(32)
        m = np.flatnonzero(high)
        words += np.bincount(w[m] - 1, high[m].astype(np.float64), len(words))

    def field(at: np.ndarray, value: np.ndarray, width: int) -> None:
        put(at + (width - 1), value)

    flat = np.frombuffer(b"".join(heads), np.uint8)
    per = head_bits // 8
    inner = np.arange(len(flat)) - np.repeat(np.cumsum(per) - per, per)
    field(np.repeat(at0, per) + 8 * inner, flat, 8)
    at = at0 + head_bits
    field(at, kind << 1, 8)
    at = at + 8
    for j in range(LPC_ORDER):
        m = order > j
        field(at[m] + 8 * j, x[m, j].astype(np.int64) & 0xFF, 8)
    at = at + 8 * order
    field(at[lpc], np.full(lpc.sum(), LPC_BITS - 1), 4)
    field(at[lpc] + 4, shift[lpc], 5)
    for j in range(LPC_ORDER):
        field(at[lpc] + 9 + LPC_BITS * j, q[j][lpc] & ((1 << LPC_BITS) - 1), LPC_BITS)
    at = at + np.where(lpc, 9 + LPC_BITS * order, 0)
    field(at, np.full(lanes, PARTS), 6)  # method 0 and the partition order
    data_at = at0 + body
    first = np.concatenate([np.zeros((lanes, 1), np.int64), ends[:, part - 1 : -1 : part]], axis=1)
    field((data_at[:, None] + first).ravel(), k.ravel(), 4)
    # a code's stop bit and low bits end where the code ends; its zeros are there already
    code = (np.int32(1) << kk) | (u & ((np.int32(1) << kk) - 1))
    code[idle] = 0
    put((data_at[:, None] + (ends - 1)).ravel(), code.ravel())
    data = words.astype(np.uint32).astype(">u4").view(np.uint8)[: base[-1]]
    crc = crc16_lanes(data, base[:-1], size - 2)
    data[base[1:] - 2], data[base[1:] - 1] = crc >> 8, crc & 0xFF
    raw = data.tobytes()
    return [raw[base[i] : base[i + 1]] for i in range(lanes)]


def encode(payloads: list[bytes], lanes: int = 2048) -> list[bytes]:
    """A stream for each payload, whose length is a positive multiple of 8 from 192 on."""
    jobs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, p in enumerate(payloads):
        for f, at in enumerate(range(0, len(p), BLOCK)):
            jobs[min(BLOCK, len(p) - at)].append((i, f))
    frames: list[dict[int, bytes]] = [{} for _ in payloads]
    for n, todo in sorted(jobs.items()):
        for lo in range(0, len(todo), lanes):
            own = todo[lo : lo + lanes]
            raw = b"".join(payloads[i][f * BLOCK : f * BLOCK + n] for i, f in own)
            x = (np.frombuffer(raw, np.uint8).astype(np.int16) - 128).reshape(-1, n)
            for (i, f), data in zip(own, _encode_lanes(x, np.array([f for _, f in own])), strict=True):
                frames[i][f] = data
    out = []
    for p, fs in zip(payloads, frames, strict=True):
        fs = [fs[i] for i in range(len(fs))]
        sizes = [len(f) for f in fs]
        signed = (np.frombuffer(p, np.uint8) ^ 0x80).tobytes()
        info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + ((RATE << 44) | (0 << 41) | (7 << 36) | len(p)).to_bytes(8, "big") + hashlib.md5(signed).digest()
        at = np.concatenate([[0], np.cumsum(sizes)])
        seek = b"".join(struct.pack(">QQH", i * BLOCK, int(at[i]), min(BLOCK, len(p) - i * BLOCK)) for i in range(len(fs)))
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + b"".join(fs))
    return out


# ---- decoding ---------------------------------------------------------------------------------


def _stream(data: bytes) -> tuple[int, bytes, int, list[int]]:
    """(samples, MD5, where frames begin, frame offsets by the seek table) of a mono 8-bit stream."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, total, md5, points = 4, False, 0, b"", []
    while not last:
        head, n = data[at], int.from_bytes(data[at + 1 : at + 4], "big")
        last, body = bool(head & 0x80), data[at + 4 : at + 4 + n]
        if head & 0x7F == 0:
            packed = int.from_bytes(body[10:18], "big")
            if (packed >> 41) & 7 or (packed >> 36) & 31 != 7:
                raise ValueError("only mono streams of 8 bits a sample are media columns")
            total, md5 = packed & ((1 << 36) - 1), body[18:34]
        elif head & 0x7F == 3:
            points = [o for s, o, _ in struct.iter_unpack(">QQH", body) if s != 2**64 - 1]
        at += 4 + n
    return total, md5, at, points


def _header(data: bytes, at: int) -> tuple[int, int] | None:
    """(block length, header bytes) of the frame at ``at``, or None where there is no valid header."""
    if len(data) < at + 6 or data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8 or data[at + 3] & 1 or data[at + 3] >> 4:
        return None
    p, lead = at + 5, data[at + 4]
    while lead & 0xC0 == 0xC0:
        p += 1
        lead = (lead << 1) & 0xFF
    code = data[at + 2] >> 4
    if code == 6:
        n, p = data[p] + 1, p + 1
    elif code == 7:
        n, p = int.from_bytes(data[p : p + 2], "big") + 1, p + 2
    else:
        n = next((s for s, c in _SIZES.items() if c == code), 0)
    p += {12: 1, 13: 2, 14: 2}.get(data[at + 2] & 15, 0)
    if not n or p >= len(data) or crc8(data[at:p]) != data[p]:
        return None
    return n, p + 1 - at


def _frames(data: bytes, at: int, points: list[int], total: int) -> list[tuple[int, int, int, int]]:
    """(offset, bytes, block length, header bytes) of each frame, by seek points or by sync codes."""
    ends = [*[at + o for o in points[1:]], len(data)] if points else []
    out = [(at + o, e - at - o, *(_header(data, at + o) or (0, 0))) for o, e in zip(points, ends, strict=True)]
    if sum(f[2] for f in out) == total:
        return out
    # A sync code that happens to lie inside a frame does not split it into parts of right checksums.
    arr = np.frombuffer(data, np.uint8)
    offs = [int(i) for i in np.flatnonzero((arr[:-1] == 0xFF) & (arr[1:] & 0xFE == 0xF8)) if i >= at and _header(data, int(i))]
    out, i = [], 0
    while i < len(offs):
        head = _header(data, offs[i])
        for j in range(i + 1, len(offs) + 1):
            n = (offs[j] if j < len(offs) else len(data)) - offs[i]
            if not crc16_lanes(arr, np.array([offs[i]]), np.array([n]))[0]:
                out.append((offs[i], n, *head))
                i = j
                break
        else:
            break
    if sum(f[2] for f in out) == total:
        return out
    raise ValueError("frames do not add up to the stream's samples")


def decode(streams: list[bytes], lanes: int = 2048) -> list[bytes]:
    """The bytes (samples + 128) of each stream. Raises where a checksum or the MD5 is wrong."""
    out: list[list[bytes]] = []
    jobs: dict[int, list[tuple[int, int, bytes, int]]] = defaultdict(list)
    sums = []
    for i, d in enumerate(streams):
        total, md5, at, points = _stream(d)
        fs = _frames(d, at, points, total)
        out.append([b""] * len(fs))
        sums.append(md5)
        for j, (o, n, block, head) in enumerate(fs):
            jobs[block].append((i, j, d[o : o + n], head))
    for block, todo in sorted(jobs.items()):
        for lo in range(0, len(todo), lanes):
            own = todo[lo : lo + lanes]
            x = _decode_lanes([f for _, _, f, _ in own], np.array([h for *_, h in own]), block)
            raw = (x + 128).astype(np.uint8)
            for (i, j, *_), row in zip(own, raw, strict=True):
                out[i][j] = row.tobytes()
    done = [b"".join(b) for b in out]
    for p, md5 in zip(done, sums, strict=True):
        if md5 != bytes(16) and hashlib.md5((np.frombuffer(p, np.uint8) ^ 0x80).tobytes()).digest() != md5:
            raise ValueError("the stream's MD5 is wrong")
    return done


def seek(stream: bytes, start: int, count: int) -> bytes:
    """Bytes (samples + 128) ``start`` to ``start + count`` of a stream, cut at its end.

    Only frames that hold them are decoded; the seek table, or where there is none the sync codes, say
    which. Their checksums are verified, the MD5 of the whole stream is not.
    """
    total, _, at, points = _stream(stream)
    if start < 0 or count < 0:
        raise ValueError("a range begins at a sample and has a length")
    end, first, out = min(total, start + count), 0, []
    for o, n, block, head in _frames(stream, at, points, total):
        if first < end and first + block > start:
            x = (_decode_lanes([stream[o : o + n]], np.array([head]), block)[0] + 128).astype(np.uint8).tobytes()
            out.append(x[max(0, start - first) : end - first])
        first += block
    return b"".join(out)


def _decode_lanes(frames: list[bytes], heads: np.ndarray, n: int) -> np.ndarray:
    """Samples (lanes x n) of frames of one block length."""
    lanes = len(frames)
    sizes = np.array([len(f) for f in frames])
    data = np.frombuffer(b"".join(frames) + bytes(8), np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    if crc16_lanes(data, base, sizes).any():
        raise ValueError("a frame's checksum is wrong")
    # 32 bits from every byte on: any field of up to 25 bits is one look-up
    d = data.astype(np.uint32)
    window = (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]

    def get(at: np.ndarray, width) -> np.ndarray:
        v = window[at >> 3].astype(np.int64)
        return (v >> (32 - (at & 7) - width)) & ((1 << np.asarray(width, np.int64)) - 1)

    def signed(v: np.ndarray, width) -> np.ndarray:
        return v - ((v >> (width - 1)) << width)

    x = np.zeros((lanes, n), np.int64)
    at = (base + heads) * 8
    head = get(at, 8)
    kind, wasted = (head >> 1) & 63, head & 1
    at = at + 8
    waste = np.zeros(lanes, np.int64)
    for i in np.flatnonzero(wasted):
        k = 1
        while not get(at[i : i + 1], 1)[0]:
            k += 1
            at[i] += 1
        at[i] += 1
        waste[i] = k
    bps = 8 - waste
    plain = kind < 2
    for i in np.flatnonzero(plain):
        if kind[i] == 0:
            x[i] = signed(get(at[i : i + 1], bps[i]), bps[i])[0]
        else:
            x[i] = signed(get(at[i] + bps[i] * np.arange(n), bps[i]), bps[i])
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (plain | fixed | lpc).all():
        raise ValueError("reserved subframe")
    order = np.where(fixed, kind - 8, np.where(lpc, kind - 31, 0))
    for j in range(int(order.max(initial=0))):
        m = order > j
        x[m, j] = signed(get(at[m] + bps[m] * j, bps[m]), bps[m])
    at = at + bps * order
    coef, shift = np.zeros((lanes, int(order.max(initial=0))), np.int64), np.zeros(lanes, np.int64)
    if lpc.any():
        prec = np.where(lpc, get(at, 4) + 1, 1)
        shift = np.where(lpc, get(at + 4, 5), 0)
        for j in range(coef.shape[1]):
            m = lpc & (order > j)
            coef[m, j] = signed(get(at[m] + 9 + prec[m] * j, prec[m]), prec[m])
        at = at + np.where(lpc, 9 + prec * order, 0)
    todo = np.flatnonzero(~plain)
    if len(todo):
        method, po = get(at[todo], 2), get(at[todo] + 2, 4)
        at[todo] += 6
        for me, p in {(int(a), int(b)) for a, b in zip(method, po, strict=True)}:
            rows = todo[(method == me) & (po == p)]
            _residuals(x, rows, at, order, me, p, n, data, get, signed)
    for i in np.unique(order[fixed]):
        if i:
            rows = np.flatnonzero(fixed & (order == i))
            binom = {1: (1,), 2: (2, -1), 3: (3, -3, 1), 4: (4, -6, 4, -1)}[int(i)]
            if i == 1:
                x[rows] = np.cumsum(x[rows], axis=1)
            else:
                _restore(x, rows, np.tile(binom, (len(rows), 1)), np.zeros(len(rows), np.int64), int(i), n)
    for i in np.unique(order[lpc]):
        rows = np.flatnonzero(lpc & (order == i))
        _restore(x, rows, coef[rows, : int(i)], shift[rows], int(i), n)
    return x << waste[:, None]


def _restore(x: np.ndarray, rows: np.ndarray, coef: np.ndarray, shift: np.ndarray, order: int, n: int) -> None:
    y = np.ascontiguousarray(x[rows].T)  # a step's values lie together
    c = np.ascontiguousarray(coef.T)
    for t in range(order, n):
        p = c[0] * y[t - 1]
        for j in range(1, order):
            p += c[j] * y[t - 1 - j]
        y[t] += p >> shift
    x[rows] = y.T


@functools.cache
def _zeros16() -> np.ndarray:
    """Leading zeros of 16-bit values; 16 for 0."""
    v = np.arange(1 << 16)
    return np.where(v, 15 - np.floor(np.log2(np.maximum(v, 1))), 16).astype(np.uint64)


def _residuals(x, rows, at, order, method, po, n, data, get, signed) -> None:
    """Rice codes of the lanes ``rows`` into ``x``, all lanes in step; ``at`` moves on."""
    width, escape = (5, 31) if method else (4, 15)
    # 64 bits from every byte on hold a whole code of up to 57 bits
    wide = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        wide |= data[i : len(data) - 7 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    zeros, one, three, seven = _zeros16(), np.uint64(1), np.uint64(3), np.uint64(7)
    part = n >> po
    y = np.ascontiguousarray(x[rows].T)
    own = order[rows]
    same = bool((own == own[0]).all())
    pos = at[rows].astype(np.uint64)

    def codes(pos: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = wide[pos >> three] << (pos & seven)
        q = zeros[v >> np.uint64(48)]
        if q.max() == 16:
            for i in np.flatnonzero(q == 16):  # a long run of zeros, bit by bit
                p = int(pos[i]) + 16
                while not (int(data[p >> 3]) >> (7 - (p & 7))) & 1:
                    p += 1
                q[i] = p - int(pos[i])
            b = pos + q + one
            v = wide[b >> three] << (b & seven)
        else:
            v = v << (q + one)
        u = (q << k) | (v >> one >> (np.uint64(63) - k))
        return (u >> one).view(np.int64) ^ -(u & one).view(np.int64), pos + q + one + k

    for p in range(1 << po):
        k = get(pos.view(np.int64), width).astype(np.uint64)
        pos = pos + np.uint64(width)
        esc = k == escape
        raw = np.zeros(len(rows), np.uint64)
        if esc.any():
            raw = np.where(esc, get(pos.view(np.int64), 5), 0).astype(np.uint64)
            pos = pos + np.where(esc, np.uint64(5), np.uint64(0))
        for t in range(p * part, (p + 1) * part):
            if not esc.any() and (same or t >= 32):
                if t >= own[0] or not same:
                    y[t], pos = codes(pos, k)
                continue
            r = np.flatnonzero((t >= own) & ~esc)
            if len(r):
                y[t, r], pos[r] = codes(pos[r], k[r])
            e = np.flatnonzero((t >= own) & esc)
            if len(e):
                w = raw[e].astype(np.int64)
                y[t, e] = np.where(w > 0, signed(get(pos[e].view(np.int64), w), np.maximum(w, 1)), 0)
                pos[e] += raw[e]
    at[rows] = pos.view(np.int64)
    x[rows] = y.T


# ---- tables -----------------------------------------------------------------------------------


def payload_of(text: bytes) -> bytes:
    """UTF-8 with blanks appended up to a positive multiple of ``PAD``."""
    return text.ljust(max(1, -(-len(text) // PAD)) * PAD, b" ")


def store_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_bytes, media): every text as a FLAC stream."""
    kind = dict(docs.dtypes)[doc_id]

    def go(it):
        for b in it:
            texts = list(texts_of(b.column(1)))
            for lo, hi in _spans([len(t) for t in texts], block_bytes):
                own = texts[lo:hi]
                distinct = list(dict.fromkeys(own))
                media = dict(zip(distinct, encode([payload_of(t) for t in distinct]), strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([len(t) for t in own], pa.int64()), pa.array([media[t] for t in own], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text)).mapInArrow(go, f"doc_id {kind}, n_bytes long, media binary")


def _spans(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes together, so that lanes are many and memory is bounded."""
    out, lo, held = [], 0, 0
    for i, s in enumerate(sizes):
        held += s
        if held >= most:
            out.append((lo, i + 1))
            lo, held = i + 1, 0
    if lo < len(sizes):
        out.append((lo, len(sizes)))
    return out


def _decoded(column: pa.Array, most: int = 4 << 20):
    media = column.to_pylist()
    for lo, hi in _spans([len(m) for m in media], most):
        own = media[lo:hi]
        distinct = list(dict.fromkeys(own))
        got = dict(zip(distinct, decode(distinct), strict=True))
        yield lo, hi, own, [got[m] for m in own]


def pcm_blocks(media: DataFrame, block: int = BLOCK, most: int = 8 << 20) -> DataFrame:
    """(doc_id, block, sample_offset, n_samples, pcm): the decoded samples in blocks that can be sought.

    Block ``b`` of a text begins at sample ``b * block``, so a table of them is sought by filter. A
    null id's blocks have a null id; an empty table has none. Batches hold about ``most`` bytes.
    """
    kind = dict(media.dtypes)["doc_id"]
    names = ["doc_id", "block", "sample_offset", "n_samples", "pcm"]

    def go(it):
        for b in it:
            for lo, _, _, payloads in _decoded(b.column(1)):
                jobs = [(lo + i, k, p[o : o + block]) for i, p in enumerate(payloads) for k, o in enumerate(range(0, len(p), block))]
                step = max(1, most // block)
                for own in (jobs[i : i + step] for i in range(0, len(jobs), step)):
                    at, number, raw = zip(*own, strict=True)
                    pcm = [(np.frombuffer(x, np.uint8) ^ 0x80).tobytes() for x in raw]
                    cols = [pa.array(number, pa.int32()), pa.array([k * block for k in number], pa.int64()), pa.array([len(x) for x in pcm], pa.int64()), pa.array(pcm, pa.binary())]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *cols], names=names)

    return media.select("doc_id", "media").mapInArrow(go, f"doc_id {kind}, block int, sample_offset long, n_samples long, pcm binary")


def read_samples(media: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc_id, start, count, samples) of the ``ranges`` (doc_id, start, count) of the stored streams.

    ``samples`` are bytes, sample + 128, cut at the stream's end and empty beyond it. Ranges of ids
    that have no stream, or of null ids, are left out; a range that comes twice is read twice.
    """
    kind = dict(media.dtypes)["doc_id"]

    def go(it):
        for b in it:
            got = [seek(m, s, n) for m, s, n in zip(*(b.column(i).to_pylist() for i in (3, 1, 2)), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(got, pa.binary())], names=["doc_id", "start", "count", "samples"])

    wanted = ranges.select("doc_id", F.col("start").cast("long"), F.col("count").cast("long")).join(media.select("doc_id", "media"), "doc_id")
    return wanted.mapInArrow(go, f"doc_id {kind}, start long, count long, samples binary")


def feature_of(payload: bytes) -> str:
    """Loudness, offset, crossings of zero and the step between neighbours, from whole samples."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"sum={int(x.sum())};energy={int((x * x).sum())};crossings={crossings};steps={int(np.abs(np.diff(x)).sum())};peak={int(np.abs(x).max())}"


def media_features(media: DataFrame) -> DataFrame:
    """Read every stream back: lengths, digests and features of what it holds. A row per row of ``media``."""
    kind = dict(media.dtypes)["doc_id"]

    def go(it):
        for b in it:
            for lo, hi, own, payloads in _decoded(b.column(2)):
                memo: dict[bytes, tuple] = {}
                rows = []
                for m, p in zip(own, payloads, strict=True):
                    if m not in memo:
                        memo[m] = (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature_of(p))
                    rows.append(memo[m])
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64()), pa.array(c[4], pa.string()), pa.array(c[5], pa.string())],
                    names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
                )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(go, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


#: How the media column is written: large pages, so that streams of copies in a page compress too.
MEDIA_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20), "parquet.enable.dictionary": "false"}


def media_column(docs: DataFrame, **kw) -> DataFrame:
    """Store every text in a media column of the shared folder, read the column back and describe it."""
    return media_features(cut(store_texts(docs, **kw), options=MEDIA_OPTIONS))
