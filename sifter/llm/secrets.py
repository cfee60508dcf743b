"""Secret scan with a recursive decoding worklist.

Each text is scanned for the three kinds of RULES. Then its encoded layers are
unwrapped: URL escapes and Unicode escapes of the whole layer, each run of
base64, and gzip, zlib, bzip2 or xz data anywhere inside decoded or decompressed
bytes, all its members. Every new layer
is scanned again and put on the worklist, until nothing is left to unwrap. A
layer that was seen before at the same place in the source (so also one that
decodes to itself) is not taken up again. Each layer carries, for every code
point, the span of the source text it came from; a finding maps back to the
smallest source span that holds all of its code points.

A text is worked on alone, so rows need no shuffle, and a lost task is redone
from its input. Of a decompressed layer ``max_layer`` bytes are held in memory: a
longer one goes to a temporary file of the task and is scanned whole, piece by
piece (a piece goes on to the next place that no finding or encoded run goes
across); ``cut`` counts such layers.

Nulls: a null text counts as empty and has no findings. Extra columns are kept.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import mmap
import re
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FINDINGS = ("struct<cut:bigint,layers:bigint,found:array<struct<start:bigint,end:bigint,rank:int,kind:string,base:boolean,"
            "value:string,path:string>>>")
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
MAX_LAYER = 16 << 20
#: Compressed bytes read at once.
STEP = 1 << 16

_BYTES = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|\\u\{[0-9A-Fa-f]{1,6}\}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
#: One run, or lines of a wrapped one.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:(?<=[A-Za-z0-9+/_-]{60})\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
_PRINTABLE = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xf4][\x80-\xbf]+){8,}")
#: The end of a line or a control byte, where no finding, escape or base64 run goes on.
_BREAK = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|\n\n|[^A-Za-z0-9+/_\r\n-]\r?\n")
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY|\xfd7zXZ\x00|\x78[\x01\x5e\x9c\xda]")


_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _class(chars: bytes) -> bytes:
    return bytes(49 if i in chars else 48 for i in range(256))


_IS_HEX = _class(b"0123456789abcdef")
_IS_BASE64 = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_RUN = b"1" * 16


def scan(s: str, raw: bytes) -> list[tuple[int, int, int, str]]:
    """(start, end, rank of the kind, value) of the findings in one layer;
    ``raw``: its UTF-8, in which a plain search tells whether a kind can occur."""
    out, low = [], raw.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), m.end(), 0, m[1]) for m in ASSIGN.finditer(s) if len(m[1]) >= 12]
    if b"AKIA" in raw:
        out += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(s)]
    if _RUN in raw.translate(_IS_HEX):
        out += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(s)]
    return out


class _Layer:
    """A text and the source span of each of its code points (None: itself)."""

    def __init__(self, text: str, lo: np.ndarray | None, hi: np.ndarray | None, path: str):
        self.text, self.lo, self.hi, self.path = text, lo, hi, path

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.lo is None:
            return start, end
        return int(self.lo[start:end].min()), int(self.hi[start:end].max())

    def spread(self, pieces: list[tuple[str, np.ndarray, np.ndarray]], path: str) -> _Layer:
        """A layer from pieces: text, and first and last + 1 code point of this layer for each of its code points."""
        text = "".join(p[0] for p in pieces)
        a = np.concatenate([p[1] for p in pieces]) if pieces else np.zeros(0, np.int64)
        b = np.concatenate([p[2] for p in pieces]) if pieces else np.zeros(0, np.int64)
        if self.lo is not None:
            a, b = self.lo[a], self.hi[b - 1]
        return _Layer(text, a, b, f"{self.path}/{path}")


def _points(raw: bytes, at: np.ndarray, to: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """Bytes as text, with the spans of the bytes of each code point. Undecodable bytes become U+FFFD one by one."""
    text, lo, hi, i = [], [], [], 0
    while i < len(raw):
        b = raw[i]
        n = 1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 1
        try:
            c = raw[i:i + n].decode()
        except UnicodeDecodeError:
            n, c = 1, "�"
        text.append(c)
        lo.append(at[i])
        hi.append(to[i + n - 1])
        i += n
    return "".join(text), np.array(lo, np.int64), np.array(hi, np.int64)


def _replaced(layer: _Layer, pattern: re.Pattern, decode, path: str) -> _Layer | None:
    """The whole layer with each match of ``pattern`` decoded; None without one."""
    pieces, at = [], 0
    for m in pattern.finditer(layer.text):
        plain = np.arange(at, m.start(), dtype=np.int64)
        pieces += [(layer.text[at:m.start()], plain, plain + 1), decode(m)]
        at = m.end()
    if not pieces:
        return None
    plain = np.arange(at, len(layer.text), dtype=np.int64)
    return layer.spread([*pieces, (layer.text[at:], plain, plain + 1)], path)


def _url(m: re.Match) -> tuple[str, np.ndarray, np.ndarray]:
    at = np.arange(m.start(), m.end(), 3, dtype=np.int64)
    return _points(bytes.fromhex(m[0].replace("%", "")), at, at + 3)


def _unicode(m: re.Match) -> tuple[str, np.ndarray, np.ndarray]:
    s, start = m[0], m.start()
    if s[:2] == "\\u" and s[2] != "{":
        text, lo, hi, i = [], [], [], 0
        while i < len(s):
            c, n = int(s[i + 2:i + 6], 16), 6
            if 0xD800 <= c < 0xDC00 and i + 12 <= len(s) and 0xDC00 <= (d := int(s[i + 8:i + 12], 16)) < 0xE000:
                c, n = 0x10000 + ((c - 0xD800) << 10) + d - 0xDC00, 12
            text.append("�" if 0xD800 <= c < 0xE000 else chr(c))
            lo.append(start + i)
            hi.append(start + i + n)
            i += n
        return "".join(text), np.array(lo, np.int64), np.array(hi, np.int64)
    if s[:2] == "\\x":
        at = np.arange(start, m.end(), 4, dtype=np.int64)
        return _points(bytes.fromhex(s.replace("\\x", "")), at, at + 4)
    digits = s[3:-1] if s[:2] == "\\u" or s[:3].lower() == "&#x" else s[2:-1] if s[0] == "&" else s[2:]
    c = int(digits, 10 if s[0] == "&" and s[2] not in "xX" else 16)
    good = c < 0x110000 and not 0xD800 <= c < 0xE000
    return chr(c) if good else "�", np.array([start], np.int64), np.array([m.end()], np.int64)


class _Zlib:
    """zlib's decompressor with the interface of bz2's and lzma's."""

    def __init__(self, bits: int):
        self.d, self.full = zlib.decompressobj(bits), False

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.d.decompress(self.d.unconsumed_tail + data, most)
        self.full = len(out) == most  # it may hold back more
        return out

    eof = property(lambda self: self.d.eof)
    unused_data = property(lambda self: self.d.unused_data)
    needs_input = property(lambda self: not self.full and not self.d.unconsumed_tail)


def _members(raw, at: int, most: int):
    """(output, end, whole) of the compressed data at ``at``, its members one
    after another, as far as it can be read. ``whole``: the first member was
    read to its end. Output of more than ``most`` bytes is in a mapped file."""
    end, whole, size = len(raw), False, 0
    with tempfile.SpooledTemporaryFile(max_size=most) as out:
        while _PACKED.match(raw, at):
            head, read = raw[at:at + 3], at
            d = (_Zlib(31) if head[:2] == b"\x1f\x8b" else bz2.BZ2Decompressor() if head == b"BZh"
                 else lzma.LZMADecompressor() if head[:1] == b"\xfd" else _Zlib(15))
            try:
                while not d.eof:
                    data = raw[read:read + STEP] if d.needs_input else b""
                    if d.needs_input and not data:
                        break
                    read += len(data)
                    size += out.write(d.decompress(data, 16 * STEP))
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                if head[:1] == b"x" and not whole:  # two bytes that looked like a header
                    return b"", end, False
            if not d.eof:
                break
            end, whole = read - len(d.unused_data), True
            at = end
            while raw[at:at + 1] == b"\0":  # padding between members
                at += 1
        if size > most:
            out.flush()
            return mmap.mmap(out.fileno(), 0, access=mmap.ACCESS_READ), end, whole
        out.seek(0)
        return out.read(), end, whole


def _texts(raw, span: tuple[int, int], path: str, most: int) -> Iterator[_Layer]:
    """Bytes as text, in pieces of ``most`` bytes and on to the next place that nothing to be found goes across."""
    at = 0
    while at < len(raw):
        m = _BREAK.search(raw, at + most) if len(raw) - at > most else None
        text = raw[at:m.end() if m else len(raw)].decode(errors="replace")
        at = m.end() if m else len(raw)
        yield _Layer(text, *(np.broadcast_to(np.int64(x), len(text)) for x in span), path)


def _unwrapped(raw: bytes, source, path: str, most: int) -> Iterator[tuple[_Layer, bool, bool]]:
    """The layers of compressed data anywhere in bytes, and in what that holds,
    and so on; whether each is a further piece of the one before it; and whether
    it is surely compressed data. ``source``: the source span of bytes from, to."""
    work, seen = [(raw, source, path)], set()
    while work:
        raw, source, path = work.pop()
        path, at = path + "/unpacked", 0
        while m := _PACKED.search(raw, at):
            out, end, whole = _members(raw, m.start(), most)
            at = end if whole else m.start() + 1
            if not len(out):
                continue
            span = source(m.start(), end)
            key = (hashlib.blake2b(out, digest_size=16).digest(), span)
            if key in seen:
                continue
            seen.add(key)
            for i, x in enumerate(_texts(out, span, path, most)):
                yield x, i > 0, whole or not m.start() or m[0][0] != 0x78
            work.append((out, lambda a, b, span=span: span, path))


def _base64(layer: _Layer, m: re.Match, most: int) -> Iterator[tuple[_Layer, bool]]:
    """Readable and compressed stretches of one base64 run, at the first of
    its four alignments that explains half of the run (or at all of them)."""
    keep = np.array([i for i, c in enumerate(m[0]) if c not in "\r\n="], np.int64) + m.start()
    run = re.sub(r"[\r\n=]", "", m[0]).replace("-", "+").replace("_", "/")
    for skip in range(4):
        part = run[skip:]
        part = part[:len(part) - (len(part) % 4 == 1)]
        if len(part) < 12:
            return
        raw = base64.b64decode(part + "=" * (-len(part) % 4))
        first = np.arange(len(raw)) * 4 // 3 + skip
        lo, hi = keep[first], keep[np.minimum(first + 1, len(keep) - 1)] + 1
        known = 0
        for p in _PRINTABLE.finditer(raw):
            known += len(p[0])
            text, a, b = _points(p[0], lo[p.start():], hi[p.start():])
            yield layer.spread([(text, a, b)], "base64"), False
        for x, more, sure in _unwrapped(raw, lambda a, b: layer.source(int(lo[a]), int(hi[b - 1])), layer.path + "/base64", most):  # noqa: B023
            known = len(raw) if sure else known
            yield x, more
        if 2 * known >= len(raw):
            return


def _escaped(layer: _Layer, raw: bytes, pattern: re.Pattern, path: str, most: int) -> Iterator[tuple[_Layer, bool]]:
    """Compressed data in the layer's bytes, of which ``pattern`` escapes some."""
    hexed = lambda m: bytes.fromhex(re.sub(r"%|\\x", "", m))
    if not _PACKED.search(re.sub(pattern.pattern.encode(), lambda m: hexed(m[0].decode()), raw)):
        return
    out, lo, hi, at = [], [], [], 0

    def plain(a: int, b: int) -> None:
        chars = [c.encode(errors="replace") for c in layer.text[a:b]]
        out.extend(chars)
        lo.append(np.repeat(np.arange(a, b), [len(c) for c in chars]))
        hi.append(lo[-1] + 1)

    for m in pattern.finditer(layer.text):
        plain(at, m.start())
        out.append(hexed(m[0]))
        width = len(m[0]) // len(out[-1])
        lo.append(np.arange(m.start(), m.end(), width))
        hi.append(lo[-1] + width)
        at = m.end()
    plain(at, len(layer.text))
    lo, hi = np.concatenate(lo).astype(np.int64), np.concatenate(hi).astype(np.int64)
    for x, more, _ in _unwrapped(b"".join(out), lambda a, b: layer.source(int(lo[a]), int(hi[b - 1])), f"{layer.path}/{path}", most):
        yield x, more


def _layers(layer: _Layer, most: int) -> Iterator[tuple[_Layer, bool]]:
    """The layers in a layer, and whether each is a further piece of the one before it."""
    s = layer.text
    raw = s.encode(errors="replace")
    if "%" in s and (x := _replaced(layer, _URL, _url, "url")):
        yield x, False
        yield from _escaped(layer, raw, _URL, "url", most)
    if ("\\" in s or "&#" in s) and (x := _replaced(layer, _UNICODE, _unicode, "unicode")):
        yield x, False
        if "\\x" in s:
            yield from _escaped(layer, raw, _BYTES, "unicode", most)
    if _RUN in raw.translate(_IS_BASE64):
        for m in _BASE64.finditer(s):
            yield from _base64(layer, m, most)


def scan_text(text: str | None, max_layer: int = MAX_LAYER) -> tuple[int, int, list[tuple]]:
    """(layers cut to pieces, layers unwrapped, findings) of one text."""
    base = _Layer(text or "", None, None, "")
    found = {(a, b, k, True): (v, "") for a, b, k, v in scan(base.text, base.text.encode(errors="replace"))}
    work, seen, cut, n, pieces = [_layers(base, max_layer)], set(), 0, 0, False
    while work:
        x, more = next(work[-1], (None, False))
        cut += more and not pieces  # a layer's second piece
        pieces = more
        if x is None:
            work.pop()
            continue
        raw = x.text.encode(errors="replace")
        if not raw:
            continue
        key = (hashlib.blake2b(raw, digest_size=16).digest(), int(x.lo.min()), int(x.hi.max()))
        if key in seen:
            continue
        seen.add(key)
        n += not more
        for a, b, k, v in scan(x.text, raw):
            lo, hi = x.source(a, b)
            if (lo, hi, k, True) not in found:
                found.setdefault((lo, hi, k, False), (v, x.path))
        work.append(_layers(x, max_layer))
    return cut, n, [(a, b, k, KINDS[k], base_, v, p) for (a, b, k, base_), (v, p) in sorted(found.items(), key=lambda x: (x[0][0], x[0][2], x[0][1]))]


def scan_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "secrets", max_layer: int = MAX_LAYER) -> DataFrame:
    """Adds ``out_col``: cut, layers, and found (start, end, rank, kind, base, value, path), by start, kind, end."""
    names = ("start", "end", "rank", "kind", "base", "value", "path")

    @F.pandas_udf(FINDINGS)
    def findings(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = [scan_text(t, max_layer) for t in s]
            yield pd.DataFrame({"cut": [r[0] for r in rows], "layers": [r[1] for r in rows],
                                "found": [[dict(zip(names, f, strict=True)) for f in r[2]] for r in rows]})

    return docs.withColumn(out_col, findings(F.col(text_col)))
