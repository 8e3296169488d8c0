"""Secret scans with a recursive decoding worklist.

The text of a document is the first layer.  Each layer is scanned, then every encoded
piece of it (URL escapes, Unicode escapes, base64, compressed bytes, UTF-16 and UTF-32)
is decoded into a new layer, readable or not, until no new layer appears.  A layer seen before at the same place ends its
branch, so cycles stop.  Every character of a layer remembers the code points of the
document it came from, and spans are reported there.

Kinds: ``assign``, ``access``, ``hex`` for the text itself; a secret that shows only
after decoding is named with its path, as ``access@base64+gzip``.  An encoded piece
that unpacks to more than ``MAX_LAYER`` bytes is not held whole in memory: it is
unpacked and scanned window by window, cut only where no match, encoded run or
compressed piece is unfinished, and told as ``oversize@...`` besides its secrets.
A window grows as long as it has no such place.

Defined cases: a null text is the empty text (no spans, digest of the empty string);
repeated rows each get their row; null ids stay null; an empty table gives an empty
result; other columns are ignored; a very long text is scanned whole.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator, Sequence
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import map_batches, slices, texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
MAX_LAYER = 16 << 20

#: URL escapes; a chain of escaped percent signs (``%252525``) is one, undone at once.
URL_RUN = re.compile(r"(?:%(?:25)+|%[0-9A-Fa-f]{2})+")
URL_ESCAPE = re.compile(r"%(?:(?:25)+|..)")
#: Percent escapes and what URL encoders leave bare between them.
URL_MIXED = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9!#$&'()*+,/:;=?@_.~-])+")
#: Unicode escapes of programs (also ``\\u{70}``, octal), of JavaScript's ``escape`` and of HTML; chains of escaped
#: escape signs (``\\u005cu005c``, ``&#38;#38;``) are one.
UNICODE_ESCAPE = re.compile(
    r"(?P<slash>\\(?:u005[cC]|x5[cC]|U0000005[cC]|u\{0*5[cC]\}|134)+)|(?P<amp>&(?:#0*38;|#[xX]0*26;)+)"
    r"|(?P<pair>[\\%]u[dD][89abAB][0-9A-Fa-f]{2}[\\%]u[dD][c-fC-F][0-9A-Fa-f]{2})"
    r"|\\(?:u|U0000)(?P<four>[0-9A-Fa-f]{4})|%u(?P<escape>[0-9A-Fa-f]{4})|\\u\{(?P<braces>[0-9A-Fa-f]{1,6})\}"
    r"|\\U(?P<eight>[0-9A-Fa-f]{8})|\\x(?P<byte>[0-9A-Fa-f]{2})|&#[xX](?P<html>[0-9A-Fa-f]{1,6});?"
    r"|\\(?P<octal>[0-3][0-7]{2}|[0-7]{2})|&#(?P<decimal>[0-9]{1,7});?")
#: Escapes of one byte as programs write them, with the bare characters between them; up to the end of the line.
BYTE_RUN = re.compile(r"(?:\\(?:x[0-9A-Fa-f]{2}|u00[0-9A-Fa-f]{2}|[0abfnrtv\\'\"/])|[^\\\r\n\u0100-\U0010ffff])+")
BYTE_HINT = re.compile(r"\\(?:x|u00)(?i:1f|fd|78|42|5d|5e|01|9c|da)|\\.*(?:BZh|x\^)|(?:BZh|x\^).*\\|(?:PK|\])\\(?:x|u00)0", re.S)
BYTE_ESCAPE = re.compile(r"\\(?:x|u00)([0-9A-Fa-f]{2})|\\(.)|(.)", re.S)
LETTER_ESCAPE = {"0": 0, "a": 7, "b": 8, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11}
#: What parts the lines of base64: a line end, a line end written as an escape, or the end of a string literal and the
#: begin of the next.
LINE = r"(?:\r?\n[ \t]*|(?:\\r)?\\n|[\"'][ \t]*[+\\]?[ \t]*\r?\n[ \t]*\+?[ \t]*[\"'])"
LINE_END = re.compile(LINE)
#: Base64, also when it is broken into lines (all but the last of at least 16 characters).
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}(?:{LINE}[A-Za-z0-9+/_-]{{16,}})*(?:{LINE}[A-Za-z0-9+/_-]+(?![A-Za-z0-9+/_ -]))?={{0,2}}")
#: ASCII characters each followed by one NUL (UTF-16) or three (UTF-32); the last of a big-endian stretch stands after it.
WIDE = re.compile(r"(?:[\x01-\x7f]\x00{3}){2,}|(?:[\x01-\x7f]\x00(?!\x00\x00)){2,}")
#: First bytes of the compressed formats that are unpacked, wherever they stand in a layer.
MAGIC = re.compile(rb"(?P<gzip>\x1f\x8b\x08)|(?P<zlib>x[\x01\x5e\x9c\xda])|(?P<bzip2>BZh[1-9](?:1AY&SY|\x17rE8P\x90))"
                   rb"|(?P<xz>\xfd7zXZ\x00)|(?P<lzma>\x5d\x00\x00[\x00-\xff]{2}(?:\xff{8}|[\x00-\xff]{5}\x00{3}))"
                   rb"|(?P<zip>PK\x03\x04[\x00-\xff]{4}\x08\x00)")
CHUNK = 1 << 16
#: Places in bytes that no match and no encoded run goes over: after the first blank behind a word (also in UTF-16; not
#: behind a keyword, and not in a line with byte escapes), at a line end that cannot be inside base64, between zeros.
CUT = re.compile(rb"(?P<blank>(?:(?<=[A-Za-z0-9.,;)>])\x20(?![\x00\x20]))|(?:(?<=[A-Za-z0-9.,;)>]\x00)\x20\x00(?=[\x01-\x7f]\x00)))"
                 rb"|(?<=[^A-Za-z0-9+/_\x00\r\"'\\ \t-])\r?\n(?!\x00)|(?<!\x00)\n(?=[^A-Za-z0-9+/_\x00 \t\"'-])|\x00{4}(?=\x00{4})")
KEYWORD_END = re.compile(rb"(?i:password|passwd|secret|token|api_?key)$")


class Oversize(Exception):
    """An encoded piece unpacks to more than the layer limit."""


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """Base matches of one layer: kind, start, end (leftmost, non-overlapping per kind)."""
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


class Packed:
    """Compressed bytes that begin at ``at``: ``chunks`` gives their content in pieces of at most
    ``CHUNK`` bytes, through all members that follow each other; then ``end`` is where they end."""

    def __init__(self, name: str, data: bytes, at: int):
        self.name, self.data, self.at, self.end = name, data, at, at
        self.whole = self.broken = False

    def _member(self) -> Iterator[bytes]:
        view = memoryview(self.data)
        inflate = self.name in ("gzip", "zlib", "zip", "deflate")
        if inflate:
            d = zlib.decompressobj(47 if self.name in ("gzip", "zlib") else -15)
        else:
            d = bz2.BZ2Decompressor() if self.name == "bzip2" else lzma.LZMADecompressor(memlimit=256 << 20)
        if self.name == "zip":  # the local header: its size and those of name and extra field
            self.end += 30 + sum(int.from_bytes(view[self.end + i:self.end + i + 2], "little") for i in (26, 28))
        while self.end < len(view) and not d.eof:
            piece = view[self.end:self.end + CHUNK]
            out = d.decompress(piece, CHUNK)
            self.end += len(piece)
            while out or (getattr(d, "unconsumed_tail", b"") and not d.eof):
                yield out
                if d.eof:
                    break
                rest = d.unconsumed_tail if inflate else b""
                out = d.decompress(rest, CHUNK) if rest or not getattr(d, "needs_input", True) else b""
        if not d.eof and inflate:
            yield d.flush()
        self.whole = d.eof
        self.end -= len(d.unused_data)

    def chunks(self) -> Iterator[bytes]:
        while True:
            try:
                self.whole = False
                yield from self._member()
            except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
                self.broken = True
                return
            if not self.whole:
                return
            pad = self.end
            while pad < len(self.data) and self.data[pad] == 0:  # between members
                pad += 1
            m = MAGIC.match(self.data, pad)
            if m is None or m.lastgroup != self.name:
                return
            self.end = pad


def content(packed: Packed) -> bytes:
    """The whole content of ``packed``, of at most ``MAX_LAYER`` bytes."""
    out, size = [], 0
    for chunk in packed.chunks():
        out.append(chunk)
        size += len(chunk)
        if size > MAX_LAYER:
            raise Oversize(packed.name)
    return b"".join(out)


def unpack(data: bytes, at: int = 0) -> tuple[str, bytes, int] | None:
    """The format, content and end of the compressed bytes at ``at``; None if there are none."""
    m = MAGIC.match(data, at)
    if m is None:
        return None
    packed = Packed(m.lastgroup, data, at)
    got = content(packed)
    return (packed.name, got, packed.end) if got else None


def last_cut(data: bytes) -> int:
    """The last place of ``data`` where it can be cut without parting a match, an encoded run or compressed bytes,
    also if more bytes follow; 0 if there is none."""
    limit, inside = len(data) - 8, []
    for m in MAGIC.finditer(data):
        if inside and m.start() < inside[-1][1]:
            continue
        packed = Packed(m.lastgroup, data, m.start())
        for _ in packed.chunks():
            pass
        if packed.end >= limit and not packed.broken:  # it, or a further member of it, goes on
            limit = min(limit, m.start())
            break
        if packed.whole:
            inside.append((m.start(), packed.end))
    limit = min(limit, max(len(data) - 8, 0))
    for back in (1 << 12, 1 << 18, len(data)):
        for m in reversed([m for m in CUT.finditer(data, max(0, limit - back)) if m.end() <= limit]):
            at = m.end()
            if at > limit:
                continue
            if m["blank"] is not None:
                if KEYWORD_END.search(data[max(0, m.start() - 64):m.start()].replace(b"\0", b"")):
                    continue
                line = data.rfind(b"\n", 0, at) + 1
                hits = [p for p in (data.find(x, line, at) for x in (b"\\", b"BZh")) if p >= 0]
                if hits:  # byte escapes go on to the end of the line
                    limit = min(hits)
                    continue
            for a, b in inside:
                if a < at < b:
                    limit = a
                    break
            else:
                return at
    return 0


def reading(data: bytes) -> str:
    """Bytes as text: UTF-8 if they are UTF-8, else one character a byte.  The patterns are ASCII,
    so they match the same bytes in both."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def decode_base64(token: str) -> Iterator[tuple[int, bytes]]:
    """The bytes of a base64 run (its characters alone), begun at each of its first four characters."""
    body = token.translate(str.maketrans("-_", "+/"))
    for at in range(4):
        part = body[at:len(body) - 1] if (len(body) - at) % 4 == 1 else body[at:]
        yield at, base64.b64decode(part + "=" * (-len(part) % 4))


def _escape(m: re.Match) -> str:
    how, part = m.lastgroup, m[m.lastgroup]
    if how in ("slash", "amp"):
        return part[0]
    if how == "pair":
        return chr(0x10000 + ((int(part[2:6], 16) - 0xD800) << 10) + int(part[8:], 16) - 0xDC00)
    code = int(part, 8 if how == "octal" else 10 if how == "decimal" else 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


class Layer:
    """A decoded text and where its characters come from: ``at`` is None (the document
    itself), one span for the whole layer, or the places in the layer before."""

    def __init__(self, text: str, at=None, path: tuple[str, ...] = ()):
        self.text, self.at, self.path = text, at, path

    def span(self, start: int, end: int) -> tuple[int, int]:
        at = self.at
        while at is not None and not isinstance(at, tuple):
            start, end = at.up(start, end)
            at = at.before
        return (start, end) if at is None else at

    def replaced(self, pieces: list[tuple[int, int, list[tuple[str, int, int]]]], name: str) -> Layer:
        """The layer with pieces (start, end, [(char, its start, its end)]) put in place."""
        out, places, last, size = [], Pieces(self.at), 0, 0
        for a, b, chars in pieces:
            out.append(self.text[last:a])
            places.copied(size, last)
            size += a - last
            out.append("".join(c for c, _, _ in chars))
            places.decoded(size, chars)
            size += len(chars)
            last = b
        out.append(self.text[last:])
        places.copied(size, last)
        return Layer("".join(out), self.at if isinstance(self.at, tuple) else places, (*self.path, name))


class Pieces:
    """Places of a layer in which pieces were replaced; memory grows with the pieces, not with the text.

    ``begins`` are where stretches of the layer begin and ``sources`` where a copied stretch begins in the layer
    ``before`` (whose own places are kept, not its text), or, below zero, the first of a decoded stretch's characters.
    """

    def __init__(self, before):
        self.before = before
        self.begins, self.sources, self.starts, self.ends = (array("q") for _ in range(4))

    def copied(self, at: int, source: int) -> None:
        self.begins.append(at)
        self.sources.append(source)

    def decoded(self, at: int, chars: list[tuple[str, int, int]]) -> None:
        self.begins.append(at)
        self.sources.append(-1 - len(self.starts))
        self.starts.extend(a for _, a, _ in chars)
        self.ends.extend(b for _, _, b in chars)

    def _place(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.begins, i) - 1
        by, source = i - self.begins[k], self.sources[k]
        if source >= 0:
            return source + by, source + by + 1
        return self.starts[by - 1 - source], self.ends[by - 1 - source]

    def up(self, start: int, end: int) -> tuple[int, int]:
        return self._place(start)[0], self._place(end - 1)[1]


class Base64Places:
    """Places of the bytes of a base64 run whose characters stand at ``places`` of the layer ``before``; ``at`` of
    them come before the first byte."""

    def __init__(self, before, places: Sequence[int], at: int):
        self.before, self.places, self.at = before, places, at

    def up(self, start: int, end: int) -> tuple[int, int]:
        return self.places[self.at + 8 * start // 6], self.places[self.at + (8 * end - 1) // 6] + 1


def url_layer(layer: Layer) -> Layer | None:
    """The layer with its URL escapes decoded."""
    pieces = []
    for m in URL_RUN.finditer(layer.text):
        tokens = [(t.start(), 0x25 if t.end() - t.start() > 3 else int(t[0][1:], 16)) for t in URL_ESCAPE.finditer(layer.text, *m.span())]
        offsets = [t for t, _ in tokens] + [m.end()]
        chars, at = [], 0
        for c in bytes(x for _, x in tokens).decode("utf-8", "replace"):
            n = len(c.encode()) if c != "�" else 1
            chars.append((c, offsets[min(at, len(tokens) - 1)], offsets[min(at + n, len(tokens))]))
            at += n
        pieces.append((m.start(), m.end(), chars))
    return layer.replaced(pieces, "url") if pieces else None


def escaped_bytes(text: str, how: str) -> Iterator[tuple[bytes, list[int]]]:
    """Stretches of URL (``url``) or byte escapes (``unicode``) as bytes that may hold compressed ones, each with
    the places of its bytes in the text and the end."""
    for m in (URL_MIXED if how == "url" else BYTE_RUN).finditer(text):
        if how == "url" and not ("%" in m[0] and MAGIC.search(unquote_to_bytes(m[0]))) or how != "url" and not BYTE_HINT.search(m[0]):
            continue
        data, places = bytearray(), []
        if how == "url":
            for part in re.finditer(r"%(..)|[^%]", m[0], re.S):
                data.append(int(part[1], 16) if part[1] else ord(part[0]))
                places.append(m.start() + part.start())
        else:
            for part in BYTE_ESCAPE.finditer(m[0]):
                data.append(int(part[1], 16) if part[1] else ord(part[3]) if part[3] else LETTER_ESCAPE.get(part[2], ord(part[2])))
                places.append(m.start() + part.start())
        places.append(m.end())
        yield bytes(data), places
        if how == "url" and "+" in m[0]:  # a blank in forms
            yield bytes(32 if text[a] == "+" else c for a, c in zip(places, data)), places


def unicode_layer(layer: Layer) -> Layer | None:
    """The layer with its Unicode escapes decoded."""
    pieces = [(m.start(), m.end(), [(_escape(m), m.start(), m.end())]) for m in UNICODE_ESCAPE.finditer(layer.text)]
    return layer.replaced(pieces, "unicode") if pieces else None


def wide_layer(layer: Layer) -> Layer | None:
    """The layer with its ASCII stretches of UTF-16 or UTF-32, of either byte order and at any place, as plain characters."""
    pieces = [(m.start(), m.end(), [(c[0][0], m.start() + c.start(), m.start() + c.end()) for c in re.finditer("[^\0]\0+", m[0])])
              for m in WIDE.finditer(layer.text)]
    return layer.replaced(pieces, "wide") if pieces else None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All secrets of a document: kind, start, end in code points, in order of start, kind, end."""
    found: dict[tuple[str, int, int], str] = {}
    todo: deque[Layer] = deque([Layer(text)])
    seen: set[tuple] = set()
    seen_bytes: set[tuple] = set()

    def push(layer: Layer) -> None:
        # a layer is known by its content and its place in the document
        place = layer.span(0, len(layer.text)) if layer.text else None
        key = (hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest(), place)
        if layer.text and key not in seen:
            seen.add(key)
            todo.append(layer)

    def push_packed(data: bytes, place, path: tuple[str, ...]) -> None:
        """Layers of the compressed bytes in ``data``; ``place`` gives the span of its bytes from one place to another."""
        end = 0
        for m in MAGIC.finditer(data):
            if m.start() < end:
                continue
            try:
                got = unpack(data, m.start())
            except Oversize as e:
                end = push_windows(Packed(str(e), data, m.start()), place, (*path, str(e)))
                continue
            if got is not None:
                at = place(m.start(), got[2])
                end = got[2] if len(got[1]) >= 16 else end
                push_bytes(got[1], at, (*path, got[0]))

    def push_deflate(data: bytes, place, path: tuple[str, ...]) -> None:
        """The layer of ``data`` that is raw deflate (which has no mark) from its begin to its end."""
        packed = Packed("deflate", data, 0)
        try:
            got = content(packed)
        except Oversize:
            push_windows(packed, place, (*path, "deflate"))
            return
        if packed.whole and len(got) >= 16 and packed.end >= len(data) - 2:
            push_bytes(got, place(0, packed.end), (*path, "deflate"))

    def push_windows(packed: Packed, place, path: tuple[str, ...]) -> int:
        """Scans the content of ``packed`` window by window; gives its end."""
        for _ in packed.chunks():
            pass
        end = packed.end
        at = place(packed.at, end)
        found.setdefault(("oversize", *at), "@" + "+".join(path))
        key = (hashlib.blake2b(memoryview(packed.data)[packed.at:end], digest_size=16).digest(), *at)
        if key in seen_bytes:
            return end
        seen_bytes.add(key)
        window, full = bytearray(), MAX_LAYER
        for chunk in Packed(packed.name, packed.data, packed.at).chunks():
            window += chunk
            if len(window) >= full:
                cut = last_cut(bytes(window))
                if cut:
                    push_bytes(bytes(window[:cut]), at, path)
                    drain()
                    del window[:cut]
                full = max(MAX_LAYER, 2 * len(window))
        push_bytes(bytes(window), at, path)
        drain()
        return end

    def push_bytes(data: bytes, at: tuple[int, int], path: tuple[str, ...]) -> None:
        key = (hashlib.blake2b(data, digest_size=16).digest(), *at)
        if key not in seen_bytes:
            seen_bytes.add(key)
            push(Layer(reading(data), at, path))
            push_packed(data, lambda a, b: at, path)

    def drain() -> None:
        while todo:
            layer = todo.popleft()
            for kind, a, b in scan(layer.text):
                found.setdefault((kind, *layer.span(a, b)), "@" + "+".join(layer.path) if layer.path else "")
            for how, mark in (("url", "%"), ("unicode", "\\")):
                if mark in layer.text:
                    for data, places in escaped_bytes(layer.text, how):
                        push_packed(data, lambda x, y: layer.span(places[x], places[y]), (*layer.path, how))
            if "%" in layer.text and (child := url_layer(layer)) is not None:
                push(child)
            if ("\\" in layer.text or "&#" in layer.text or "%u" in layer.text) and (child := unicode_layer(layer)) is not None:
                push(child)
            if "\0" in layer.text and (child := wide_layer(layer)) is not None:
                push(child)
            path = (*layer.path, "base64")
            for m in BASE64.finditer(layer.text):
                # without line breaks, places are a range
                last, places, parts = m.start(), None, []
                for line in LINE_END.finditer(layer.text, *m.span()):
                    places = places or array("q")
                    places.extend(range(last, line.start()))
                    parts.append(layer.text[last:line.start()])
                    last = line.end()
                parts.append(layer.text[last:m.end()].rstrip("="))
                rest = range(last, last + len(parts[-1]))
                if places is None:
                    places = rest
                else:
                    places.extend(rest)
                for at, data in decode_base64("".join(parts)):
                    if len(data) >= 16 or MAGIC.search(data):  # no secret and no further layer is shorter
                        # one character a byte, so that every byte has its place
                        push(Layer(data.decode("latin-1"),
                                   layer.at if isinstance(layer.at, tuple) else Base64Places(layer.at, places, at), path))

                        def place(x: int, y: int) -> tuple[int, int]:
                            return layer.span(places[at + 8 * x // 6], places[at + (8 * y - 1) // 6] + 1 if y < len(data) else m.end())

                        push_packed(data, place, path)
                        push_deflate(data, place, path)

    drain()
    order = {k: i for i, k in enumerate(KINDS)}
    return [(k + how, a, b) for (k, a, b), how in
            sorted(found.items(), key=lambda x: (x[0][1], bool(x[1]), order.get(x[0][0], 9), x[0][2], x[1]))]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with the span of every secret (overlaps merged) replaced by ``mark``."""
    spans = sorted((a, b) for k, a, b in find_spans(text) if not k.startswith("oversize@"))
    out, last, i = [], 0, 0
    while i < len(spans):
        a, b = spans[i]
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][1])
            i += 1
        out += [text[last:a], mark]
        last = b
    return "".join([*out, text[last:]])


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, all spans."""

    def batch(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded")}
        for text in texts(b.column(1)):
            spans = find_spans(text)
            base = [s for s in spans if s[0] in KINDS]
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(spans))
            out["n_decoded"].append(len(spans) - len(base))
        return {"doc_id": b.column(0)} | {k: pa.array(v, pa.string() if isinstance(v[0], str) else pa.int64())
                                          for k, v in out.items()}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch,
                       "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
                       "n_decoded long")


def redact_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` (all columns) with the secrets of ``text`` replaced; null texts stay null."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            new = pa.array([None if t is None else redact(t, mark) for t in b.column(at).to_pylist()],
                           b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
