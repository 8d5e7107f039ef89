"""Secret scanning with a recursive decoding worklist.

A text is scanned as it is; then URL escapes, Unicode escapes, base64 runs and
compressed data inside them are unwrapped, layer upon layer, until no layer
yields a new text. Every layer is scanned, and spans found in it are mapped
back to the code points of the original text.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect
from collections.abc import Iterator
from html.entities import html5
from itertools import chain
from urllib.parse import unquote_to_bytes

import zstandard
from pyspark.sql import DataFrame

from panelkit.llm.common import map_text

MAX_INFLATED = 64 << 20  # bytes; what a compressed stream holds beyond is read window by window
WINDOW_BYTES = 4 << 20   # of such a stream at a time
OVERLAP_BYTES = 64 << 10  # that a window repeats of the one before, for secrets and runs across the cut
DECODER_BYTES = 160 << 20  # working memory of an xz or zstandard decoder; xz -9 needs 65 MB, zstd --ultra -22 128 MB

# Fixed patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
# Escapes of one character: \u0070 and %u0070, \x70, \u{70}, \U00000070, &#x70; and &#112; (also without the
# semicolon), \160, &quot;
_ESCAPE = (r"[\\%]u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})"
           r"|&#[xX]([0-9A-Fa-f]{1,6});?|&#([0-9]{1,7});?|\\([0-3][0-7]{2})|&([A-Za-z][A-Za-z0-9]{1,31};)")
UNICODE_ONE = re.compile(_ESCAPE)
UNICODE_RUN = re.compile("(?:" + re.sub(r"(?<!\\)\((?!\?)", "(?:", _ESCAPE) + ")+")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{16,}+)*(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)?={0,2}")
URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/+!*'()-])+")
URL_BYTE = re.compile(r"%..|.")
MAGIC = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd", re.DOTALL)
UTF8 = re.compile(
    rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"
    rb"|\xf4[\x80-\x8f][\x80-\xbf]{2}){3,}+", re.DOTALL)

Span = tuple[int, int, int]  # start, kind, end


def scan_layer(text: str) -> list[Span]:
    """Secrets in one text: leftmost non-overlapping matches of each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


# A replacement: start and end in the layer, and for every new character its own start and end.
Change = tuple[int, int, str, list[tuple[int, int]]]


def _url_streams(text: str) -> list[Change]:
    """Compressed data escaped byte by byte, where letters and digits stand for themselves."""
    out = []
    for m in URL_BYTES.finditer(text):
        if "%" not in m.group():
            continue
        raw = unquote_to_bytes(m.group())
        found = _streams(raw) or (_streams(raw_plus) if (raw_plus := unquote_to_bytes(m.group().replace("+", " "))) != raw
                                  else [])
        if found:
            own = [b.span() for b in URL_BYTE.finditer(text, m.start(), m.end())]
            out += [(own[i][0], own[j - 1][1], new, [(own[i][0], own[j - 1][1])] * len(new)) for i, j, new in found]
    return out


def _url(text: str) -> list[Change]:
    if "%" not in text:
        return []
    out = _url_streams(text)
    streams = [(c[0], c[1]) for c in out]
    for m in URL_RUN.finditer(text):
        if any(m.start() < end and start < m.end() for start, end in streams):
            continue
        try:
            new = bytes.fromhex(m.group().replace("%", "")).decode("utf-8")
        except UnicodeDecodeError:
            continue
        places, at = [], m.start()
        for ch in new:
            width = 3 * len(ch.encode("utf-8"))
            places.append((at, at + width))
            at += width
        out.append((m.start(), m.end(), new, places))
    return sorted(out, key=lambda c: c[0])


def _unicode(text: str) -> list[Change]:
    out = []
    for m in UNICODE_RUN.finditer(text) if "\\" in text or "&" in text or "%u" in text else ():
        new, places = [], []
        for one in UNICODE_ONE.finditer(text, m.start(), m.end()):
            u, x, braced, wide, entity, decimal, octal, name = one.groups()
            if name:
                chars = html5.get(name)
                if chars is None:   # no entity: its characters stand for themselves
                    new += one.group()
                    places += [(k, k + 1) for k in range(*one.span())]
                else:
                    new += chars
                    places += [one.span()] * len(chars)
                continue
            code = int(decimal) if decimal else int(octal, 8) if octal else int(u or x or braced or wide or entity, 16)
            if u and 0xDC00 <= code < 0xE000 and new and 0xD800 <= ord(new[-1]) < 0xDC00:
                new[-1] = chr(0x10000 + ((ord(new[-1]) - 0xD800) << 10) + code - 0xDC00)
                places[-1] = (places[-1][0], one.end())
            elif code <= 0x10FFFF:
                new.append(chr(code))
                places.append(one.span())
        if new and "".join(new) != m.group():
            out.append((m.start(), m.end(), "".join(new), places))
    return out


class TooLarge(Exception):
    """A stream that inflates beyond MAX_INFLATED."""


class Large(str):
    """Stands (as an empty text) for what a stream beyond MAX_INFLATED holds; ``raw`` is the stream."""

    raw: bytes

    def __new__(cls, raw: bytes):
        made = super().__new__(cls, "")
        made.raw = raw
        return made


def _zstandard(raw: memoryview, room: int) -> tuple[bytes, int] | None:
    """As :func:`_member`, fed in small pieces so that a frame that grows beyond ``room`` is left early."""
    d = zstandard.ZstdDecompressor(max_window_size=DECODER_BYTES).decompressobj()
    parts, held, step = [], 0, 1 << 10
    for at in range(0, len(raw), step):
        parts.append(d.decompress(raw[at:at + step]))
        held += len(parts[-1])
        if held > room:
            raise TooLarge
        if d.eof:
            return b"".join(parts), min(at + step, len(raw)) - len(d.unused_data)
    return b"".join(parts), len(raw)


def _member(raw: memoryview, room: int) -> tuple[bytes, int] | None:
    """What one compressed stream at the start of ``raw`` holds and how many bytes it takes; None for other bytes."""
    try:
        if raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] == 0x78 and (raw[0] * 256 + raw[1]) % 31 == 0):
            d = zlib.decompressobj(wbits=47)
            out = d.decompress(raw, room)
            if d.unconsumed_tail:
                raise TooLarge
            return out, len(raw) - len(d.unused_data)
        if raw[:3] == b"BZh":
            d = bz2.BZ2Decompressor()
        elif raw[:6] == b"\xfd7zXZ\x00":
            d = lzma.LZMADecompressor(memlimit=DECODER_BYTES)
        elif raw[:4] == b"\x28\xb5\x2f\xfd":
            return _zstandard(raw, room)
        else:
            return None
        out = d.decompress(raw, room)
        if not (d.eof or d.needs_input):
            raise TooLarge
        return out, len(raw) - len(d.unused_data)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
        return None


def _members(raw: bytes | memoryview) -> tuple[bytes, int] | None:
    """What the compressed streams at the start of ``raw`` hold, one after another, and the bytes they take."""
    raw, parts, held, used = memoryview(raw), [], 0, 0
    while used < len(raw) and (got := _member(raw[used:], max(1, MAX_INFLATED - held))) is not None and got[1]:
        parts.append(got[0])
        held += len(got[0])
        used += got[1]
    return (b"".join(parts), used) if parts else None


def inflate(raw: bytes) -> bytes | None:
    """What gzip, zlib, bzip2, xz or zstandard streams hold; None for other bytes."""
    got = _members(raw)
    return got and got[0]


class _Feed:
    """A decoder of one stream that takes and gives a bounded number of bytes at a time."""

    def __init__(self, head: bytes) -> None:
        self.step, self.tail, self.wants = 1 << 16, b"", True
        if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] == 0x78 and (head[0] * 256 + head[1]) % 31 == 0):
            self.kind, self.d = "zlib", zlib.decompressobj(wbits=47)
        elif head[:3] == b"BZh":
            self.kind, self.d = "bounded", bz2.BZ2Decompressor()
        elif head[:6] == b"\xfd7zXZ\x00":
            self.kind, self.d = "bounded", lzma.LZMADecompressor(memlimit=DECODER_BYTES)
        elif head[:4] == b"\x28\xb5\x2f\xfd":
            self.kind, self.step = "frame", 1 << 10
            self.d = zstandard.ZstdDecompressor(max_window_size=DECODER_BYTES).decompressobj()
        else:
            raise ValueError("no compressed stream")

    def feed(self, data: bytes) -> bytes:
        if self.kind == "zlib":
            out = self.d.decompress(self.tail + data, WINDOW_BYTES)
            self.tail = self.d.unconsumed_tail
            self.wants = not self.tail
        elif self.kind == "bounded":
            out = self.d.decompress(data, WINDOW_BYTES)
            self.wants = self.d.eof or self.d.needs_input
        else:
            out = self.d.decompress(data)
        return out


def _inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """What the streams in ``pieces`` hold, one after another, up to the first bytes that are none."""
    held = b""

    def take(size: int) -> bytes:
        nonlocal held
        while len(held) < size and (more := next(pieces, None)) is not None:
            held += more
        out, held = held[:size], held[size:]
        return out

    try:
        while head := take(8):
            held = head + held
            d = _Feed(head)
            while not d.d.eof:
                data = take(d.step) if d.wants else b""
                if d.wants and not data:
                    return
                if out := d.feed(data):
                    yield out
            held = d.d.unused_data + held
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
        return


def _windows(raw: bytes) -> Iterator[str]:
    """The text in a large stream, in overlapping windows; compressed layers directly inside it are unwrapped, too.

    A window that is no UTF-8 (but for characters cut at its ends) is passed over.
    """
    pieces, met = _inflated(iter((raw,))), set()
    while True:
        first = next(pieces, b"")
        inner = chain((first,), pieces)
        digest = hashlib.sha256(first).digest()
        if not MAGIC.match(first) or digest in met:
            pieces = inner
            break
        met.add(digest)
        pieces = _inflated(inner)
    held = b""
    for piece in pieces:
        held += piece
        while len(held) >= WINDOW_BYTES:
            if text := _cut_text(held[:WINDOW_BYTES]):
                yield text
            held = held[WINDOW_BYTES - OVERLAP_BYTES:]
    if text := _cut_text(held):
        yield text


def _cut_text(window: bytes) -> str | None:
    start = next((k for k in range(min(4, len(window))) if window[k] & 0xC0 != 0x80), 0)
    for end in range(len(window), max(start, len(window) - 4), -1):
        try:
            return window[start:end].decode("utf-8")
        except UnicodeDecodeError:
            continue
    return None


def _plain(raw: bytes) -> str | None:
    """The text that bytes hold, after unwrapping compressed layers; None if they hold none."""
    seen = set()
    try:
        while (inner := inflate(raw)) is not None:
            digest = hashlib.sha256(inner).digest()
            if digest in seen:  # a stream that unwraps to itself
                return None
            seen.add(digest)
            raw = inner
    except TooLarge:
        return Large(raw)
    if (wide := _wide(raw)) is not None:
        return wide
    try:
        return raw.decode("utf-8") or None
    except UnicodeDecodeError:
        return None


def _wide(raw: bytes) -> str | None:
    """UTF-16 text with a byte order mark, or with a zero in every second byte; None for other bytes."""
    even = raw[:len(raw) - len(raw) % 2]
    if even[:2] in (b"\xff\xfe", b"\xfe\xff"):
        kind = "utf-16"
    elif len(even) >= 24 and not any(even[1:128:2]) and all(even[:128:2]):
        kind = "utf-16-le"
    elif len(even) >= 24 and not any(even[:128:2]) and all(even[1:128:2]):
        kind = "utf-16-be"
    else:
        return None
    try:
        return even.decode(kind) or None
    except UnicodeDecodeError:
        return None


def _streams(raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, text) of the compressed streams anywhere in ``raw``."""
    out, at = [], 0
    while m := MAGIC.search(raw, at):
        at = m.start() + 1
        try:
            got = _members(memoryview(raw)[m.start():])
        except TooLarge:   # its end is not known before it is read
            out.append((m.start(), len(raw), Large(bytes(raw[m.start():]))))
            break
        if got is not None and (text := _plain(got[0])) is not None:
            at = m.start() + got[1]
            out.append((m.start(), at, text))
    return out


# A decoded piece of a run: start and end in the run, text, and its own span for every character (None: the piece's).
Piece = tuple[int, int, str, list[tuple[int, int]] | None]


def _pieces(run: str) -> list[Piece]:
    """What a base64 run without padding holds, from its first character or from any other.

    A run that decodes as a whole is one piece. Else the compressed streams
    and the UTF-8 parts of at least 12 bytes are taken at all four alignments,
    the longest first, so that what stands before or after a payload (a path,
    a name) does not hide it.
    """
    run = run.translate({45: 43, 95: 47})
    found: list[Piece] = []
    for shift in range(4):
        n = len(run) - shift
        n -= n % 4 == 1
        raw = binascii.a2b_base64(run[shift:shift + n] + "=" * (-n % 4))

        def place(i: int, j: int) -> tuple[int, int]:
            return shift + i * 4 // 3, min(shift - (-j * 4 // 3), len(run))

        found += [(*place(i, j), text, None) for i, j, text in _streams(raw)]
        if (wide := _wide(raw)) is not None:
            found.append((*place(0, len(raw)), wide, None))
        for m in UTF8.finditer(raw):
            if m.end() - m.start() >= 12:
                text, spans, i = m.group().decode("utf-8"), [], m.start()
                for ch in text:
                    j = i + (1 if ch < "\x80" else len(ch.encode("utf-8")))
                    spans.append(place(i, j))
                    i = j
                found.append((*place(m.start(), m.end()), text, spans))
        if any(start == 0 and end >= len(run) - 1 for start, end, _, _ in found):
            break
    chosen: list[Piece] = []
    for piece in sorted(found, key=lambda p: (p[0] - p[1], p[3] is not None, p[0])):
        k = bisect(chosen, piece[0], key=lambda p: p[0])
        if (not k or chosen[k - 1][1] <= piece[0]) and (k == len(chosen) or piece[1] <= chosen[k][0]):
            chosen.insert(k, piece)
    return chosen


def _base64(text: str) -> list[Change]:
    out = []
    for m in BASE64_RUN.finditer(text):
        run = m.group().rstrip("=")
        for start, end, new, _ in _pieces(run):
            at = m.start() + start, m.end() if end >= len(run) - 1 else m.start() + end
            out.append((*at, new, [at] * len(new)))
    return out


def _wrapped(text: str) -> list[Change]:
    """Base64 over several lines (MIME, PEM), joined."""
    out = []
    for m in WRAPPED_RUN.finditer(text) if "\n" in text else ():
        own = [k for k in range(m.start(), m.end()) if text[k] not in " \t\r\n="]
        for start, end, new, spans in _pieces("".join(text[k] for k in own)):
            at = own[start], m.end() if end >= len(own) - 1 else own[end - 1] + 1
            if text.find("\n", *at) >= 0:  # else _base64 has it
                places = [at] * len(new) if spans is None else [(own[i], own[j - 1] + 1) for i, j in spans]
                out.append((*at, new, places))
    return out


class _Same:
    """The places of a window: every character stands for the whole stream's span."""

    def __init__(self, place: tuple[int, int]) -> None:
        self.place = place

    def __getitem__(self, at: int) -> tuple[int, int]:
        return self.place


def _apply(text: str, places: list[tuple[int, int]] | _Same | None, changes: list[Change]) -> tuple[str, list | _Same]:
    """The next layer: changed text and, for each character, its span in the original text."""
    if isinstance(places, _Same):
        ends = [0, *(c[1] for c in changes)]
        return "".join([x for at, c in zip(ends, changes) for x in (text[at:c[0]], c[2])] + [text[ends[-1]:]]), places
    own = places if places is not None else [(k, k + 1) for k in range(len(text))]
    parts, mapped, at = [], [], 0
    for start, end, new, inner in changes:
        parts += [text[at:start], new]
        mapped += own[at:start]
        mapped += [(own[s][0], own[e - 1][1]) for s, e in inner]
        at = end
    parts.append(text[at:])
    return "".join(parts), mapped + own[at:]


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each sorted by start, kind and end."""
    text = text or ""
    base = scan_layer(text)
    spans, seen = set(base), set()

    def fresh(layer: bytes) -> bool:
        """Whether a layer comes for the first time; layers are known by their digests."""
        digest = hashlib.sha256(layer).digest()
        new = digest not in seen
        seen.add(digest)
        return new

    def explore(top: str, top_places: _Same | None) -> None:
        work = [(top, top_places)]
        while work:
            layer, places = work.pop()
            for decode in (_url, _unicode, _base64, _wrapped):
                changes = decode(layer)
                if not changes:
                    continue
                if not seen:
                    fresh(text.encode("utf-8", "surrogatepass"))
                child, mapped = _apply(layer, places, changes)
                if fresh(child.encode("utf-8", "surrogatepass")):
                    work.append((child, mapped))
                    spans.update((mapped[s][0], kind, mapped[e - 1][1]) for s, kind, e in scan_layer(child))
                for start, end, new, _ in changes:
                    if isinstance(new, Large) and fresh(new.raw):
                        place = (start, end) if places is None else (places[start][0], places[end - 1][1])
                        for window in _windows(new.raw):
                            spans.update((place[0], kind, place[1]) for _, kind, _ in scan_layer(window))
                            explore(window, _Same(place))

    explore(text, None)
    return sorted(base), sorted(spans)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with every (merged) secret span replaced by ``[SECRET]``."""
    if not spans:
        return text
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    Counts and the digest are of the undecoded text; ``spans`` joins all spans
    (kind:start:end in code points, by start and kind). A null or empty text
    has no spans (empty string, digest of the empty string). Rows are scanned
    one by one, whole; an empty table gives an empty result.
    """

    def fn(texts: list) -> dict[str, list]:
        out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
        for text in texts:
            base, spans = find_secrets(text)
            for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(sum(s[1] == kind for s in base))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(spans))
        return out

    return map_text(docs, keep, text_col,
                    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", fn)


def redact(docs: DataFrame, keep: list[str], text_col: str = "text", out_col: str = "redacted") -> DataFrame:
    """``keep`` columns and the text with secrets, encoded ones too, replaced (null stays null)."""
    return map_text(docs, keep, text_col, f"{out_col} string",
                    lambda ts: {out_col: [redacted(t, find_secrets(t)[1]) for t in ts]})
