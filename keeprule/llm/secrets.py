"""Search for secrets in texts and in what is encoded in them.

Each text is the first layer of a worklist. Encoded stretches of a layer (URL escapes, Unicode escapes, base64, and
compressed bytes inside base64) are decoded to further layers until nothing new appears; a layer that repeats one already
seen for the same place ends there. Every layer is searched with the same patterns, and the spans found are mapped back
to the original text: to the single characters for escapes, to the whole stretch for base64.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import html
import lzma
import re
import string
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in order, with pattern, group that is measured, and its least length.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
RANK = {kind: place for place, (kind, *_) in enumerate(KINDS)}
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

ESCAPED = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|\w{2,8});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")  # the shortest secret has 12 bytes
#: Stretches that go on over line ends, as encoded files are wrapped: lines that end in a stretch, and perhaps a last line
#: that has no more than the rest of it. A stretch begins where no such character stands before.
LINE = r"[A-Za-z0-9+/_-]{16,}+\r?\n[ \t]*"
REST = r"[A-Za-z0-9+/_-]++={0,2}(?=[\"'<>),;]*[ \t]*(?:\r?\n|$))"
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:(?:{LINE})++{REST}|(?:{LINE}){{2,}}+)")
LINE_END = re.compile(r"\s+")
#: How compressed bytes begin, and what every secret holds.
BEGINNINGS = (b"\x1f\x8b\x08", b"BZh", b"\xfd7zXZ\x00")
READABLE = re.compile(rb"[\x20-\x7e]{12}")
#: A layer that unpacks to more bytes than this is searched as a stream, in windows cut where no pattern can match across.
#: Where no such place comes within as many characters, windows overlap by OVERLAP; the layer is counted in n_too_large.
MAX_LAYER = 64 << 20
CHUNK = WINDOW = 1 << 20
OVERLAP = 1 << 20
#: All characters that a match of ESCAPED, BASE64 or a kind can hold.
INSIDE = string.ascii_letters + string.digits + "+/_.=:\"' %&;#\\-"
BROKEN = (zlib.error, OSError, lzma.LZMAError, EOFError)


def plain_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the matches in one layer, in the order of start and kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # The matches of HEX are the maximal runs, so those long enough are the runs found directly.
    found += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], RANK[x[1]]))


def _escape(run: str) -> str:
    if run[0] == "%":
        return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")
    if run[0] == "&":
        return html.unescape(run)
    if run[1] == "x":
        return bytes.fromhex(run.replace("\\x", "")).decode("utf-8", "replace")
    units = bytes.fromhex(run.replace("\\u", ""))
    return units.decode("utf-16-be", "replace")


def _tool(data: bytes):
    """A decompressor for bytes that begin like compressed ones."""
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(zlib.MAX_WBITS | 32)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\x00" else None


def _unpacked(data: bytes, source: Iterator[bytes]) -> Iterator[bytes]:
    """The content of all compressed members of ``data`` and what ``source`` adds to it, in bounded chunks.

    Nothing if it is not compressed. Raises BROKEN if the first member is none; a later broken one ends the content.
    What follows the members is content too, as far as it is text.
    """
    first = True
    while True:
        while len(data) < 6 and (more := next(source, None)) is not None:
            data += more
        tool = _tool(data)
        if tool is None:
            break
        try:
            while not tool.eof:
                out = tool.decompress(data, CHUNK)
                data = getattr(tool, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not tool.eof and not data and (data := next(source, None)) is None:
                    return  # cut short
        except BROKEN:
            if first:
                raise
            return
        data, first = tool.unused_data, False
    decoder = codecs.getincrementaldecoder("utf-8")()
    while not first and data is not None:
        try:
            decoder.decode(data)
        except UnicodeDecodeError:
            return
        yield data
        data = next(source, None)


def _whole(chunks: Iterator[bytes]) -> bytes | None:
    """All chunks as one; None if they are not compressed. Raises OverflowError beyond MAX_LAYER."""
    found, size = [], 0
    try:
        for chunk in chunks:
            found.append(chunk)
            size += len(chunk)
            if size > MAX_LAYER:
                raise OverflowError
    except BROKEN:
        return None  # it only begins like compressed bytes
    return b"".join(found) or None


def _opened(data: bytes, source: Iterator[bytes]) -> Iterator[bytes]:
    """``data`` and what ``source`` adds, through any compression, in chunks."""
    while len(data) < CHUNK and (more := next(source, None)) is not None:
        data += more
    try:
        packed = next(_unpacked(data, iter(())), None) is not None
    except BROKEN:
        packed = False  # it only begins like compressed bytes
    if packed:
        inner = _unpacked(data, source)
        yield from _opened(next(inner), inner)
    else:
        yield data
        yield from source


class Large:
    """A layer of more than MAX_LAYER bytes, which is never held as a whole."""

    def __init__(self, data: bytes):
        self.data = data

    def windows(self) -> Iterator[tuple[str, bool]]:
        """The text in pieces, and whether nothing can match across the end of each; ends where it is no text."""
        decoder, text = codecs.getincrementaldecoder("utf-8")(), ""
        try:
            for chunk in _opened(self.data, iter(())):
                new = decoder.decode(chunk)
                text, safe = text + new, len(text) + len(new.rstrip(INSIDE)) if new.strip(INSIDE) else 0
                if safe and len(text) >= WINDOW:
                    yield text[:safe], True
                    text = text[safe:]
                elif len(text) >= MAX_LAYER:
                    text = re.sub(" {2,}", " ", text)  # any number of blanks matches like one
                    if len(text) >= MAX_LAYER // 2:
                        yield text, False
                        text = text[-OVERLAP:]
        except (UnicodeDecodeError, *BROKEN):
            pass
        yield text, True


def _content(data: bytes) -> str | Large | None:
    """The text of bytes, through any compression; None if they hold no text."""
    packed = False
    try:
        while (inner := _whole(_unpacked(data, iter(())))) is not None and inner != data:
            data, packed = inner, True
        # The last character of compressed bytes that were cut short may not be whole.
        text = codecs.getincrementaldecoder("utf-8")().decode(data, not packed)
    except OverflowError:
        return Large(data)
    except ValueError:
        return None
    return text or None


def _bytes_of(body: str) -> bytes:
    """The bytes of a stretch, without a last character that stands for less than a byte."""
    if len(body) % 4 == 1:
        body = body[:-1]
    return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)


def _from_base64(run: str) -> Iterator[str | Large]:
    """The texts inside a base64 stretch.

    If the stretch as a whole is text, or compressed text, that is all. Otherwise something is glued to it, as in paths:
    it is read from each of its first four characters, one of which is right for whatever begins further on. Bytes that
    are no text become marks of replacement there, and compressed bytes are opened wherever they begin.
    """
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 != 1 and (text := _content(_bytes_of(body))) is not None:
        yield text
        return
    for skipped in range(4):
        data = _bytes_of(body[skipped:])
        for beginning in BEGINNINGS:
            at = data.find(beginning)
            while at >= 0:
                if (text := _content(data[at:])) is not None:
                    yield text
                at = data.find(beginning, at + 1)
        if READABLE.search(data):
            yield data.decode("utf-8", "replace")


def _children(text: str) -> Iterator[tuple[str | Large, list[int] | None, int, int]]:
    """Layers inside a layer: text, the start in the parent of each character (None: all at start), start and end."""
    if "%" in text or "\\" in text or "&" in text:
        parts, starts, at, changed = [], [], 0, False
        for m in ESCAPED.finditer(text):
            new = _escape(m[0])
            if new == m[0]:
                continue
            changed = True
            parts += [text[at : m.start()], new]
            starts += range(at, m.start())
            width = (m.end() - m.start()) / len(new) if new else 0
            starts += [m.start() + int(k * width) for k in range(len(new))]
            at = m.end()
        if changed:
            starts += range(at, len(text) + 1)
            yield "".join([*parts, text[at:]]), starts, 0, len(text)
    for m in BASE64.finditer(text):
        for inner in _from_base64(m[0]):
            yield inner, None, m.start(), m.end()
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            for inner in _from_base64(LINE_END.sub("", m[0])):
                yield inner, None, m.start(), m.start() + len(m[0].rstrip())


def all_spans(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]], int, int]:
    """Spans of the text itself; spans of all layers; number of further layers; number of those in overlapping windows."""
    base = plain_spans(text)
    found, seen, layers, too_large = set(base), set(), 0, 0

    def note(layer, to):
        for s, kind, e in plain_spans(layer):
            first, last = to(s, e)
            found.add((first, kind, last))

    def search(layer, origin):
        """All layers inside ``layer``; those inside a window of a large one before the next window."""
        nonlocal layers, too_large
        work = [(layer, origin)]
        while work:
            layer, origin = work.pop()
            for inner, starts, start, end in _children(layer):
                if starts is None:
                    place = origin(start, end)
                    to = lambda s, e, place=place: place
                else:
                    place = origin(0, len(layer))
                    to = lambda s, e, starts=starts, up=origin: up(starts[s], max(starts[e], starts[s] + 1))
                large = isinstance(inner, Large)
                content = inner.data if large else inner.encode("utf-8", "surrogatepass")
                mark = (hashlib.sha256(content).digest(), place, large)
                if mark in seen or inner == text:
                    continue
                seen.add(mark)
                layers += 1
                if not large:
                    note(inner, to)
                    work.append((inner, to))
                    continue
                whole = True
                for window, safe in inner.windows():
                    whole = whole and safe
                    note(window, to)
                    search(window, to)
                too_large += not whole

    search(text, lambda s, e: (s, e))
    return base, sorted(found, key=lambda x: (x[0], RANK[x[1]], x[2])), layers, too_large


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


SCHEMA = (
    "doc_id {id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string,"
    " n_layers long, n_too_large long"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_too_large"]
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            base, spans, layers, too_large = all_spans(text.as_py() or "")
            kinds = [kind for _, kind, _ in base]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((*(kinds.count(k) for k in RANK), digest, _joined(spans), layers, too_large))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [
            pa.array([], t) for t in kinds
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def scan(docs: DataFrame) -> DataFrame:
    """Secrets of every row of ``docs``: counts and digest of those in plain sight, spans of all.

    A null text counts as empty. Repeated rows are searched each for itself; other columns are left out.
    """
    return docs.select("doc_id", F.col("text")).mapInArrow(_scan, SCHEMA.format(id=dict(docs.dtypes)["doc_id"]))
