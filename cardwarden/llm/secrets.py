"""Secret scan with a worklist of decoded layers.

The text itself is the first layer. Every layer is scanned, and each stretch of it that is URL-encoded, holds
Unicode escapes or is base64, wrapped or not and at any of its four alignments, becomes a layer of its own, and
so does all compressed data in the bytes of a decoded layer, until nothing new is found; a layer seen before at
the same place is not entered again. Bytes that are no UTF-8 are kept as surrogates. Each character of a layer
knows the stretch of the text that it came from, so finds are spans of the text. What comes out of compressed
data maps to the whole stretch, so a large one is written to a temporary file and scanned in parts.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import mmap
import re
import tempfile
import urllib.parse
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, table

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
# a run of 24 or 20 characters is there exactly where the run without a least length is that long
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# a whole run that holds a code: tried at the start of each run only, so linear in the text
URL = re.compile(r"(?<![!-~])(?=[!-~]*?%[0-9A-Fa-f]{2})[!-~]++")
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)")
ESCAPED = re.compile(rf"(?<![!-~])(?=[!-~]*?{ESCAPES.pattern})[!-~]++")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\0|x[\x01\x5e\x9c\xda]")
# what a decoded layer must hold to give a find or a further layer
WORTH = re.compile(rb"(?i:password|passwd|secret|token|api_?key)|AKIA|%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}|" + MAGIC.pattern)
# behind such a place no token of any kind goes on
BREAK = re.compile(r"""[^\x20-~\r\n\t]|[^A-Za-z0-9+/_=\r\n\t\x20-]\r?\n|\n\r?\n|[!-~](?<![dDnNtTyY"':=])\x20""")
BLOCK = 8 << 20  # what is inflated and scanned at a time
HELD = 64 << 20  # what inflated data may take in memory; more goes to a temporary file


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in ``text`` as it stands."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _opener(head: bytes):
    if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] & 143 == 8 and int.from_bytes(head[:2], "big") % 31 == 0):
        return zlib.decompressobj(47)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor(lzma.FORMAT_XZ) if head[:6] == b"\xfd7zXZ\0" else None


def inflated(data, at: int, end: list[int]) -> Iterator[bytes]:
    """Contents of the gzip, zlib, bzip2 or xz members that begin at ``at``, in blocks; of a broken member what
    comes out of it. ``end`` gets the end of the last whole member."""
    while (opener := _opener(bytes(data[at : at + 6]))) is not None:
        try:
            while not opener.eof:
                given = bytes(data[at : at + (1 << 20)])
                at += len(given)
                piece, out = given, b"."
                while (piece or len(out) == BLOCK) and not opener.eof:  # a full block may leave more inside
                    out = opener.decompress(piece, BLOCK)
                    piece = getattr(opener, "unconsumed_tail", b"")
                    if out:
                        yield out
                if not given:
                    return
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return
        at -= len(opener.unused_data)
        end[0] = at


def _spooled(blocks: Iterator[bytes]):
    """The blocks as one buffer, in a temporary file where they are large."""
    held, size, file = [], 0, None
    for block in blocks:
        held.append(block)
        size += len(block)
        if size > HELD and file is None:
            file = tempfile.TemporaryFile()
        if file is not None:
            file.writelines(held)
            held = []
    if file is None:
        return b"".join(held)
    file.flush()
    return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def _parts(data) -> Iterator[str]:
    """Text of ``data`` in parts of about a block, cut where no token is open."""
    decoder, held = codecs.getincrementaldecoder("utf-8")("surrogateescape"), []
    for at in range(0, len(data), BLOCK):
        text = decoder.decode(bytes(data[at : at + BLOCK]), at + BLOCK >= len(data))
        tail = held[-1][-2:] if held else ""
        cut = 0
        for low in range(max(0, len(text) - (1 << 16)), -1, -(1 << 16)) if at + BLOCK < len(data) else ():
            for m in BREAK.finditer(text, low, min(len(text), low + (1 << 16) + 4)):
                cut = m.end()
            if cut:
                break
        else:
            if at + BLOCK < len(data) and (m := BREAK.search(tail + text[:2])) and m.end() > len(tail):
                cut = m.end() - len(tail)
        if cut:
            yield "".join([*held, text[:cut]])
            held = []
        held.append(text[cut:])
    if held:
        yield "".join(held)


def _bytes_of(layer: str) -> list[bytes]:
    """Bytes that a decoded layer may stand for: its characters up to 255 themselves, or UTF-8."""
    try:
        out = [layer.encode("utf-8", "surrogateescape")]
    except UnicodeEncodeError:
        out = [layer.encode("utf-8", "replace")]
    if not layer.isascii() and max(layer) <= "\xff":
        out.append(layer.encode("latin-1"))
    return out


def _byte_ends(layer: str) -> np.ndarray:
    """End of each character in the UTF-8 bytes of ``layer``."""
    code = np.frombuffer(layer.encode("utf-32-le", "surrogatepass"), "<u4")
    size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    return np.cumsum(np.where((code >= 0xDC80) & (code <= 0xDCFF), 1, size))


class _Places:
    """The piece of a token behind each character of what it decodes to."""

    def __init__(self):
        self.out, self.starts, self.ends, self.at = [], array("q"), array("q"), 0

    def keep(self, token: str, upto: int) -> None:
        """What lies between the codes stays."""
        self.out.append(token[self.at : upto])
        self.starts.extend(range(self.at, upto))
        self.ends.extend(range(self.at + 1, upto + 1))
        self.at = upto

    def put(self, char: str, upto: int) -> None:
        self.out.append(char)
        self.starts.append(self.at)
        self.ends.append(upto)
        self.at = upto

    def done(self, token: str) -> tuple[str, np.ndarray]:
        self.keep(token, len(token))
        return "".join(self.out), np.stack([np.array(self.starts, np.int64), np.array(self.ends, np.int64)], axis=1)


def _url(token: str) -> tuple[str, np.ndarray]:
    """Percent-encoded runs as text."""
    found = _Places()
    for run in re.finditer(r"(?:%[0-9A-Fa-f]{2})+", token):
        found.keep(token, run.start())
        for c in urllib.parse.unquote(run.group(), errors="surrogateescape"):
            found.put(c, found.at + 3 * len(c.encode("utf-8", "surrogateescape")))
    return found.done(token)


def _escapes(token: str) -> tuple[str, np.ndarray]:
    found = _Places()
    for m in ESCAPES.finditer(token):
        code = m.group()
        number = int(code[3:-1], 16) if code[:3] == "&#x" else int(code[2:-1]) if code[:2] == "&#" else int(code[2:], 16)
        if number > 0x10FFFF:
            continue
        found.keep(token, m.start())
        found.put(chr(number), m.end())
    return found.done(token)


def _base64(token: str) -> Iterator[tuple[str, np.ndarray]]:
    """Texts of the four alignments, as far as they hold anything."""
    body = token.rstrip("=")
    kept = np.arange(len(body))
    if "\n" in body:
        kept = np.array([i for i, c in enumerate(body) if c not in "\r\n\t "], np.int64)
        body = re.sub(r"[\r\n\t ]", "", body)
    body = body.replace("-", "+").replace("_", "/")
    for skip in range(4):
        part = body[skip : len(body) - ((len(body) - skip) % 4 == 1)]
        try:
            data = base64.b64decode(part + "=" * (-len(part) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        if not WORTH.search(data) and _opener(data[:6]) is None:
            continue
        text = data.decode("utf-8", "surrogateescape")
        ends = _byte_ends(text)
        starts = np.concatenate([[0], ends[:-1]])
        last = np.minimum(-(-ends * 8 // 6), len(part)) - 1
        places = np.stack([kept[skip + starts * 8 // 6], kept[skip + last] + 1], axis=1)
        if skip == 0 and _opener(data[:6]):
            places[-1, 1] = len(token)
        yield text, places


def _once(unwrap: Callable) -> Callable:
    def run(token: str) -> Iterator[tuple[str, np.ndarray]]:
        text, places = unwrap(token)
        if text != token:
            yield text, places

    return run


def _opened(layer: str, places: np.ndarray, seen: set) -> Iterator[tuple[str, tuple[int, int]]]:
    """Parts of all compressed data in the bytes of a decoded layer, and in what comes out of it."""
    for raw in _bytes_of(layer):
        if not MAGIC.search(raw) and _opener(raw[:6]) is None:
            continue
        ends = _byte_ends(layer) if len(raw) != len(layer) else np.arange(1, len(layer) + 1)
        work = [(raw, None)]
        while work:
            data, span = work.pop()
            at = 0
            while at < len(data):
                if at or _opener(bytes(data[:6])) is None:
                    found = MAGIC.search(data, at)
                    if found is None:
                        break
                    at = found.start()
                end = [0]
                inner = _spooled(inflated(data, at, end))
                stop = end[0] or len(data)
                place = span
                if span is None:
                    first, last = np.searchsorted(ends, at, "right"), np.searchsorted(ends, stop, "left")
                    place = (int(places[first, 0]), int(places[min(last, len(places) - 1), 1]))
                at = end[0] or at + 1
                if not len(inner):
                    continue
                mark = (hashlib.sha256(inner).digest(), *place)
                if mark in seen:
                    continue
                seen.add(mark)
                for part in _parts(inner):
                    yield part, place
                work.append((inner, place))


def _below(layer: str, places, seen: set) -> Iterator[tuple[str, np.ndarray | tuple[int, int]]]:
    """The layers right below one, and the compressed data in their bytes."""
    for pattern, unwrap, signs in ((URL, _once(_url), "%"), (ESCAPED, _once(_escapes), ("\\", "&#")), (BASE64, _base64, ""), (WRAPPED, _base64, "\n")):
        if not any(s in layer for s in ([signs] if isinstance(signs, str) else signs)):
            continue
        for m in pattern.finditer(layer):
            for text, inner in unwrap(m.group()):
                if not text:
                    continue
                inner = inner + m.start()
                if isinstance(places, tuple):
                    inner = np.broadcast_to(np.array(places, np.int64), (len(text), 2))
                elif places is not None:
                    inner = np.stack([places[inner[:, 0], 0], places[inner[:, 1] - 1, 1]], axis=1)
                mark = (hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), int(inner[0, 0]), int(inner[-1, 1]))
                if mark not in seen:
                    seen.add(mark)
                    yield text, inner
                    yield from _opened(text, inner, seen)


def layers(text: str) -> Iterator[tuple[str, np.ndarray | tuple[int, int] | None]]:
    """The text and all decoded layers below it, with (start, end) in the text of each character, or of all."""
    seen: set = set()
    work = [iter([(text, None)])]
    while work:
        found = next(work[-1], None)
        if found is None:
            work.pop()
            continue
        yield found
        work.append(_below(*found, seen))


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(finds in the text as it stands, those and the finds of all decoded layers), in order of their start."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base, every = [], set()
    for layer, places in layers(text):
        found = scan(layer)
        if places is None:
            base = found
        elif isinstance(places, tuple):
            found = [(k, *places) for k in {k for k, _, _ in found}]
        else:
            found = [(k, int(places[a:b, 0].min()), int(places[a:b, 1].max())) for k, a, b in found]
        every.update(found)
    return sorted(base, key=order), sorted(every, key=order)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text in b.column(b.num_columns - 1):
            base, every = all_spans(text.as_py() or "")
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        added = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)]
        yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts and digest of the plain finds and ``spans`` of all finds. A null or empty text has
    none (digest of the empty string); repeated rows are scanned each; columns with the names of the added
    ones are replaced; no rows give no rows. A text is scanned whole, however long."""
    added = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    prepared = docs.select(*[c for c in docs.columns if c not in added], F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prepared.schema.fields)
    return arrow_map(prepared, _scan, schema + ", n_assign long, n_access long, n_hex long, base_sha256 string, spans string").drop("__text")


def op10_decoding_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
