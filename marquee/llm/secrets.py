"""Secret scans through nested encodings.

Three kinds of secrets are looked for in every text. Then a worklist unwraps what is encoded:
percent-escapes and Unicode escapes of a whole layer, runs of base64, also over several lines and
from any of their characters, and compressed bytes found inside those. Each layer is scanned and unwrapped again until nothing new comes out. A layer that
equals one it came from ends its chain, so data that unpack to themselves do not loop. Spans are
always given in code points of the original text: escapes keep a place for every character,
anything inside base64 stands for the whole run.

All is per document in one pass over the table: no shuffle, and a task holds a batch at a time.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text

#: Fixed patterns of the three kinds, in the order in which they are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}+")  # a run of 16 or more: shorter runs would be dropped
KINDS = ("assign", "access", "hex")
ASSIGNED, ACCESS_CHARS = 12, 18

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
#: Lines of base64 that go on in the next line, which can be shorter.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+\r?\n[ \t]*+)+[A-Za-z0-9+/_-]+={0,2}")
#: Where packed bytes can begin within a run: at or after a character that also separates words. Magic numbers in base64.
PACKED = re.compile(r"(?:(?<=[+/_-])(?:H4sI|e[AFJN]|Qlpo)|[/_]Td6WFoA)")
LONG_WORD = 16
#: A compressed layer is read in windows of so many bytes that overlap, whatever it unpacks to.
WINDOW_BYTES, OVERLAP_BYTES = 8 << 20, 64 << 10

SPANS = "doc_id long, text string, spans array<struct<kind:string,start:long,end:long,layers:string>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layers", pa.string())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(_SPAN))])


def scan(text: str) -> list[tuple[str, int, int]]:
    """Base matches of one layer: leftmost, not overlapping within a kind, those that are too short dropped."""
    found: list[tuple[str, int, int]] = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    # No white space lies within a run, so only long words can hold one.
    if any(HEX.search(word) for word in text.split() if len(word) >= LONG_WORD):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


@dataclass
class _Layer:
    text: str
    names: tuple[str, ...]
    #: Of every character, its first place and the place after it in the document; or one region for all.
    starts: np.ndarray | int
    ends: np.ndarray | int
    ancestors: tuple[bytes, ...]

    def place(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return int(self.starts[start]), int(self.ends[end - 1])


def _percent(run: str) -> list[tuple[str, int]]:
    """Characters of a run of percent-escapes, each with the number of source characters."""
    data = bytes.fromhex(run.replace("%", ""))
    try:
        return [(c, 3 * len(c.encode())) for c in data.decode()]
    except UnicodeDecodeError:
        return [(chr(b), 3) for b in data]


def _escape(run: str) -> list[tuple[str, int]]:
    if run[1] == "u" and run[2] != "{":
        units = [int(run[i + 2 : i + 6], 16) for i in range(0, len(run), 6)]
        out, i = [], 0
        while i < len(units):
            pair = i + 1 < len(units) and 0xD800 <= units[i] < 0xDC00 <= units[i + 1] < 0xE000
            code = 0x10000 + ((units[i] - 0xD800) << 10) + units[i + 1] - 0xDC00 if pair else units[i]
            out.append(("�" if 0xD800 <= code < 0xE000 else chr(code), 12 if pair else 6))
            i += 1 + pair
        return out
    code = int(run.strip("\\uUx{}"), 16)
    return [(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�", len(run))]


def _unescape(layer: _Layer, pattern: re.Pattern, decode, name: str) -> _Layer | None:
    """The whole layer with all runs of ``pattern`` decoded."""
    parts: list[str] = []
    starts: list[np.ndarray] = []
    ends: list[np.ndarray] = []
    at = 0

    def plain(a: int, b: int) -> None:
        if b > a:
            parts.append(layer.text[a:b])
            starts.append(np.arange(a, b))
            ends.append(np.arange(a + 1, b + 1))

    for m in pattern.finditer(layer.text):
        plain(at, m.start())
        chars = decode(m[0])
        widths = np.array([n for _, n in chars])
        stops = m.start() + np.cumsum(widths)
        parts.append("".join(c for c, _ in chars))
        starts.append(stops - widths)
        ends.append(stops)
        at = m.end()
    if not parts and not at:
        return None
    plain(at, len(layer.text))
    first, last = np.concatenate(starts), np.concatenate(ends)
    if isinstance(layer.starts, int):
        return _Layer("".join(parts), (*layer.names, name), layer.starts, layer.ends, layer.ancestors)
    return _Layer("".join(parts), (*layer.names, name), layer.starts[first], layer.ends[last - 1], layer.ancestors)


def _from_base64(run: str) -> bytes:
    """What whole groups of characters give; a last character that is alone gives nothing."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def _decodings(run: str) -> Iterator[tuple[bytes, bool]]:
    """Bytes of a run of base64, and whether only packed bytes count.

    Base64 can begin inside a run, as in a path or behind a dash; then one of the four alignments has its bytes after others.
    """
    for skip in range(4):
        yield _from_base64(run[skip:]), False
    for m in PACKED.finditer(run, 1):
        yield _from_base64(run[m.start() :]), True


def _unpacker(data: bytes):
    """(name, decompressor) by the first bytes."""
    if data[:2] == b"\x1f\x8b":
        return "gzip", zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and (data[0] * 256 + data[1]) % 31 == 0:
        return "zlib", zlib.decompressobj()
    if data[:3] == b"BZh":
        return "bz2", bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor()
    return None


def _unpacked(data: bytes, unpacker) -> Iterator[bytes]:
    """Windows of the unpacked bytes, of all members in a row and what follows them; what is broken ends them."""
    held, rest = b"", data
    try:
        while True:
            made = unpacker.decompress(rest, WINDOW_BYTES)
            rest = unpacker.unconsumed_tail if hasattr(unpacker, "unconsumed_tail") else b""
            if made:
                yield held + made
                held = (held + made)[-OVERLAP_BYTES:]
            if unpacker.eof:
                rest = unpacker.unused_data
                if not rest:
                    break
                if (more := _unpacker(rest)) is None:
                    yield held + rest
                    break
                unpacker = more[1]
            elif not made:
                break
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return


def _opened(
    data: bytes, names: tuple[str, ...], ancestors: tuple[bytes, ...], packed: bool
) -> Iterator[tuple[str, tuple[str, ...], tuple[bytes, ...]]]:
    """Texts inside bytes: the bytes themselves (unless ``packed``) and what they unpack to, through any number of packings.

    Bytes that are no UTF-8 become replacement characters; those of the patterns stay as they are.
    """
    # One window of each packing is held at a time: the next is unpacked when all inside the last has been read.
    work = [iter([(data, names, ancestors)])]
    while work:
        if (one := next(work[-1], None)) is None:
            work.pop()
            continue
        data, names, ancestors = one
        if not packed:
            yield data.decode("utf-8", "replace"), names, ancestors
        packed = False
        if (found := _unpacker(data)) is not None and (mark := hashlib.sha256(data).digest()) not in ancestors:
            work.append(_windows(data, found[1], (*names, found[0]), (*ancestors, mark)))


def _windows(data: bytes, unpacker, names: tuple[str, ...], ancestors: tuple[bytes, ...]) -> Iterator[tuple]:
    for window in _unpacked(data, unpacker):
        yield window, names, ancestors


def find(text: str) -> list[tuple[str, int, int, str]]:
    """All spans of a text by start, then kind as listed; the last field names the layers that were unwrapped.

    Spans of decoded layers that a base span or an earlier layer has already are not repeated.
    """
    spans = {(kind, start, end): "" for kind, start, end in scan(text)}
    escapes = "%" in text or "\\" in text
    candidates = any(BASE64.search(word) for word in text.split() if len(word) >= LONG_WORD)
    if escapes or candidates:
        places = np.arange(len(text))
        root = _Layer(text, (), places, places + 1, (hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(),))
        # Layers are made when they are asked for and read depth first, so one window of each depth is held.
        work = [iter([root])]
        while work:
            if (layer := next(work[-1], None)) is None:
                work.pop()
                continue
            if layer.names:
                for kind, start, end in scan(layer.text):
                    spans.setdefault((kind, *layer.place(start, end)), ".".join(layer.names))
            work.append(filter(_is_new, _inside(layer)))
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [(*span, spans[span]) for span in order]


def _inside(layer: _Layer) -> Iterator[_Layer]:
    """The layers that a layer's text holds."""
    for pattern, decode, name in ((PERCENT, _percent, "url"), (ESCAPE, _escape, "unicode")):
        if (inner := _unescape(layer, pattern, decode, name)) is not None:
            yield inner
    for m in (m for pattern in (BASE64, WRAPPED) for m in pattern.finditer(layer.text)):
        region = layer.place(m.start(), m.end())
        for data, packed in _decodings("".join(m[0].split())):
            for inside, names, ancestors in _opened(data, (*layer.names, "base64"), layer.ancestors, packed):
                yield _Layer(inside, names, *region, ancestors)


def _is_new(layer: _Layer) -> bool:
    """Whether no layer around this one has its text; notes it for those inside."""
    mark = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
    new = mark not in layer.ancestors
    layer.ancestors = (*layer.ancestors, mark)
    return new


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """A row per document: ``doc_id``, ``text`` (null unless asked for) and ``spans``.

    A span is (``kind``, ``start``, ``end``, ``layers``) in code points, end exclusive; ``layers`` is empty for
    matches in the text as it stands. A null or empty text has no spans.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = [[dict(zip(("kind", "start", "end", "layers"), s)) for s in find(t)] for t in texts.to_pylist()]
            kept = texts if with_text else pa.nulls(batch.num_rows, pa.string())
            yield pa.record_batch([batch.column("doc_id"), kept, pa.array(found, _ARROW.field("spans").type)], schema=_ARROW)

    return id_and_text(docs, id_col, text_col).mapInArrow(rows, SPANS)


def span_string(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["layers"] == "")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: (s["kind"] == kind) & (s["layers"] == ""))).cast("long")


def mask(text: str, mark: str = "[SECRET]") -> str:
    """The text with every region that spans cover replaced."""
    out, at, reach = [], 0, -1
    for _, start, end, _ in find(text):
        if start >= reach:
            out += [text[at:start], mark]
        reach = max(reach, end)
        at = reach
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all other columns as they are, with secrets masked; null texts stay null."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [None if t is None else mask_of(t) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array(texts, batch.schema.field(at).type), *batch.columns[at + 1 :]]
            yield pa.record_batch(columns, schema=batch.schema)

    def mask_of(text: str) -> str:
        return mask(text, mark)

    return docs.mapInArrow(rows, docs.schema)
