"""Secret scan with a recursive decoding worklist.

Layer 0 is the text. Each layer is scanned and then unwrapped: percent escapes
and Unicode or character escapes decode the layer as a whole (a secret may
straddle an escape), base64 runs, also over line breaks and from each of their
first four characters, decode on their own, with zlib or gzip content anywhere in
them inflated. Whatever a layer's bytes are, its text is scanned. New layers go on the worklist until none is left; a layer whose
content was seen for the same place is a cycle and not followed again. Every
layer keeps, for each code point, the span of the original text it came from.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_batches

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HINT = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: The same over line breaks; only the last line may be short.
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})*[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+={0,2}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")  # gzip, zlib
#: Inflated content is read in windows of so many bytes (a bomb of zeros would
#: fill the worker), each with the end of the one before it.
INFLATE_BYTES = 64 << 20
OVERLAP_BYTES = 1 << 16


def matches(text: str) -> list[tuple[str, int, int]]:
    """Base matches of one layer: leftmost, non-overlapping per kind, those too
    short dropped after matching."""
    out = []
    if _HINT.search(text):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


class _Layer:
    """Text with the original span of each code point; ``starts`` None: the
    identity."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (int(self.starts[start]), int(self.ends[end - 1]))

    def place(self) -> tuple[int, int]:
        return (0, -1) if self.starts is None else (int(self.starts.min()), int(self.ends.max()))

    def replaced(self, pieces: list[tuple[int, int, list[tuple[str, int, int]]]]) -> _Layer:
        """``pieces``: (start, end, decoded (char, start, end) in this layer)."""
        text, starts, ends, at = [], [], [], 0
        plain = np.arange(len(self.text))
        s = plain if self.starts is None else self.starts
        e = plain + 1 if self.ends is None else self.ends
        for start, end, chars in pieces:
            text.append(self.text[at:start] + "".join(c for c, _, _ in chars))
            starts += [s[at:start], s[[a for _, a, _ in chars]] if chars else s[:0]]
            ends += [e[at:start], e[[b - 1 for _, _, b in chars]] if chars else e[:0]]
            at = end
        return _Layer("".join([*text, self.text[at:]]), np.concatenate([*starts, s[at:]]), np.concatenate([*ends, e[at:]]))

    def inside(self, start: int, end: int, text: str) -> _Layer:
        s, e = self.span(start, end)
        return _Layer(text, np.broadcast_to(np.int64(s), len(text)), np.broadcast_to(np.int64(e), len(text)))


def _percent(m: re.Match) -> list[tuple[str, int, int]]:
    raw, at = bytes.fromhex(m[0].replace("%", "")), m.start()
    try:
        chars = raw.decode()
    except UnicodeDecodeError:
        chars = raw.decode("latin-1")
        return [(c, at + 3 * i, at + 3 * i + 3) for i, c in enumerate(chars)]
    out = []
    for c in chars:
        n = 3 * len(c.encode())
        out.append((c, at, at + n))
        at += n
    return out


def _escape(m: re.Match) -> list[tuple[str, int, int]]:
    digits = next(x for x in m.groups() if x is not None)
    code = int(digits, 10 if m[6] else 16)
    ok = code < 0x110000 and not 0xD800 <= code < 0xE000
    return [(chr(code) if ok else "�", m.start(), m.end())]


def _inflated(raw: bytes) -> Iterator[bytes]:
    """Contents of the compressed streams anywhere in ``raw``."""
    at, view = 0, memoryview(raw)
    while m := _MAGIC.search(raw, at):
        at, d, before, rest = m.start() + 1, zlib.decompressobj(47), b"", view[m.start() :]
        try:
            while True:
                out = d.decompress(rest, INFLATE_BYTES)
                if out:
                    yield before + out
                rest, before = d.unconsumed_tail, out[-OVERLAP_BYTES:]
                if d.eof or not rest:
                    break
        except zlib.error:
            continue
        if d.eof:
            at = len(raw) - len(d.unused_data)


def _texts(raw: bytes) -> Iterator[str]:
    """Texts of ``raw`` and, until none is new, of what is compressed in it.
    Bytes that are no UTF-8 are replaced; with NULs, UTF-16 is read too (from
    the second byte for the other byte order)."""
    seen, work = set(), [iter([raw])]
    while work:
        if (b := next(work[-1], None)) is None:
            work.pop()
            continue
        mark = hashlib.blake2b(b, digest_size=16).digest()
        if mark in seen:
            continue
        seen.add(mark)
        yield b.decode("utf-8", "replace")
        if b"\0" in b:
            yield b.decode("utf-16-le", "replace")
            yield (b[1:] + b"\0").decode("utf-16-le", "replace")
        work.append(_inflated(b))


def _unpacked(run: str) -> Iterator[tuple[int, str]]:
    """``(characters left out, text)`` of a base64 run from each of its first
    four characters, for a word may stand right before it."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    for skip in range(4):
        part = body[skip:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        for text in _texts(base64.b64decode(part + "=" * (-len(part) % 4))):
            if _HINT.search(text) or "AKIA" in text or _HEX.search(text) or _PERCENT.search(text) or _ESCAPE.search(text) or _BASE64.search(text):
                yield skip, text


def _unwrapped(layer: _Layer) -> Iterator[_Layer]:
    text = layer.text
    if "%" in text and (found := list(_PERCENT.finditer(text))):
        yield layer.replaced([(m.start(), m.end(), _percent(m)) for m in found])
    if ("\\" in text or "&#" in text) and (found := list(_ESCAPE.finditer(text))):
        yield layer.replaced([(m.start(), m.end(), _escape(m)) for m in found])
    for m in _BASE64.finditer(text):
        for skip, inner in _unpacked(m[0]):
            yield layer.inside(m.start() + skip, m.end(), inner)
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            for skip, inner in _unpacked("".join(m[0].split())):
                yield layer.inside(m.start() + skip, m.end(), inner)


def scan(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """``(base, all)`` spans ``(kind, start, end)`` of the original text, both
    by start, then kind, then end. Null or empty: none."""
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    if not text:
        return [], []
    base = matches(text)
    spans, layers, seen = set(base), [iter([_Layer(text)])], set()
    while layers:
        if (layer := next(layers[-1], None)) is None:
            layers.pop()
            continue
        mark = (layer.place(), hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()) if layer.starts is not None else None
        if mark in seen:
            continue
        if mark:
            seen.add(mark)
            spans |= {(kind, *layer.span(a, b)) for kind, a, b in matches(layer.text)}
        layers.append(_unwrapped(layer))
    return sorted(base, key=order), sorted(spans, key=order)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: ``doc_id, n_assign,
    n_access, n_hex`` (base matches), ``base_sha256`` and ``spans`` (base and
    decoded ones). Null and empty texts have no spans; repeated rows each have
    their row; other columns are not used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for text in batch.column(1).to_pylist():
                base, spans = scan(text)
                for c, k in zip(cols, KINDS, strict=False):
                    c.append(sum(x[0] == k for x in base))
                cols[3].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                cols[4].append(_joined(spans))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    _, spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced and ``n_chars``, where
    there is one, counted anew; all other columns stay. A null text stays null,
    an empty one empty; repeated rows are redacted alike; an empty table gives no
    rows. A ``text`` that is not a string is an error, for it would pass unread."""
    names = docs.columns
    if dict(docs.dtypes)["text"] != "string":
        raise TypeError("text must be a string column")
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.columns)
            cols[text_at] = pa.array([redacted(x) for x in cols[text_at].to_pylist()], pa.string())
            if chars_at is not None:
                was, now = batch.column(text_at), cols[text_at]
                same = pc.fill_null(pc.equal(was, now), True)
                cols[chars_at] = pc.if_else(same, cols[chars_at], pc.utf8_length(now).cast(cols[chars_at].type))
            yield pa.RecordBatch.from_arrays(cols, names)

    return small_batches(docs).mapInArrow(run, docs.schema)
