"""Secret scanning with a recursive decoding worklist.

A text is scanned as it stands (the *base* layer). Stretches that look encoded (URL escapes, Unicode
escapes, base64, and gzip/zlib/zstd/bzip2 data inside base64) are decoded into new layers, which go on
a worklist and are scanned and unwrapped in turn until nothing new appears. A layer whose content was
seen before is not visited again, so layers that decode to each other cannot loop. URL and
Unicode escapes are decoded in place, over the whole layer, so that a secret is seen with its neighbours.
Compressed data is expanded and scanned piece by piece, however long it gets; pieces overlap.
Each hit in a layer is mapped back to the stretch of the original text that it came from: to the letters
that hold it where the layers are escapes and base64, to the whole stretch where compressed data is among them.
Escapes of escapes are layers of their own up to ``LAYERS`` in a row; what is nested deeper is decoded to its end at once,
so that time and memory do not grow with the square of a chain. A plus sign beside an encoded or plain : or = is read as
the space of a form too.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import map_rows, with_mapped

KINDS = ("assign", "access", "hex")

# The base patterns, with the least length of what they must hold.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KEYWORDS = re.compile(r"passw|secret|token|api", re.IGNORECASE | re.ASCII)

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
UNICODE_ANY = re.compile(r"\\[uUx][0-9A-Fa-f]|&#")
#: Signs that begin an escape, encoded again and again.
CHAIN = re.compile(r"%(?:25)+(?=[0-9A-Fa-f]{2})|\\(?:u005[cC]|x5[cC])+(?=[uUx][0-9A-Fa-f])|&(?:#38;|#[xX]26;)+(?=#)")
FORM = re.compile(r"\+(?=\+*(?:%3[AaDd]|[:=]))|(?<=[:=])\++|(?<=%3[AaDd])\++")
#: Layers of escapes directly upon one another that are scanned each.
LAYERS = 8
# A run may go on over line breaks; the lines after its first may be short and indented.
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+={0,2})*")
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: Bytes of expanded data that are scanned at a time, and by how much one piece reaches into the next.
EXPANDED, OVERLAP = 4 << 20, 1 << 16
#: Bytes of compressed data that a decoder is given at a time.
FED = 1 << 16
#: How gzip, zlib, zstd and bzip2 data begin in base64.
PACKED = ("H4sI", "eA", "eJ", "eN", "eF", "KLUv", "Qlpo")


@dataclass(frozen=True)
class Layer:
    """Decoded text, the span of the source text it stands for, and the decoders applied, outermost first.

    ``places`` has the source's (starts, ends) of each character; None if all stand for the whole span.
    """

    text: str
    start: int
    end: int
    path: tuple[str, ...]
    places: tuple[np.ndarray, np.ndarray] | None = None

    def source(self, a: int, b: int) -> tuple[int, int]:
        if not self.path:
            return a, b
        return (int(self.places[0][a]), int(self.places[1][b - 1])) if self.places and a < b else (self.start, self.end)


def scan_layer(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in one layer; candidates that are too short are dropped after matching."""
    found = []
    if KEYWORDS.search(text):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _format(data: bytes) -> str | None:
    if data[:2] == b"\x1f\x8b":
        return "gzip"
    if data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0:
        return "zlib"
    return "zstd" if data[:4] == b"\x28\xb5\x2f\xfd" else "bzip2" if data[:3] == b"BZh" else None


def _expanded(data: memoryview, how: str) -> Iterator[bytes]:
    """The decompressed data in pieces; it ends where the data is damaged. Input is taken in stretches of ``FED`` bytes."""
    try:
        if how == "zstd":
            reader = zstandard.ZstdDecompressor().stream_reader(data)
            while piece := reader.read(EXPANDED):
                yield piece
            return
        coder = bz2.BZ2Decompressor() if how == "bzip2" else zlib.decompressobj(31 if how == "gzip" else 15)
        held, size = [], 0
        for at in range(0, len(data), FED):
            fed: bytes | memoryview = data[at : at + FED]
            while True:
                piece = coder.decompress(fed, EXPANDED)
                held.append(piece)
                size += len(piece)
                if size >= EXPANDED:
                    yield b"".join(held)
                    held, size = [], 0
                fed = b"" if how == "bzip2" else coder.unconsumed_tail
                if coder.eof or (coder.needs_input if how == "bzip2" else not fed):
                    break
            if coder.eof:
                break
        if size:
            yield b"".join(held)
    except (zlib.error, zstandard.ZstdError, OSError, EOFError, ValueError):
        if how != "zstd" and held:
            yield b"".join(held)


def _code_point(m: re.Match) -> str:
    hexa = m[1] or m[2] or m[3] or m[5]
    n = int(hexa, 16) if hexa else int(m[4])
    return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else m[0]


def base64_runs(text: str) -> Iterator[tuple[int, int, list[tuple[int, str]], list[tuple[int, int]]]]:
    """(start, end, places and letters of its lines, where compressed data may begin) of what may be base64.

    These are each long line, and lines joined up to padding or their end. Joined lines are read from the first of each of
    the four alignments, so a payload is read as a whole even if words stand on the lines before it. Where a later line of
    that alignment begins as compressed data does, it is told as (number of letters before it, place in the text).
    """
    for m in BASE64_RUN.finditer(text):
        lines = [(x.start(), x.end(), x[0].rstrip("=")) for x in BASE64_LINE.finditer(text, m.start(), m.end())]
        yield from ((a, b, [(a, x)], []) for a, b, x in lines if len(x) >= 16)
        at = 0
        while at < len(lines):
            last = next((j for j in range(at, len(lines)) if lines[j][1] - lines[j][0] > len(lines[j][2])), len(lines) - 1)
            offset, first, packed = 0, {}, {}
            for i in range(at, last):
                kind = offset % 4
                if kind not in first:
                    first[kind], packed[kind] = (i, offset), []
                elif lines[i][2].startswith(PACKED):
                    packed[kind].append((offset - first[kind][1], lines[i][0]))
                offset += len(lines[i][2])
            for kind, (i, _) in first.items():
                yield lines[i][0], lines[last][1], [(a, x) for a, _, x in lines[i : last + 1]], packed[kind]
            at = last + 1


def _letters_of(plain: str, lines: list[tuple[int, str]], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end, in the layer, of the base64 letters that hold each character of the decoded text."""
    letters = np.concatenate([np.arange(a, a + len(x)) for a, x in lines])
    code = np.frombuffer(plain.encode("utf-32-le"), np.uint32)
    stop = np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))  # the byte after each character
    first = np.concatenate([[0], stop[:-1]])
    ends = letters[(8 * stop - 1) // 6] + 1
    ends[-1] = end  # padding too
    return letters[8 * first // 6], ends


def _url_chars(run: str) -> list[tuple[str, int]]:
    """The characters of a run of %XX, and how many of its letters each takes."""
    raw, out, at = bytes.fromhex(run.replace("%", "")), [], 0
    while at < len(raw):
        n = 1 if raw[at] < 0xC0 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
        try:
            out.append((raw[at : at + n].decode(), 3 * n))
        except UnicodeDecodeError:
            n = 1
            out.append(("\ufffd", 3))
        at += n
    return out


Places = tuple[np.ndarray, np.ndarray]


def _replaced(text: str, pattern: re.Pattern, decoded) -> tuple[str, Places]:
    """``text`` with what ``decoded`` gives for each match, as (characters, how many letters they take); and the places of its characters."""
    parts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(text):
        parts.append(text[at : m.start()])
        starts.append(np.arange(at, m.start()))
        ends.append(np.arange(at, m.start()) + 1)
        found = decoded(m)
        parts += [c for c, _ in found]
        stop = m.start() + np.cumsum([n for _, n in found])
        starts.append(np.concatenate([[m.start()], stop[:-1]]))
        ends.append(stop)
        at = m.end()
    parts.append(text[at:])
    starts.append(np.arange(at, len(text)))
    ends.append(np.arange(at, len(text)) + 1)
    return "".join(parts), (np.concatenate(starts), np.concatenate(ends))


def _url(m: re.Match) -> list[tuple[str, int]]:
    return _url_chars(m[0])


def _unicode(m: re.Match) -> list[tuple[str, int]]:
    c = _code_point(m)
    return [(c, len(m[0]))] if c != m[0] else [(x, 1) for x in c]


ESCAPES = (("url", URL_RUN, URL_RUN, _url), ("unicode", UNICODE_ONE, UNICODE_ANY, _unicode))


def unescaped(text: str) -> Iterator[tuple[str, str, np.ndarray, np.ndarray]]:
    """(decoder, decoded text, start and end in ``text`` of each of its characters) for the kinds of escapes in one layer."""
    for how, pattern, quick, decoded in ESCAPES:
        if quick.search(text):
            plain, (starts, ends) = _replaced(text, pattern, decoded)
            if plain != text:
                yield how, plain, starts, ends
    if "+" in text and FORM.search(text):
        spaced = FORM.sub(lambda m: " " * len(m[0]), text)
        plain, (starts, ends) = _replaced(spaced, URL_RUN, _url)
        yield "form", plain, starts, ends


def unescaped_wholly(text: str) -> tuple[str, Places] | None:
    """The text with its escapes decoded until none is left, and the places of its characters; None if there are none."""
    whole, places = text, None
    while True:
        before = whole
        for pattern, quick, decoded in ((CHAIN, CHAIN, lambda m: [(m[0][0], len(m[0]))]), *(e[1:] for e in ESCAPES)):
            if quick.search(whole):
                whole, (starts, ends) = _replaced(whole, pattern, decoded)
                places = (starts, ends) if places is None else (places[0][starts], places[1][ends - 1])
        if whole == before:
            return None if places is None or whole == text else (whole, places)


Found = tuple[str, int, int, str, Places | None]


def unwrap(text: str) -> Iterator[Found]:
    """(decoder, start, end, decoded text, places of its characters if known) for every stretch of base64 in one layer.

    Compressed data gives one entry for each piece.
    """
    for start, end, lines, packed in base64_runs(text):
        body = "".join(x for _, x in lines)
        body = body[: len(body) - (len(body) % 4 == 1)]  # a single last letter holds no byte
        try:
            raw = base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        expanded = False
        for letters, place in [(0, start), *packed]:
            data = memoryview(raw)[letters // 4 * 3 :]
            if how := _format(bytes(data[:4])):
                before = b""
                for piece in _expanded(data, how):
                    yield f"base64+{how}", place, end, (before + piece).decode("utf-8", "replace"), None
                    before = piece[-OVERLAP:]
                expanded |= bool(before) and not letters
        if expanded:
            continue
        try:
            plain = raw.decode()
        except UnicodeDecodeError:  # what is not UTF-8 is replaced, so that the rest is still scanned
            yield "base64", start, end, raw.decode("utf-8", "replace"), None
        else:
            if plain:
                yield "base64", start, end, plain, _letters_of(plain, lines, end)


def scan(text: str | None, bomb: int = 16 << 20) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, spans found only in decoded layers) of one text; null counts as empty.

    A compressed stretch that expands to ``bomb`` bytes or more is scanned like any other, and reported as ``bomb`` too.
    """
    if not text:
        return [], []
    base = scan_layer(text)
    known = set(base)
    deeper: set[tuple[str, int, int]] = set()
    seen = {hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()}

    def through(layer: Layer, places: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not layer.path or places is None:
            return places
        return (layer.places[0][places[0]], layer.places[1][places[1] - 1]) if layer.places else None

    def children(layer: Layer) -> Iterator[Layer]:
        if len(layer.path) >= LAYERS and all(h in ("url", "unicode", "form", "escapes") for h in layer.path[-LAYERS:]):
            if whole := unescaped_wholly(layer.text):
                yield Layer(whole[0], layer.start, layer.end, (*layer.path[:-1], "escapes"), through(layer, whole[1]))
        else:
            for how, plain, starts, ends in unescaped(layer.text):
                yield Layer(plain, layer.start, layer.end, (*layer.path, how), through(layer, (starts, ends)))
        size, at = 0, None
        for how, a, b, plain, places in unwrap(layer.text):
            start, end = layer.source(a, b)
            path = (*layer.path, how)
            size, at = (size if at == (a, b, how) else 0) + len(plain), (a, b, how)
            if size >= bomb:
                deeper.add((">".join((*path, "bomb")), start, end))
            if plain:
                yield Layer(plain, start, end, path, through(layer, places))

    def fresh(layer: Layer) -> bool:
        """Scan a layer, unless it has been: the same content at another place is another finding, at the same place a cycle or a repeat."""
        key = hashlib.blake2b(f"{layer.start}:{layer.end}:".encode() + layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if key in seen:
            return False
        seen.add(key)
        for kind, x, y in scan_layer(layer.text):
            start, end = layer.source(x, y)
            # a hit that is literally there too has been reported already
            there = (kind, start, end) in known if layer.places else False
            if not (there and layer.text[x:y] == text[start:end]) and not (layer.places is None and layer.text[x:y] in text[start:end]):
                deeper.add((">".join((*layer.path, kind)), start, end))
        return True

    # the worklist holds iterators, so that of a long expanded stretch one piece is in memory at a time
    work = [children(Layer(text, 0, len(text), ()))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif fresh(layer):
            work.append(children(layer))
    return base, sorted(deeper)


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order.get(s[0], len(order)), s[0], s[2])))


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones joined, replaced by ``mark``."""
    if not text:
        return text
    base, deeper = scan(text)
    out, at = [], 0
    for _, a, b in sorted([*base, *deeper], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bomb: int = 16 << 20) -> DataFrame:
    """One row per input row: id, counts of the base kinds, digest of the base spans, all spans, number of decoded hits.

    Null and empty texts have no spans. Repeated rows are each answered. Other columns of ``docs`` are not read.
    """

    def rows(ids: list, texts: list) -> list:
        out: list[list] = [[] for _ in range(7)]
        for i, t in zip(ids, texts, strict=True):
            base, deeper = scan(t, bomb)
            kinds = [s[0] for s in base]
            values = (i, *(kinds.count(k) for k in KINDS), hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text([*base, *deeper]), len(deeper))
            for column, v in zip(out, values, strict=True):
                column.append(v)
        return out

    ids = docs.schema[id_col].dataType.simpleString()
    fields = [pa.field("doc_id", _arrow_type(docs, id_col)), *(pa.field(f"n_{k}", pa.int64()) for k in KINDS), pa.field("base_sha256", pa.string()), pa.field("spans", pa.string()), pa.field("n_decoded", pa.int64())]
    return map_rows(docs.select(id_col, text_col), rows, fields, f"doc_id {ids}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long")


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of secrets masked in its text column; every other column is unchanged."""
    return with_mapped(docs, text_col, lambda texts: [redact(t) for t in texts], text_col, pa.string(), "string")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
