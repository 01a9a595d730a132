"""Media columns: interleaved text and media references parsed from HTML, payloads in a media table joined by digest."""

from __future__ import annotations

import base64
import hashlib
import html
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise

#: Payloads are padded to a multiple of this, the width of the stored greyscale images.
WIDTH = 64
_PNG = b"\x89PNG\r\n\x1a\n"
#: Tags whose text is no content, tags that a head may hold, tags that end a text block, tags that refer to
#: media, attributes that name the reference, in order.
_SKIPPED = {"script", "style", "template", "noscript", "title"}
_HEAD = {"html", "head", "title", "meta", "link", "base", "script", "style", "template", "noscript"}
_BLOCKS = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "td", "th", "br", "hr", "nav", "footer", "header", "main", "aside", "blockquote", "pre", "figure", "figcaption", "body", "html"}
_MEDIA = {"img": "image", "video": "video", "audio": "audio", "source": "source", "embed": "embed", "iframe": "iframe", "object": "object"}
_SOURCES = ("src", "data-src", "srcset", "data-srcset", "data")
SEGMENT = "position int, kind string, text string, ref string, digest string, caption string"


def reference(values: dict[str, str | None]) -> str | None:
    """What a media tag refers to: src, else a lazy one, else the first candidate of a source set."""
    for name in _SOURCES:
        value = (values.get(name) or "").strip()
        if value:
            return value.split(",")[0].split()[0] if name.endswith("srcset") and not value.startswith("data:") else value.split()[0] if name.endswith("srcset") else value
    return None


def digest_of(ref: str) -> str | None:
    """The payload's SHA-256: named by a reference `sha256:<hex>`, or of the bytes that a `data:` reference holds."""
    if ref.startswith("sha256:"):
        return ref[7:].lower()
    if ref.startswith("data:") and "," in ref:
        kind, _, body = ref[5:].partition(",")
        raw = unquote_to_bytes(body)
        if kind.lower().endswith(";base64"):
            try:
                raw = base64.b64decode(b"".join(raw.split()) + b"===")
            except ValueError:
                return None
        return hashlib.sha256(raw).hexdigest()
    return None


class _Segments(HTMLParser):
    """Ordered text and media segments; a figure's caption belongs to the media of that very figure.

    End tags that HTML lets a page leave out may be missing: the first content ends a head, and a caption ends with its
    figure, with the next caption or figure, or with the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.words: list[str] = []
        self.skip: list[str] = []
        self.head = False
        self.figures: list[list[dict]] = []
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = "".join(self.words).strip()
        self.words = []
        if text:
            self.add("text", text=text)

    def add(self, kind: str, **values: str | None) -> None:
        self.out.append({"position": len(self.out), "kind": kind, "text": None, "ref": None, "digest": None, "caption": None} | values)

    def end_caption(self) -> None:
        if self.caption is not None:
            text, self.caption = " ".join("".join(self.caption).split()), None
            for s in self.figures[-1] if self.figures and text else ():
                s["caption"] = text

    def end_page(self) -> None:
        self.end_caption()
        self.flush()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "head":
            self.head = True
        elif tag not in _HEAD:
            self.head = False
        if tag in _SKIPPED:
            self.skip.append(tag)
        if tag in ("figure", "figcaption"):
            self.end_caption()
        if tag in _BLOCKS:
            self.flush()
        if tag == "figure":
            self.figures.append([])
        if tag == "figcaption":
            self.caption = []
        if tag in _MEDIA and not self.skip:
            values = dict(attrs)
            if ref := reference(values):
                self.flush()
                self.add(_MEDIA[tag], ref=ref, digest=digest_of(ref), caption=values.get("alt") or None)
                if self.figures:
                    self.figures[-1].append(self.out[-1])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in _SKIPPED or tag in ("figure", "figcaption"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "head":
            self.head = False
        if tag in self.skip:
            while self.skip.pop() != tag:
                pass
        if tag in ("figcaption", "figure"):
            self.end_caption()
        if tag in _BLOCKS:
            self.flush()
        if tag == "figure" and self.figures:
            self.figures.pop()

    def handle_data(self, data: str) -> None:
        if self.head and data.strip():
            self.head = bool(self.skip)
        if not self.skip and not self.head:
            (self.words if self.caption is None else self.caption).append(data)


def parse_segments(page: str | None) -> list[dict]:
    """Segments of one page in order; null or empty gives none, broken markup what can be read."""
    parser = _Segments()
    parser.feed(page or "")
    parser.close()
    parser.end_page()
    return parser.out


def interleave(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """key, segments: array of (position, kind, text, ref, digest, caption) for every row of pages.

    Positions count from 0 without gaps. A reference sha256:<hex> is a digest of the media table, one with data: has the
    digest of its bytes, any other one is plain, with a null digest. Captions come from the figure, else from alt. Other columns are dropped.
    """
    kind = pages.schema[key].dataType.simpleString()
    fields = pa.list_(pa.struct([("position", pa.int32()), *((n, pa.string()) for n in ("kind", "text", "ref", "digest", "caption"))]))

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([parse_segments(t) for t in b.column(1).to_pylist()], fields)], names=[key, "segments"])

    return map_arrow(pages.select(key, markup), one, f"`{key}` {kind}, segments array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>")


def resolve(sequences: DataFrame, key: str, media: DataFrame) -> DataFrame:
    """One row per segment: key, position, kind, text, ref, caption, digest and the media table's columns.

    media has one row per digest. A digest it lacks, or none, gives null media columns; order and captions stay with
    their positions. Columns that a computation does not use are pruned before the join.
    """
    return resolve_rows(sequences.select(key, F.explode("segments").alias("s")).select(key, "s.*"), media)


def resolve_rows(rows: DataFrame, media: DataFrame) -> DataFrame:
    """The digest join over rows that are one segment each; a digest that many segments share is split by AQE."""
    return rows.join(media, "digest", "left")


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(length, UTF-8 bytes padded with 0 to a positive multiple of WIDTH)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def to_png(payload: bytes) -> bytes:
    """Greyscale PNG of 8-bit samples, WIDTH to a row, without filters."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), dtype=np.uint8)
    rows[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + chunk(b"IEND", b"")


def from_png(stored: bytes) -> bytes:
    """The samples of a PNG that to_png wrote."""
    at, data = len(_PNG), b""
    while at < len(stored):
        size, name = struct.unpack(">I4s", stored[at : at + 8])
        if name == b"IDAT":
            data += stored[at + 8 : at + 8 + size]
        at += size + 12
    return np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(-1, WIDTH + 1)[:, 1:].tobytes()


def describe(payload: bytes) -> str:
    """Mean, deviation and entropy of the samples, and a 64-bit map of the columns above the mean."""
    x = np.frombuffer(payload, dtype=np.uint8)
    share = np.bincount(x, minlength=256) / len(x)
    share = share[share > 0]
    above = np.packbits(x.reshape(-1, WIDTH).mean(axis=0) > x.mean()).tobytes().hex()
    return f"mean={x.mean():.4f};sd={x.std():.4f};bits={-(share * np.log2(share)).sum():.4f};map={above}"


def store_payloads(docs: DataFrame) -> DataFrame:
    """Media table (digest, media): the payload of every text as a PNG, each once a task; written and read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            for t in b.column(0):
                payload = payload_of(t.as_py())[1]
                digest = hashlib.sha256(payload).digest()
                if digest not in seen:
                    seen.add(digest)
                    yield pa.RecordBatch.from_arrays([pa.array([digest.hex()]), pa.array([to_png(payload)], pa.binary())], names=["digest", "media"])

    return materialise(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "digest string, media binary"), "media")


def media_features(media: DataFrame) -> DataFrame:
    """Facts of each stored image, one row per digest, from the bytes read back."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for m in b.column("media").to_pylist():
            p = from_png(m)
            rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-WIDTH:]), len(m), hashlib.sha256(m).hexdigest(), describe(p)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
        return pa.RecordBatch.from_arrays([b.column("digest"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names=["digest", *names])

    schema = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_arrow(media, one, schema).dropDuplicates(["digest"])


def document_sequences(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_segments, position, digest, caption: each text as an HTML page with its payload as a figure, parsed.

    The page holds the escaped text in a paragraph and then a figure whose reference is the payload's digest.
    """

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            n, payload = payload_of(t)
            page = f'<article><p>{html.escape(t or "", quote=False)}</p><figure><img src="sha256:{hashlib.sha256(payload).hexdigest()}" alt=""><figcaption>{n} bytes</figcaption></figure></article>'
            segments = parse_segments(page)
            texts = hashlib.sha256("\n".join(s["text"] for s in segments if s["kind"] == "text").encode("utf-8", "surrogatepass")).hexdigest()
            rows += [(key, n, len(segments), texts, s["position"], s["digest"], s["caption"]) for s in segments if s["digest"]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_segments", "texts_sha256", "position", "digest", "caption"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), one, "doc_id long, n_bytes long, n_segments int, texts_sha256 string, position int, digest string, caption string")


def documents_as_media(docs: DataFrame) -> DataFrame:
    """One row per document with the facts of its stored payload; a null text is an empty one (a payload of zeros).

    Payloads stay in the media table: only references, and facts computed from the bytes read back, meet in the
    digest join. Equal texts share a payload; repeated rows repeat.
    """
    facts = media_features(store_payloads(docs))
    return resolve_rows(document_sequences(docs), facts).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption", "n_segments", "texts_sha256"
    )
