"""TIFF media columns: pages of a TIFF file as rows, and bytes stored as TIFF.

The decoder walks the chain of image directories, reads strips or tiles, undoes
PackBits, LZW or deflate compression and the horizontal predictor, and returns
one row per page. The encoder writes 8-bit grey pages and is the inverse.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the TIFF 6.0 format.
NONE, LZW, ADOBE_DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
TYPE_CODE = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
LZW_CLEAR, LZW_END = 256, 257


def unpack_bits(data: bytes) -> bytes:
    out, i, n = [], 0, len(data)
    while i < n:
        c = data[i]
        i += 1
        if c < 128:
            out.append(data[i : i + c + 1])
            i += c + 1
        elif c > 128:
            out.append(data[i : i + 1] * (257 - c))
            i += 1
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    out, i, n = [], 0, len(data)
    while i < n:
        run = 1
        while run < 128 and i + run < n and data[i + run] == data[i]:
            run += 1
        if run > 1:
            out.append(bytes((257 - run, data[i])))
            i += run
            continue
        j = i + 1
        while j < n and j - i < 128 and not (j + 1 < n and data[j] == data[j + 1]):
            j += 1
        out.append(bytes((j - i - 1,)) + data[i:j])
        i = j
    return b"".join(out)


def lzw_decode(data: bytes) -> bytes:
    table = [bytes((i,)) for i in range(256)] + [b"", b""]
    out, width, acc, bits, last = [], 9, 0, 0, None
    for byte in data:
        acc, bits = (acc << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = acc >> bits
        acc &= (1 << bits) - 1
        if code == LZW_END:
            break
        if code == LZW_CLEAR:
            del table[258:]
            width, last = 9, None
            continue
        if last is None:
            word = table[code]
        else:
            word = table[code] if code < len(table) else last + last[:1]
            table.append(last + word[:1])
        out.append(word)
        last = word
        size = len(table) + 1
        width = 12 if size >= 2048 else 11 if size >= 1024 else 10 if size >= 512 else 9
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, acc, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}

    def put(code: int) -> None:
        nonlocal acc, bits
        size = 258 + len(table) + 1
        width = 12 if size > 2048 else 11 if size > 1024 else 10 if size > 512 else 9
        acc, bits = (acc << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append((acc >> bits) & 255)
        acc &= (1 << bits) - 1

    def code_of(word: bytes) -> int:
        return word[0] if len(word) == 1 else table[word]

    put(LZW_CLEAR)
    word = b""
    for i in range(len(data)):
        c = data[i : i + 1]
        if not word or word + c in table:
            word += c
            continue
        put(code_of(word))
        table[word + c] = 258 + len(table)
        if 258 + len(table) >= 4094:
            put(LZW_CLEAR)
            table.clear()
        word = c
    if word:
        put(code_of(word))
        table[word + b"\0\0"] = 0  # the decoder has added an entry by now
    put(LZW_END)
    if bits:
        out.append((acc << (8 - bits)) & 255)
    return bytes(out)


_ENCODE = {NONE: bytes, LZW: lzw_encode, ADOBE_DEFLATE: lambda b: zlib.compress(b, 6), OLD_DEFLATE: lambda b: zlib.compress(b, 6), PACKBITS: pack_bits}
_DECODE = {NONE: bytes, LZW: lzw_decode, ADOBE_DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress, PACKBITS: unpack_bits}


def encode(pages: list[np.ndarray], compression: int = ADOBE_DEFLATE, predictor: int = 1, rows_per_strip: int = 1024, tile: tuple[int, int] | None = None) -> bytes:
    """A little-endian TIFF file of 8-bit grey pages (arrays of height x width)."""
    out, body, at, links = bytearray(b"II*\0\0\0\0\0"), [], 8, []
    for image in pages:
        height, width = image.shape
        if tile:
            th, tw = tile
            padded = np.zeros((-(-height // th) * th, -(-width // tw) * tw), np.uint8)
            padded[:height, :width] = image
            parts = [padded[y : y + th, x : x + tw] for y in range(0, padded.shape[0], th) for x in range(0, padded.shape[1], tw)]
        else:
            parts = [image[y : y + rows_per_strip] for y in range(0, height, rows_per_strip)]
        blobs = []
        for p in parts:
            if predictor == 2:
                p = p.copy()
                p[:, 1:] -= p[:, :-1].copy()
            blobs.append(_ENCODE[compression](np.ascontiguousarray(p).tobytes()))
        offsets = []
        for blob in blobs:
            offsets.append(at)
            body.append(blob + b"\0" * (len(blob) % 2))
            at += len(body[-1])
        counts = [len(x) for x in blobs]
        tags = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor])]
        if tile:
            tags += [(TILE_WIDTH, 4, [tile[1]]), (TILE_HEIGHT, 4, [tile[0]]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)]
        else:
            tags += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [rows_per_strip]), (STRIP_COUNTS, 4, counts)]
        tags.sort()
        extra_at, entries, extra = at + 2 + 12 * len(tags) + 4, [], b""
        for tag, kind, values in tags:
            raw = struct.pack(f"<{len(values)}{TYPE_CODE[kind]}", *values)
            if len(raw) > 4:
                entries.append(struct.pack("<HHII", tag, kind, len(values), extra_at + len(extra)))
                extra += raw + b"\0" * (len(raw) % 2)
            else:
                entries.append(struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        links.append(at)
        body.append(struct.pack("<H", len(tags)) + b"".join(entries) + b"NEXT" + extra)
        at += len(body[-1])
    chain = links[1:] + [0]
    k = 0
    struct.pack_into("<I", out, 4, links[0] if links else 0)
    where = 8
    for part in body:
        if k < len(links) and where == links[k]:
            n = struct.unpack_from("<H", part)[0]
            part = part[: 2 + 12 * n] + struct.pack("<I", chain[k]) + part[6 + 12 * n :]
            k += 1
        out += part
        where += len(part)
    return bytes(out)


def directories(data: bytes) -> Iterator[dict[int, list[int]]]:
    """The image directories in file order; a repeated offset ends the walk."""
    if data[:4] not in (b"II*\0", b"MM\0*"):
        raise ValueError("not a TIFF file")
    e = "<" if data[:2] == b"II" else ">"
    at, seen = struct.unpack_from(e + "I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        tags: dict[int, list[int]] = {}
        (n,) = struct.unpack_from(e + "H", data, at)
        for i in range(n):
            p = at + 2 + 12 * i
            tag, kind, count = struct.unpack_from(e + "HHI", data, p)
            if kind not in TYPE_CODE:
                continue
            if TYPE_SIZE[kind] * count > 4:
                p = struct.unpack_from(e + "I", data, p + 8)[0] - 8
            tags[tag] = list(struct.unpack_from(f"{e}{count}{TYPE_CODE[kind]}", data, p + 8))
        yield tags
        (at,) = struct.unpack_from(e + "I", data, at + 2 + 12 * n)


def decode(data: bytes) -> Iterator[np.ndarray]:
    """The pages as arrays of height x width x samples, samples of 8 bits."""
    for tags in directories(data):
        width, height = tags[WIDTH][0], tags[HEIGHT][0]
        samples = tags.get(SAMPLES, [1])[0]
        if set(tags.get(BITS, [1])) != {8} or tags.get(PLANAR, [1])[0] != 1:
            raise ValueError("only chunky samples of 8 bits are read")
        undo, predictor = _DECODE[tags.get(COMPRESSION, [NONE])[0]], tags.get(PREDICTOR, [1])[0]
        image = np.zeros((height, width, samples), np.uint8)
        if TILE_OFFSETS in tags:
            tw, th = tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]
            spots = [(y, x) for y in range(0, height, th) for x in range(0, width, tw)]
            places, sizes = tags[TILE_OFFSETS], tags[TILE_COUNTS]
        else:
            tw, th = width, min(height, tags.get(ROWS_PER_STRIP, [height])[0])
            spots = [(y, 0) for y in range(0, height, max(1, th))]
            places, sizes = tags[STRIP_OFFSETS], tags[STRIP_COUNTS]
        for (y, x), place, n in zip(spots, places, sizes, strict=True):
            rows = th if TILE_OFFSETS in tags else min(th, height - y)
            part = np.frombuffer(undo(data[place : place + n]), np.uint8)[: rows * tw * samples].reshape(rows, tw, samples)
            if predictor == 2:
                part = np.add.accumulate(part, axis=1, dtype=np.uint8)
            h, w = min(rows, height - y), min(tw, width - x)
            image[y : y + h, x : x + w] = part[:h, :w]
        yield image


def to_tiff(df: DataFrame, id_col: str, payload_col: str, width: int = 64, compression: int = ADOBE_DEFLATE, predictor: int = 1, rows_per_strip: int = 1024) -> DataFrame:
    """Rows ``id, n_bytes, media``: each payload as a one-page 8-bit TIFF.

    The payload is padded with zero bytes to a positive multiple of ``width``; a
    null payload is empty. Every input row gives one row, repeated ids included.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, media = [], []
            for raw in b.column("payload"):
                raw = raw.as_py() or b""
                padded = raw + b"\0" * (-len(raw) % width if raw else width)
                sizes.append(len(raw))
                media.append(encode([np.frombuffer(padded, np.uint8).reshape(-1, width)], compression, predictor, rows_per_strip))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    cut = df.select(F.col(id_col).cast("long").alias("id"), F.col(payload_col).cast("binary").alias("payload"))
    return cut.mapInArrow(run, "id long, n_bytes long, media binary")


def pages(df: DataFrame, keep: tuple[str, ...] = ("id", "n_bytes", "media")) -> DataFrame:
    """One row per page of each TIFF file in column ``media``, in file order.

    Adds ``page int, width int, height int, samples int, pixels binary``. A null
    file gives no row; bytes that are no TIFF file raise.
    """
    fields = [f for f in df.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                raw = b.column("media")[i].as_py()
                if raw is None:
                    continue
                images = list(decode(raw))
                one = b.slice(i, 1)
                own = [one.column(f.name).take(pa.array([0] * len(images), pa.int64())) for f in fields]
                shape = [pa.array([x.shape[j] for x in images], pa.int32()) for j in (1, 0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(range(len(images)), pa.int32()), *shape, pa.array([x.tobytes() for x in images], pa.binary())],
                    [*(f.name for f in fields), "page", "width", "height", "samples", "pixels"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return df.select(*(f.name for f in fields)).mapInArrow(run, f"{kinds}, page int, width int, height int, samples int, pixels binary")


def with_features(df: DataFrame) -> DataFrame:
    """Per page: digests of pixels and file, and sums that give the mean, spread and edge strength.

    Null pixels or a null file count as empty; every row gives one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            out: dict[str, list] = {k: [] for k in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
            for pix, media in zip(b.column("pixels"), b.column("media"), strict=True):
                pix, media = pix.as_py() or b"", media.as_py() or b""
                a = np.frombuffer(pix, np.uint8)
                hist = np.bincount(a, minlength=256)
                edge = int(np.abs(np.diff(a.astype(np.int16))).sum())
                out["payload_bytes"].append(len(pix))
                out["payload_sha256"].append(hashlib.sha256(pix).hexdigest())
                out["tail_crc32"].append(zlib.crc32(pix[-64:]))
                out["media_bytes"].append(len(media))
                out["media_sha256"].append(hashlib.sha256(media).hexdigest())
                total, square = int(hist @ np.arange(256)), int(hist @ (np.arange(256) ** 2))
                out["feature"].append(f"{total}:{square}:{edge}:{int((hist > 0).sum())}")
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), b.column("page"), *(pa.array(out[k], t) for k, t in zip(out, kinds, strict=True))], ["id", "n_bytes", "page", *out])

    return df.select("id", "n_bytes", "page", "pixels", "media").mapInArrow(
        run, "id long, n_bytes long, page int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )
