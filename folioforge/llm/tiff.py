"""TIFF files as a media column: a reader that walks image directories, one row a page, and a lossless writer.

Format numbers below are those of the TIFF 6.0 specification.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: tags, field types (code: struct letter), compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FILL_ORDER, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 266, 339
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d"}
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
#: No stream of these kinds unpacks to more bytes for each of its own (LZW: a code of 12 bits or less stands for up to 4,094 bytes).
MOST = {NONE: 1, LZW: 3639, DEFLATE: 1032, OLD_DEFLATE: 1032, PACKBITS: 64}
LARGEST = 2**31 - 4096  # bytes of a page; what a binary column can hold


class TiffError(ValueError):
    pass


def unpack_bits(data: bytes, most: int = LARGEST) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < most:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += 2 + n
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out[:most])


def pack_bits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        j = i
        while j + 1 < n and data[j + 1] == data[i] and j - i < 127:
            j += 1
        if j > i:
            out += bytes((257 - (j - i + 1), data[i]))
            i = j + 1
            continue
        while j + 1 < n and j - i < 127 and not (j + 2 < n and data[j + 1] == data[j + 2]):
            j += 1
        out += bytes((j - i,)) + data[i : j + 1]
        i = j + 1
    return bytes(out)


def unlzw(data: bytes, most: int = LARGEST) -> bytes:
    """Codes from 9 bits up, most significant first; 256 clears the table, 257 ends; widths change one code early."""
    out, table, width, prev = bytearray(), [bytes((i,)) for i in range(256)] + [b"", b""], 9, None
    bits, held, at, end = 0, 0, 0, len(data)
    while len(out) < most:
        while held < width:
            if at >= end:
                return bytes(out)
            bits, held, at = (bits << 8 | data[at]) & 0xFFFFFF, held + 8, at + 1
        code = bits >> (held - width) & ((1 << width) - 1)
        held -= width
        if code == 257:
            break
        if code == 256:
            del table[258:]
            width, prev = 9, None
            continue
        if prev is None:
            if code > 255:
                raise TiffError("LZW code out of order")
            entry = table[code]
        else:
            if code > len(table) or len(table) >= 4096:
                raise TiffError("LZW code out of order")
            entry = table[code] if code < len(table) else prev + prev[:1]
            table.append(prev + entry[:1])
            if len(table) >= 511:
                width = 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
        out += entry
        prev = entry
    return bytes(out[:most])


def lzw(data: bytes) -> bytes:
    bits, held, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal bits, held
        bits, held = bits << width | code, held + width
        while held >= 8:
            held -= 8
            out.append(bits >> held & 255)
        bits &= (1 << held) - 1

    table, width, run = {bytes((i,)): i for i in range(256)}, 9, b""
    put(256, 9)
    size = 258
    for i in range(len(data)):
        more = run + data[i : i + 1]
        if more in table:
            run = more
            continue
        put(table[run], width)
        table[more] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            put(256, 12)
            table, width, size = {bytes((i,)): i for i in range(256)}, 9, 258
        run = data[i : i + 1]
    if run:
        put(table[run], width)
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257, width)
    if held:
        out.append(bits << (8 - held) & 255)
    return bytes(out)


def decompress(kind: int, data: bytes, most: int = LARGEST) -> bytes:
    """Up to `most` bytes of what data unpacks to."""
    if kind == NONE:
        return data[:most]
    if kind in (DEFLATE, OLD_DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, max(1, most))
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from e
    if kind == LZW:
        return unlzw(data, most)
    if kind == PACKBITS:
        return unpack_bits(data, most)
    raise TiffError(f"compression {kind}")


def compress(kind: int, data: bytes, width: int) -> bytes:
    if kind == NONE:
        return data
    if kind == DEFLATE:
        return zlib.compress(data, 1)
    if kind == LZW:
        return lzw(data)
    if kind == PACKBITS:  # each row by itself
        return b"".join(pack_bits(data[i : i + width]) for i in range(0, len(data), width))
    raise TiffError(f"compression {kind}")


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """The tags of every image directory, in file order; a chain that meets itself or leaves the file is an error. Fields of unknown type
    are left out; one whose values don't fit the file is too, so that its page, not the walk, fails if it needs it."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise TiffError("not a TIFF file")
    at, seen = struct.unpack(order + "I", data[4:8])[0], set()
    while at:
        if at in seen:
            raise TiffError("directories in a circle")
        seen.add(at)
        if at + 2 > len(data):
            raise TiffError("directory beyond the file")
        (n,) = struct.unpack_from(order + "H", data, at)
        if at + 6 + 12 * n > len(data):
            raise TiffError("directory beyond the file")
        tags = {}
        for place in range(at + 2, at + 2 + 12 * n, 12):
            tag, kind, count = struct.unpack_from(order + "HHI", data, place)
            letters = TYPES.get(kind)
            if letters is None or not count:
                continue
            size = struct.calcsize(order + letters) * count
            place += 8
            if size > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            if place + size <= len(data):
                tags[tag] = struct.unpack_from(f"{order}{count * len(letters)}{letters[0]}", data, place)
        yield order, tags
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def _number(tags: dict[int, tuple], tag: int, default: int | None = None) -> int:
    value = tags.get(tag, (default,))[0]
    if not isinstance(value, int) or value < 0:
        raise TiffError(f"tag {tag} missing or no number" if value is None else f"tag {tag} is {value!r}")
    return value


def _numbers(tags: dict[int, tuple], tag: int) -> tuple[int, ...]:
    values = tags.get(tag, ())
    if not values or not all(isinstance(v, int) and v >= 0 for v in values):
        raise TiffError(f"tag {tag} missing or no numbers")
    return values


def read_page(data: bytes, order: str, tags: dict[int, tuple]) -> np.ndarray:
    """Samples of one page, (height, width, samples): of 1, 2, 4 or 8 bits in bytes, of 16 or 32 bits in words. Sizes are held against the
    file before anything is allocated. Whatever is wrong with a page is a TiffError."""
    w, h, spp = _number(tags, WIDTH), _number(tags, HEIGHT), _number(tags, SAMPLES, 1)
    bits = set(_numbers(tags, BITS)) if BITS in tags else {1}
    kind, predictor, split = _number(tags, COMPRESSION, 1), _number(tags, PREDICTOR, 1), _number(tags, PLANAR, 1) == 2
    deep = bits.pop() if len(bits) == 1 else 0
    if deep not in (1, 2, 4, 8, 16, 32) or predictor not in (1, 2) or (predictor == 2 and deep < 8) or kind not in MOST:
        raise TiffError(f"{deep or 'mixed'} bits a sample, predictor {predictor}, compression {kind}")
    if _number(tags, FILL_ORDER, 1) != 1 or set(tags.get(SAMPLE_FORMAT, (1,))) - {1, 4}:
        raise TiffError("bits reversed, or samples that are no unsigned numbers")
    if not (w and h and spp):
        raise TiffError(f"{w} x {h} pixels of {spp} samples")
    dtype, planes = np.dtype(f"{order}u{max(deep, 8) // 8}"), spp if split else 1
    per, tiled = spp // planes, TILE_OFFSETS in tags
    offsets, counts = _numbers(tags, TILE_OFFSETS if tiled else STRIP_OFFSETS), _numbers(tags, TILE_COUNTS if tiled else STRIP_COUNTS)
    bw, bh = (_number(tags, TILE_WIDTH), _number(tags, TILE_HEIGHT)) if tiled else (w, min(h, _number(tags, ROWS_PER_STRIP, h)))
    if not (bw and bh):
        raise TiffError("blocks without size")
    across, down = -(-w // bw), -(-h // bh)
    line = -(-bw * per * deep // 8)
    if len(offsets) < across * down * planes or len(counts) != len(offsets):
        raise TiffError("blocks missing")
    if w * h * spp * dtype.itemsize > LARGEST or bh * line > LARGEST:
        raise TiffError("page too large for a column")
    for i in range(across * down * planes):
        rows = bh if tiled else min(bh, h - i % (across * down) * bh)
        if offsets[i] + counts[i] > len(data) or rows * line > counts[i] * MOST[kind]:
            raise TiffError("block too short")
    page = np.zeros((h, w, spp), dtype)
    for i in range(across * down * planes):
        plane, cell = divmod(i, across * down)
        y, x = cell // across * bh, cell % across * bw
        rows = bh if tiled else min(bh, h - y)
        raw = decompress(kind, data[offsets[i] : offsets[i] + counts[i]], rows * line)
        if len(raw) < rows * line:
            raise TiffError("block too short")
        if deep < 8:
            byte = np.frombuffer(raw, np.uint8, rows * line).reshape(rows, line)
            shift = np.arange(8 - deep, -1, -deep, dtype=np.uint8)
            block = (byte[:, :, None] >> shift & ((1 << deep) - 1)).reshape(rows, -1)[:, : bw * per].reshape(rows, bw, per)
        else:
            block = np.frombuffer(raw, dtype, rows * bw * per).reshape(rows, bw, per)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=dtype.newbyteorder("="))
        page[y : y + rows, x : x + bw, plane * per : plane * per + per] = block[: h - y, : w - x]
    return page


def read_pages(data: bytes) -> Iterator[np.ndarray]:
    for order, tags in directories(data):
        yield read_page(data, order, tags)


def write(pages: list[np.ndarray], kind: int = DEFLATE, predictor: int = 1, order: str = "<", rows: int = 4096, tile: tuple[int, int] | None = None) -> bytes:
    """Pages (height, width) or (height, width, samples) of 8 or 16 bits, in strips of `rows` rows or tiles (height, width)."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for page in pages:
        page = page[:, :, None] if page.ndim == 2 else page
        h, w, spp = page.shape
        page = page.astype(page.dtype.newbyteorder(order))
        bh, bw = tile or (min(rows, h), w)
        offsets, counts = [], []
        for y in range(0, h, bh):
            for x in range(0, w, bw):
                block = page[y : y + bh, x : x + bw]
                if tile:
                    block = np.pad(block, ((0, bh - block.shape[0]), (0, bw - block.shape[1]), (0, 0)))
                if predictor == 2:
                    block = np.diff(block, axis=1, prepend=np.zeros_like(block[:, :1])).astype(page.dtype)
                raw = compress(kind, block.tobytes(), bw * spp * page.dtype.itemsize)
                offsets.append(len(out))
                counts.append(len(raw))
                out += raw + b"\0" * (len(raw) % 2)
        tags = [(WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [8 * page.dtype.itemsize] * spp), (COMPRESSION, 3, [kind]), (PHOTOMETRIC, 3, [1 if spp < 3 else 2]), (SAMPLES, 3, [spp]), (PREDICTOR, 3, [predictor])]
        tags += [(TILE_WIDTH, 4, [bw]), (TILE_HEIGHT, 4, [bh]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)] if tile else [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [bh]), (STRIP_COUNTS, 4, counts)]
        fields = []
        for tag, t, values in sorted(tags):
            raw = struct.pack(f"{order}{len(values)}{TYPES[t]}", *values)
            if len(raw) > 4:
                place = len(out)
                out += raw + b"\0" * (len(raw) % 2)
                raw = struct.pack(order + "I", place)
            fields.append(struct.pack(order + "HHI", tag, t, len(values)) + raw.ljust(4, b"\0"))
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(fields)) + b"".join(fields)
        link = len(out)
        out += b"\0" * 4
    return bytes(out)


def pages(files: DataFrame, content: str = "content", key: str = "path") -> DataFrame:
    """(key, content binary) -> (key, page int, width, height, samples, bits, pixels binary, error string), a row a page.

    Null content gives no row. A file that can't be read gives its good pages and then one row with the error; so does a
    damaged page, after which the walk goes on. Samples are in native little-endian order, row by row; those under 8 bits fill a byte each.
    Repeated files give repeated rows, an empty table none; other columns are ignored. Files are read one at a time, and no page takes more
    memory than its bytes in the file can unpack to, nor more than LARGEST.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0), b.column(1), strict=True):
                if not data.is_valid:
                    continue
                rows, n = [], 0
                walk = directories(data := data.as_py())
                while True:
                    try:
                        order, tags = next(walk)
                    except StopIteration:
                        break
                    except TiffError as e:
                        rows.append((n, None, None, None, None, None, str(e)))
                        break
                    try:
                        p = read_page(data, order, tags)
                        rows.append((n, p.shape[1], p.shape[0], p.shape[2], 8 * p.dtype.itemsize, p.astype(p.dtype.newbyteorder("<")).tobytes(), None))
                    except TiffError as e:
                        rows.append((n, None, None, None, None, None, str(e)))
                    n += 1
                cols = [pa.array([name.as_py()] * len(rows), b.schema.field(0).type)]
                cols += [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, [pa.int32()] * 5 + [pa.binary(), pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays(cols, [key, "page", "width", "height", "samples", "bits", "pixels", "error"])

    kind = files.schema[key].dataType.simpleString()
    return files.select(key, content).mapInArrow(run, f"`{key}` {kind}, page int, width int, height int, samples int, bits int, pixels binary, error string")


PAGE_ROWS, COLUMNS = 16384, 64  # 1 MB a page: longer payloads run over several pages


#: Forms of storage (name, compression, predictor, tile), one of which a payload's CRC picks; most payloads are deflated strips.
FORMS = [("lzw", LZW, 2, None), ("packbits", PACKBITS, 1, None), ("tiles", DEFLATE, 2, (16, 16)), ("plain", NONE, 1, None)] + [("deflate", DEFLATE, 2, None)] * 12


def store(payload: bytes) -> tuple[str, bytes]:
    """A payload (a positive multiple of 64 bytes) as 8-bit samples, 64 to a row, lossless: (name of its form, file)."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, COLUMNS)
    name, kind, predictor, tile = FORMS[zlib.crc32(payload) % len(FORMS)]
    return name, write([rows[i : i + PAGE_ROWS] for i in range(0, len(rows), PAGE_ROWS)], kind, predictor, tile=tile)


def round_trip(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature).

    The text in UTF-8 (null: empty), padded with zeros to a positive multiple of 64 bytes, is stored as a TIFF file, which is read back
    page by page; all but n_bytes comes from what was read. feature: form, pages, their sizes, mean and entropy of the samples. A row for each
    row; equal texts give equal values; an empty table gives an empty result; other columns are ignored.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                form, media = store(raw + b"\0" * (-len(raw) % 64 if raw else 64))
                back = list(read_pages(media))
                payload = b"".join(p.tobytes() for p in back)
                count = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
                share = count[count > 0] / len(payload)
                feature = f"tiff;{form};pages={len(back)};{'+'.join(f'{p.shape[1]}x{p.shape[0]}' for p in back)};mean={float(count @ np.arange(256)) / len(payload):.4f};entropy={float(-(share * np.log2(share)).sum()) + 0.0:.4f}"
                rows.append((doc.as_py(), len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            cols = zip(*rows) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
