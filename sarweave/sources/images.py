"""PNG and TIFF in plain Python: headers, pixels, and a PNG writer. Grey rasters of 8, 16 and 32 bits."""

from __future__ import annotations

import struct
import zlib
from datetime import datetime
from xml.etree import ElementTree

import numpy as np

PNG = b"\x89PNG\r\n\x1a\n"
#: TIFF field types by number: size in bytes and struct letter.
FIELD = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}


def encode_png(a: np.ndarray) -> bytes:
    """A two-dimensional array of uint8 or uint16 as PNG."""
    if a.ndim != 2 or a.dtype not in (np.uint8, np.uint16):
        raise ValueError(f"PNG takes a 2-D uint8 or uint16 array, not {a.ndim}-D {a.dtype}")
    h, w = a.shape
    raw = np.ascontiguousarray(a.astype(a.dtype.newbyteorder(">"))).view(np.uint8).reshape(h, -1)
    lines = np.concatenate((np.zeros((h, 1), np.uint8), raw), axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8 * a.dtype.itemsize, 0, 0, 0, 0)
    return PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def _png_chunks(data: bytes):
    at = len(PNG)
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        yield kind, data[at + 8 : at + 8 + n]
        at += 12 + n


def _decode_png(data: bytes, bands: list[int]) -> np.ndarray:
    parts = list(_png_chunks(data))
    w, h, depth, color, _, _, interlaced = struct.unpack(">IIBBBBB", dict(parts)[b"IHDR"])
    if color not in (0, 2, 4, 6) or interlaced or depth not in (8, 16):
        raise ValueError("only plain grey or colour PNGs of 8 or 16 bits are read")
    n = {0: 1, 2: 3, 4: 2, 6: 4}[color]
    size = n * depth // 8
    raw = np.frombuffer(zlib.decompress(b"".join(d for k, d in parts if k == b"IDAT")), np.uint8).reshape(h, w * size + 1)
    out = np.zeros((h, w * size), dtype=np.uint8)
    before = np.zeros(w * size, dtype=np.int64)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int64)
        if kind == 1:
            line = (np.cumsum(line.reshape(w, size), axis=0) & 255).ravel()
        elif kind == 2:
            line = (line + before) & 255
        elif kind in (3, 4):
            for x in range(len(line)):
                left = line[x - size] if x >= size else 0
                if kind == 3:
                    guess = (left + before[x]) // 2
                else:
                    corner = before[x - size] if x >= size else 0
                    p = left + before[x] - corner
                    guess = min((abs(p - left), 0, left), (abs(p - before[x]), 1, before[x]), (abs(p - corner), 2, corner))[2]
                line[x] = (line[x] + guess) & 255
        out[y], before = line, line
    a = out.view(">u2").astype(np.uint16) if depth == 16 else out
    return a.reshape(h, w, n)[..., bands]


def _tiff_fields(data: bytes) -> dict[int, tuple]:
    """The first directory of a TIFF or BigTIFF: values by tag, the byte order under 0."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    big = struct.unpack(order + "H", data[2:4])[0] == 43
    word, few, wide = ("Q", "Q", 8) if big else ("I", "H", 4)
    at = struct.unpack(order + word, data[8:16] if big else data[4:8])[0]
    first, step = at + struct.calcsize(order + few), 4 + 2 * wide
    out: dict = {0: (order,)}
    for i in range(struct.unpack(order + few, data[at:first])[0]):
        entry = first + step * i
        tag, kind, n = struct.unpack(order + "HH" + word, data[entry : entry + 4 + wide])
        if kind not in FIELD:
            continue
        size, letter = FIELD[kind]
        spot = entry + 4 + wide
        if size * n > wide:
            spot = struct.unpack(order + word, data[spot : spot + wide])[0]
        value = data[spot : spot + size * n]
        out[tag] = (value.rstrip(b"\0"),) if letter == "s" else struct.unpack(order + letter * n, value)
    return out


def _tiff_dtype(f: dict) -> np.dtype:
    kind = {1: "u", 2: "i", 3: "f"}[f.get(339, (1,))[0]]
    return np.dtype(f"{f[0][0]}{kind}{f[258][0] // 8}")


def _inflate_lzw(data: bytes) -> bytes:
    """LZW as TIFF has it: codes from the high bit on, 9 to 12 bits wide, the width growing one code early."""
    clear, end = 256, 257
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, before = list(first), 9, b""
    out, held, bits = [], 0, 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == end:
            break
        if code == clear:
            table, width, before = list(first), 9, b""
            continue
        word = table[code] if code < len(table) else before + before[:1]
        if before:
            table.append(before + word[:1])
        out.append(word)
        before = word
        width = min(12, (len(table) + 1).bit_length())
    return b"".join(out)


UNPACK = {1: bytes, 5: _inflate_lzw, 8: zlib.decompress, 32946: zlib.decompress}


def _unpredict(raw: bytes, shape: tuple[int, int, int], dtype: np.dtype, how: int) -> np.ndarray:
    """A block of (rows, columns, samples) from its bytes, with differences to the left sample summed up again."""
    if how == 3:  # bytes of each row by significance, highest first, differenced
        rows, columns, n = shape
        planes = np.frombuffer(raw, np.uint8)[: rows * columns * n * dtype.itemsize].reshape(rows, columns * dtype.itemsize, n)
        planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, dtype.itemsize, columns * n)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(dtype.newbyteorder(">")).reshape(shape)
    a = np.frombuffer(raw, dtype, int(np.prod(shape))).reshape(shape)
    return np.cumsum(a, axis=1, dtype=dtype.newbyteorder("=")) if how == 2 else a


def _decode_tiff(data: bytes, bands: list[int]) -> np.ndarray:
    """Bands of a striped or tiled file; only their blocks are unpacked where bands lie apart."""
    f = _tiff_fields(data)
    unpack = UNPACK.get(f.get(259, (1,))[0])
    if unpack is None:
        raise ValueError(f"TIFF compression {f[259][0]} is not read (known: none, LZW, deflate)")
    w, h, n, dtype, how = f[256][0], f[257][0], f.get(277, (1,))[0], _tiff_dtype(f), f.get(317, (1,))[0]
    apart = f.get(284, (1,))[0] == 2
    tiled = 322 in f
    bw, bh = (f[322][0], f[323][0]) if tiled else (w, min(f.get(278, (h,))[0], h))
    starts, sizes = (f[324], f[325]) if tiled else (f[273], f[279])
    across, down = -(-w // bw), -(-h // bh)
    out = np.zeros((h, w, len(bands)), dtype.newbyteorder("="))
    for to, skip in [([i], b * across * down) for i, b in enumerate(bands)] if apart else [(range(len(bands)), 0)]:
        for k in range(across * down):
            y, x = k // across * bh, k % across * bw
            rows = bh if tiled else min(bh, h - y)
            raw = unpack(data[starts[skip + k] : starts[skip + k] + sizes[skip + k]])
            block = _unpredict(raw, (rows, bw, 1 if apart else n), dtype, how)
            out[y : y + bh, x : x + bw, to] = block[: h - y, : w - x, [0] if apart else bands]
    return out


#: Names under which a file tells its time, in the order in which they are asked.
TIME_TAGS = ("TIFFTAG_DATETIME", "TIFFTAG_TIMESTAMP", "TIME", "ACQUISITION_TIME")


def _tiff_time(f: dict) -> str | None:
    """The acquisition time that a file's own field or its metadata items tell, as YYYY-MM-DDTHH:MM:SSZ."""
    told = {}
    if 42112 in f:
        try:
            told = {e.get("name"): e.text for e in ElementTree.fromstring(f[42112][0]).iter("Item")}
        except ElementTree.ParseError:
            pass
    if 306 in f:
        told["TIFFTAG_DATETIME"] = f[306][0].decode("ascii", "replace")
    for name in TIME_TAGS:
        text = (told.get(name) or "").strip()
        try:
            when = datetime.strptime(text[:19], "%Y:%m:%d %H:%M:%S") if text[4:5] == ":" else datetime.fromisoformat(text)
        except ValueError:
            continue
        return when.strftime("%Y-%m-%dT%H:%M:%SZ")
    return None


def header(data: bytes) -> dict:
    """width, height, count, dtype, crs, transform and time; what a format lacks is null."""
    if data[: len(PNG)] == PNG:
        w, h, depth, color = struct.unpack(">IIBB", data[16:26])
        return {"width": w, "height": h, "count": {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color], "dtype": f"uint{depth}", "crs": None, "transform": None, "time": None}
    if data[:2] in (b"II", b"MM"):
        f = _tiff_fields(data)
        move = None
        if 33550 in f and 33922 in f:
            (sx, sy), (i, j, _, x, y, _) = f[33550][:2], f[33922][:6]
            move = [sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy]
        keys = f.get(34735, ())
        code = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] in (2048, 3072)), None)
        return {"width": f[256][0], "height": f[257][0], "count": f.get(277, (1,))[0], "dtype": {"u": "uint", "i": "int", "f": "float"}[_tiff_dtype(f).kind] + str(f[258][0]), "crs": f"EPSG:{code}" if code else None, "transform": move, "time": _tiff_time(f)}
    raise ValueError("neither PNG nor TIFF")


def decode(data: bytes, band: int = 0) -> np.ndarray:
    """One band as a two-dimensional array."""
    return decode_bands(data, [band])[0]


def decode_bands(data: bytes, bands: list[int] | None = None) -> list[np.ndarray]:
    """Some bands, or all, from one pass over the file."""
    bands = list(range(header(data)["count"])) if bands is None else bands
    a = (_decode_png if data[: len(PNG)] == PNG else _decode_tiff)(data, bands)
    return [a[..., i] for i in range(len(bands))]


def encode_tiff(a: np.ndarray, origin: tuple[float, float] | None = None, pixel: float = 1.0, epsg: int = 4326) -> bytes:
    """A plain little-endian TIFF of one band, with a georeference where an origin (x, y) is given. For tests and exchange."""
    a = np.ascontiguousarray(a.astype(a.dtype.newbyteorder("<")))
    h, w = a.shape
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags: list[tuple[int, int, tuple]] = [(256, 4, (w,)), (257, 4, (h,)), (258, 3, (8 * a.dtype.itemsize,)), (259, 3, (1,)), (262, 3, (1,)), (273, 4, (8,)), (277, 3, (1,)), (278, 4, (h,)), (279, 4, (a.nbytes,)), (339, 3, (kind,))]
    if origin:
        tags += [(33550, 12, (pixel, pixel, 0.0)), (33922, 12, (0.0, 0.0, 0.0, origin[0], origin[1], 0.0)), (34735, 3, (1, 1, 0, 1, 2048, 0, 1, epsg))]
    at = 8 + a.nbytes
    extra, entries = b"", b""
    base = at + 2 + 12 * len(tags) + 4
    for tag, k, values in tags:
        size, letter = FIELD[k]
        raw = struct.pack("<" + letter * len(values), *values)
        if len(raw) > 4:
            entries += struct.pack("<HHII", tag, k, len(values), base + len(extra))
            extra += raw
        else:
            entries += struct.pack("<HHI", tag, k, len(values)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", at) + a.tobytes() + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + extra
