"""NetCDF files in the classic formats (versions 1, 2 and 5), read and written with arrays alone.

The layout is that of the public file format specification: a header with dimensions, attributes and variables, then
the data big-endian, variables without the record dimension one after the other, records interleaved.
"""

from __future__ import annotations

import datetime as dt
import re
import struct
from dataclasses import dataclass, field

import numpy as np

# Fixed values of the format: tags of the header's lists, and the types by number.
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}


@dataclass
class Variable:
    dims: list[str]
    data: np.ndarray
    attributes: dict[str, object] = field(default_factory=dict)

    def values(self) -> np.ndarray:
        """The data as numbers: scaled, and NaN where the fill or missing value stands."""
        x = self.data.astype(float)
        for name in ("_FillValue", "missing_value"):
            if name in self.attributes:
                x = np.where(x == float(np.ravel(self.attributes[name])[0]), np.nan, x)
        scale, offset = (float(np.ravel(self.attributes.get(k, d))[0]) for k, d in (("scale_factor", 1.0), ("add_offset", 0.0)))
        return x * scale + offset


def is_classic(content: bytes) -> bool:
    return content[:3] == b"CDF" and content[3:4] in (b"\x01", b"\x02", b"\x05")


def read(content: bytes) -> tuple[dict[str, Variable], dict[str, object]]:
    """Variables and global attributes; the arrays are views of ``content``. A header that is cut off is an error."""
    if not is_classic(content):
        raise ValueError("no NetCDF file of a classic format")
    version, at = content[3], 4
    count = ">q" if version == 5 else ">i"

    def number(kind: str = count) -> int:
        nonlocal at
        (v,) = struct.unpack_from(kind, content, at)
        at += struct.calcsize(kind)
        return v

    def padded(n: int) -> bytes:
        nonlocal at
        part = content[at : at + n]
        at += -(-n // 4) * 4
        return part

    def attributes() -> dict[str, object]:
        _, n = number(">i"), number()
        out = {}
        for _ in range(n):
            name, kind, length = padded(number()).decode(), number(">i"), number()
            raw = padded(length * np.dtype(TYPES[kind]).itemsize)
            out[name] = raw.decode("utf-8", "replace") if kind == 2 else np.frombuffer(raw, TYPES[kind])
        return out

    records = number()
    _, n = number(">i"), number()
    dims = [(padded(number()).decode(), number()) for _ in range(n)]
    everywhere = attributes()
    _, n = number(">i"), number()
    found = []
    for _ in range(n):
        name = padded(number()).decode()
        axes = [number() for _ in range(number())]
        notes, kind, size, begin = attributes(), number(">i"), number(), number(">i" if version == 1 else ">q")
        found.append((name, axes, notes, kind, size, begin))
    recorded = [v for v in found if v[1] and dims[v[1][0]][1] == 0]
    step = sum(v[4] for v in recorded)
    out = {}
    for name, axes, notes, kind, size, begin in found:
        shape, t = [dims[a][1] for a in axes], np.dtype(TYPES[kind])
        if shape and shape[0] == 0:
            shape[0] = records
            each = int(np.prod(shape[1:])) * t.itemsize
            stride = step if len(recorded) > 1 else each
            inner = np.cumprod([t.itemsize, *shape[:0:-1]])[::-1][1:] if len(shape) > 1 else []
            data = np.ndarray(shape, t, content, begin, (stride, *[int(s) for s in inner])) if records else np.zeros(shape, t)
        else:
            data = np.frombuffer(content, t, int(np.prod(shape)) if shape else 1, begin).reshape(shape)
        out[name] = Variable([dims[a][0] for a in axes], data, notes)
    return out, everywhere


def write(variables: dict[str, Variable], attributes: dict[str, object] | None = None) -> bytes:
    """A file of version 2 (64-bit offsets) with dimensions of fixed length; whole numbers become 32-bit, the rest 64-bit floats."""
    sizes: dict[str, int] = {}
    for v in variables.values():
        sizes.update(zip(v.dims, v.data.shape))
    order = list(sizes)
    text = lambda s: struct.pack(">i", len(s.encode())) + s.encode() + b"\0" * (-len(s.encode()) % 4)

    def notes(a: dict[str, object]) -> bytes:
        if not a:
            return struct.pack(">ii", 0, 0)
        out = struct.pack(">ii", ATTRIBUTE, len(a))
        for k, v in a.items():
            raw = v.encode() if isinstance(v, str) else np.atleast_1d(v).astype(">f8").tobytes()
            out += text(k) + struct.pack(">ii", 2 if isinstance(v, str) else 6, len(raw) if isinstance(v, str) else len(raw) // 8) + raw + b"\0" * (-len(raw) % 4)
        return out

    kinds = {k: 4 if np.issubdtype(v.data.dtype, np.integer) else 6 for k, v in variables.items()}
    data = {k: v.data.astype(TYPES[kinds[k]]).tobytes() for k, v in variables.items()}

    def header(begins: dict[str, int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", 0) + struct.pack(">ii", DIMENSION, len(order)) + b"".join(text(d) + struct.pack(">i", sizes[d]) for d in order) + notes(attributes or {})
        out += struct.pack(">ii", VARIABLE, len(variables))
        for k, v in variables.items():
            out += text(k) + struct.pack(f">i{len(v.dims)}i", len(v.dims), *[order.index(d) for d in v.dims]) + notes(v.attributes) + struct.pack(">iiq", kinds[k], len(data[k]), begins[k])
        return out

    at, begins = len(header(dict.fromkeys(variables, 0))), {}
    for k in variables:
        begins[k] = at
        at += len(data[k])
    return header(begins) + b"".join(data.values())


def decoded_times(v: Variable) -> list[dt.datetime]:
    """Times of a variable whose units are ``<unit> since <date>[ <clock>]``."""
    m = re.match(r"(second|minute|hour|day)s? since (\d{4})-(\d{1,2})-(\d{1,2})(?:[T ](\d{1,2}):(\d{2})(?::(\d{2}))?)?", str(v.attributes.get("units", "")))
    if not m:
        raise ValueError("a time axis without units")
    start = dt.datetime(*[int(x or 0) for x in m.groups()[1:]])
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[m[1]]
    return [start + dt.timedelta(seconds=float(x) * seconds) for x in np.ravel(v.data)]
