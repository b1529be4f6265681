"""Reading the Avro bodies of one Arrow batch, a field at a time.

Helper of the decoding UDFs in :mod:`eventlake.operators.avro`. It keeps one
cursor per row and moves all cursors over a field together with numpy, so the
Python cost is per field and batch, not per row and field. A row whose bytes
run out or make no sense is marked ``bad`` and never raises.
"""

from __future__ import annotations

import base64
import datetime as dt
import decimal
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

from eventlake.functions.payload import LEAVES, flat_json, quote

# Byte widths and numpy types of the plain Avro types.
FLOATS = {"float": (4, "<f4"), "double": (8, "<f8")}
PRIMITIVES = {"null", "boolean", "int", "long", "float", "double", "bytes", "string"}

EPOCH = dt.datetime(1970, 1, 1)
UTC_EPOCH = EPOCH.replace(tzinfo=dt.timezone.utc)


class Cursors:
    """Read positions of every row of a binary Arrow array, past ``skip`` bytes."""

    def __init__(self, payloads: pa.Array, skip: int):
        wide = pa.types.is_large_binary(payloads.type)
        ends = np.frombuffer(payloads.buffers()[1], "<i8" if wide else "<i4")
        ends = ends[payloads.offset : payloads.offset + len(payloads) + 1].astype(np.int64)
        body = payloads.buffers()[2]
        self.data = body.to_pybytes() if body else b""
        # Ten spare bytes let every fixed-width read happen before its bounds check.
        self.bytes = np.frombuffer(self.data + bytes(10), np.uint8)
        self.start, self.end = ends[:-1], ends[1:]
        self.skip = skip
        self.pos = np.empty(len(payloads), np.int64)
        self.bad = np.empty(len(payloads), bool)
        self.rewind(np.arange(len(payloads)))

    def rewind(self, rows: np.ndarray) -> None:
        self.pos[rows] = np.minimum(self.start[rows] + self.skip, self.end[rows])
        self.bad[rows] = False

    def take(self, rows: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        """Start of the next ``width`` bytes of each row; moves past them."""
        at = self.pos[rows]
        fits = (width >= 0) & (width <= self.end[rows] - at)
        self.bad[rows[~fits]] = True
        self.pos[rows] = np.where(fits, at + width, self.end[rows])
        return at

    def varints(self, rows: np.ndarray) -> np.ndarray:
        at, end = self.pos[rows], self.end[rows]
        total = np.zeros(len(rows), np.uint64)
        more = np.ones(len(rows), bool)
        for shift in range(0, 70, 7):
            inside = at < end
            byte = np.where(inside, self.bytes[np.minimum(at, len(self.data))], 0)
            part = (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            total |= np.where(more, part, np.uint64(0))
            self.bad[rows[more & ~inside]] = True
            at = at + (more & inside)
            more = more & (byte > 0x7F)
            if not more.any():
                break
        self.bad[rows[more]] = True
        self.pos[rows] = at
        return (total >> np.uint64(1)).astype(np.int64) ^ -(total & np.uint64(1)).astype(np.int64)


    def varint_run(self, row: int, count: int) -> list[int]:
        """The next ``count`` varints of one row."""
        start, end = int(self.pos[row]), int(self.end[row])
        part = self.bytes[start:end]
        lasts = np.flatnonzero(part < 0x80)[:count]
        if len(lasts) < count:
            self.bad[row], self.pos[row] = True, end
            return []
        firsts = np.concatenate([[0], lasts[:-1] + 1])
        sizes = lasts - firsts + 1
        if (sizes > 10).any():
            self.bad[row] = True
            return []
        used = part[: lasts[-1] + 1]
        place = np.arange(len(used)) - np.repeat(firsts, sizes)
        bits = (used & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64)
        total = np.bitwise_or.reduceat(bits, firsts)
        self.pos[row] = start + len(used)
        return ((total >> np.uint64(1)).astype(np.int64) ^ -(total & np.uint64(1)).astype(np.int64)).tolist()


Reader = Callable[[Cursors, np.ndarray], list]


def read_rows(read: Reader, cursors: Cursors, rows: np.ndarray) -> list:
    """Values of ``rows``; halves the set on an error until only its cause is bad."""
    cursors.rewind(rows)
    try:
        return read(cursors, rows)
    except (ValueError, ArithmeticError, LookupError, TypeError, RecursionError):
        if len(rows) == 1:
            cursors.bad[rows] = True
            return [None]
        middle = len(rows) // 2
        return [
            *read_rows(read, cursors, rows[:middle]),
            *read_rows(read, cursors, rows[middle:]),
        ]


def _spans(cursors: Cursors, rows: np.ndarray, width, make: Callable) -> list:
    """``make`` of the next ``width`` bytes of each row."""
    start = cursors.take(rows, width).tolist()
    data, stop = cursors.data, cursors.pos[rows].tolist()
    return [make(data[a:b]) for a, b in zip(start, stop)]


def _decimal(schema: dict) -> Callable[[bytes], str]:
    scale = schema.get("scale", 0)

    def text(raw: bytes) -> str:
        # An integer becomes a Decimal with all its digits; the point is put between them.
        number = decimal.Decimal(int.from_bytes(raw, "big", signed=True))
        digits = "".join(map(str, number.as_tuple().digits)).zfill(scale + 1)
        sign = "-" if number < 0 else ""
        return sign + (f"{digits[:-scale]}.{digits[-scale:]}" if scale > 0 else digits + "0" * -scale)

    return text


def _since(start: dt.datetime, unit: str, part: Callable) -> Callable[[int], str]:
    def text(count: int) -> str:
        try:
            return part(start + dt.timedelta(**{unit: count})).isoformat()
        except OverflowError:
            # Outside the calendar: the plain number.
            return str(count)

    return text


def _logical_text(schema: dict) -> Callable | None:
    """How a logical type becomes text, as JSON has no form for it."""
    name = schema.get("logicalType", "")
    if name == "decimal":
        return _decimal(schema)
    if name == "date":
        return _since(EPOCH, "days", dt.datetime.date)
    for unit in ("millis", "micros"):
        step = "milliseconds" if unit == "millis" else "microseconds"
        if name == f"time-{unit}":
            return _since(EPOCH, step, dt.datetime.time)
        if name == f"timestamp-{unit}":
            return _since(UTC_EPOCH, step, lambda moment: moment)
        if name == f"local-timestamp-{unit}":
            return _since(EPOCH, step, lambda moment: moment)
    return None


def _base64(raw: bytes) -> str:
    return base64.b64encode(raw).decode("ascii")


def _qualified(schema: dict, space: str | None) -> tuple[str, str | None]:
    name = schema["name"]
    if "." in name:
        return name, name.rpartition(".")[0]
    space = schema.get("namespace", space)
    return (f"{space}.{name}" if space else name), space


def _lookup(name: str, space: str | None, known: dict):
    qualified = f"{space}.{name}" if space and "." not in name else name
    return known[qualified] if qualified in known else known[name]


def reader(schema, known: dict[str, Reader] | None = None, space: str | None = None) -> Reader:
    """Compile a schema into a function of (cursors, rows) -> one value per row."""
    known = {} if known is None else known
    if isinstance(schema, list):
        return _union_reader([reader(branch, known, space) for branch in schema])
    if isinstance(schema, str):
        schema = {"type": schema}
    kind = schema["type"]
    if isinstance(kind, (list, dict)):
        return reader(kind, known, space)
    text = _logical_text(schema)

    if kind in ("int", "long"):
        if text is None:
            return lambda cur, rows: cur.varints(rows).tolist()
        return lambda cur, rows: [text(n) for n in cur.varints(rows).tolist()]
    if kind in FLOATS:
        width, dtype = FLOATS[kind]

        def floats(cur: Cursors, rows: np.ndarray) -> list:
            at = np.minimum(cur.take(rows, width), len(cur.data))
            packed = cur.bytes[at[:, None] + np.arange(width)]
            with np.errstate(invalid="ignore"):
                return packed.view(dtype).ravel().astype("f8").tolist()

        return floats
    if kind == "boolean":
        return lambda cur, rows: (cur.bytes[np.minimum(cur.take(rows, 1), len(cur.data))] != 0).tolist()
    if kind == "null":
        return lambda cur, rows: [None] * len(rows)
    if kind == "string":
        return lambda cur, rows: _spans(cur, rows, cur.varints(rows), bytes.decode)
    if kind == "bytes":
        return lambda cur, rows: _spans(cur, rows, cur.varints(rows), text or _base64)
    if kind == "array":
        items = schema["items"]
        run = _number_run(items)
        return _block_reader(reader(items, known, space), list, list.append, least_bytes(items), run)
    if kind == "map":
        value = reader(schema["values"], known, space)
        key = reader("string")

        def pairs(cur: Cursors, rows: np.ndarray) -> list:
            return list(zip(key(cur, rows), value(cur, rows)))

        return _block_reader(pairs, dict, lambda out, pair: out.__setitem__(*pair), 1)
    if kind == "fixed":
        known[_qualified(schema, space)[0]] = fixed = lambda cur, rows: _spans(
            cur, rows, schema["size"], text or _base64
        )
        return fixed
    if kind == "enum":
        symbols = schema["symbols"]

        def enum(cur: Cursors, rows: np.ndarray) -> list:
            at = cur.varints(rows)
            cur.bad[rows[(at < 0) | (at >= len(symbols))]] = True
            return [symbols[i] for i in np.clip(at, 0, len(symbols) - 1).tolist()]

        known[_qualified(schema, space)[0]] = enum
        return enum
    if kind in ("record", "error"):
        name, inner = _qualified(schema, space)
        fields: list[tuple[str, Reader]] = []

        def record(cur: Cursors, rows: np.ndarray) -> list:
            if not fields:
                return [{} for _ in rows]
            names = [field for field, _ in fields]
            columns = [read(cur, rows) for _, read in fields]
            return [dict(zip(names, values)) for values in zip(*columns)]

        known[name] = record
        fields.extend((f["name"], reader(f["type"], known, inner)) for f in schema["fields"])
        return record
    return _lookup(kind, space, known)


def _union_reader(branches: list[Reader]) -> Reader:
    def union(cur: Cursors, rows: np.ndarray) -> list:
        branch = cur.varints(rows)
        out = np.empty(len(rows), object)
        cur.bad[rows[(branch < 0) | (branch >= len(branches))]] = True
        live = ~cur.bad[rows]
        if len(rows) and live.all() and (branch == branch[0]).all():
            return branches[branch[0]](cur, rows)
        for index, read in enumerate(branches):
            mine = np.flatnonzero(live & (branch == index))
            if len(mine):
                for at, value in zip(mine.tolist(), read(cur, rows[mine])):
                    out[at] = value
        return out.tolist()

    return union


# Bytes that a value takes at least; what is not listed takes one.
LEAST_BYTES = {"null": 0, "float": 4, "double": 8}

# Items of no bytes whose JSON text no longer fits into a string.
MOST_EMPTY_ITEMS = (1 << 31) // len("{}, ")


def least_bytes(schema) -> int:
    """Fewest bytes of an encoded value; nought where that is not known, as for a name."""
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, dict):
        return least_bytes(kind)
    if isinstance(kind, list):
        return 1
    if kind == "fixed":
        return schema["size"]
    if kind in ("record", "error"):
        return sum(least_bytes(f["type"]) for f in schema["fields"])
    return LEAST_BYTES.get(kind, 1 if kind in PRIMITIVES | {"array", "map", "enum"} else 0)


def _number_run(schema) -> Callable[[Cursors, int, int], list] | None:
    """Reads many plain integers or floating-point numbers of one row at once, where items are such."""
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(schema, dict) and _logical_text(schema) is not None:
        return None
    if kind in ("int", "long"):
        return Cursors.varint_run
    if kind in FLOATS:
        width, dtype = FLOATS[kind]

        def floats(cur: Cursors, row: int, count: int) -> list:
            at = int(cur.take(np.array([row]), width * count)[0])
            with np.errstate(invalid="ignore"):
                return [] if cur.bad[row] else np.frombuffer(cur.data[at : at + width * count], dtype).astype("f8").tolist()

        return floats
    return None


# Items of one row from which a block of numbers is read at once.
LONG_RUN = 32


def _block_reader(
    item: Reader, new: Callable, add: Callable, least: int, run: Callable[[Cursors, int, int], list] | None = None
) -> Reader:
    """Arrays and maps: blocks of counted items, ended by a zero count.

    ``least``: bytes of an item at least. Items that take no bytes are all alike:
    one of them is read for a block.
    """

    def blocks(cur: Cursors, rows: np.ndarray) -> list:
        out = [new() for _ in rows]
        left = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            opening = live[left[live] == 0]
            if len(opening):
                count = cur.varints(rows[opening])
                sized = count < 0
                if sized.any():
                    cur.varints(rows[opening[sized]])
                    count = np.abs(count)
                # A count beyond what the bytes that remain can hold cannot be honest.
                room = cur.end[rows[opening]] - cur.pos[rows[opening]]
                most = room // least if least else np.full(len(opening), MOST_EMPTY_ITEMS)
                cur.bad[rows[opening[(count < 0) | (count > most)]]] = True
                left[opening] = count
                live = live[(left[live] > 0) & ~cur.bad[rows[live]]]
            at_once = live[left[live] >= LONG_RUN] if run is not None else live[:0]
            for at in at_once.tolist():
                out[at].extend(run(cur, int(rows[at]), int(left[at])))
            left[at_once] = 0
            rest = live[left[live] > 0]
            before = cur.pos[rows[rest]]
            values = item(cur, rows[rest]) if len(rest) else ()
            alike = (cur.pos[rows[rest]] == before) & (least == 0)
            for at, value, repeated in zip(rest.tolist(), values, alike.tolist()):
                if repeated:
                    out[at].extend([value] * int(left[at]))
                else:
                    add(out[at], value)
            left[rest] = np.where(alike, 0, left[rest] - 1)
            live = live[~cur.bad[rows[live]]]
        return out

    return blocks


# ------------------------------------------------------- flat records as text


def _texts(values: list) -> list[str]:
    return [LEAVES[type(value)](value) for value in values]


def _leaves(schema, known: dict, space: str | None, path: tuple[str, ...] = ()):
    """(path, reader) of every leaf; None in place of a reader whose keys vary by row."""
    if isinstance(schema, dict) and isinstance(schema["type"], dict):
        schema = schema["type"]
    if isinstance(schema, dict) and schema["type"] == "record":
        _, inner = _qualified(schema, space)
        for field in schema["fields"]:
            yield from _leaves(field["type"], known, inner, (*path, field["name"]))
    else:
        kinds = schema if isinstance(schema, list) else [schema]
        kinds = [kind["type"] if isinstance(kind, dict) else kind for kind in kinds]
        fixed = all(isinstance(k, str) and k in PRIMITIVES | {"array", "enum", "fixed"} for k in kinds)
        yield path, reader(schema, known, space) if fixed else None


def text_reader(schema, drop: Sequence[Sequence[str]] = ()) -> Reader:
    """Reader of the flattened event as JSON text.

    Where the schema fixes the keys, every leaf column is turned to text at
    once. Where they vary by row (maps, unions of records), rows are flattened
    one by one.
    """
    known: dict[str, Reader] = {}
    whole = reader(schema, known)
    is_record = isinstance(schema, dict) and schema["type"] == "record"
    leaves = list(_leaves(schema, known, None)) if is_record else []

    def by_row(cur: Cursors, rows: np.ndarray) -> list[str]:
        values = whole(cur, rows)
        return [flat_json(v, drop) if isinstance(v, dict) else "null" for v in values]

    if not leaves or any(read is None for _, read in leaves):
        return by_row

    dropped = {tuple(path) for path in drop}
    # A later leaf takes the place of an earlier one of the same name.
    shown = {
        "_".join(path): at
        for at, (path, _) in enumerate(leaves)
        if not any(path[: n + 1] in dropped for n in range(len(path)))
    }
    names = [quote(name).replace("%", "%%") for name in shown]
    template = "{" + ", ".join(f"{name}: %s" for name in names) + "}"

    def by_column(cur: Cursors, rows: np.ndarray) -> list[str]:
        columns = [read(cur, rows) for _, read in leaves]
        if not shown:
            return ["{}"] * len(rows)
        texts = [_texts(columns[at]) for at in shown.values()]
        return [template % row for row in zip(*texts)]

    return by_column
