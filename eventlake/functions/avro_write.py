"""Writing the Avro bodies of one Arrow batch, a field at a time.

Helper of the encoding UDF in :mod:`eventlake.operators.avro`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import islice

import numpy as np
import pyarrow as pa

from eventlake.functions.avro_read import FLOATS
from eventlake.functions.payload import to_text


def varints(numbers: np.ndarray) -> list[bytes]:
    """Avro int or long of every number."""
    numbers = numbers.astype(np.int64)
    left = ((numbers << 1) ^ (numbers >> 63)).view(np.uint64)
    groups = np.empty((len(left), 10), np.uint8)
    size = np.ones(len(left), np.int64)
    for at in range(10):
        groups[:, at] = left & np.uint64(0x7F)
        left = left >> np.uint64(7)
        groups[:, at] |= np.where(left > 0, np.uint8(0x80), np.uint8(0))
        size += left > 0
    data = groups.tobytes()
    return [data[at : at + n] for at, n in zip(range(0, len(data), 10), size.tolist())]


def varint(number: int) -> bytes:
    return varints(np.array([number]))[0]


# One body per row; None for a row that its schema does not allow.
Bodies = list[bytes | None]


def _joined(parts: Iterable[bytes | None]) -> bytes | None:
    parts = tuple(parts)
    return None if None in parts else b"".join(parts)


def _sized(bodies: list[bytes]) -> list[bytes]:
    sizes = varints(np.fromiter(map(len, bodies), np.int64, len(bodies)))
    return [size + body for size, body in zip(sizes, bodies)]


def _column(rows: pa.Array, field: dict) -> pa.Array:
    """One named child of a struct array or one key of a map array, else its default."""
    name, default = field["name"], field.get("default")
    if pa.types.is_map(rows.type):
        found = [dict(row).get(name, default) for row in rows.to_pylist()]
        return pa.array(found, rows.type.item_type)
    at = rows.type.get_field_index(name)
    return rows.flatten()[at] if at >= 0 else pa.array([default] * len(rows))


Writer = Callable[[pa.Array], Bodies]


def _required(write: Writer) -> Writer:
    def column(values: pa.Array) -> Bodies:
        if not values.null_count:
            return write(values)
        present = iter(write(values.drop_null()))
        return [next(present) if there else None for there in values.is_valid().to_pylist()]

    return column


def _optional_writer(schema: list) -> Writer:
    some = [branch for branch in schema if branch != "null"]
    if len(schema) != 2 or len(some) != 1:
        raise ValueError(f"cannot encode union {to_text(schema)}")
    null, tag = varint(schema.index("null")), varint(schema.index(some[0]))
    write = writer(some[0])

    def optional(values: pa.Array) -> Bodies:
        present = iter(write(values.drop_null()))
        return [_joined((tag, next(present))) if there else null for there in values.is_valid().to_pylist()]

    return optional


def _array_writer(write: Writer) -> Writer:
    def items(values: pa.Array) -> Bodies:
        bodies = iter(write(values.flatten()))
        lengths = values.value_lengths()
        counts = varints(lengths.to_numpy())
        return [
            _joined((count, *islice(bodies, n), b"\0")) if n else b"\0"
            for count, n in zip(counts, lengths.to_pylist())
        ]

    return items


def _record_writer(fields: list[dict]) -> Writer:
    writers = [(field, writer(field["type"])) for field in fields]

    def record(values: pa.Array) -> Bodies:
        columns = [write(_column(values, field)) for field, write in writers]
        return list(map(_joined, zip(*columns))) if columns else [b""] * len(values)

    return record


def writer(schema) -> Writer:
    """Compile a schema into a function from an Arrow array to one body per row.

    Covers what message payloads are made of: records of primitives, enums,
    nullable unions, arrays and records of those. A null where the schema wants a
    value, or a symbol that an enum has not, makes the row's body None.
    """
    if isinstance(schema, list):
        return _optional_writer(schema)
    if isinstance(schema, str):
        schema = {"type": schema}
    kind = schema["type"]
    if isinstance(kind, (list, dict)):
        return writer(kind)
    if kind == "null":
        return lambda values: [b""] * len(values)
    if kind == "record":
        return _required(_record_writer(schema["fields"]))
    if kind == "array":
        return _required(_array_writer(writer(schema["items"])))
    if kind in ("int", "long"):
        return _required(lambda values: varints(values.to_numpy()))
    if kind in ("string", "bytes"):
        return _required(lambda values: _sized(values.cast(pa.binary()).to_pylist()))
    if kind == "boolean":
        return _required(lambda values: [b"\1" if value else b"\0" for value in values.to_pylist()])
    if kind == "enum":
        codes = {symbol: varint(at) for at, symbol in enumerate(schema["symbols"])}
        return _required(lambda values: [codes.get(symbol) for symbol in values.to_pylist()])
    if kind in FLOATS:
        width, dtype = FLOATS[kind]

        def floats(values: pa.Array) -> list[bytes]:
            data = values.to_numpy(zero_copy_only=False).astype(dtype).tobytes()
            return [data[at : at + width] for at in range(0, len(data), width)]

        return _required(floats)
    raise ValueError(f"cannot encode Avro type {kind!r}")
