"""Flattening of nested events and removal of unwanted keys.

Two routes. When the schema is known the work is done at plan time and the
result is typed columns (:func:`flatten_struct`). When keys differ from row to
row the result is JSON text whose exact bytes feed a digest, which no built-in
function produces; that route is one Arrow-batched UDF (:func:`flatten_text`).
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from json.encoder import encode_basestring_ascii

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


# JSON text with ", " and ": " between parts and nothing outside ASCII.
to_text = json.JSONEncoder().encode
quote = encode_basestring_ascii


def _float_text(value: float) -> str:
    return repr(value) if math.isfinite(value) else to_text(value)


SCALARS: dict[type, Callable[..., str]] = {
    str: quote,
    int: repr,
    float: _float_text,
    bool: {True: "true", False: "false"}.__getitem__,
    type(None): lambda _: "null",
}


def _list_text(items: list) -> str:
    """A list as the text of its JSON text; null for an empty one."""
    if not items:
        return "null"
    try:
        return quote("[" + ", ".join([SCALARS[type(item)](item) for item in items]) + "]")
    except KeyError:
        return quote(to_text(items))


# How a leaf of an event becomes JSON text.
LEAVES = SCALARS | {list: _list_text}


def flat_leaves(node: dict, prefix: str = "", into: dict | None = None) -> dict[str, str]:
    """JSON text of the leaves of a nested mapping, under ``_``-joined names.

    Of two leaves with one name the later replaces the earlier in its place.
    """
    leaves = {} if into is None else into
    for key, child in node.items():
        kind = type(child)
        if kind is dict:
            flat_leaves(child, f"{prefix}{key}_" if prefix or key else "", leaves)
        else:
            leaves[prefix + key] = LEAVES[kind](child)
    return leaves


def without_path(event: dict, path: Sequence[str]) -> None:
    """Delete one key path in place; a path that does not resolve is left alone."""
    *parents, last = path
    for key in parents:
        event = event.get(key) if isinstance(event, dict) else None
    if isinstance(event, dict):
        event.pop(last, None)


def parsed(raw: bytes) -> object:
    """Value of JSON bytes in any of the encodings JSON may come in."""
    if raw[:1] == b"{" and raw[1:2] != b"\0":
        # Nothing but UTF-8 starts like this, so the detection can be skipped.
        return json.loads(raw.decode("utf-8", "surrogatepass"))
    return json.loads(raw)


def split_paths(paths: Sequence[str]) -> list[list[str]]:
    return [path.split(".") for path in paths]


def flat_json(event: dict, paths: Sequence[Sequence[str]] = ()) -> str:
    for path in paths:
        without_path(event, path)
    parts = [f"{quote(name)}: {text}" for name, text in flat_leaves(event).items()]
    return "{" + ", ".join(parts) + "}"


def flatten_text(value: Column, drop: Sequence[str] = ()) -> Column:
    """Binary JSON object in, flattened JSON bytes out.

    Null where the input is null or is not a JSON object. ``drop`` lists dotted
    key paths removed before flattening.
    """
    paths = split_paths(drop)

    def one(raw: bytes | None) -> bytes | None:
        if raw is None:
            return None
        try:
            event = parsed(raw)
            return flat_json(event, paths).encode() if isinstance(event, dict) else None
        except (ValueError, RecursionError):
            return None

    @F.arrow_udf("binary")
    def flatten_batch(values: pa.Array) -> pa.Array:
        return pa.array([one(raw) for raw in values.to_pylist()], pa.binary())

    return flatten_batch(value.cast("binary"))


def drop_keys(value: Column, paths: Sequence[str]) -> Column:
    """:func:`flatten_text` after removing the dotted key paths."""
    return flatten_text(value, paths)


def _leaves(
    column: Column,
    dtype: DataType,
    name: str,
    path: tuple[str, ...],
    dropped: frozenset[tuple[str, ...]],
) -> Iterator[tuple[str, Column]]:
    if path in dropped:
        return
    if isinstance(dtype, StructType):
        for field in dtype.fields:
            yield from _leaves(
                column.getField(field.name),
                field.dataType,
                f"{name}_{field.name}" if name else field.name,
                (*path, field.name),
                dropped,
            )
    elif isinstance(dtype, ArrayType):
        yield name, F.when(F.size(column) > 0, F.to_json(column))
    else:
        yield name, column


def flatten_struct(df: DataFrame, column: str, drop: Sequence[str] = ()) -> DataFrame:
    """Replace a struct column by its leaves, at plan time.

    Same naming, collision and array rules as :func:`flatten_text`; only the
    leaves that are used are read, as the nested fields stay prunable.
    """
    dropped = frozenset(tuple(path) for path in split_paths(drop))
    leaves = dict(_leaves(F.col(column), df.schema[column].dataType, "", (), dropped))
    others = [F.col(name) for name in df.columns if name != column]
    return df.select(*others, *(leaf.alias(name) for name, leaf in leaves.items()))
