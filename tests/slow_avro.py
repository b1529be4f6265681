"""Row-at-a-time Avro encoder, kept apart from the code it is used to check."""

import struct


def number(n):
    n = 2 * n if n >= 0 else -2 * n - 1
    out = b""
    while n >= 128:
        out += bytes([128 + n % 128])
        n //= 128
    return out + bytes([n])


def encode(schema, value, names=None):
    names = {} if names is None else names
    if isinstance(schema, str) and schema in names:
        schema = names[schema]
    if isinstance(schema, list):
        branch, value = value
        return number(branch) + encode(schema[branch], value, names)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(schema, dict) and "name" in schema:
        names[schema["name"]] = schema
    if isinstance(kind, dict):
        return encode(kind, value, names)
    if kind == "null":
        return b""
    if kind == "boolean":
        return bytes([value])
    if kind in ("int", "long"):
        return number(value)
    if kind == "float":
        return struct.pack("<f", value)
    if kind == "double":
        return struct.pack("<d", value)
    if kind == "bytes":
        return number(len(value)) + value
    if kind == "string":
        return number(len(value.encode())) + value.encode()
    if kind == "fixed":
        return value
    if kind == "enum":
        return number(schema["symbols"].index(value))
    if kind == "array":
        body = b"".join(encode(schema["items"], item, names) for item in value)
        return (number(len(value)) + body if value else b"") + b"\0"
    if kind == "map":
        body = b"".join(
            encode("string", key) + encode(schema["values"], item, names) for key, item in value.items()
        )
        # A sized block: negative count, then the byte length.
        return (number(-len(value)) + number(len(body)) + body if value else b"") + b"\0"
    return b"".join(encode(f["type"], value[f["name"]], names) for f in schema["fields"])


def frame(schema_id, schema, value):
    return struct.pack(">bI", 0, schema_id) + encode(schema, value)
