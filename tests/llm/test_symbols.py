"""The symbol table of language ID is built without a Python object per code point."""

import tracemalloc

from eventlake.llm import language_id


def test_symbol_table_is_built_in_little_memory():
    tracemalloc.start()
    try:
        table = language_id.symbol_table({"a": 2, "é": 3, "ß": 4})
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    # A list of all 1.1 million code points as strings takes some 80 MB.
    assert peak < 40 << 20
    assert len(table) == 0x110000
    assert table[ord("a")] == table[ord("A")] == 2
    assert table[ord("é")] == table[ord("É")] == 3
    assert table[ord("ß")] == 4  # its upper case is two letters
    for point in [0x20, 0x30, 0x2E, 0xD800, 0xDFFF, 0x10FFFF, 0x4E00, 0x3B1, 0x1F600, 0x10400]:
        letter = not 0xD800 <= point < 0xE000 and chr(point).isalpha()
        assert table[point] == (0 if letter else 1), hex(point)
