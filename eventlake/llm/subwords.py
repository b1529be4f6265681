"""Subword ids of whole texts from public vocabulary files.

Both encoders give exactly the ids of ``Tokenizer.encode(text, add_special_tokens=False)``;
the mark of a special token in a text is that token, as the library has it. They remember
the ids of words by a hash: a space or a line break between two other characters
always ends a pre-token, and so does the place between a letter and a comma or
full stop that ends a word. Words are hashed and looked up by numpy, and the
tokenizers library encodes each new one. A text that could be cut otherwise (other
white space, two spaces, control characters, rarer scripts, the mark of special
tokens) goes through the library as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from eventlake.llm import words
from eventlake.llm.worker import kept

# Words that a worker remembers; beyond it starts anew.
REMEMBERED = 1_000_000
# Rows that are encoded at a time, and text that the library gets in a call.
PART_ROWS, CALL_CHARS = 1000, 4000

BREAKS = words.separators((0x20, 0x20), (0x0A, 0x0A))
# What a word follows: nothing, a space, a line break; or it is a mark behind a word.
FIRST, SPACED, BROKEN, MARK = range(4)


def _plain_bytes() -> np.ndarray:
    """Bytes of texts that are cut into words: ASCII and scripts of two bytes from U+00C0 on."""
    plain = np.zeros(256, dtype=bool)
    plain[0x20:0x7F] = plain[0x80:0xC0] = plain[0xC3:0xE0] = plain[0x0A] = True
    return plain


class Encoder:
    """Ids of texts as little-endian bytes, ``width`` bytes per id.

    ``spaces``: the vocabulary keeps white space as part of the next word;
    otherwise it drops it, lower-cases, and marks the ends of words.
    """

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaces = spaces
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if len(vocabulary) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        # Ids that begin a word after a space, or that end a word.
        self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.edge[[i for t, i in vocabulary.items() if (t.startswith("Ġ") if spaces else t.endswith("</w>"))]] = True
        self.run = re.compile((" " if spaces else "") + "[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch
        self.plain = _plain_bytes()
        self._forget()

    def _forget(self) -> None:
        """Remembered words: sorted hashes, where their ids begin in ``ids``, and how many they are."""
        self.keys = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=self.kind)
        self.used = 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in found]

    def _runs(self, runs: list[str]) -> list[np.ndarray]:
        """Ids of runs of letters, each one pre-token, encoded many to a call.

        Runs after a space are told apart by the ids that begin with it, in the
        other vocabulary by the ids that end a word.
        """
        calls, last, size = [], 0, 0
        for at, run in enumerate(runs):
            size += len(run) + 1
            if size > CALL_CHARS or at == len(runs) - 1:
                calls.append(("" if self.spaces else " ").join(runs[last : at + 1]))
                last, size = at + 1, 0
        ids = np.concatenate(self._whole(calls) or [np.zeros(0, self.kind)])
        edges = np.flatnonzero(self.edge[ids])
        edges = edges[1:] if self.spaces else edges[:-1] + 1
        if len(edges) + 1 != len(runs):
            return self._whole(runs)
        return np.split(ids, edges)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Adds new words, given by their hashes and what the library is to encode."""
        runs = [at for at, text in enumerate(texts) if self.run(text)]
        others = sorted(set(range(len(texts))).difference(runs))
        found: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        for at, ids in zip(runs, self._runs([texts[at] for at in runs]) if runs else []):
            found[at] = ids
        for at, ids in zip(others, self._whole([texts[at] for at in others])):
            found[at] = ids
        count = np.array([len(ids) for ids in found], dtype=np.int64)
        total = self.used + int(count.sum())
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(total, len(self.ids)), self.kind)])
        self.ids[self.used : total] = np.concatenate(found)
        first = self.used + np.cumsum(count) - count
        self.used = total
        all_keys = np.concatenate([self.keys, keys])
        order = np.argsort(all_keys, kind="stable")
        self.keys = all_keys[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]

    def _regular(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts of a slice are cut into words."""
        bad = ~self.plain[data]
        bad[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        low, high = offsets[:-1], offsets[1:]
        there = high > low
        edge = np.zeros(len(low), dtype=bool)
        if self.spaces:
            breaks = BREAKS[data]
            bad[1:] |= breaks[1:] & breaks[:-1]
            edge[there] = breaks[low[there]] | breaks[high[there] - 1]
        sums = np.concatenate([[0], np.cumsum(bad)])
        return (sums[high] == sums[low]) & ~edge

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        starts, ends, bounds = words.word_spans(data, offsets, BREAKS)
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        letter = (before >= 65) & (before <= 90) | (before >= 97) & (before <= 122)
        marked = ((last == ord(",")) | (last == ord("."))) & letter & (ends - starts > 1)
        kinds = np.full(len(starts), SPACED, dtype=np.int64)
        if self.spaces:
            kinds[data[starts - 1] == 0x0A] = BROKEN
            heads = bounds[:-1][np.diff(bounds) > 0]
            kinds[heads] = FIRST
        # Words and the marks behind them, in order.
        place = np.arange(len(starts)) + np.cumsum(marked) - marked
        size = len(starts) + int(marked.sum())
        low, high, kind = (np.zeros(size, dtype=np.int64) for _ in range(3))
        low[place], high[place], kind[place] = starts, ends - marked, kinds
        marks = place[marked] + 1
        low[marks], high[marks], kind[marks] = ends[marked] - 1, ends[marked], MARK
        keys = words.mix(words.span_hashes(data, low, high, fold=not self.spaces) + kind.astype(np.uint64))
        unique, example, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), dtype=bool)
        near = at < len(self.keys)
        new[near] = self.keys[at[near]] != unique[near]
        if new.any():
            if len(self.keys) + new.sum() > REMEMBERED:
                self._forget()
                new[:] = True
            lead = ("", " ", "\n", "") if self.spaces else ("", "", "", "")
            raw = data.tobytes()
            texts = [
                lead[k] + raw[x:y].decode("utf-8", "replace")
                for x, y, k in zip(*(a[example[new]].tolist() for a in (low, high, kind)))
            ]
            self._learn(unique[new], texts)
            at = np.searchsorted(self.keys, unique)
        count = self.count[at][back]
        first = self.first[at][back]
        ends_at = np.cumsum(count)
        ids = self.ids[np.repeat(first - ends_at + count, count) + np.arange(ends_at[-1] if size else 0)]
        ends_at = np.concatenate([[0], ends_at])
        words_before = np.concatenate([place, [size]])[bounds]
        cuts = (ends_at[words_before] * self.width).tolist()
        out = ids.tobytes()
        return [out[x:y] for x, y in zip(cuts, cuts[1:])]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; null texts are empty."""
        out: list[bytes] = []
        for first, data, offsets in words.slices(texts):
            found = self._slice(data, offsets)
            for row in np.flatnonzero(~self._regular(data, offsets)).tolist():
                text = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
                found[row] = self._whole([text])[0].tobytes()
            out += found
        return out


def encoder(path: str, spaces: bool) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return kept(("encoder", path, spaces), lambda: Encoder(path, spaces))


def encoded(path: str, spaces: bool, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    """Parts of a batch with (bytes per id, ids of each ``text``); null texts are empty."""
    found = encoder(path, spaces)
    for at in range(0, batch.num_rows, PART_ROWS):
        part = batch.slice(at, PART_ROWS)
        yield part, found.width, found.encode(part.column("text"))
