"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of labelled text accepts every string that
occurs in it. A text is parsed from left to right into the longest phrases that
the automaton knows; the language that needs the fewest phrases, normalised by
text length and by the logarithm of the language's sample, wins.

The walk through an automaton is a table look-up per character. Texts are cut
into lanes of ``LANE`` characters that advance together, so numpy walks thousands
of lanes at once; a phrase ends where its lane ends. Every character of every
text is read. Every letter of the samples has a symbol of its own; an automaton's
table has columns for the symbols of its language only, and one that would be too
large is kept as a sorted list of its transitions.

Learning takes whole documents of each language in the order of a hash until
``sample_chars`` characters, at most ``sample_docs`` of them: a bounded sample,
and the same bound for each language.

Nulls: a null text, or one without any letter, is ``und`` with
score 0. Rows are kept
one for one. Documents of null language teach nothing; when nothing can be
learned, all texts are ``und``. Ties go to the language that sorts first. An
empty table gives an empty result. Extra columns stay only where the caller
keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.worker import give_back, kept

UNDETERMINED = "und"
# Characters of a lane and lanes that walk together.
LANE = 512
LANES = 4096
# Rows that are parsed at a time.
PART_ROWS = 2000
# Places of a table beyond which only its transitions are kept.
DENSE = 1 << 23


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a document is kept out of learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder


# ------------------------------------------------------------ learning


def labelled_sample(docs: DataFrame, sample_chars: int, sample_docs: int) -> dict[str, str]:
    """Up to so many characters of text of each language, from whole documents.

    The documents are chosen by the smallest hashes, before their texts are fetched.
    """
    labelled = docs.where("lang is not null and doc_id is not null")
    spread = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    # The smallest hashes of many parts of a language hold the smallest of all.
    low = spread.withColumn("part", F.pmod("h", F.lit(4 * sample_docs)))
    low = low.groupBy("lang", "part").agg(F.min(F.struct("h", "doc_id")).alias("low"))
    rows = low.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list("low")), 1, sample_docs).alias("low"))
    chosen = {r["lang"]: [x["doc_id"] for x in r["low"]] for r in rows.collect()}
    wanted = [(lang, at, doc_id) for lang, ids in chosen.items() for at, doc_id in enumerate(ids)]
    if not wanted:
        return {}
    wanted = docs.sparkSession.createDataFrame(wanted, "want string, at int, doc_id long")
    found = docs.join(F.broadcast(wanted), "doc_id").where("want = lang")
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in found.select("lang", "at", F.left("text", F.lit(sample_chars)).alias("text")).collect():
        texts.setdefault(r["lang"], []).append((r["at"], r["text"]))
    return {lang: "\n".join(t for _, t in sorted(rows))[:sample_chars] for lang, rows in sorted(texts.items())}


def alphabet(samples: dict[str, str]) -> dict[str, int]:
    """Symbol of each letter of the samples: 0 is what no sample has, 1 everything between words."""
    letters = sorted({letter for text in samples.values() for letter in text.lower() if letter.isalpha()})
    return {letter: at + 2 for at, letter in enumerate(letters)}


def symbol_table(letters: dict[str, int]) -> np.ndarray:
    """Symbol of every code point."""
    table = np.ones(0x110000, dtype=np.int32)
    # The code points as one string, without a Python object for each on the way.
    at = np.arange(0x110000, dtype=np.uint32)
    at = at[(at < 0xD800) | (at >= 0xE000)]
    points = at.tobytes().decode("utf-32-le")
    is_letter = np.fromiter((c.isalpha() for c in points), bool, len(points))
    table[at[is_letter]] = 0
    for letter, symbol in letters.items():
        table[ord(letter)] = symbol
        upper = letter.upper()
        if len(upper) == 1:
            table[ord(upper)] = symbol
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """A text in symbols; a run of anything but letters is one separator."""
    out = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    repeated = (out[1:] == 1) & (out[:-1] == 1)
    return np.concatenate([out[:1], out[1:][~repeated]]) if len(out) else out


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in text:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in following[state]:
            following[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = following[state][symbol]
            if length[state] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and following[state].get(symbol) == target:
                    following[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return following


class Walk:
    """State and column to twice the next state, plus one where a phrase ends before the symbol.

    Column 0 stands for all symbols that the text has not: each is a phrase of its own.
    """

    def __init__(self, text: np.ndarray):
        following = suffix_automaton(text.tolist())
        known = np.unique(text)
        self.width = len(known) + 1
        # Column of each symbol up to one behind the largest.
        self.column = np.zeros(int(known[-1]) + 2 if len(known) else 1, dtype=np.int32)
        self.column[known] = np.arange(1, self.width)
        unknown = len(following)  # the state behind a symbol that the start does not know
        self.begin = np.full(self.width, 2 * unknown, dtype=np.int32)
        keys = np.array([s * self.width + self.column[c] for s, steps in enumerate(following) for c in steps], np.int64)
        targets = np.array([2 * t for steps in following for t in steps.values()], np.int32)
        self.begin[keys[keys < self.width]] = targets[keys < self.width]
        if (unknown + 1) * self.width <= DENSE:
            table = np.tile(self.begin | 1, unknown + 1)
            table[keys] = targets
            table[: self.width] = self.begin
            self.table = table
        else:
            order = np.argsort(keys)
            self.table, self.keys, self.targets = None, keys[order], targets[order]

    def columns(self, lanes: np.ndarray) -> np.ndarray:
        return self.column[np.minimum(lanes, len(self.column) - 1)]

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[state * self.width + column]
        key = state.astype(np.int64) * self.width + column
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], self.begin[column] | (state > 0))


def walk_table(text: np.ndarray) -> Walk:
    """The walk through the automaton of a text in symbols."""
    return Walk(text)


# ------------------------------------------------------------ parsing


def phrase_counts(lanes: np.ndarray, lengths: np.ndarray, walk: Walk) -> np.ndarray:
    """Phrases of each lane; lanes are rows in descending length."""
    columns = walk.columns(np.ascontiguousarray(lanes.T))
    state = np.zeros(len(lanes), dtype=np.int32)
    ends = np.zeros(len(lanes), dtype=np.int32)
    active = np.searchsorted(-lengths, -np.arange(1, columns.shape[0] + 1), side="right")
    for at, n in enumerate(active.tolist()):
        if not n:
            break
        step = walk.step(state[:n], columns[at, :n])
        ends[:n] += step & 1
        state[:n] = step >> 1
    return ends + (lengths > 0)


class Parser:
    """Walks texts through the automata of all languages."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = alphabet(samples)
        self.table = symbol_table(letters)
        coded = [symbols(samples[lang], self.table) for lang in self.languages]
        self.walks = [walk_table(text) for text in coded]
        self.scale = np.array([np.log2(len(text) + 2) for text in coded])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text per language."""
        counts = [-(-len(text) // LANE) for text in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        lengths = np.concatenate(
            [np.minimum(LANE, len(t) - LANE * np.arange(n)) for t, n in zip(texts, counts)] or [np.zeros(0, int)]
        ).astype(np.int64)
        lanes = np.zeros((len(owner), LANE), dtype=np.int32)
        row = 0
        for text, n in zip(texts, counts):
            lanes[row : row + n].reshape(-1)[: len(text)] = text
            row += n
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(texts), len(self.walks)), dtype=np.int64)
        for at, walk in enumerate(self.walks):
            found = phrase_counts(lanes[order], lengths[order], walk)
            out[:, at] = np.bincount(owner[order], weights=found, minlength=len(texts))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """(language, score, bits per character) of each text."""
        langs = [UNDETERMINED] * len(texts)
        scores, bits = [0.0] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return langs, scores, bits
        coded, size, first = [], 0, 0
        for at, text in enumerate([*texts, None]):
            if text is None or (coded and size + len(text) > LANE * LANES):
                self._decide(first, coded, langs, scores, bits)
                coded, size, first = [], 0, at
            if text is not None:
                coded.append(symbols(text, self.table))
                size += len(text)
        return langs, scores, bits

    def _decide(self, first: int, coded: list[np.ndarray], langs: list, scores: list, bits: list) -> None:
        entropy = self.phrases(coded) * self.scale
        for at, text in enumerate(coded):
            if not (text != 1).any():  # no letter; letters that no sample has are a phrase each, in any language
                continue
            rates = entropy[at] / len(text)
            best = int(np.argmin(rates))
            others = np.delete(rates, best)
            langs[first + at] = self.languages[best]
            bits[first + at] = float(rates[best])
            scores[first + at] = float(1 - rates[best] / others.min()) if len(others) else 1.0


def _predictions(samples: dict[str, str], keep: list[str], names: list[str], batches: Iterator[pa.RecordBatch]):
    parser = kept(("parser", tuple(samples.items())), lambda: Parser(samples))
    for whole in batches:
        for at in range(0, whole.num_rows, PART_ROWS):
            batch = whole.slice(at, PART_ROWS)
            found = parser.predict(batch.column("text").fill_null("").to_pylist())
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(c, kind) for c, kind in zip(found, (pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *names])
        give_back()


def learn(
    docs: DataFrame,
    modulus: int = 4,
    remainder: int = 2,
    sample_chars: int = 20_000,
    sample_docs: int = 64,
) -> dict[str, str]:
    """Labelled text per language, from documents (doc_id, text, lang) that are not held out."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    rows = rows.where("text <> ''").where(~held_out(F.col("doc_id"), modulus, remainder))
    return labelled_sample(rows, sample_chars, sample_docs)


RESULT = ("lang_pred", "score", "bits_per_char")


def identify(
    docs: DataFrame, samples: dict[str, str], keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str, str] = RESULT
) -> DataFrame:
    """Kept columns and the prediction, score and entropy under ``names``, per row of ``docs``; reads ``text``."""
    kept_fields = [docs.schema[c] for c in keep]
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_fields)
    schema += "".join(f", {name} {kind}" for name, kind in zip(names, ("string", "double", "double")))
    return rows.mapInArrow(partial(_predictions, samples, list(keep), list(names)), schema)
