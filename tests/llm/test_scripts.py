"""Language ID of many scripts."""

import numpy as np
import pytest

from eventlake.llm import language_id

RANGES = {
    "ar": range(0x627, 0x64B),
    "de": range(ord("a"), ord("z") + 1),
    "el": range(0x3B1, 0x3CA),
    "hi": range(0x904, 0x93A),
    "hy": range(0x561, 0x587),
    "ja": range(0x3041, 0x3097),
    "ka": range(0x10D0, 0x10F1),
    "ru": range(0x430, 0x450),
    "zh": range(0x4E00, 0x5400),
}


def prose(lang, words, seed):
    rng = np.random.default_rng(seed)
    letters = [chr(p) for p in RANGES[lang]]
    return " ".join("".join(rng.choice(letters, rng.integers(1, 8))) for _ in range(words))


@pytest.mark.parametrize("dense", [1 << 23, 1000])
def test_no_script_is_lost(monkeypatch, dense):
    monkeypatch.setattr(language_id, "DENSE", dense)
    # Rarer scripts have shorter samples; the shortest is no one's default.
    samples = {lang: prose(lang, 900 - 80 * at, at) for at, lang in enumerate(RANGES)}
    parser = language_id.Parser(samples)
    texts = [prose(lang, 40, 100 + at) for at, lang in enumerate(RANGES)]
    langs, scores, _ = parser.predict([*texts, *map(str.upper, texts), "\u0e01\u0e02\u0e03", "12 - 3"])
    # Letters that no sample has: some learned language; no letter at all: none.
    assert langs[:-2] == [*RANGES, *RANGES] and langs[-2] in RANGES and langs[-1] == "und"
    assert all(s > 0 for s in scores[:-2]) and 0 <= scores[-2] <= 1 and scores[-1] == 0
    assert all(len(set(language_id.symbols(t, parser.table).tolist())) == len(set(t)) for t in samples.values())


def test_listed_transitions_walk_as_the_table(monkeypatch):
    rng = np.random.default_rng(5)
    sample = rng.integers(1, 300, 2000)
    dense = language_id.walk_table(sample)
    monkeypatch.setattr(language_id, "DENSE", 0)
    sparse = language_id.walk_table(sample)
    assert dense.table is not None and sparse.table is None
    lanes = np.concatenate([rng.integers(0, 310, (20, 512)), sample[:512][None]])
    lengths = np.full(21, 512)
    found = [language_id.phrase_counts(lanes, lengths, w).tolist() for w in (dense, sparse)]
    assert found[0] == found[1] and found[0][-1] == 1


def test_texts_of_unlearned_scripts_get_a_learned_language():
    parser = language_id.Parser({"en": prose("de", 300, 1), "fr": prose("de", 200, 2)})
    langs, scores, _ = parser.predict(["\u041f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440", "\u4f60\u597d\u4e16\u754c", "", "7 !", None or ""])
    assert set(langs[:2]) <= {"en", "fr"} and langs[2:] == ["und"] * 3
    assert all(0 <= s <= 1 for s in scores)
