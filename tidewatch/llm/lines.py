"""Features of a text's lines for the line-labelling field; numpy, run inside tasks."""

from __future__ import annotations

import unicodedata
from itertools import islice
from operator import eq

import numpy as np

#: Character classes.
LOWER, UPPER, LETTER, DIGIT, SPACE, PLAIN, SHOUT, BAR, SYMBOL = range(9)
CLASSES = 9


def _class_of(code: int) -> int:
    c = chr(code)
    kind = unicodedata.category(c)
    if kind == "Ll":
        return LOWER
    if kind in ("Lu", "Lt"):
        return UPPER
    if kind[0] in "LM":
        return LETTER
    if kind[0] == "N":
        return DIGIT
    if c.isspace() or kind[0] in "ZC":
        return SPACE
    if c == "!":
        return SHOUT
    if c == "|":
        return BAR
    return PLAIN if kind in ("Pd", "Ps", "Pe", "Pi", "Pf") or c in ".,;:'\"?…·¿¡" else SYMBOL


_TABLE = np.array([_class_of(i) for i in range(0x10000)], np.uint8)
#: What a line tells by itself; a field also sees these of the lines before and after.
OWN = ("length", "words", "word_length", "upper", "digit", "plain", "shout", "bar", "symbol", "unlettered", "ends", "echo", "repeated")
ONLY = ("first", "last")
WIDTH = 1 + 3 * len(OWN) + len(ONLY)


def own_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(what every line tells by itself, characters of each line, lines of each text)."""
    parts = [t.split("\n") for t in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    own = np.empty((int(counts.sum()), len(OWN)), np.float32)
    size = np.empty(len(own), np.int64)
    at, held, chars = 0, [], 0
    for p in parts:
        held += p
        chars += sum(map(len, p))
        if chars > 1 << 20:
            own[at : at + len(held)], size[at : at + len(held)] = _own(held)
            at, held, chars = at + len(held), [], 0
    if held:
        own[at:], size[at:] = _own(held)
    k = 0
    for p in parts:
        seen: set[str] = set()
        for line in p:
            own[k, -1] = line in seen
            seen.add(line)
            k += 1
    return own, size, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All features of lines from what each tells by itself; ``counts`` lines belong to each text."""
    first = np.zeros(len(own), bool)
    first[np.cumsum(counts) - counts] = True
    last = np.roll(first, -1)
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    one = np.ones((len(own), 1), np.float32)
    return np.concatenate([one, own, before, after, first[:, None], last[:, None]], 1).astype(np.float32)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, characters of each line, lines of each text); a text without characters is one empty line."""
    own, size, counts = own_features(texts)
    return with_neighbours(own, counts), size, counts


def _own(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(size + 1) - size - 1
    kind = np.where(code < 0x10000, _TABLE[np.minimum(code, 0xFFFF)], LETTER)
    line = np.repeat(np.arange(len(lines)), size + 1)[: len(code)]
    per = np.bincount(line * CLASSES + kind, minlength=len(lines) * CLASSES).reshape(-1, CLASSES).astype(np.float64)
    per[:-1, SPACE] -= 1  # the line ends that join the lines
    space = kind == SPACE
    words = np.bincount(line[~space & np.concatenate(([True], space[:-1]))], minlength=len(lines)) if len(code) else np.zeros(len(lines))
    letters = per[:, LOWER] + per[:, UPPER] + per[:, LETTER]
    solid = np.maximum(per.sum(1) - per[:, SPACE], 1)
    final = np.array([code[s + n - 1] if n else 0 for s, n in zip(starts.tolist(), size.tolist(), strict=True)])
    out = np.stack([
        np.log1p(size) / 5, np.log1p(words) / 4, np.minimum(letters / np.maximum(words, 1), 30) / 10, per[:, UPPER] / np.maximum(letters, 1),
        per[:, DIGIT] / solid, per[:, PLAIN] / solid * 5, per[:, SHOUT] / solid * 5, per[:, BAR] / solid * 5, per[:, SYMBOL] / solid * 5,
        letters == 0, np.isin(final, [0x2E, 0x3F, 0x2026]), [_echo(x.split()) for x in lines], np.zeros(len(lines)),
    ], 1)
    return out, size


def _echo(words: list[str]) -> float:
    """Share of words that repeat the word before, on the scale of the other features."""
    return sum(map(eq, words, islice(words, 1, None))) / max(len(words), 1) * 5
