"""Text measures that look at every character, as Arrow functions over batches of texts.

White space, word characters and letters are ASCII here, as in the patterns of ``fixed_values``; a bytewise search finds them
in UTF-8 just as well. Texts are taken in slices of a megabyte, so what a task holds does not depend on the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = 1 << 20  # bytes of text looked at in one go
SPACE = r"[ \t\n\x0B\f\r]"  # what \s stands for in Java; RE2 has no vertical tab there
BLANK_LINES = rf"\n{SPACE}*\n{SPACE}*\n"
# of the letters that are no ASCII ones, these two have ASCII ones in lower case
LOWERED = (("\u0130", "i\u0307"), ("\u212a", "k"))
LINE_ENDS = tuple(c.encode() for c in "\n\r\u0085\u2028\u2029")  # a dot matches none of them
LEADS = ((0x00, 0x80), (0xC0, 0xE0), (0xE0, 0xF0), (0xF0, 0x100))  # first bytes of characters of 1 to 4 bytes


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins (and the last one ends)."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _slices(texts: pa.Array):
    if len(texts) == 0:
        yield texts
        return
    ends, begin = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + SLICE, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def _sliced(measure, texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([measure(part) for part in _slices(texts)])


def _struct(**columns) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns.values()], names=list(columns))


def _starts(data: np.ndarray, offsets: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of bytes that are not ``between`` begin, and how many begin in each text."""
    begins = ~between
    begins[1:] &= between[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = ~between[first]
    at = np.flatnonzero(begins)
    return at, np.diff(np.searchsorted(at, offsets))


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text the mask holds for."""
    counts, some = np.zeros(len(offsets) - 1, np.int64), np.flatnonzero(np.diff(offsets))
    if len(some):
        counts[some] = np.add.reduceat(mask.view(np.uint8), offsets[some], dtype=np.int64)
    return counts


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _words(texts: pa.Array) -> pa.Array:
    """Words of a text: runs of anything but white space."""
    data, offsets = _bytes(texts)
    return pa.array(_starts(data, offsets, _blank(data))[1].astype(np.float64))


def _sentences(texts: pa.Array) -> pa.Array:
    """Sentences of a text, and the squares of their lengths' distances from the mean, added up in order.

    A sentence is what stands between marks and has a word; a mark inside a word cuts it.
    """
    data, offsets = _bytes(texts)
    blank = _blank(data)
    words = _starts(data, offsets, blank)[1].astype(np.float64)
    mark = (data == 46) | (data == 33) | (data == 63) | (data == 124)
    at, _ = _starts(data, offsets, blank | mark)
    # words are counted between marks and ends of texts, which are few beside them
    bounds = np.sort(np.concatenate([_places(mark), offsets]))
    lengths = np.diff(np.searchsorted(at, bounds))
    some = np.flatnonzero(lengths)
    lengths, text = lengths[some].astype(np.float64), np.searchsorted(offsets, bounds[some], "right") - 1
    sentences = np.bincount(text, minlength=len(texts))
    counted = np.where(words == 0, 0.0, np.maximum(sentences, 1.0))
    mean = words / np.maximum(counted, 1.0)
    squares = np.bincount(text, weights=np.square(lengths - mean[text]), minlength=len(texts)).astype(np.float64)
    return _struct(sentences=counted, squares=squares)


def _places(mask: np.ndarray) -> np.ndarray:
    """Where a mask with few hits holds: eight bytes are looked at in one go."""
    wide = np.zeros(-(-len(mask) // 8) * 8, bool)
    wide[:len(mask)] = mask
    eights = np.flatnonzero(wide.view(np.uint64))
    row, column = np.nonzero(wide.reshape(-1, 8)[eights])
    return eights[row] * 8 + column


def _repeats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts in which a character, other than one that ends a line, stands five times in a row."""
    found = np.zeros(len(offsets) - 1, bool)
    wide = len(data) and data.max() >= 0x80
    for size, (low, high) in enumerate(LEADS, 1):
        if len(data) < 5 * size or (size > 1 and not wide):
            continue
        same, run = data[size:] == data[:-size], 1
        while run < 4 * size:  # from here on, so many bytes are the same as those a character further on
            step = min(run, 4 * size - run)
            same, run = same[:-step] & same[step:], run + step
        if not same.any():
            continue
        at = _places(same)
        at = at[(data[at] >= low) & (data[at] < high)]
        for end in LINE_ENDS:
            if len(end) == size:
                at = at[~np.all([data[at + i] == byte for i, byte in enumerate(end)], axis=0)]
        row = np.searchsorted(offsets, at, "right") - 1
        found[row[at + 5 * size <= offsets[row + 1]]] = True
    return found


def _folded(texts: pa.Array) -> pa.Array:
    """The texts with runs of white space made one space, and none at the ends; NULL stays NULL."""
    filled = pc.fill_null(texts, "")
    data, offsets = _bytes(filled)
    blank = _blank(data)
    kept = blank.copy()
    kept[1:] &= ~blank[:-1]
    kept[offsets[:-1][np.diff(offsets) > 0]] = False  # white space at the beginning of a text
    kept |= ~blank
    shown, ends = data[kept], np.concatenate([[0], np.cumsum(_per_text(kept, offsets))])
    shown[_blank(shown)] = 32
    last = ends[1:][np.diff(ends) > 0] - 1
    last = last[shown[last] == 32]
    if len(last):
        shown = np.delete(shown, last)
        ends = ends - np.searchsorted(last, ends)
    out = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(shown)]).cast(pa.string())
    return out if texts.null_count == 0 else pc.if_else(pc.is_valid(texts), out, pa.scalar(None, pa.string()))


def _capitals(texts: pa.Array) -> pa.Array:
    """How many letters A-Z and how many letters a text has."""
    data, offsets = _bytes(texts)
    lower = data | 32
    upper, letters = _per_text((data >= 65) & (data <= 90), offsets), _per_text((lower >= 97) & (lower <= 122), offsets)
    return _struct(upper=upper.astype(np.float64), letters=letters.astype(np.float64))


def _repeated(texts: pa.Array) -> pa.Array:
    return pa.array(_repeats(*_bytes(texts)))


def _record(kind: T.DataType, *names: str) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name in names])


def whole_words(entries: tuple[str, ...]):
    """A column function: whether the text holds any of ``entries`` as whole words, in either case, with any white space between.

    Word characters are ASCII letters, digits and underscore.
    """
    letter = lambda c: f"{SPACE}+" if c == " " else f"[{c}{c.upper()}]"
    any_of = "|".join("".join(letter(c) for c in entry) for entry in entries)
    other = "[^0-9A-Za-z_]"
    pattern = rf"(?:^|[^0-9A-Za-z_])(?:{any_of})(?:$|[^0-9A-Za-z_])"

    def found(texts: pa.Array) -> pa.Array:
        data, _ = _bytes(texts)
        for special, instead in LOWERED:
            if (data == special.encode()[0]).any():
                texts = pc.replace_substring(texts, special, instead)
        return pc.match_substring_regex(texts, pattern)

    @F.arrow_udf(T.BooleanType())
    def flag(texts: pa.Array) -> pa.Array:
        return _sliced(found, texts)
    return flag


@F.arrow_udf(T.StringType())
def folded(texts: pa.Array) -> pa.Array:
    return _sliced(_folded, texts)


@F.arrow_udf(T.DoubleType())
def words(texts: pa.Array) -> pa.Array:
    return _sliced(_words, texts)


@F.arrow_udf(_record(T.DoubleType(), "sentences", "squares"))
def sentences(texts: pa.Array) -> pa.Array:
    return _sliced(_sentences, texts)


@F.arrow_udf(_record(T.DoubleType(), "upper", "letters"))
def capitals(texts: pa.Array) -> pa.Array:
    return _sliced(_capitals, texts)


@F.arrow_udf(T.BooleanType())
def repeats(texts: pa.Array) -> pa.Array:
    return _sliced(_repeated, texts)


@F.arrow_udf(T.BooleanType())
def blank_lines(texts: pa.Array) -> pa.Array:
    return _sliced(lambda part: pc.match_substring_regex(part, BLANK_LINES), texts)
