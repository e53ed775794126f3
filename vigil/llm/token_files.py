"""Token ids in files of patched frame-of-reference blocks, written in ascending order of the document ids.

A table of token files is parquet written by Spark, one row per segment of whole documents, so lost executors and repeated tasks
are the writer's business. Columns: part and segment (order of the segments), first (ids before it in its part), n_ids,
doc_ids, lengths (ids of each document) and payload. A payload, all numbers little-endian:

  header   4 bytes VTOK, u8 version, u8 bytes of an exception's high part, u16 ids in a block, u64 number of ids
  index    for each block: u32 start of its packed bits, u32 minimum, u32 exceptions before it, u8 width
           (four arrays, one after the other; the exceptions have one entry more, their total)
  bits     for each block its ids minus the minimum, the lowest ``width`` bits of each
  patches  for each exception: u8 place in its block (array), then what is above ``width`` bits (array)

The width of a block is what ``share`` of its ids need; the others are its exceptions.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.words import row_groups

VOCABULARY = "word_bpe_49k.json"
END = 2              # id behind each document
BLOCK = 256          # ids of a block; a place in it is one byte
SHARE = 0.9          # of a block's ids fit its width
SEGMENT = 1 << 18    # ids of a segment, but for whole documents
GROUP = 4 << 20       # bytes of text that are encoded at once
KNOWN_WORDS, KNOWN_BYTES = 1 << 19, 1 << 25  # what a worker remembers of words at most, between row groups
HELD = "_vigil_encoder"

HEADER = "<4sBBHQ"
MAGIC, VERSION = b"VTOK", 1
_LETTER, _SIGN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF", r"!-&(-/:;=?@\[-`{}~"
LATIN = f"^[{_LETTER}]+$"
CUT = re.compile(f"(?<=[{_LETTER}0-9])(?=[{_SIGN}])|(?<=[{_SIGN}])(?=[{_LETTER}0-9])")
SCHEMA = "part int, segment int, first long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1]


def packed(ids: np.ndarray, share: float = SHARE) -> bytes:
    """The payload of an array of ids below 2^32."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    grid = np.empty(blocks * BLOCK, dtype=np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1] if n else 0
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(axis=1) if blocks else np.zeros(0, dtype=np.uint32)
    rest = grid - least[:, None]
    place = max(int(np.ceil(share * BLOCK)) - 1, 0)
    widths = bit_lengths(np.partition(rest, place, axis=1)[:, place]) if blocks else np.zeros(0, dtype=np.int64)
    high = (rest.astype(np.uint64) >> widths.astype(np.uint64)[:, None]).astype(np.uint32)
    patched, places = np.nonzero(high)
    above = high[patched, places]
    high_bytes = next(b for b in (1, 2, 4) if not len(above) or int(above.max()) < 1 << (8 * b))
    sizes = widths * (BLOCK // 8)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    bits = np.zeros(starts[-1], dtype=np.uint8)
    for width in np.unique(widths[widths > 0]):
        of_width = np.flatnonzero(widths == width)
        for k in range(0, len(of_width), 4096):
            rows = of_width[k:k + 4096]
            single = np.unpackbits(rest[rows].astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2, bitorder="little")
            together = np.packbits(single[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")
            bits[starts[rows][:, None] + np.arange(together.shape[1])] = together
    before = np.concatenate([[0], np.cumsum(np.bincount(patched, minlength=blocks))])
    return b"".join([
        struct.pack(HEADER, MAGIC, VERSION, high_bytes, BLOCK, n), starts[:-1].astype("<u4").tobytes(), least.astype("<u4").tobytes(),
        before.astype("<u4").tobytes(), widths.astype(np.uint8).tobytes(), bits.tobytes(),
        places.astype(np.uint8).tobytes(), above.astype(f"<u{high_bytes}").tobytes()])


def unpacked(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids first to last (exclusive) of a payload; only the blocks that hold them are read."""
    magic, version, high_bytes, block, n = struct.unpack_from(HEADER, payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a payload of token ids of a known version")
    last = n if last is None else min(last, n)
    first = min(max(first, 0), last)
    blocks = -(-n // block)
    at, index = struct.calcsize(HEADER), []
    for kind, entries in (("<u4", blocks), ("<u4", blocks), ("<u4", blocks + 1), ("u1", blocks)):
        index.append(np.frombuffer(payload, dtype=kind, count=entries, offset=at))
        at += index[-1].nbytes
    starts, least, before, widths = index
    total = int(before[-1])
    patches = len(payload) - total * (1 + high_bytes)
    low, high = first // block, -(-last // block)
    out = np.zeros((max(high - low, 0), block), dtype=np.uint32)
    for width in np.unique(widths[low:high]):
        of_width = np.flatnonzero(widths[low:high] == width)
        for k in range(0, len(of_width) if width else 0, 4096):
            rows = of_width[k:k + 4096]
            where = at + starts[low:high][rows].astype(np.int64)[:, None] + np.arange(int(width) * block // 8)
            single = np.unpackbits(np.frombuffer(payload, dtype=np.uint8)[where], axis=1, bitorder="little")
            wide = np.zeros((len(rows), block, 32), dtype=np.uint8)
            wide[:, :, :width] = single.reshape(len(rows), block, int(width))
            out[rows] = np.packbits(wide, axis=2, bitorder="little").view("<u4")[:, :, 0]
    a, b = (int(before[low]), int(before[high])) if high > low else (0, 0)
    owner = np.repeat(np.arange(max(high - low, 0)), np.diff(before[low:high + 1].astype(np.int64)) if high > low else 0)
    places = np.frombuffer(payload, dtype=np.uint8, count=b - a, offset=patches + a)
    above = np.frombuffer(payload, dtype=f"<u{high_bytes}", count=b - a, offset=patches + total + a * high_bytes)
    out[owner, places] |= above.astype(np.uint32) << widths[low:high][owner].astype(np.uint32)
    out += least[low:high][:, None]
    return out.reshape(-1)[first - low * block:last - low * block]


def _flat(lists: list[list[int]]):
    """(values, values by list) of lists of ids."""
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(counts.sum())), counts


def _plain(array) -> list:
    """The values of an Arrow array as Python's; much faster than by its scalars."""
    return array.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of texts by the tokenizers library, which is asked for each different part of a word once.

    The tokenizer cuts at white space and between letters and signs, and composes no character over such a cut. So the ids of
    a text are those of its runs without ASCII white space, and of these of their parts; what may hold a special token stays
    whole. A part of Latin letters in lower case is one word to the library's model, without any further preparation.
    """

    def __init__(self, vocabulary: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._forget()

    def _forget(self):
        self.numbers: dict[str, int] = {}
        self.ids, self.cuts, self.bytes = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64), 0

    def _asked(self, parts) -> list[list[int]]:
        """Ids of an Arrow array of different parts."""
        import pyarrow.compute as pc
        tokenize, shown = self.model.tokenize, self.shown
        plain = _plain(pc.match_substring_regex(parts, LATIN))
        found: list = [[t.id for t in tokenize(p if p.isascii() else p.translate(shown))] if simple else None
                       for p, simple in zip(_plain(pc.utf8_lower(parts)), plain, strict=True)]
        rest = [k for k, simple in enumerate(plain) if not simple]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast(_plain(parts.take(rest)) if rest else [], add_special_tokens=False), strict=True):
            found[k] = e.ids
        return found

    def _learn(self, words: list[str]) -> None:
        """Makes words known: from the library by parts, then as a row of their parts."""
        import pyarrow as pa
        import pyarrow.compute as pc
        new = [w for w in words if w not in self.numbers]
        special = [w for w in new if "<|" in w]
        if special:
            new = [w for w in new if "<|" not in w]
            self._add(special, *_flat([e.ids for e in self.tokenizer.encode_batch_fast(special, add_special_tokens=False)]))
        if not new:
            return
        lists = pc.split_pattern(pa.array(CUT.sub("\n", " ".join(new)).split(" "), pa.large_string()), "\n")  # no word has white space
        parts = lists.flatten().dictionary_encode()
        different = _plain(parts.dictionary)
        unknown = [k for k, p in enumerate(different) if p not in self.numbers]
        if unknown:
            self._add([different[k] for k in unknown], *_flat(self._asked(parts.dictionary.take(unknown))))
        offsets = lists.offsets.to_numpy()
        numbers = self._numbers_of(different)[parts.indices.to_numpy()]
        joined = np.diff(offsets) > 1
        ids, counts = self._ids_of(numbers[np.repeat(joined, np.diff(offsets))])
        if joined.any():
            starts = np.cumsum([0, *np.diff(offsets)[joined]])[:-1]
            self._add([new[k] for k in np.flatnonzero(joined)], ids, np.add.reduceat(counts, starts))

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.numbers.update(zip(words, range(len(self.numbers), len(self.numbers) + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(counts)])
        self.bytes += sum(map(len, words))

    def _numbers_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))

    def _ids_of(self, numbers: np.ndarray):
        """(ids, ids by word) of known words."""
        starts, counts = self.cuts[numbers], np.diff(self.cuts)[numbers]
        ends = np.cumsum(counts)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)], counts

    def encoded(self, texts, end: int):
        """(ids, ids by text) of an Arrow string array, each text with ``end`` behind it; null is empty."""
        import pyarrow as pa
        import pyarrow.compute as pc
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        words = lists.flatten().dictionary_encode()
        different = _plain(words.dictionary)
        if len(self.numbers) > KNOWN_WORDS or self.bytes > KNOWN_BYTES:
            self._forget()
        self._learn(different)
        ids, counts = self._ids_of(self._numbers_of(different)[words.indices.to_numpy()] if len(words) else np.zeros(0, dtype=np.int64))
        offsets = lists.offsets.to_numpy()
        ends = np.concatenate([[0], np.cumsum(counts)])[offsets - offsets[0]]
        return np.insert(ids, ends[1:], np.uint32(end)), np.diff(ends) + 1


def _taken(vocabulary: str) -> tuple[bytes, Encoder]:
    """The encoder that an earlier task of this worker process handed on, with the words it knows, or a new one."""
    import tokenizers  # a module of the worker itself: this one travels with each task anew
    key = hashlib.sha256(vocabulary.encode()).digest()
    held = tokenizers.__dict__.pop(HELD, None)
    return key, held[1] if held and held[0] == key else Encoder(vocabulary)


def _handed_on(key: bytes, encoder: Encoder) -> None:
    """For tasks that came to their end: one that broke off may have left its encoder half changed."""
    import tokenizers
    setattr(tokenizers, HELD, (key, encoder))


def _segments(vocabulary: str, end: int, share: float, size: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        part, number, before = TaskContext.get().partitionId(), 0, 0
        key, encoder = _taken(vocabulary)
        for batch in batches:
            for a, b in row_groups(batch.column("text"), GROUP):
                rows = batch.slice(a, b - a)
                ids, lengths = encoder.encoded(rows.column("text"), end)
                ends = np.cumsum(lengths)
                first = 0
                while first < len(lengths):
                    start = int(ends[first] - lengths[first])
                    last = max(first + 1, int(np.searchsorted(ends, start + size, side="right")))
                    mine = ids[start:int(ends[last - 1])]
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([part], pa.int32()), "segment": pa.array([number], pa.int32()),
                        "first": pa.array([before], pa.int64()), "n_ids": pa.array([len(mine)], pa.int64()),
                        "doc_ids": pa.array([rows.column("doc_id").slice(first, last - first)], pa.list_(pa.int64())),
                        "lengths": pa.array([lengths[first:last]], pa.list_(pa.int64())),
                        "payload": pa.array([packed(mine, share)], pa.binary())})
                    before, number, first = before + len(mine), number + 1, last
        _handed_on(key, encoder)
    return run


def vocabulary_text(path: str | None = None) -> str:
    """The tokenizer's file as text, read once on the driver and sent with the tasks."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as lines:
        return lines.read()


def write_token_files(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                      end: int = END, share: float = SHARE, size: int = SEGMENT) -> None:
    """Writes the ids of every whole text to a table of token files at ``path``, in ascending order of the document ids.

    ``vocabulary`` is the path of a tokenizers file whose tokenizer cuts at white space. Each document ends with the id
    ``end``. Null, empty and blank texts are that id alone. Null ids come first; rows of one id keep some order, the same in
    index and payload; repeated rows stay. Other columns are not looked at. An empty table gives a table without segments.

    Texts are dealt into ranges of ids once (a row number splits an id that many rows carry) and encoded where they then are.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    ordered.mapInArrow(_segments(vocabulary_text(vocabulary), end, share, size), SCHEMA).write.parquet(path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The segments at ``path`` with the column start: ids before each in all parts."""
    files = spark.read.schema(SCHEMA).parquet(path)
    # One row for each task of the writing job.
    parts = files.groupBy("part").agg(F.max(F.expr("first + n_ids")).alias("n")).selectExpr(
        "part", "coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS ahead")
    return files.join(F.broadcast(parts), "part").selectExpr(
        "first + ahead AS start", "n_ids", "doc_ids", "lengths", "payload")


def _documents(digest: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for k in range(len(batch)):
                ids = unpacked(batch.column("payload")[k].as_py()).astype("<u4")
                lengths = batch.column("lengths")[k].values.to_numpy()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                if digest:
                    shown = pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64())
                else:
                    shown = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, pa.array(starts + batch.column("start")[k].as_py()), pa.array(lengths), shown],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
    return run


def documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in ``files``."""
    return files.mapInArrow(_documents(False), "doc_id long, start long, n_tokens long, ids array<int>")


def digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in ``files``; the checksum is over the ids as little-endian u32."""
    return files.mapInArrow(_documents(True), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _between(low: int, high: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for k in range(len(batch)):
                start = batch.column("start")[k].as_py()
                ids = unpacked(batch.column("payload")[k].as_py(), low - start, high - start).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ids)) + max(start, low)), pa.array(ids)], names=["position", "id"])
    return run


def ids_between(files: DataFrame, low: int, high: int) -> DataFrame:
    """(position, id) of the ids at positions low to high (exclusive) of all ids; only segments and blocks that hold them are unpacked."""
    return files.where(f"start < {high} AND start + n_ids > {low}").mapInArrow(_between(low, high), "position long, id int")
