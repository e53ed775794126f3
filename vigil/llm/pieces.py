"""SentencePiece encoding and decoding: words of equal length advance together through a Viterbi pass in numpy.

The pass keeps, for every prefix of a word, the last piece of the prefix's own
encoding (the backpointer). A piece can follow another one only if the merge
order would not have joined across their border; exactly one candidate of each
prefix meets that, and it is the maximum that is stored. So the ids are those of the
model's merges, found without merging.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.words import mixed, powers, row_groups, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CHUNK = 1 << 20      # characters encoded at once
LONG_WORD = 96       # longer words (rare: no border that pieces respect) are merged one by one
FLAG_BITS = 21
KNOWN_WORDS = 1_000_000  # words whose pieces a task remembers; then it begins anew

SIZE_KEYS = mixed(np.arange(1 << 10, dtype=np.uint64))  # keeps pieces of different lengths apart


def flag_place(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FLAG_BITS)).astype(np.int64)


def merged(word: str, scores: dict[str, float]) -> list[str]:
    """The model's merges, one by one: the best-scored adjacent pair first, the leftmost of equals."""
    n = len(word)
    text, right, left = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i):
        j = right[i]
        if j < n and text[i] + text[j] in scores:
            heapq.heappush(heap, (-scores[text[i] + text[j]], i, text[i], text[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if text[i] != a or j >= n or text[j] != b:
            continue
        text[i], text[j], right[i] = a + b, None, right[j]
        if right[j] < n:
            left[right[j]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    return [t for t in text if t is not None]


def last_merge(piece: str, scores: dict[str, float]) -> tuple[str, str] | None:
    """The two pieces that the merges of ``piece`` join last; None if they do not make it whole."""
    if merged(piece, scores) != [piece]:
        return None
    first, second = merged(piece, _Without(scores, piece))
    return first, second


class _Without:
    """Scores without one piece."""

    def __init__(self, scores, piece):
        self.scores, self.piece = scores, piece

    def __contains__(self, key):
        return key != self.piece and key in self.scores

    def __getitem__(self, key):
        return self.scores[key]


class Model:
    """Tables of a byte-fallback merge model; their size is that of the vocabulary."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, pieces: list[tuple[str, float, str]]):
        """``pieces``: (text, score, kind) by id; kind is normal, byte or other."""
        normal = {p: (i, s) for i, (p, s, kind) in enumerate(pieces) if kind == "normal"}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_ids[int(p[3:5], 16)] = i
        spaces = {len(p) for p in normal if set(p) == {SPACE}}
        atoms = sorted(p for p in normal if len(p) == 1)
        self.scores = {p: s for p, (_, s) in normal.items() if len(p) > 1 and not set(p) == {SPACE}}
        if any(SPACE in p[1:] for p in self.scores) or len(set(self.scores.values())) < len(self.scores):
            raise ValueError("pieces with inner spaces or equal scores are not supported")
        halves = {p: last_merge(p, self.scores) for p in self.scores}
        ranked = atoms + sorted((p for p in self.scores if halves[p]), key=lambda p: -self.scores[p])
        rank = {p: r for r, p in enumerate(ranked)}
        self.texts, self.met = ranked, None
        self.n, self.ids = len(ranked), np.array([normal[p][0] for p in ranked], dtype=np.int32)
        self.left = np.array([rank[halves[p][0]] if len(p) > 1 else r for r, p in enumerate(ranked)], dtype=np.int64)
        self.right = np.array([rank[halves[p][1]] if len(p) > 1 else r for r, p in enumerate(ranked)], dtype=np.int64)
        joined = sorted((rank[p[:k]] * self.n + rank[p[k:]], rank[p]) for p in ranked if len(p) > 1
                        for k in range(1, len(p)) if p[:k] in rank and p[k:] in rank)
        self.pair_keys = np.array([k for k, _ in joined], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in joined], dtype=np.int64)
        self.space_id, self.space = normal[SPACE][0], rank[SPACE]
        self.space_ids = {k: normal[SPACE * k][0] for k in spaces}
        # characters: rank of their piece, -1 without one; a literal space mark is a space
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        for p in atoms:
            self.symbol[ord(p)] = rank[p]
        self.symbol[ord(" ")] = self.space
        self.longest = max(map(len, ranked))
        self.n_atoms = len(atoms)
        crossed = {(rank[a], rank[b]) for p in ranked if len(p) > 1 for a, b in zip(p, p[1:])}
        self.inside = np.zeros((self.n_atoms, self.n_atoms), dtype=bool)
        for a, b in crossed:
            self.inside[a, b] = True
        # hashed pieces: sorted keys, the ranks that go with them, and a flag table that spares most searches
        self.up = powers(self.BASE, LONG_WORD + 2)
        self.down = powers(pow(self.BASE, -1, 1 << 64), LONG_WORD + 2)
        keys = np.array([self.key(np.array([rank[c] for c in p])) for p in ranked], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], order.astype(np.int64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        self.key_flags, self.pair_flags = np.zeros(1 << FLAG_BITS, bool), np.zeros(1 << FLAG_BITS, bool)
        self.key_flags[flag_place(self.keys)] = True
        self.pair_flags[flag_place(self.pair_keys.astype(np.uint64))] = True
        # decoding: bytes by id
        spelled = [bytes([int(p[3:5], 16)]) if kind == "byte" else p.replace(SPACE, " ").encode() if kind == "normal" else b""
                   for p, _, kind in pieces]
        self.spelled = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.spell_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])

    def key(self, symbols):
        return (((symbols.astype(np.uint64) + np.uint64(1)) * self.up[:len(symbols)]).sum(keepdims=True)
                + SIZE_KEYS[len(symbols)])[0]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece ``b`` may follow piece ``a``: undoing the later merge of both again and again, no
        merge across the border comes earlier than the one undone."""
        out = np.zeros(len(a), dtype=bool)
        live, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            key = a * self.n + b
            crossing = self.pair_flags[flag_place(key.view(np.uint64))]
            maybe = np.flatnonzero(crossing)
            at = np.minimum(np.searchsorted(self.pair_keys, key[maybe]), len(self.pair_keys) - 1)
            crossing[maybe] = (self.pair_keys[at] == key[maybe]) & (self.pair_ranks[at] < limit[maybe])
            done = ~crossing & (a < self.n_atoms) & (b < self.n_atoms)
            out[live[done]] = True
            go = ~crossing & ~done
            live, a, b = live[go], a[go], b[go]
            first = a > b
            limit = np.where(first, a, b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible``, remembered for pairs that were met lately: one slot a hash, the latest pair stays."""
        if self.met is None:
            self.met = np.full(1 << FLAG_BITS, -1, dtype=np.int64), np.zeros(1 << FLAG_BITS, dtype=bool)
        pairs, answers = self.met
        key = a * self.n + b
        slot = flag_place(key.view(np.uint64))
        out = answers[slot]
        new = np.flatnonzero(pairs[slot] != key)
        if len(new):
            out[new] = self.compatible(a[new], b[new])
            place = slot[new]
            pairs[place], answers[place] = key[new], out[new]
            lost = pairs[place] != key[new]  # two new pairs of one slot: their answers must not mix
            pairs[place[lost]] = -1
        return out

    def best_pieces(self, words: np.ndarray) -> list[np.ndarray]:
        """Pieces (as ranks) of words of one length: a matrix of symbols, a row a word."""
        n, length = words.shape
        sums = np.zeros((length + 1, n), dtype=np.uint64)
        np.cumsum((words.T.astype(np.uint64) + np.uint64(1)) * self.up[:length, None], axis=0, out=sums[1:])
        last = np.zeros((length + 1, n), dtype=np.int64)
        back = np.zeros((length + 1, n), dtype=np.int64)
        for j in range(1, length + 1):
            open_rows = np.arange(n)  # exactly one piece fits each row; a row that has its own is done
            for size in range(min(j, self.longest), 1, -1):
                i = j - size
                key = (sums[j, open_rows] - sums[i, open_rows]) * self.down[i] + SIZE_KEYS[size]
                maybe = np.flatnonzero(self.key_flags[flag_place(key)])
                if not len(maybe):
                    continue
                key, row = key[maybe], open_rows[maybe]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                row, piece = row[hit], self.key_ranks[at[hit]]
                if i:
                    fits = self.follows(last[i, row], piece)
                    row, piece = row[fits], piece[fits]
                back[j, row], last[j, row] = size, piece
                open_rows = open_rows[back[j, open_rows] == 0]
            back[j, open_rows], last[j, open_rows] = 1, words[open_rows, j - 1]
        out = [[] for _ in range(n)]
        at, rows = np.full(n, length), np.arange(n)
        while len(rows):
            for r, p in zip(rows.tolist(), last[at[rows], rows].tolist(), strict=True):
                out[r].append(p)
            at[rows] -= back[at[rows], rows]
            rows = rows[at[rows] > 0]
        return [np.array(p[::-1]) for p in out]


def space_run(model: Model, n: int) -> list[int]:
    """Ids of a run of spaces alone; their merges have one score, so the leftmost goes first."""
    stack = []
    for _ in range(n):
        stack.append(1)
        while len(stack) > 1 and stack[-2] + stack[-1] in model.space_ids:
            stack[-2:] = [stack[-2] + stack[-1]]
    return [model.space_ids[k] for k in stack]


class Encoder:
    """Encodes texts; remembers the pieces of words it has met."""

    def __init__(self, model: Model, chunk: int | None = None):
        self.model, chunk = model, chunk or CHUNK
        self.powers, self.inverse = powers(model.BASE, chunk), powers(pow(model.BASE, -1, 1 << 64), chunk)
        self.forget()

    def forget(self):
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bare, self.store = np.zeros(0, bool), np.zeros(0, np.int32)
        self.extra: dict = {}

    def _remember(self, keys, pieces):
        """Adds words: ids of their pieces, without a leading lone space, which is noted in ``bare``."""
        model = self.model
        bare = np.array([p[0] == model.space for p in pieces])
        ids = [model.ids[p[1:] if b else p] for p, b in zip(pieces, bare, strict=True)]
        sizes = np.array([len(i) for i in ids])
        starts = len(self.store) + np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.store = np.concatenate([self.store, *ids])
        order = np.argsort(joined := np.concatenate([self.keys, keys]))
        self.keys = joined[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.bare = np.concatenate([self.bare, bare])[order]

    def _other(self, key, make):
        """Place and size in the store of the ids of a run of spaces or a character without a piece."""
        if key not in self.extra:
            ids = np.array(make(), dtype=np.int32)
            self.extra[key] = len(self.store), len(ids)
            self.store = np.concatenate([self.store, ids])
        return self.extra[key]

    def _learn(self, symbols, starts, lengths, keys):
        """Pieces of the words at ``starts`` that are not known yet."""
        first = np.unique(keys, return_index=True)[1]
        at = np.minimum(np.searchsorted(self.keys, keys[first]), max(len(self.keys) - 1, 0))
        new = first[self.keys[at] != keys[first]] if len(self.keys) else first
        all_keys, all_pieces = [], []
        for length in np.unique(lengths[new]).tolist():
            rows = new[lengths[new] == length]
            if length > LONG_WORD:
                pieces = [self._merged(symbols[starts[r]:starts[r] + length]) for r in rows]
            else:
                pieces = self.model.best_pieces(symbols[starts[rows][:, None] + np.arange(length)])
            all_keys.append(keys[rows])
            all_pieces += pieces
        if all_keys:
            self._remember(np.concatenate(all_keys), all_pieces)

    def _merged(self, symbols):
        texts = self.model.texts
        rank = {p: r for r, p in enumerate(texts)}
        return np.array([rank[p] for p in merged("".join(texts[s] for s in symbols.tolist()), self.model.scores)])

    def encode(self, chars: np.ndarray, cuts: np.ndarray):
        """(ids, offsets by text) of code points; each text begins with its added space."""
        model = self.model
        if len(chars) == 0:
            return np.zeros(0, np.int32), np.zeros(len(cuts), np.int64)
        if len(self.keys) > KNOWN_WORDS:
            self.forget()
        symbols = model.symbol[chars]
        known, space = symbols >= 0, symbols == model.space
        begin = np.zeros(len(symbols), dtype=bool)
        begin[cuts[:-1][cuts[:-1] < len(symbols)]] = True
        begin[1:] |= (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1]
        both = np.flatnonzero(~begin[1:] & ~space[1:]) + 1
        begin[both[~model.inside[symbols[both - 1], symbols[both]]]] = True
        # a space that no piece joins to what follows is cut off as a unit of its own by the line above
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(symbols))
        spaced = np.concatenate([[0], np.cumsum(space)])
        lead = spaced[ends] - spaced[starts]
        body = (ends - starts) - lead
        unknown = ~known[starts]
        word = (body > 0) & ~unknown
        first = starts + np.maximum(lead - 1, 0)  # one space belongs to the word
        size = np.where(lead > 0, body + 1, body)
        w = np.flatnonzero(word)
        del spaced
        sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        up, down = (self.powers, self.inverse) if len(symbols) < len(self.powers) else (
            powers(model.BASE, len(symbols) + 1), powers(pow(model.BASE, -1, 1 << 64), len(symbols) + 1))
        np.cumsum((symbols.astype(np.uint64) + np.uint64(2)) * up[:len(symbols)], out=sums[1:])
        keys = mixed((sums[first[w] + size[w]] - sums[first[w]]) * down[first[w]] + size[w].astype(np.uint64))
        del sums
        self._learn(symbols, first[w], size[w], keys)
        at = np.searchsorted(self.keys, keys)
        run = lead.copy()
        run[w] = np.where(lead[w] > 0, lead[w] - 1 + self.bare[at], 0)
        # two segments a unit: its run of spaces, then its word or the bytes of its character
        place, count = np.zeros((len(starts), 2), np.int64), np.zeros((len(starts), 2), np.int64)
        for n in np.unique(run[run > 0]).tolist():
            place[run == n, 0], count[run == n, 0] = self._other(n, lambda n=n: space_run(model, n))
        place[w, 1], count[w, 1] = self.starts[at], self.sizes[at]
        u = np.flatnonzero(unknown)
        points = chars[starts[u]]
        for c in np.unique(points).tolist():
            rows = u[points == c]
            place[rows, 1], count[rows, 1] = self._other(-1 - c, lambda c=c: model.byte_ids[list(chr(c).encode())])
        place, count = place.reshape(-1), count.reshape(-1)
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.store[np.repeat(place - total[:-1], count) + np.arange(total[-1])]
        return ids, total[2 * np.searchsorted(starts, cuts)]


def spaced_points(texts):
    """(code points, offsets by text) of an Arrow string array; a space stands before each text that is not empty."""
    data, cuts = text_bytes(texts)
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[cuts]
    full = np.flatnonzero(np.diff(begins) > 0)
    points = np.insert(chars, begins[full], ord(" "))
    return points, begins + np.concatenate([[0], np.cumsum(np.diff(begins) > 0)])


def decoded(model: Model, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of ids: bytes of all pieces; the added space goes, broken characters are replaced."""
    size = model.spell_at[ids + 1] - model.spell_at[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    raw = model.spelled[np.repeat(model.spell_at[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
    return [raw[a:b].removeprefix(b" ").decode("utf-8", "replace")
            for a, b in zip(total[offsets[:-1]].tolist(), total[offsets[1:]].tolist(), strict=True)]


def load(path: str = MODEL) -> Model:
    """Reads a public model file on the driver; what the tasks get has the size of its vocabulary."""
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i):
        return "byte" if p.is_byte(i) else "other" if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else "normal"
    return Model([(p.id_to_piece(i), p.get_score(i), kind(i)) for i in range(p.get_piece_size())])


def _stretches(text: str, chunk: int | None = None):
    """Pieces of a long text with the offsets of nothing that a piece could join: cut before a blank or a line break."""
    at, chunk = 0, chunk or CHUNK
    while at < len(text):
        end = at + chunk
        while end < len(text) and not (text[end] == "\n" or text[end] == " " != text[end - 1]):
            end += 1
        yield text[at:end]
        at = end


def _encode(model: Model, chunk: int | None = None):
    chunk = chunk or CHUNK

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        encoder = Encoder(model, chunk)
        for batch in batches:
            for first, last in row_groups(batch.column("text"), chunk):
                part = batch.slice(first, last - first)
                if last - first == 1 and len(text := part.column("text")[0].as_py() or "") > chunk:
                    found = []
                    for k, stretch in enumerate(_stretches(text, chunk)):
                        points = np.frombuffer(((" " if k == 0 else "") + stretch).encode("utf-32-le"), dtype=np.uint32)
                        found.append(encoder.encode(points.astype(np.int64), np.array([0, len(points)]))[0])
                    ids = np.concatenate(found)
                    offsets = np.array([0, len(ids)])
                else:
                    ids, offsets = encoder.encode(*spaced_points(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names if c != "text"),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                    names=[*(c for c in part.schema.names if c != "text"), "ids"])
    return run


def encoded(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", path: str = MODEL,
            chunk: int | None = None) -> DataFrame:
    """The columns ``keep`` and ids: the model's piece ids of the whole text; one row per input row.

    Null and empty texts have no ids. A space stands before each other text, runs
    of spaces are kept, and characters without a piece are spelled in byte pieces, so decoding gives the
    text back (a literal space mark U+2581 as a space). Repeated rows are rows of
    their own; other columns are not looked at; an empty table gives an empty result. About ``chunk`` characters (CHUNK) are encoded
    at once; fewer take less memory and more time.
    """
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_encode(load(path), chunk), f"{schema}, ids array<int>")


def _lists(column):
    import pyarrow.compute as pc
    column = pc.fill_null(column, [])
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))])
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int32), offsets.astype(np.int64)


def _decode(model: Model, digest: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            ids, offsets = _lists(batch.column("ids"))
            # a few rows at a time, so that the bytes of a batch are not all held at once
            step, texts, digests = 64, [], []
            for a in range(0, len(batch), step):
                cuts = offsets[a:a + step + 1]
                part = ids[cuts[0]:cuts[-1]]
                made = decoded(model, part, cuts - cuts[0])
                if digest:
                    digests += [hashlib.sha256(part[i - cuts[0]:j - cuts[0]].astype("<i4").tobytes()).hexdigest()
                                for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                    texts += [(len(t), hashlib.sha256(t.encode()).hexdigest()) for t in made]
                else:
                    texts += made
            columns, names = [batch.column("doc_id")], ["doc_id"]
            if digest:
                columns += [pa.array(np.diff(offsets)), pa.array(digests, pa.string()),
                            pa.array([t[0] for t in texts], pa.int64()), pa.array([t[1] for t in texts], pa.string())]
                names += ["n_pieces", "ids_sha256", "decoded_chars", "decoded_sha256"]
            else:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def decoded_texts(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and ids. Null ids are an empty text; bytes that are no UTF-8 are replaced."""
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        _decode(load(path), False), "doc_id long, text string")


def digests(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the ids as 32-bit little endian), decoded_chars, decoded_sha256."""
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        _decode(load(path), True),
        "doc_id long, n_pieces long, ids_sha256 string, decoded_chars long, decoded_sha256 string")
