"""Secrets in texts: fixed patterns, and random strings that a public vocabulary needs many tokens for."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.words import row_groups, text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MIN_RUN = 20       # characters of a run that is tested
MAX_RATIO = 2.0    # characters per token; a run below it is taken for random

# The patterns of the kinds, in their order.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
# Fixed value: the published split pattern of the vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DIGEST_DIGITS = (32, 40, 56, 64, 96, 128)
KNOWN = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # UUID
    r"(?:sha(?:1|224|256|384|512)|md5)[-=_](?:[0-9A-Fa-f]+|[A-Za-z0-9+/]+=*)",        # named digest
    r"[0-9_+/=-]+",                                                                  # number, date, rule
    r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})(?:[_/-]+(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}))+(?:[_/-]+[0-9]+)?",  # words joined by signs
)

# The known forms that may stand among the parts of a run.
INNER = re.compile("(?<![^/=_+-])(?:" + "|".join([*KNOWN[:2], *(f"[0-9A-Fa-f]{{{n}}}" for n in DIGEST_DIGITS)]) + ")(?![^/=_+-])",
                   re.ASCII)
PARTS = re.compile("[^/=_+-]+")


def base_spans(text: str, patterns) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the fixed kinds."""
    assign, access, digits = patterns
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), 2, m.end()) for m in digits.finditer(text) if m.end() - m.start() >= 24]


def compiled():
    return re.compile(ASSIGN, re.ASCII | re.IGNORECASE), re.compile(ACCESS), re.compile(HEX)


def known_identifier(run: str, known) -> bool:
    """A digest of a usual length, or text of one of the known identifier forms."""
    return len(run) in DIGEST_DIGITS and not run.strip("0123456789abcdefABCDEF") or bool(known.fullmatch(run))


def rests(start: int, end: int, spans) -> Iterator[tuple[int, int]]:
    """What is left of a stretch without spans, which are sorted by start."""
    for a, b in spans:
        if a > start:
            yield start, min(a, end)
        start = max(start, b)
    if start < end:
        yield start, end


def maximal(scores: list[int]) -> list[tuple[int, int]]:
    """All maximal scoring stretches (Ruzzo and Tompa): no positive score is outside, no stretch gains by its neighbours."""
    held, total = [], 0  # first, last, sum before, sum after, the last one before it with a smaller sum before
    for k, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        first, j = k, len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= before:
                j = held[j][4]
            if j < 0 or held[j][3] >= total:
                break
            first, before, j = held[j][0], held[j][2], held[j][4]
            del held[next(i for i in range(len(held) - 1, -1, -1) if held[i][0] == first):]
        held.append((first, k, before, total, j))
    return [(h[0], h[1]) for h in held]


def random_spans(run: str, n_tokens, known, min_run: int, max_ratio: float) -> list[tuple[int, int]]:
    """Random stretches of a run: the whole of it, or else stretches of its parts between signs."""
    def random(a, b):
        return b - a >= min_run and not known_identifier(run[a:b], known) and b - a < max_ratio * n_tokens(run[a:b])
    if len(run) < min_run or known_identifier(run, known):
        return []
    if random(0, len(run)):
        return [(0, len(run))]
    found = []
    for a, b in rests(0, len(run), [m.span() for m in INNER.finditer(run)]):
        parts = [m.span() for m in PARTS.finditer(run, a, b)] if b - a >= min_run else []
        scores = [max_ratio * n_tokens(run[x:y]) - (y - x) for x, y in parts]
        for first, last in maximal(scores):
            if random(parts[first][0], parts[last][1]):
                found.append((parts[first][0], parts[last][1]))
            else:
                found += [part for part in parts[first:last + 1] if random(*part)]
    return found


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _long_runs(data, allowed, cuts, least):
    """(start, end) in bytes of runs of allowed bytes of that length; none crosses a text."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = allowed[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[1:] = inside[1:] != inside[:-1]
    edge[0] = inside[0]
    edge[cuts] |= inside[cuts]
    marks = np.flatnonzero(edge)
    following = np.append(marks[1:], len(data))
    keep = inside[marks] & (following - marks >= least)
    return marks[keep], following[keep]


def _scanner(ranks: dict[bytes, int], min_run: int, max_ratio: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import tiktoken
        coder = tiktoken.Encoding("runs", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        patterns, known = compiled(), re.compile("|".join(KNOWN), re.ASCII)

        def n_tokens(text):
            return len(coder.encode_ordinary(text))
        hexadecimal, allowed, lower = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool), np.arange(256, dtype=np.uint8)
        hexadecimal[list(b"0123456789abcdef")] = True
        allowed[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
        lower[65:91] += 32
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for first, last in row_groups(batch.column("text")):
                part = batch.slice(first, last - first)
                data, cuts = text_bytes(part.column("text"))
                n = len(part)
                starts, ends = _long_runs(data, allowed, cuts, min_run)
                wanted = set((np.searchsorted(cuts, starts, side="right") - 1).tolist())
                hex_starts, _ = _long_runs(data, hexadecimal, cuts, 24)
                wanted |= set((np.searchsorted(cuts, hex_starts, side="right") - 1).tolist())
                folded = lower[data].tobytes()
                for word in (b"passw", b"secret", b"token", b"api", b"akia"):
                    at = folded.find(word)
                    while at >= 0:
                        k = int(np.searchsorted(cuts, at, side="right")) - 1
                        wanted.add(k)
                        at = folded.find(word, int(cuts[k + 1]))
                counts, digests, spans = np.zeros((3, n), dtype=np.int64), [empty] * n, [""] * n
                of_row = np.searchsorted(cuts, starts, side="right") - 1
                for k in wanted:
                    raw = data[cuts[k]:cuts[k + 1]].tobytes()
                    text = raw.decode("utf-8", "replace")
                    found = sorted(base_spans(text, patterns))
                    for kind in range(3):
                        counts[kind, k] = sum(f[1] == kind for f in found)
                    digests[k] = hashlib.sha256(listed(found).encode()).hexdigest()
                    a, b = np.searchsorted(of_row, k), np.searchsorted(of_row, k, side="right")
                    added, at, place = [], 0, 0
                    for s, e in zip((starts[a:b] - cuts[k]).tolist(), (ends[a:b] - cuts[k]).tolist(), strict=True):
                        place += len(raw[at:s].decode("utf-8", "replace"))
                        at = s
                        run_text = raw[s:e].decode()
                        over = [(f[0] - place, f[2] - place) for f in found if f[0] < place + e - s and place < f[2]]
                        for low, high in rests(0, e - s, over):
                            added += [(place + low + x, 3, place + low + y) for x, y in random_spans(
                                run_text[low:high], n_tokens, known, min_run, max_ratio)]
                    spans[k] = listed(sorted(found + added))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, counts), pa.array(digests), pa.array(spans)],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def vocabulary(spark, path: str) -> dict[bytes, int]:
    """Tokens and ranks of a public vocabulary file, read on the driver; the file has a fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY,
            min_run: int = MIN_RUN, max_ratio: float = MAX_RATIO) -> DataFrame:
    """Spans of likely secrets: doc_id, n_assign, n_access, n_hex, base_sha256, spans; one row per input row.

    Spans are kind:start:end in code points, by start, then kind. A run of at
    least ``min_run`` letters, digits and ``+/_=-``, without what the fixed kinds take of it, is
    random if it has fewer than ``max_ratio`` characters per token. Of another run the maximal stretches of parts
    between signs that are random by themselves are, so words before a secret do not hide it. Digests of usual
    lengths, UUIDs, numbers and words joined by signs are known and left alone.

    A null text is empty; repeated rows are rows of their own; texts are read
    whole; other columns are not looked at; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scanner(vocabulary(docs.sparkSession, path), min_run, max_ratio),
                           "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
