"""Byte-level BPE: pre-tokenisation by scans over codepoint classes, cached merging, decoding.

Texts are cut where the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

would start a match, without running it. Every codepoint has a class; what depends on the next
codepoints (a blank before non-blank text, an apostrophe before s, t, m, d, re, ve, ll) is put into
the class with shifted arrays. An automaton of eight states then reads the classes. Its transition
functions compose associatively, so a whole batch is scanned in blocks side by side: first each
block's function, then the state each block starts in, then all states.

A null text is empty and has no ids. Ids are returned with the byte offset each token starts at;
`decode` needs the ids only. Rows are independent: repeated rows, null ids and empty tables pass
through. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgmart.llm.texts import packed

L, N, O, BLANK, SPACE = range(5)  # classes of codepoints  # noqa: E741
#: Classes that the automaton reads: the first three, an apostrophe that begins a contraction of one or two letters, a blank that is
#: the last before other text (a space or another one), any other blank, and the place where a text ends.
APOS1, APOS2, LAST_SPACE, LAST_BLANK, MORE_BLANK, END = range(3, 9)
#: States: a match has ended; within letters, numbers, others; a space that the next match takes; within blanks; one or two letters of a contraction to come.
CLOSED, IN_L, IN_N, IN_O, TAKES, IN_BLANK, ONE, TWO = range(8)
#: Codepoints of the class \s of the pattern.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    """The class of each codepoint."""
    kinds = {"L": L, "N": N}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], O) for c in range(0x110000)), dtype=np.uint8, count=0x110000)
    table[SPACES] = BLANK
    table[0x20] = SPACE
    return table


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """The next state and whether a match starts, by class and state."""
    follow, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for state in range(8):
        for kind, inside in ((L, IN_L), (N, IN_N), (O, IN_O)):
            follow[kind, state] = inside
            starts[kind, state] = state not in (inside, TAKES)
        for kind, left in ((APOS1, ONE), (APOS2, TWO)):
            joins = state in (IN_O, TAKES)
            follow[kind, state] = IN_O if joins else left
            starts[kind, state] = not joins
        follow[LAST_SPACE, state], follow[LAST_BLANK, state] = TAKES, CLOSED
        follow[MORE_BLANK, state] = IN_BLANK
        starts[MORE_BLANK, state] = state != IN_BLANK
        follow[END, state] = CLOSED
    for state, left in ((ONE, CLOSED), (TWO, ONE)):
        follow[L, state], starts[L, state] = left, False
    return follow, starts


def kinds(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The class of each place in texts laid end to end, each followed by one place that ends it (code 0)."""
    raw = classes()[codes]
    ends = np.cumsum(lengths + 1) - 1
    out = raw.copy()
    raw[ends] = BLANK
    blank = raw >= BLANK
    follows_text = np.zeros(len(codes), bool)
    follows_text[:-1] = ~blank[1:]
    out[blank] = np.where(follows_text[blank], np.where(raw[blank] == SPACE, LAST_SPACE, LAST_BLANK), MORE_BLANK)
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        far = np.concatenate([codes, np.zeros(2, codes.dtype)])
        a, b = far[quote + 1], far[quote + 2]
        out[quote[np.isin(a, [ord(x) for x in "stmd"])]] = APOS1
        pair = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        out[quote[pair]] = APOS2
    out[ends] = END
    return out


def match_starts(kind: np.ndarray) -> np.ndarray:
    """Where matches start, by a blocked scan of transition functions."""
    follow, starts = automaton()
    n = len(kind)
    steps = max(16, int(np.sqrt(n)))
    grid = np.full(-(-n // steps) * steps, END, np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(-1, steps).T)  # a column for each block
    blocks = grid.shape[1]
    flat = follow.reshape(-1)
    function = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))  # of each block, as far as it has been read
    for row in grid:
        function = flat[row[:, None].astype(np.int16) * 8 + function]
    state = np.empty(blocks, np.uint8)
    now = CLOSED
    for k, step in enumerate(function.tolist()):
        state[k] = now
        now = step[now]
    out = np.empty(grid.shape, bool)
    marks = starts.reshape(-1)
    for t, row in enumerate(grid):
        at = row.astype(np.int16) * 8 + state
        out[t] = marks[at]
        state = flat[at]
    return out.T.reshape(-1)[:n]


def ranks_of(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Bytes up to which matches are merged side by side, and how many are.
SHORT, ABREAST = 40, 20_000


class Merger:
    """The ids of matches: again and again the leftmost pair of least rank is merged."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([x])] for x in range(256)], np.int64)
        self.span = max(ranks.values()) + 1
        pairs = {ranks[t[:k]] * self.span + ranks[t[k:]]: rank for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        # what two neighbours merge into, by both ids; one more entry that no pair has
        self.pairs = np.array([*sorted(pairs), np.iinfo(np.int64).max])
        self.into = np.array([*(pairs[x] for x in sorted(pairs)), self.span])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.span + right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.into[at], self.span)

    def _abreast(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Matches of `width` bytes. In each round every match with a pair left makes its next merge."""
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, width)]
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        rows, done = np.arange(len(pieces)), [b""] * len(pieces)
        while len(rows):
            n = ids.shape[1]
            at = rank.argmin(axis=1) if n > 1 else np.zeros(len(rows), np.int64)
            least = rank[np.arange(len(rows)), at] if n > 1 else np.full(len(rows), self.span)
            over = least == self.span
            for k in np.flatnonzero(over):
                done[rows[k]] = ids[k].astype(np.int32).tobytes()
            go = ~over
            rows, ids, rank, at, least = rows[go], ids[go], rank[go], at[go], least[go]
            if not len(rows):
                break
            row = np.arange(len(rows))
            ids[row, at] = least
            column = np.arange(n - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            rank = np.take_along_axis(rank, column + (column >= at[:, None]), axis=1)
            for place, ok in ((at - 1, at > 0), (at, at < n - 2)):
                r, c = row[ok], place[ok]
                rank[r, c] = self._rank(ids[r, c], ids[r, c + 1])
        return done

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each match, as 32-bit numbers."""
        out = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = array("i", [whole]).tobytes()
            elif len(piece) > SHORT:
                out[k] = array("i", _merge_long(piece, self.ranks)).tobytes()
            else:
                by_width.setdefault(len(piece), []).append(k)
        for width, places in by_width.items():
            for at in range(0, len(places), ABREAST):
                part = places[at : at + ABREAST]
                for k, ids in zip(part, self._abreast([pieces[x] for x in part], width), strict=True):
                    out[k] = ids
        return out


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Pairs wait in a heap, so that a match of n bytes takes n log n steps."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at an index; 0: merged away
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != to:
            continue
        end[i], end[middle] = to, 0
        if to < n:
            before[to] = i
            if (rank := ranks.get(piece[i : end[to]])) is not None:
                heapq.heappush(heap, (rank, i, end[to]))
        if (left := before[i]) >= 0 and (rank := ranks.get(piece[left:to])) is not None:
            heapq.heappush(heap, (rank, left, to))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


#: Codepoints that are scanned together; rows that are decoded together.
SCANNED, DECODED = 1_000_000, 200
#: Matches whose ids a worker remembers.
REMEMBERED = 400_000


@functools.cache
def _known(path: str) -> tuple[dict[str, bytes], Merger, np.ndarray, np.ndarray, np.ndarray]:
    """Of a vocabulary: the matches remembered (shared by a worker's tasks), what merges others, the tokens laid end to end, where each begins, and its length."""
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return {}, Merger(ranks), np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, merger, _, _, size = _known(path)

        def several(texts: list[str]) -> list[bytes]:
            codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), dtype="<u4")
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            kind = kinds(codes, lengths)
            starts = np.flatnonzero(match_starts(kind) & (kind != END))
            ends = np.cumsum(lengths + 1) - 1
            firsts = np.searchsorted(starts, np.concatenate([[0], ends + 1]))
            pieces: list[str] = []
            for k, text in enumerate(texts):
                cuts = (starts[firsts[k] : firsts[k + 1]] - (ends[k] - lengths[k])).tolist()
                pieces += [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)], strict=False)]
            new = [x for x in set(pieces) if x not in memo]
            if len(memo) + len(new) > REMEMBERED:
                memo.clear()
                new = list(set(pieces))
            memo.update(zip(new, merger.merge([x.encode() for x in new]), strict=True))
            found = list(map(memo.__getitem__, pieces))
            out = [b"".join(found[a:b]) for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
            for piece in new:
                if len(piece) > SHORT:
                    del memo[piece]
            return out

        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, total = at, 0
                while to < len(texts) and (to == at or total + len(texts[to]) <= SCANNED):
                    total += len(texts[to])
                    to += 1
                blobs = several(texts[at:to])
                counts = np.fromiter((len(x) // 4 for x in blobs), np.int64, len(blobs))
                ids = np.frombuffer(b"".join(blobs), np.int32)
                ahead = np.concatenate([[0], np.cumsum(size[ids], dtype=np.int64)])
                first = np.concatenate([[0], np.cumsum(counts)])
                offsets = (ahead[:-1] - np.repeat(ahead[first[:-1]], counts)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), packed(counts, pa.array(ids)), packed(counts, pa.array(offsets))], names=["doc_id", "ids", "offsets"])
                at = to

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, offsets: the ids of each text by the ranks in the file `path`, and the byte each token starts at.

    The file has to be there on every executor, as installed libraries are.
    """
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_encode(path), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, offsets array<int>")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, tokens, begins, size = _known(path)
        for whole in batches:
            for at in range(0, whole.num_rows, DECODED):
                batch = whole.slice(at, DECODED)
                column = batch.column(batch.schema.get_field_index("ids"))
                ids, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
                sizes = size[ids]
                ahead = np.concatenate([[0], np.cumsum(sizes)])
                content = tokens[np.arange(ahead[-1]) + np.repeat(begins[ids] - ahead[:-1], sizes)]
                offsets = pa.array(ahead[ends - ends[0]].astype(np.int32)).buffers()[1]
                texts = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(content.tobytes())])
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "bytes"])

    return run


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """`tokens` and the bytes that the column `ids` stands for."""
    kinds_ = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields)
    return tokens.mapInArrow(_decode(path), f"{kinds_}, bytes binary")
