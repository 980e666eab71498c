"""Byte-level BPE encoding and decoding in whole batches of texts.

Pre-tokenisation uses no regular expression.  Every code point gets a symbol: its class, with as much
of what follows as the pattern looks ahead.  A symbol is a function from the scanner's state before it
to the state after it.  Composition of such functions is associative and they make a small monoid, so
the composed functions of all prefixes of a batch come from a blocked scan over a composition table
(``prefixes``); state and symbol tell where a piece starts.  The slices between boundaries are hashed;
each distinct slice is merged once per worker, lowest rank first and leftmost among equals, all slices of
a batch in step, and cached.  A slice takes a cached result only if its bytes are equal.  Offsets of the
pieces stay with the ids.

A null text is an empty one: no ids, and the digest of nothing.  An empty table gives an empty
result, repeated rows and rows with equal or null ids are encoded each by itself, and no order of
ids matters.  Other columns are not read.  A very long text is worked on alone, in memory in proportion to it.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, ship
from .text_arrays import U64, _stream, buffers, lean, mix64, place_key

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: White space by the Unicode property, fixed values.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Slices longer than this are merged one by one with a heap instead of in step with others.
LONG_PIECE = 48
#: Distinct slices a worker keeps, and bytes of them; beyond either the cache starts anew.
CACHE_PIECES = 200_000
CACHE_BYTES = 32 << 20
#: Bytes of text worked on at once (a single longer text is worked on alone).
GROUP_BYTES = 1 << 20


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        k = kinds.get(unicodedata.category(chr(c))[0])
        if k is not None:
            out[c] = k
    out[WHITE] = SPACE
    return out


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte offset of each) of UTF-8 bytes."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    lead = raw[at].astype(np.uint32)
    if len(at) == len(raw):
        return lead, at
    tail = np.concatenate([raw, np.zeros(3, np.uint8)])
    wide = np.flatnonzero(lead >= 0xC0)
    p, a = at[wide], lead[wide]
    b, c, d = (tail[p + k].astype(np.uint32) & 0x3F for k in (1, 2, 3))
    two = ((a & 0x1F) << 6) | b
    three = ((a & 0x0F) << 12) | (b << 6) | c
    four = ((a & 0x07) << 18) | (b << 12) | (c << 6) | d
    lead[wide] = np.where(a < 0xE0, two, np.where(a < 0xF0, three, four))
    return lead, at


#: Symbols: letter, number, other, quote that may open a contraction of one or two letters, white
#: space within a run or at the text's end, a run's last character that is a space, or that is none.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_WHITE, S_LEAD, S_LAST = range(8)
#: States: a piece has just ended, inside a run of letters, numbers, others or white space, after a
#: space that leads a piece, one or two letters of a contraction still to come.
FRESH, LETTERS, NUMBERS, OTHERS, WHITES, LED, ONE, TWO = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece starts here)."""
    if symbol == S_LETTER and state in (ONE, TWO):
        return (FRESH if state == ONE else ONE), False
    if symbol in (S_SHORT, S_LONG) and state not in (OTHERS, LED):
        return (ONE if symbol == S_SHORT else TWO), True
    run = {S_LETTER: LETTERS, S_NUMBER: NUMBERS, S_WHITE: WHITES, S_LAST: WHITES, S_LEAD: LED}.get(symbol, OTHERS)
    if symbol in (S_LEAD, S_LAST):
        return run, True
    return run, state != run and (state != LED or run == WHITES)


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(generators, compose, apply, starts): the element of each symbol, of symbols at a text's start
    in the second row; the element of two in a row; the state after an element; where pieces start."""
    plain = [tuple(_step(q, s)[0] for q in range(8)) for s in range(8)]
    first = [(f[FRESH],) * 8 for f in plain]
    found = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    for f in todo:
        for g in plain + first:
            h = tuple(g[q] for q in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    compose = np.array([[found[tuple(g[q] for q in f)] for g in todo] for f in todo], np.uint16)
    generators = np.array([[found[f] for f in plain], [found[f] for f in first]], np.uint16)
    starts = np.array([[_step(q, s)[1] for q in range(8)] for s in range(8)])
    return generators, compose, np.array(todo, np.uint8), starts


def prefixes(elements: np.ndarray) -> np.ndarray:
    """The composition of all elements up to and with each one, by an associative scan.

    Blocks are scanned side by side, their totals by the same scan, and each block's prefixes
    are composed with all that comes before the block.
    """
    compose = monoid()[1]
    n, width = len(elements), len(compose)
    flat = compose.ravel()
    length = 256 if n > 4096 else 16
    if n <= length:
        out = elements.copy()
        for k in range(1, n):
            out[k] = compose[out[k - 1], elements[k]]
        return out
    blocks = -(-n // length)
    grid = np.zeros((blocks, length), np.uint16)
    grid.ravel()[:n] = elements
    grid = np.ascontiguousarray(grid.T)
    for k in range(1, length):
        grid[k] = flat[grid[k - 1].astype(np.int32) * width + grid[k]]
    before = np.concatenate([np.zeros(1, np.uint16), prefixes(grid[-1])[:-1]]).astype(np.int32) * width
    for k in range(length):
        grid[k] = flat[before + grid[k]]
    return np.ascontiguousarray(grid.T).ravel()[:n]


def symbols(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The symbol of every code point."""
    kind = classes()[points]
    last = np.ones(len(points), bool)  # of its text, or followed by white space
    last[:-1] = begins[1:] | (kind[1:] == SPACE)
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_WHITE], np.uint8)[kind]
    closing = (kind == SPACE) & ~last
    out[closing] = np.where(points[closing] == 0x20, S_LEAD, S_LAST)
    quote = np.flatnonzero(points == 0x27)
    pad = np.concatenate([points, np.zeros(2, points.dtype)])
    edge = np.concatenate([begins, np.ones(2, bool)])
    x = np.where(edge[quote + 1], 0, pad[quote + 1])
    y = np.where(edge[quote + 1] | edge[quote + 2], 0, pad[quote + 2])
    out[quote[np.isin(x, [ord(c) for c in "stmd"])]] = S_SHORT
    long = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (x == ord(a)) & (y == ord(b))
    out[quote[long]] = S_LONG
    return out


def boundaries(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Marks the code points at which a piece starts; ``begins`` marks where a text starts."""
    n = len(points)
    if n == 0:
        return np.zeros(0, bool)
    generators, _, apply, starts = monoid()
    symbol = symbols(points, begins)
    state = np.empty(n, np.uint8)
    state[0] = FRESH
    state[1:] = apply[:, FRESH][prefixes(generators[begins.view(np.uint8), symbol])[:-1]]
    state[begins] = FRESH
    return starts.ravel()[symbol.astype(np.intp) * 8 + state]


class Merges:
    """The ranks of a vocabulary file and the pairs that they merge."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f.read().splitlines() if line]
        ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.decimal = [b"%d" % k for k in range(len(self.bytes))]
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, made = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(rank)
        keys, made = np.array(keys, np.int64), np.array(made, np.int64)
        order = np.argsort(keys)
        self.keys, self.made = keys[order], made[order]
        self.size = 1 << 21
        self.slots = np.full(self.size, -1, np.int32)
        self._fill()

    @cached_property
    def pair(self) -> dict[int, int]:
        """The pairs as a dictionary, made when the first long piece is met."""
        return dict(zip(self.keys.tolist(), self.made.tolist(), strict=True))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.view(U64)) >> U64(43)).astype(np.int64)

    def _fill(self) -> None:
        """An open table of the pairs: where two pairs share a slot, the later ones lie in ``rest``."""
        slot = self._slot(self.keys)
        first = np.unique(slot, return_index=True)[1]
        self.slots[slot[first]] = first
        rest = np.ones(len(self.keys), bool)
        rest[first] = False
        self.rest_keys, self.rest_made = self.keys[rest], self.made[rest]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, or a very large number."""
        key = (a << 32) | b
        at = self.slots[self._slot(key)]
        hit = (at >= 0) & (self.keys[at] == key)
        out = np.where(hit, self.made[at], NEVER)
        miss = np.flatnonzero((at >= 0) & ~hit)
        if len(miss) and len(self.rest_keys):
            k = np.minimum(np.searchsorted(self.rest_keys, key[miss]), len(self.rest_keys) - 1)
            out[miss] = np.where(self.rest_keys[k] == key[miss], self.rest_made[k], NEVER)
        return out

    def merge_one(self, piece: bytes) -> list[int]:
        """Merges one long piece with a heap of pairs, lowest rank first, leftmost among equals."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        nxt, prv, pair = [*range(1, n), -1], [-1, *range(n - 1)], self.pair
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
                if (x := pair.get(r << 32 | ids[nxt[j]])) is not None:
                    heapq.heappush(heap, (x, i, r, ids[nxt[j]]))
            if (p := prv[i]) >= 0 and (x := pair.get(ids[p] << 32 | r)) is not None:
                heapq.heappush(heap, (x, p, ids[p], r))
        return [x for x in ids if x >= 0]

    def merge_all(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces of ``raw``, in step: (ids, number of ids of each piece)."""
        owner = np.repeat(np.arange(len(start)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        ids = self.byte_id[raw[np.repeat(start, size) + place]]
        done_ids, done_owner = [], []
        while len(ids):
            score = np.full(len(ids), NEVER)
            score[:-1] = self.rank(ids[:-1], ids[1:])
            score[:-1][owner[1:] != owner[:-1]] = NEVER
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(score, first)
            count = np.diff(np.append(first, len(ids)))
            alive = np.repeat(best < NEVER, count)
            done_ids.append(ids[~alive])
            done_owner.append(owner[~alive])
            if not alive.any():
                break
            hit = np.flatnonzero(alive & (score == np.repeat(best, count)))
            hit = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])]  # the leftmost of each piece
            ids[hit] = score[hit]
            alive[hit + 1] = False
            ids, owner = ids[alive], owner[alive]
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
        owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(start))


NEVER = np.int64(1 << 62)
_BYTE = _stream(256, 37)


class Encoder:
    """Encodes batches of texts; keeps the ids of the distinct pieces it has met."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self._reset()

    def _reset(self) -> None:
        self.known = np.zeros(0, U64)  # hashes of pieces, sorted
        self.index = np.zeros(0, np.int64)  # where in the lists each is
        self.ids: list[bytes] = []  # ids of four bytes each
        self.text: list[bytes] = []  # decimal ids joined by a space
        self.back: list[bytes] = []  # bytes that the ids decode to
        self.count = np.zeros(0, np.int64)
        self.odd: dict[bytes, int] = {}  # pieces whose hash belongs to other bytes
        self.held = 0

    def _learn(self, raw, start, size, hashes) -> None:
        short = np.flatnonzero(size <= LONG_PIECE)
        flat, count = self.merges.merge_all(raw, start[short], size[short])
        flat, upto = flat.tolist(), np.concatenate([[0], np.cumsum(count)]).tolist()
        made: list = [None] * len(start)
        for k, i in enumerate(short.tolist()):
            made[i] = flat[upto[k] : upto[k + 1]]
        for i in np.flatnonzero(size > LONG_PIECE).tolist():
            made[i] = self.merges.merge_one(raw[start[i] : start[i] + size[i]].tobytes())
        decimal, token = self.merges.decimal, self.merges.bytes
        base = len(self.ids)
        self.ids += [np.array(ids, np.int32).tobytes() for ids in made]
        self.text += [b" ".join([decimal[x] for x in ids]) for ids in made]
        self.back += [b"".join([token[x] for x in ids]) for ids in made]
        self.count = np.concatenate([self.count, np.array([len(x) for x in made], np.int64)])
        self.held += int(size.sum())
        known = np.concatenate([self.known, hashes])
        index = np.concatenate([self.index, np.arange(base, base + len(made))])
        order = np.argsort(known, kind="stable")
        self.known, self.index = known[order], index[order]

    def _odd(self, piece: bytes) -> int:
        """The number of a piece whose hash is taken by other bytes."""
        if piece not in self.odd:
            ids = self.merges.merge_one(piece)
            self.odd[piece] = len(self.ids)
            self.ids.append(np.array(ids, np.int32).tobytes())
            self.text.append(b" ".join([self.merges.decimal[x] for x in ids]))
            self.back.append(piece)
            self.count = np.append(self.count, len(ids))
            self.held += len(piece)
        return self.odd[piece]

    def pieces(self, raw: np.ndarray, offsets: np.ndarray):
        """(piece numbers, byte offset of each piece, index of each text's first piece)."""
        points, at = code_points(raw)
        begins = np.zeros(len(points), bool)
        own = np.searchsorted(at, offsets[:-1][offsets[:-1] < offsets[1:]])
        begins[own] = True
        start = at[boundaries(points, begins)]
        first = np.searchsorted(start, offsets)
        if not len(start):
            return np.zeros(0, np.int64), start, first
        size = np.diff(np.append(start, len(raw)))
        place = np.arange(len(raw), dtype=np.int64) - np.repeat(start, size)
        hashes = mix64(np.add.reduceat(_BYTE[raw] * place_key(place), start) + size.astype(U64))
        distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.ids) > CACHE_PIECES or self.held > CACHE_BYTES:
            self._reset()
        k = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        fresh = self.known[k] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if fresh.any():
            e = example[fresh]
            self._learn(raw, start[e], size[e], distinct[fresh])
            k = np.searchsorted(self.known, distinct)
        number = self.index[k]
        # Equal hashes are not enough: the bytes are compared, with the first piece of that hash in
        # the batch and that one with the cached piece.
        whole = raw.tobytes()
        at, upto = start[example].tolist(), (start[example] + size[example]).tolist()
        wrong = np.zeros(len(distinct), bool)
        for j in np.flatnonzero(~fresh).tolist():
            wrong[j] = self.back[number[j]] != whole[at[j] : upto[j]]
        alike = np.minimum(np.repeat(start[example][inverse], size) + place, len(raw) - 1)
        differs = np.logical_or.reduceat(raw != raw[alike], start) | (size != size[example][inverse]) | wrong[inverse]
        out = number[inverse]
        for j in np.flatnonzero(differs).tolist():
            out[j] = self._odd(whole[start[j] : start[j] + size[j]])
        return out, start, first


def groups(column: pa.Array):
    """Slices of a string column of about GROUP_BYTES each: (first row, raw, offsets)."""
    raw, offsets = buffers(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, offsets array<long>) of every text; a null text is empty.

    ``offsets`` are the byte offsets at which the pieces start, ``pieces`` the number of ids of each.
    """

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            ids, offs, counts = [], [], []
            for _, raw, offsets in groups(batch.column("text")):
                piece, start, first = enc.pieces(raw, offsets)
                for d in range(len(offsets) - 1):
                    own = piece[first[d] : first[d + 1]]
                    ids.append(np.frombuffer(b"".join([enc.ids[p] for p in own.tolist()]), np.int32))
                    offs.append(start[first[d] : first[d + 1]] - offsets[d])
                    counts.append(enc.count[own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(offs, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
                ["doc_id", "ids", "offsets", "pieces"],
            )

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, ids array<int>, offsets array<long>, pieces array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, content binary): the bytes that the ids stand for."""

    def run(batches):
        token = encoder(path).merges.bytes
        for batch in batches:
            rows = [None if ids is None else b"".join([token[x] for x in ids]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "content"])

    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lean(run), "doc_id long, content binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of every whole text's ids and of the bytes that they decode to, without
    building the ids as rows: each distinct piece's ids are written and decoded once."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            n_tokens, ids_sha, back_sha = [], [], []
            for _, raw, offsets in groups(batch.column("text")):
                piece, _, first = enc.pieces(raw, offsets)
                upto = np.concatenate([[0], np.cumsum(enc.count[piece])]) if len(piece) else np.zeros(1, np.int64)
                n_tokens += (upto[first[1:]] - upto[first[:-1]]).tolist()
                own = piece.tolist()
                text, back = enc.text, enc.back
                for d in range(len(offsets) - 1):
                    mine = own[first[d] : first[d + 1]]
                    ids_sha.append(hashlib.sha256(b" ".join([text[p] for p in mine])).hexdigest())
                    back_sha.append(hashlib.sha256(b"".join([back[p] for p in mine])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> str:
    """Place of the production vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op3_byte_bpe(spark, sf_dir) -> DataFrame:
    """Contract query: token counts and digests of every whole text, encoded and decoded.

    One row for each row of the table, repeated rows included; a null text is an empty one, an empty table gives no rows."""
    return round_trip(documents(spark, sf_dir), vocabulary())
