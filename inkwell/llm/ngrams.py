"""LM scoring: an interpolated modified Kneser-Ney bigram model counted in Spark.

Training counts word pairs in batches, sends each batch's distinct pairs to shards by the first
word (by both words where the first is common), and merges them there.  A shard writes its
pairs as a sorted array of 64-bit hashes and an array of counts into the shared folder; what
it knows of each word (continuations, follower counts) goes on to shards by word, which write sorted
word arrays.  Scoring maps those files into memory and looks up the sorted pairs of a batch of
texts by binary search.  The model grows with the corpus; no worker holds it, only pages in use.

Counts are 64-bit; a file or block takes four bytes a count where all of its counts fit.  A null or empty
text is the end token alone, in training too; a table without rows trains a model that
gives every token the same probability, and is scored to an empty result.  Repeated rows count as often as they occur;
rows with equal or null ids are scored each by itself, other columns are not read.  A very long text is
worked on alone, in memory in proportion to it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import groups
from .common import documents, new_path, ship
from .text_arrays import U64, lean, lean_key_group, mix64, words

#: Tokens that a batch counts before it sends its pairs, tokens of a pair shard and of a word shard.
BATCH_TOKENS = 3_000_000
PAIR_SHARD = 2_000_000
WORD_SHARD = 16_000_000
#: Hashes of the tokens that start and end a text.
BEGIN, END = U64(0x0B5E55ED0B5E55ED), U64(0x0E4DED0E4DED0E4D)
_STEP = U64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Rows that training leaves out; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(first * _STEP + (second ^ (second >> U64(29))))


def token_pairs(column):
    """(previous token, token, index of each text's first pair) for slices of a string column."""
    for row, raw, offsets in groups(column):
        h, at = words(raw, offsets)
        n = len(offsets) - 1
        start = at + np.arange(n + 1)  # one more token, the end, for each text
        now = np.empty(len(h) + n, U64)
        ends = start[1:] - 1
        inner = np.ones(len(now), bool)
        inner[ends] = False
        now[inner], now[ends] = h, END
        prev = np.empty_like(now)
        prev[1:] = now[:-1]
        prev[start[:-1]] = BEGIN
        yield prev, now, start


def shard_of(first: np.ndarray, second: np.ndarray, shards: int, common: np.ndarray) -> np.ndarray:
    """The shard of each pair: by its first word, or by both where the first is in ``common``."""
    out = (first % U64(shards)).astype(np.int64)
    if len(common):
        k = np.minimum(np.searchsorted(common, first), len(common) - 1)
        hot = common[k] == first
        out[hot] = (mix64(second[hot]) % U64(shards)).astype(np.int64)
    return out


def _merge(first, second, count):
    """Distinct pairs with their summed counts, ordered by pair."""
    order = np.lexsort((second, first))
    first, second, count = first[order], second[order], count[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(new)
    return first[at], second[at], np.add.reduceat(count, at) if len(at) else count


def _filesystem(uri: str):
    """(file system, path) of a folder given as a path or URI."""
    return pafs.FileSystem.from_uri(uri if urlparse(uri).scheme else f"file://{uri}")


def _counts(values: np.ndarray) -> np.ndarray:
    """Counts in four bytes each, or in eight where one of them needs more."""
    return values.astype(np.uint32 if not values.size or int(values.max()) < 1 << 32 else U64)


def _pack(rows: np.ndarray) -> bytes:
    """Rows of a hash and some counts as bytes: the width of a count, the hashes, the counts."""
    values = _counts(rows[:, 1:])
    return bytes([values.itemsize]) + np.ascontiguousarray(rows[:, 0]).tobytes() + values.tobytes()


def _unpack(blob: bytes, columns: int) -> np.ndarray:
    kind = np.uint32 if blob[0] == 4 else U64
    n = (len(blob) - 1) // (8 + blob[0] * columns)
    values = np.frombuffer(blob, kind, n * columns, 1 + 8 * n).reshape(n, columns).astype(np.int64)
    return np.concatenate([np.frombuffer(blob, np.int64, n, 1)[:, None], values], axis=1)


def _publish(folder: str, name: str, keys: np.ndarray, values: np.ndarray) -> None:
    """Writes sorted hashes and a row of counts for each: the width of a count in eight bytes, the
    hashes, the counts.  A repeated task replaces the file by an equal one."""
    values = _counts(values)
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        for a in (np.array([values.itemsize], U64), keys, values):
            out.write(np.ascontiguousarray(a).tobytes())
    fs.move(part, f"{path}/{name}")


def _mapped(folder: str, name: str, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of a file, mapped into memory; from a remote store by way of an unlinked copy."""
    fs, path = _filesystem(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:
        with tempfile.TemporaryFile() as copy, fs.open_input_stream(f"{path}/{name}", compression=None) as source:
            while block := source.read(8 << 20):
                copy.write(block)
            copy.flush()
            raw = np.memmap(copy, np.uint8, "r")
    width = int(raw[0])
    n = (len(raw) - 8) // (8 + width * columns)
    return raw[8 : 8 + 8 * n].view(U64), raw[8 + 8 * n :].view(np.uint32 if width == 4 else U64).reshape(n, columns)


def common_words(docs: DataFrame, shards: int) -> np.ndarray:
    """Words that make up more than 1 / (4 shards) of a sample of the documents (one in 64 by
    hash, at most 4 shards words).  It only decides how pairs are dealt, never a count."""

    def run(batches):
        for batch in batches:
            for _, now, _ in token_pairs(batch.column("text")):
                w, n = np.unique(now, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["w", "n"])

    sample = docs.where(F.pmod(F.xxhash64(F.lit(13), "doc_id", "text"), F.lit(64)) == 0).select("text")
    seen = sample.mapInArrow(lean(run), "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = seen.agg(F.sum("n")).first()[0] or 0
    rows = seen.where(F.col("n") > max(50, total // (4 * shards))).collect()
    return np.sort(np.array([r["w"] for r in rows] + [int(BEGIN.view(np.int64))], np.int64).view(U64))


def train(docs: DataFrame) -> dict:
    """Counts the texts of ``docs`` (doc_id, text; null texts are empty) and writes the model.

    Returns its folder, shard counts, totals and discounts.
    """
    spark = ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pair_shards, word_shards = 16 + size // (6 * PAIR_SHARD), 4 + size // (6 * WORD_SHARD)
    common = common_words(docs, pair_shards)
    folder = new_path(spark, "kneser-ney")

    def count(batches):
        held, tokens = [], 0

        def flush():
            first, second, number = _merge(*(np.concatenate([h[k] for h in held]) for k in range(3)))
            shard = shard_of(first, second, pair_shards, common)
            order = np.argsort(shard, kind="stable")
            shard, first, second, number = shard[order], first[order], second[order], number[order]
            at = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            rows = []
            for a, b in zip(at.tolist(), [*at.tolist()[1:], len(shard)], strict=True):
                begin = np.flatnonzero(np.concatenate([[True], first[a + 1 : b] != first[a : b - 1]]))
                run = np.diff(np.append(begin, b - a)).astype(np.uint32)
                rows.append((int(shard[a]), first[a:b][begin].tobytes(), run.tobytes(), second[a:b].tobytes(), number[a:b].astype(np.uint32).tobytes()))
            kinds = (pa.int64(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["shard", "first", "run", "second", "number"])

        for batch in batches:
            for prev, now, _ in token_pairs(batch.column("text")):
                if len(now):
                    held.append((prev, now, np.ones(len(now), np.int64)))
                    tokens += len(now)
                if tokens >= BATCH_TOKENS:
                    yield flush()
                    held.clear()
                    tokens = 0
        if held:
            yield flush()

    def read(table, name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    def pairs(key, table):
        first = np.repeat(read(table, "first", U64), read(table, "run", np.uint32))
        first, second, number = _merge(first, read(table, "second", U64), read(table, "number", np.uint32).astype(np.int64))
        hashes = pair_key(first, second)
        order = np.argsort(hashes)
        _publish(folder, f"pairs-{key[0].as_py()}", hashes[order], number[order][:, None])
        at = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        sums = [np.add.reduceat(x, at) for x in (number, number == 1, number == 2, number > 2)]
        own = np.stack([first[at].view(np.int64), *[s.astype(np.int64) for s in sums]], axis=1)
        order = np.argsort(second, kind="stable")
        w, n = second[order], number[order]
        at = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        after = np.stack([w[at].view(np.int64), np.add.reduceat(n, at), np.diff(np.append(at, len(w)))], axis=1)
        rows = [(-1, np.array([(number == k).sum() for k in (1, 2, 3, 4)], np.int64).tobytes(), b"")]
        place = [(x[:, 0].view(U64) >> U64(32)) * U64(word_shards) >> U64(32) for x in (own, after)]
        for k in range(word_shards):
            a, b = own[place[0] == k], after[place[1] == k]
            rows.append((k, _pack(a), _pack(b)))
        return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate((("shard", pa.int64()), ("own", pa.binary()), ("after", pa.binary())))})

    def summed(x):
        order = np.argsort(x[:, 0].view(U64), kind="stable")
        x = x[order]
        at = np.flatnonzero(np.concatenate([[True], x[1:, 0] != x[:-1, 0]])) if len(x) else np.zeros(0, np.int64)
        return x[at, 0].view(U64), np.add.reduceat(x[:, 1:], at, axis=0) if len(at) else x[:, 1:]

    def by_word(key, table):
        k = key[0].as_py()
        if k < 0:
            total = sum((np.frombuffer(x, np.int64) for x in table.column("own").to_pylist()), np.zeros(4, np.int64))
            return pa.table({"shard": pa.array([-1], pa.int64()), "stats": pa.array([[*total.tolist()]], pa.list_(pa.int64()))})
        own_w, own = summed(np.concatenate([_unpack(x, 4) for x in table.column("own").to_pylist()]))
        after_w, after = summed(np.concatenate([_unpack(x, 2) for x in table.column("after").to_pylist()]))
        all_w = np.union1d(own_w, after_w)
        values = np.zeros((len(all_w), 6), np.int64)
        values[np.searchsorted(all_w, own_w), :4] = own
        values[np.searchsorted(all_w, after_w), 4:] = after
        _publish(folder, f"words-{k}", all_w, values)
        c = after[:, 1]
        stats = [int(after[:, 0].sum()), len(after), int(c.sum()), *[int((c == j).sum()) for j in (1, 2, 3, 4)]]
        return pa.table({"shard": pa.array([k], pa.int64()), "stats": pa.array([stats], pa.list_(pa.int64()))})

    counted = docs.select("text").mapInArrow(lean(count), "shard long, first binary, run binary, second binary, number binary")
    known = counted.groupBy("shard").applyInArrow(lean_key_group(pairs), "shard long, own binary, after binary")
    rows = known.groupBy("shard").applyInArrow(lean_key_group(by_word), "shard long, stats array<long>").collect()
    of_pairs = sum((np.array(r["stats"]) for r in rows if r["shard"] < 0), np.zeros(4, np.int64))
    of_words = sum((np.array(r["stats"]) for r in rows if r["shard"] >= 0), np.zeros(7, np.int64))
    below, (n1, n2) = discounts(of_words[3:]), of_words[3:5]
    taken = below[0] * n1 + below[1] * n2 + below[2] * (of_words[1] - n1 - n2)
    return {
        "folder": folder, "pair_shards": pair_shards, "word_shards": word_shards, "common": common, "made": sorted(r["shard"] for r in rows),
        "tokens": int(of_words[0]), "distinct": int(of_words[1]), "continuations": int(of_words[2]),
        "pair_discounts": discounts(of_pairs), "word_discounts": below,
        # What the discounts take from all words goes evenly to the known words and one unknown.
        "spare": float(taken / of_words[2]) if of_words[2] else 1.0,
    }


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """The modified discounts of counts one, two, and three or more, from how often counts 1 to 4 occur."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    step = lambda k, a, b: min(float(k), max(0.0, k - (k + 1) * y * b / a)) if a else y
    return step(1, n1, n2), step(2, n2, n3), step(3, n3, n4)


class Model:
    """The files of a trained model, mapped when first needed."""

    def __init__(self, info: dict):
        self.info = info
        self.words: dict[int, tuple] = {}
        self.pairs: dict[int, tuple] = {}
        self.made = set(info["made"])

    def _words(self, k: int):
        if k not in self.words:
            self.words[k] = _mapped(self.info["folder"], f"words-{k}", 6) if k in self.made else (np.zeros(0, U64), np.zeros((0, 6), U64))
        return self.words[k]

    def _pairs(self, k: int):
        if k not in self.pairs:
            try:
                self.pairs[k] = _mapped(self.info["folder"], f"pairs-{k}", 1)
            except FileNotFoundError:  # no pair of the training texts fell into this shard
                self.pairs[k] = np.zeros(0, U64), np.zeros((0, 1), U64)
        return self.pairs[k]

    def word_values(self, w: np.ndarray) -> np.ndarray:
        """Six counts for each of the sorted distinct words, zeros for unknown ones."""
        out = np.zeros((len(w), 6), np.int64)
        shard = ((w >> U64(32)) * U64(self.info["word_shards"]) >> U64(32)).astype(np.int64)
        edge = np.searchsorted(shard, np.arange(self.info["word_shards"] + 1))
        for k in range(self.info["word_shards"]):
            a, b = edge[k], edge[k + 1]
            known, values = self._words(k)
            if a < b and len(known):
                at = np.minimum(np.searchsorted(known, w[a:b]), len(known) - 1)
                hit = known[at] == w[a:b]
                out[a:b][hit] = values[at[hit]].astype(np.int64)
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        shard = shard_of(first, second, self.info["pair_shards"], self.info["common"])
        key = pair_key(first, second)
        order = np.lexsort((key, shard))
        out = np.zeros(len(key), np.int64)
        sorted_shard, sorted_key = shard[order], key[order]
        edge = np.searchsorted(sorted_shard, np.arange(self.info["pair_shards"] + 1))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            a, b = edge[k], edge[k + 1]
            known, number = self._pairs(k)
            if len(known):
                at = np.minimum(np.searchsorted(known, sorted_key[a:b]), len(known) - 1)
                out[order[a:b]] = np.where(known[at] == sorted_key[a:b], number[at, 0].astype(np.int64), 0)
        return out

    def score(self, prev: np.ndarray, now: np.ndarray, start: np.ndarray):
        """(tokens, known tokens, base score, model score) of each text of a batch."""
        info = self.info
        distinct, inverse = np.unique(np.concatenate([prev, now]), return_inverse=True)
        values = self.word_values(distinct)
        before, after = inverse[: len(prev)], inverse[len(prev) :]
        total, kinds = info["tokens"], info["distinct"]
        c = values[:, 4]
        base = np.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
        cont, d = values[:, 5], info["word_discounts"]
        n = max(1, info["continuations"])
        cut = np.select([cont == 1, cont == 2, cont > 2], d, 0.0)
        low = np.maximum(cont - cut, 0.0) / n + info["spare"] / (kinds + 1)
        followers = values[:, 0]
        d1, d2, d3 = info["pair_discounts"]
        back = np.where(followers > 0, (d1 * values[:, 1] + d2 * values[:, 2] + d3 * values[:, 3]) / np.maximum(followers, 1), 1.0)
        number = self.pair_counts(prev, now)
        less = np.select([number == 1, number == 2, number > 2], [d1, d2, d3], 0.0)
        p = np.maximum(number - less, 0.0) / np.maximum(followers[before], 1) + back[before] * low[after]
        add = lambda x: np.add.reduceat(x, start[:-1]) if len(start) > 1 else np.zeros(0)
        return np.diff(start), add((c > 0)[after].astype(np.int64)), add(base[after]), add(np.log10(p))


_models: dict[str, Model] = {}


def model(info: dict) -> Model:
    """This worker's model: its files are opened, or fetched, once for all tasks of the worker."""
    if info["folder"] not in _models:
        _models.clear()
        _models[info["folder"]] = Model(info)
    return _models[info["folder"]]


def score(docs: DataFrame, info: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every whole text; a null text is empty."""
    sent = ship(docs.sparkSession).sparkContext.broadcast(info)

    def run(batches):
        own = model(sent.value)
        for batch in batches:
            parts = [own.score(*x) for x in token_pairs(batch.column("text"))]
            columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(4)]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds, strict=True)]], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def op6_lm_scoring(spark, sf_dir) -> DataFrame:
    """Contract query: base and model scores of every whole text, learned from the training rows.

    One row for each row of the table, repeated rows included; a null id is no held-out one, a null or empty text is
    one token, its end; an empty table gives no rows."""
    docs = documents(spark, sf_dir)
    info = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text"))
    rows = score(docs, info)
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(info["tokens"]).cast("long").alias("train_tokens"), "base_score", "score",
    )
