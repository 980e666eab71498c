"""Line dedup, exact and fuzzy, by MinHash over character shingles.

A line is taken in lower case and without white space at its ends.  Its shingles are the runs of SHINGLE
characters at every place; a shorter line is one shingle.  Its signature is sixteen MinHash values: the least and
the greatest of its shingle hashes times eight odd numbers.  Lines that agree in a band
of three values are candidates.  First every line is compared with the least line of the buckets it shares
most, and linked if the exact Jaccard similarity of their shingle sets is at least PERCENT / 100.  Distributed
union-find joins links to components, equal lines being one node from the start.  Where lines of a bucket
are in several components still, those outside its largest one are searched in the whole bucket, so that in the end every
two lines of a bucket have been compared or are in one component.  Of every component
the occurrence in the lowest document stays, there the first; all others go.

Splitting, banding, joins and components are DataFrame functions.  Signatures and set comparisons are array
kernels: a shingle at every character is several times over the budget as a DataFrame function (figures in the README).

A bucket is never gathered: its pivot is an aggregate, and a search takes at most CHUNK lines that ask and CHUNK
that are asked, so a bucket of a third of all lines costs one comparison a line if its lines are alike.  A
bucket of many lines that are not alike costs a search for each of them.  The bands find a pair of similarity 0.8 with a
probability of about 0.994, one of 0.9 with 0.9998.  Lines and shingles are known by 64-bit hashes.

Lines without a word are left alone and keep their places; a null or empty text has none.  Rows equal in id and
text count as one document and lose the same lines; ties of equal lines within a document go to the first, null
ids come after all others.  A very long line is worked on alone, in memory in proportion to it.  An empty
table gives an empty result; columns of any other name stay as they are, and a null in them does not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import code_points
from .common import SPACES, checked_join, discard, documents, kept, shielded, ship, text_of
from .components import components
from .similar import Index, linked, needed
from .text_arrays import U64, _stream, buffers, lean, lean_group, mix64

SHINGLE = 12
PERCENT = 80
#: Bands of three of the sixteen values (least 0-7, greatest 8-15), ten of them, evenly dealt.
BANDS = ((0, 9, 6), (1, 10, 7), (2, 11, 8), (3, 12, 5), (4, 13, 15), (5, 14, 0), (6, 15, 1), (7, 8, 2), (9, 3, 14), (10, 4, 13))
#: Lines that a task remembers to have signed.
MET_LINES = 200_000
#: Bytes of lines worked on at once, and pairs compared at once.
SLICE_BYTES = 256 << 10
PAIRS = 512
#: Lines that ask, and lines asked, in one search; lines of small buckets that are searched by one call.
CHUNK = 1024
BUNDLE = 4096
_FACTOR = _stream(8, 53) | U64(1)
_STEP = _stream(4, 59) | U64(1)
_MIX = _stream(4, 61) | U64(1)


def row_key() -> Column:
    return F.xxhash64(F.lit(11), F.col("doc_id"), F.col("text"))


def plain(line: Column) -> Column:
    """A line as its shingles see it."""
    return F.lower(F.btrim(line, F.lit(SPACES)))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, pos, x, l) of every line with a word: the plain line and its hash."""
    rows = docs.select("doc_id", row_key().alias("rk"), F.posexplode(F.split(text_of(F.col("text")), "\n")).alias("pos", "line"))
    return rows.select("doc_id", "rk", "pos", plain(F.col("line")).alias("x")).where("x <> ''").withColumn("l", F.xxhash64("x"))


def shingles(column: pa.Array):
    """For slices of a string column: (first row, hashes of all shingles of its lines, index of each line's first one)."""
    raw, offsets = buffers(column)
    row, n = 0, len(column)
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        stop = min(n, max(stop, row + 1))
        points, at = code_points(raw[offsets[row] : offsets[stop]])
        begin = np.searchsorted(at, offsets[row : stop + 1] - offsets[row])
        size = np.diff(begin)
        # Zeros behind each line keep the runs of neighbours apart and fill up short lines.
        place = np.arange(len(points)) + np.repeat(np.arange(len(size)) * SHINGLE, size)
        h = np.zeros(len(points) + len(size) * SHINGLE, U64)
        h[place] = mix64(points.astype(U64) + U64(1))
        two = h[:-1] * _STEP[0] + h[1:]
        four = two[:-2] * _STEP[1] + two[2:]
        twelve = four[:-8] * _STEP[2] + four[4:-4] * _STEP[3] + four[8:]
        many = np.maximum(size - (SHINGLE - 1), 1)
        first = np.concatenate([[0], np.cumsum(many)])
        take = np.arange(first[-1]) + np.repeat(begin[:-1] + np.arange(len(size)) * SHINGLE - first[:-1], many)
        yield row, mix64(twelve[take]), first
        row = stop


def bands(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """One hash for each band of each line."""
    values, product = [], np.empty_like(h)
    for factor in _FACTOR:
        np.multiply(h, factor, out=product)
        values.append((np.minimum.reduceat(product, first[:-1]), np.maximum.reduceat(product, first[:-1])))
    values = [v[0] for v in values] + [v[1] for v in values]
    return [mix64(values[a] * _MIX[0] + values[b] * _MIX[1] + values[c] * _MIX[2] + U64(k)) for k, (a, b, c) in enumerate(BANDS)]


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, pos, l, bands) of every line with a word; ``bands`` is null for lines that the task met before."""

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            l = batch.column("l").to_numpy()
            if len(met) > MET_LINES:
                met.clear()
            distinct, new = np.unique(l, return_index=True)
            new = new[[x not in met for x in distinct.tolist()]]
            met.update(distinct.tolist())
            parts = [bands(h, first) for _, h, first in shingles(batch.column("x").take(pa.array(new)))]
            own = np.stack([np.concatenate([p[k] for p in parts]) for k in range(len(BANDS))], axis=1).view(np.int64) if parts else np.zeros((0, len(BANDS)), np.int64)
            row = np.full(len(l), -1)
            row[new] = np.arange(len(new))
            lists = pa.ListArray.from_arrays(np.arange(0, own.size + 1, len(BANDS), dtype=np.int32), pa.array(own.ravel()))
            lists = lists.take(pa.array(row, mask=row < 0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rk"), batch.column("pos"), batch.column("l"), lists], ["doc_id", "rk", "pos", "l", "bands"])

    ship(docs.sparkSession)
    return occurrences(docs).mapInArrow(lean(run), "doc_id long, rk long, pos int, l long, bands array<long>")


def line_texts(docs: DataFrame, seen: DataFrame, wanted: DataFrame) -> DataFrame:
    """(l, x): the plain line of every hash in ``wanted`` (a kept table), read from one of its places."""
    place = checked_join(seen.select("l", "rk", "pos"), wanted, "l").groupBy("l").agg(F.min(F.struct("rk", "pos")).alias("p"))
    of_doc = kept(place.groupBy("p.rk").agg(F.collect_list(F.struct("p.pos", "l")).alias("own")))
    rows = checked_join(docs.select(row_key().alias("rk"), "text"), of_doc, "rk")
    rows = rows.select("own", F.split("text", "\n").alias("lines")).select("lines", F.explode("own").alias("o"))
    rows = rows.select(F.col("o.l").alias("l"), plain(F.get("lines", F.col("o.pos"))).alias("x"))
    return rows.dropDuplicates(["l"]) if _repeats(docs) else rows


def _repeats(docs: DataFrame) -> bool:
    """Whether rows equal in id and text occur."""
    return bool(docs.groupBy(row_key()).count().where("count > 1").limit(1).count())


def overlaps(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size of a's set, size of b's, shared shingles) for pairs of lines.

    Each shingle becomes one number of its pair's place and 54 bits of its hash; distinct numbers are counted.
    """

    def keys(column):
        out = []
        for row, h, first in shingles(column):
            out.append((h >> U64(10)) | (np.repeat(np.arange(row, row + len(first) - 1), np.diff(first)).astype(U64) << U64(54)))
        return _distinct(np.sort(np.concatenate(out)))

    x, y, n = keys(a), keys(b), len(a)
    size = lambda k: np.bincount((k >> U64(54)).astype(np.int64), minlength=n)
    either = _distinct(np.sort(np.concatenate([x, y])))
    return size(x), size(y), size(x) + size(y) - size(either)


def _distinct(sorted_keys: np.ndarray) -> np.ndarray:
    return sorted_keys[np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])] if len(sorted_keys) else sorted_keys


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose exact Jaccard similarity is at least PERCENT / 100."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, PAIRS):
                part = batch.slice(k, PAIRS)
                # The lines' lengths alone rule out many pairs only if sets were as long, so all are compared.
                n, m, both = overlaps(part.column("xa"), part.column("xb"))
                keep = pa.array(linked(n, m, both))
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    side = lambda k: texts.select(F.col("l").alias(k), F.col("x").alias(f"x{k}"))
    ship(pairs.sparkSession)
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "xa", "xb").mapInArrow(lean(run), "a long, b long")


def search(node: np.ndarray, comp: np.ndarray, asks: np.ndarray, partners, sure=lambda q, w: True) -> list[tuple[int, int]]:
    """Links between members of a bucket: of the ``partners`` of each one that asks those that are not in
    its component and that ``sure`` confirms.  It ends when all are in one component."""
    parent = {int(c): int(c) for c in np.unique(comp)}

    def find(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links, left = [], len(parent)
    for q in np.flatnonzero(asks).tolist():
        if left == 1:
            break
        for w in partners(q).tolist():
            x, y = find(int(comp[q])), find(int(comp[w]))
            if x != y and sure(q, w):
                parent[x] = y
                left -= 1
                links.append((int(node[q]), int(node[w])))
    return links


def alike(sets: list[np.ndarray], held: np.ndarray):
    """The partners of a member: those held whose sets reach the similarity with its own, by T-occurrence search."""
    rows, size = np.flatnonzero(held), np.array([len(s) for s in sets])
    index = Index([sets[k] for k in rows.tolist()])

    def partners(q):
        hit, both = index.search(sets[q], int(needed(int(size[q]))))
        who = rows[hit]
        return who[linked(size[q], size[who], both)]

    return partners


def by_search(table: pa.Table):
    """(table sorted, start and end of each search) of rows with band, i and j."""
    table = table.sort_by([("band", "ascending"), ("i", "ascending"), ("j", "ascending")])
    band, i, j = (table.column(c).to_numpy() for c in ("band", "i", "j"))
    new = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])) if len(band) else np.zeros(0, np.int64)
    return table, zip(new.tolist(), np.append(new, len(band))[1:].tolist(), strict=True)


def link_table(links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def searched(members: DataFrame) -> DataFrame:
    """Links (a, b) of the searches in ``members`` (bundle, band, i, j, l, c, asks, held, x); a bundle holds whole searches."""

    def run(table):
        table, parts = by_search(table)
        node, comp = (table.column(c).to_numpy() for c in ("l", "c"))
        asks, held = (table.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "held"))
        sets = []
        for _, h, first in shingles(table.column("x")):
            sets += [np.unique(h[p:q]) for p, q in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        links = []
        for p, q in parts:
            links += search(node[p:q], comp[p:q], asks[p:q], alike(sets[p:q], held[p:q]))
        return link_table(links)

    ship(members.sparkSession)
    return members.groupBy("bundle", "i", "j").applyInArrow(lean_group(run), "a long, b long")


def open_buckets(inside: DataFrame, comp: DataFrame) -> DataFrame:
    """(bundle, band, i, j, l, c, asks, held): the searches that are still needed in ``inside`` (band, l).

    Lines of a bucket's largest component ask nothing.  Of buckets with the same lines one is searched.
    """
    marked = inside.join(comp.select(F.col("node").alias("l"), "root"), "l", "left").select("band", "l", F.coalesce("root", "l").alias("c"))
    marked = kept(marked)
    parts = marked.groupBy("band", "c").agg(F.count("*").alias("n"), F.sum(F.pmod("l", F.lit(1 << 31))).alias("s"), F.bit_xor("l").alias("x"))
    whole = parts.groupBy("band").agg(F.max(F.struct("n", "c")).alias("main"), F.sum("n").alias("m"), F.sum("s").alias("s"), F.bit_xor("x").alias("x"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    once = kept(whole.groupBy("m", "s", "x").agg(F.min(F.struct("band", "main")).alias("b")).select("b.band", F.col("b.main.c").alias("main"), "m", (F.col("m") - F.col("b.main.n")).alias("outside")))
    rows = checked_join(marked, once, "band").withColumn("asks", F.col("c") != F.col("main"))
    chunks = lambda n: F.ceil(F.col(n) / CHUNK).cast("int")
    draw = F.pmod(F.xxhash64("l"), F.lit(1 << 30))
    small = F.col("m") <= CHUNK
    zero = F.array(F.lit(0))
    others = lambda n: F.when(small, zero).otherwise(F.sequence(F.lit(0), chunks(n) - 1))
    held = rows.withColumn("j", F.when(small, 0).otherwise(F.pmod(draw, chunks("m"))).cast("int")).withColumn("i", F.explode(others("outside"))).withColumn("held", F.lit(True))
    held = held.withColumn("asks", small & F.col("asks"))
    ask = rows.where("asks").where(~small).withColumn("i", F.pmod(draw, chunks("outside")).cast("int")).withColumn("j", F.explode(others("m"))).withColumn("held", F.lit(False))
    total = once.agg(F.sum(F.when(small, F.col("m")))).first()[0] or 0
    bundle = F.when(small, F.pmod(F.xxhash64("band"), F.lit(1 + total // BUNDLE))).otherwise(F.col("band"))
    return held.unionByName(ask).select(bundle.alias("bundle"), "band", "i", "j", "l", "c", "asks", "held")


def line_components(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """(node, root) of the hashes of lines that are linked to a different line; ``seen`` as from ``signed``."""
    banded = seen.where("bands IS NOT NULL").select("l", F.explode("bands").alias("band"))
    bucket = kept(banded.groupBy("band").agg(F.min("l").alias("lo"), F.max("l").alias("hi")).where("lo <> hi"))
    inside = kept(checked_join(banded, bucket.select("band", "lo"), "band").distinct())
    near = inside.where("l <> lo").groupBy("l", "lo").agg(F.count("*").alias("n"))
    best = near.groupBy("l").agg(F.max(F.struct("n", "lo")).alias("p"))
    texts = kept(line_texts(docs, seen, kept(inside.select("l").distinct())))
    comp = kept(components(verified(best.select(F.col("l").alias("a"), F.col("p.lo").alias("b")), texts)))
    members = open_buckets(inside.select("band", "l"), comp).join(texts, "l")
    links = kept(searched(members))
    if links.limit(1).count():
        comp = kept(components(links.union(comp.select(F.col("node").alias("a"), F.col("root").alias("b")))))
    discard(bucket, inside, texts)
    return comp


def removals(docs: DataFrame) -> DataFrame:
    """(rk, removed): of each document that loses lines, their numbers in order, from 0."""
    seen = kept(signed(docs))
    comp = line_components(docs, seen)
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rk", "pos")
    known = checked_join(seen.drop("bands"), comp.select(F.col("node").alias("l"), "root"), "l", "left").withColumn("c", F.coalesce("root", "l"))
    first = known.groupBy("c").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("c", "first")
    first = kept(first)
    gone = checked_join(known, first, "c").where(place != F.col("first"))
    return gone.groupBy("rk").agg(F.array_sort(F.collect_set("pos")).alias("removed"))


def with_removed(docs: DataFrame) -> DataFrame:
    """Adds ``removed``, the numbers of the lines that go (empty where none do)."""
    found = kept(removals(docs)).select(F.col("rk").alias("_rk"), F.col("removed"))
    out = checked_join(docs.drop("removed").withColumn("_rk", row_key()), found, "_rk", "left").drop("_rk")
    return out.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go, columns as in ``docs``; n_chars follows the text.

    A document of which no word is left goes as well; one that lost nothing stays as it is.
    """
    docs, back = shielded(docs, ("doc_id", "text", "n_chars"))
    rows = with_removed(docs)
    # The numbers that stay are a set difference, so a text costs time in proportion to its lines.
    rows = rows.withColumn("_n", F.size("removed")).withColumn("_lines", F.when(F.col("_n") > 0, F.split("text", "\n")))
    rows = rows.withColumn("_stay", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("removed")))
    left = F.array_join(F.transform("_stay", lambda k: F.get("_lines", k)), "\n")
    rows = rows.withColumn("text", F.when(F.col("_n") > 0, left).otherwise(F.col("text"))).drop("_lines", "_stay")
    rows = rows.where((F.col("_n") == 0) | (F.btrim("text", F.lit(SPACES)) != ""))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_n") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(rows)


def op8_line_dedup(spark, sf_dir) -> DataFrame:
    """Query: of every document, how many lines it has and which of them go.

    One row for each row of the table; repeated rows are one document and lose the same lines, a null or empty text
    has one line, without a word, which stays; an empty table gives no rows."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = with_removed(docs)
    return rows.select(
        "doc_id", F.size(F.split(text_of(F.col("text")), "\n")).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"), F.col("removed"),
    )
