"""Substring dedup: repeated passages anywhere in a text, found by paragraph MinHash banding.

Passages need not start or end with a line, so a text's paragraphs are cut by content: after
every word whose hash is the least within RADIUS words on either side, and around repeats of one word.  A passage of fifty words
holds several whole paragraphs wherever it stands.  Equal paragraphs are one node.  Others become
candidates in two ways: one of BANDS MinHash values of their five-word shingles agrees, or the paragraphs
before and after them are equal, which finds a word changed inside a passage, where a paragraph keeps few
shingles.  Candidates are linked if the exact Jaccard similarity of their shingles, or one
minus the exact edit distance of their words over the words of the longer, is at least PERCENT / 100.

First every paragraph is compared with the least one of the buckets it shares most.  Paragraphs of buckets that
then hold several components still are searched by an exact prefix filter: two sets of the similarity share
one of the first shingles of either, rarest first, so that a phrase common to many unlike paragraphs makes no
long list.  Union-find makes components of the links.  Neighbouring paragraphs
of a document whose components occur in another document too make up a passage if they have at least
MIN_WORDS words together.  The occurrence in the lowest document is kept, others are for removal.

One band of one value suffices for each of three chances: a pair of similarity 0.8 is found with
a probability of 0.992.  Buckets are only ever aggregated, so a paragraph of all documents costs two
comparisons for each of its variants.

A null or empty text has no paragraph.  Rows equal in id and text count as one document, so repeats within
one document are not passages; rows with equal ids and other texts, or null ids, are documents of their own.
Among equal occurrences the lowest id is kept, then the lowest hash of the row.  A very long text is worked on
alone.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import token_distance

from .bpe import groups
from .common import checked_join, cut, discard, documents, ship, stored
from .components import components
from .lines import alike, by_search, link_table, open_buckets, search
from .similar import Index
from .text_arrays import U64, _stream, lean, lean_group, mix64, shingles, words

RADIUS = 5
WIDTH = 5
PERCENT = 80
#: MinHash values, and with the neighbours' value the bands.
BANDS = 3
#: Words of whole paragraphs that a passage has at least; up to about eleven more at either
#: end lie in paragraphs that its surroundings cut differently.
MIN_WORDS = 20
#: Paragraphs of more words (runs of few different words have them) are compared by their shingles alone.
EDIT_WORDS = 64
#: Candidate paragraphs whose hashes are sent to the workers; beyond it they are joined.
FEW = 1_000_000
_SEED = _stream(BANDS, 41) | U64(1)


def row_key() -> Column:
    return F.xxhash64(F.lit(17), F.col("doc_id"), F.col("text"))


def cuts(h: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Marks the words that start a paragraph."""
    n = len(h)
    start = np.zeros(n, bool)
    first = index[:-1][index[:-1] < index[1:]]
    start[first] = True
    if n < 2:
        return start
    text = np.zeros(n, np.int64)
    text[first] = 1
    text = np.cumsum(text)
    least = np.ones(n, bool)
    for k in range(1, RADIUS + 1):
        if n <= k:
            break
        same = text[k:] == text[:-k]
        least[k:] &= ~same | (h[k:] < h[:-k])
        least[:-k] &= ~same | (h[:-k] <= h[k:])
    after = np.flatnonzero(least[:-1]) + 1
    start[after] = True
    # Repeats of one word have no least hash: such a run is a paragraph of its own.
    if n > 3:
        equal = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        three = equal[1:] & equal[:-1]
        start[np.flatnonzero(three[:-1] & ~equal[2:]) + 3] = True
        start[np.flatnonzero(three[1:] & ~equal[:-2]) + 1] = True
    return start


def paragraphs_of(column):
    """For slices of a string column: (first row, word index of each paragraph, its number of words,
    its text, its hash, its shingles, index of its first shingle, code-point span, word hashes, index of its first)."""
    for row, raw, offsets in groups(column):
        h, index, begin, end = words(raw, offsets, spans=True)
        if not len(h):
            continue
        at = np.flatnonzero(cuts(h, index))
        size = np.diff(np.append(at, len(h)))
        s, first = shingles(h, np.append(at, len(h)), WIDTH)
        place = np.arange(len(h)) - np.repeat(at, size)
        whole = mix64(np.add.reduceat(h * (mix64(place.astype(U64)) | U64(1)), at) + size.astype(U64))
        text = np.searchsorted(index, at, "right") - 1
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        origin = points[offsets[text]]
        yield row, at - index[text], size, text, whole, s, first, points[begin[at]] - origin, points[end[at + size - 1]] - origin, h, at


def between(whole: np.ndarray, new: np.ndarray) -> np.ndarray:
    """A hash of the paragraphs before and after each one; of itself at a text's start or end."""
    inner = ~new & ~np.append(new[1:], True)
    before, after = np.roll(whole, 1), np.roll(whole, -1)
    return np.where(inner, mix64(before * U64(0x9E3779B97F4A7C15) + (after ^ (after >> U64(31)))), whole)


def pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, pos, word, n, a, b, ph, b0..) of every paragraph: its number in the text, first word, words,
    code-point span, hash and MinHash values.  Null and empty texts have none."""
    names = ["doc_id", "rk", "pos", "word", "n", "a", "b", "ph", *[f"b{k}" for k in range(BANDS + 1)]]

    def run(batches):
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("rk")
            for row, word, size, text, whole, s, first, a, b, _, _ in paragraphs_of(batch.column("text")):
                new = np.concatenate([[True], text[1:] != text[:-1]])
                start = np.flatnonzero(new)
                pos = np.arange(len(text)) - np.repeat(start, np.diff(np.append(start, len(text))))
                low = [np.minimum.reduceat(mix64(s * seed), first[:-1]) for seed in _SEED]
                low.append(between(whole, new))
                take = pa.array(text + row)
                numbers = [pos, word, size, a, b, whole.view(np.int64), *[mix64(x + U64(k)).view(np.int64) for k, x in enumerate(low)]]
                yield pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), *[pa.array(x.astype(np.int64)) for x in numbers]], names)

    ship(docs.sparkSession)
    return docs.select("doc_id", row_key().alias("rk"), "text").mapInArrow(lean(run), ", ".join(f"{n} long" for n in names))


def contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(ph, s, w): shingle set and word hashes (none beyond EDIT_WORDS) of the paragraphs whose hash is in ``wanted`` (a stored table)."""

    def run(batches):
        wanted_ = None if known is None else known.value
        sent = None if known is None else np.zeros(len(wanted_), bool)
        for batch in batches:
            for _, _, size, _, whole, s, first, _, _, h, at in paragraphs_of(batch.column("text")):
                ph = whole.view(np.int64)
                keep = np.arange(len(ph))
                if wanted_ is not None and len(wanted_):
                    place = np.minimum(np.searchsorted(wanted_, ph), len(wanted_) - 1)
                    keep = np.flatnonzero((wanted_[place] == ph) & ~sent[place])  # once for each task
                    sent[place[keep]] = True
                sets = [np.unique(s[first[k] : first[k + 1]]).view(np.int64) for k in keep.tolist()]
                own = [h[at[k] : at[k] + size[k]].view(np.int64) if size[k] <= EDIT_WORDS else h[:0].view(np.int64) for k in keep.tolist()]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ph[keep]), pa.array(sets, longs), pa.array(own, longs)], ["ph", "s", "w"])

    known = None
    if wanted.limit(FEW + 1).count() <= FEW:
        # Few enough hashes (8 bytes each) go to the workers as one array; else all sets go through a join.
        hashes = np.sort(wanted.toArrow().column("ph").to_numpy())
        known = ship(docs.sparkSession).sparkContext.broadcast(hashes)
    ship(docs.sparkSession)
    rows = docs.select("text").mapInArrow(lean(run), "ph long, s array<long>, w array<long>")
    if known is None:
        rows = rows.join(wanted.hint("merge"), "ph", "left_semi")
    return rows.groupBy("ph").agg(F.first("s").alias("s"), F.first("w").alias("w"))


def verified(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of the pairs (x, y) that are similar enough by their shingles or by their words."""
    side = lambda k: known.select(F.col("ph").alias(k), F.col("s").alias(f"s{k}"), F.col("w").alias(f"w{k}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    shared = F.size(F.array_intersect("sx", "sy"))
    by_set = (100 + PERCENT) * shared >= PERCENT * (F.size("sx") + F.size("sy"))
    least, most = F.least(F.size("wx"), F.size("wy")), F.greatest(F.size("wx"), F.size("wy"))
    near = (least > 0) & (100 * least >= PERCENT * most)
    by_words = F.when(near, 100 * token_distance(F.col("wx"), F.col("wy")) <= (100 - PERCENT) * most).otherwise(False)
    return both.where(by_set | by_words).select("x", "y")


def rarest(postings: DataFrame, spare) -> DataFrame:
    """(ph, size, t): the first tokens of each set in ``postings`` (g, ph, size, n, t), rarest first.

    ``n`` is the number of tokens of the set of ph in g.  A similar set lacks at most ``spare`` of them, so
    it shares one of the first spare + 1; those that no other set has come first and make no list.
    """
    common = postings.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    ranked = checked_join(postings, cut(common), "t").groupBy("g", "ph", "size", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("own"))
    take = F.size("own") - F.col("n") + spare + 1
    return ranked.where(take > 0).select("ph", "size", F.explode(F.slice("own", 1, F.greatest(take, F.lit(1)))).alias("o")).select("ph", "size", F.col("o.t").alias("t"))


def edits(a: list[int], b: list[int]) -> int:
    """The edit distance of two short sequences."""
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def searched(members: DataFrame) -> DataFrame:
    """Links (a, b) of the searches in ``members`` (bundle, band, i, j, l, c, asks, held, s, w): by shingles, or by words where the band is odd."""

    def run(table):
        table, parts = by_search(table)
        band, node, comp = (table.column(c).to_numpy() for c in ("band", "l", "c"))
        asks, held = (table.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "held"))
        sets, words_ = ([np.array(x, np.int64).view(U64) for x in table.column(c).to_pylist()] for c in ("s", "w"))
        links = []
        for p, q in parts:
            if band[p] & 1 == 0:
                links += search(node[p:q], comp[p:q], asks[p:q], alike(sets[p:q], held[p:q]))
                continue
            own = words_[p:q]
            distinct, rows = [np.unique(x) for x in own], np.flatnonzero(held[p:q])
            index = Index([distinct[k] for k in rows.tolist()])

            def partners(k, own=own, distinct=distinct, rows=rows, index=index):
                return rows[index.search(distinct[k], max(1, len(distinct[k]) - len(own[k]) * (100 - PERCENT) // PERCENT))[0]]

            def sure(k, m, own=own):
                most = max(len(own[k]), len(own[m]))
                return 100 * min(len(own[k]), len(own[m])) >= PERCENT * most and 100 * edits(own[k].tolist(), own[m].tolist()) <= (100 - PERCENT) * most

            links += search(node[p:q], comp[p:q], asks[p:q], partners, sure)
        return link_table(links)

    ship(members.sparkSession)
    return members.groupBy("bundle", "i", "j").applyInArrow(lean_group(run), "a long, b long")


def settled(inside: DataFrame, known: DataFrame, comp: DataFrame) -> DataFrame:
    """``comp`` after all similar paragraphs of each band in ``inside`` (k, band, ph) are in one component.

    Paragraphs of bands with several components are listed by the first of their shingles, and where the
    band is that of equal neighbours by the first of their words: rarest first, any two similar
    ones share one of them.  In each list those outside its largest component are searched in the whole list.
    """
    marked = inside.join(comp.select(F.col("node").alias("ph"), "root"), "ph", "left").withColumn("c", F.coalesce("root", "ph"))
    several = marked.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("band")
    open_ = stored(checked_join(inside, cut(several), "band"), "passage-open")
    sets = known.select("ph", "s").join(open_.select("ph").distinct(), "ph")
    by_set = rarest(sets.select(F.lit(0).cast("long").alias("g"), "ph", F.size("s").alias("size"), F.size("s").alias("n"), F.explode("s").alias("t")), F.floor(F.col("n") * (100 - PERCENT) / 100).cast("int"))
    own = open_.where(F.col("k") == BANDS).select(F.col("band").alias("g"), "ph").distinct().join(known.select("ph", "w"), "ph").where(F.size("w") > 0)
    own = own.select("g", "ph", F.size("w").alias("size"), F.array_distinct("w").alias("d"))
    own = own.select("g", "ph", "size", F.size("d").alias("n"), F.explode("d").alias("x")).withColumn("t", F.xxhash64("g", "x")).drop("x")
    # An edit distance of a fifth of the longer's words loses a quarter of the shorter's at most.
    by_word = rarest(own, F.floor(F.col("size") * (100 - PERCENT) / PERCENT).cast("int"))
    kind = lambda df, bit: df.select(F.shiftleft("t", 1).bitwiseOR(F.lit(bit).cast("long")).alias("band"), F.col("ph").alias("l")).distinct()
    lists = stored(kind(by_set, 0).union(kind(by_word, 1)), "passage-lists")
    members = open_buckets(lists, comp).join(known.withColumnRenamed("ph", "l"), "l")
    links = cut(searched(members))
    discard(open_, lists)
    if not links.limit(1).count():
        return comp
    return cut(components(links.union(comp.select(F.col("node").alias("a"), F.col("root").alias("b")))))


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, rk, passage, word, n_words, start, end, cluster, kept) of every repeated passage.

    ``word`` is its first word's number, ``start`` and ``end`` its code-point span, ``cluster`` the
    least component of its paragraphs.  ``kept`` says that its paragraphs occur in no lower document (null
    ids are highest); a run of repeated paragraphs is cut in passages where that changes, and those of fewer than
    ``min_words`` words stay with their run.  Rows equal in id and text count as one document.
    """
    docs = docs.select("doc_id", "text")
    table = stored(pieces(docs), "passage-pieces")
    bands = table.select("ph", F.posexplode(F.array(*[f"b{k}" for k in range(BANDS + 1)])).alias("k", "band"))
    bucket = stored(bands.groupBy("band").agg(F.min("ph").alias("lo"), F.max("ph").alias("hi")).where("lo <> hi"), "passage-buckets")
    inside = stored(checked_join(bands, bucket.drop("hi"), "band").distinct(), "passage-inside")
    discard(bucket)
    near = inside.where("ph <> lo").groupBy("ph", "lo").agg(F.count("*").alias("n")).groupBy("ph").agg(F.max(F.struct("n", "lo")).alias("p"))
    pairs = near.select(F.col("ph").alias("x"), F.col("p.lo").alias("y"))
    known = stored(contents(docs, cut(inside.select("ph").distinct())), "passage-contents")
    comp = cut(components(verified(pairs, known)))
    comp = settled(inside.select("k", "band", "ph"), known, comp).select(F.col("node").alias("ph"), "root")
    discard(inside, known)
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rk")
    slim = table.select("doc_id", "rk", "pos", "word", "n", "a", "b", "ph")
    by_hash = slim.groupBy("ph").agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
    of_comp = checked_join(by_hash, comp, "ph", "left").withColumn("c", F.coalesce("root", "ph"))
    alone = of_comp.where("root IS NULL AND lo <> hi").select("ph", "c", F.col("lo.rk").alias("first"))
    joint = of_comp.where("root IS NOT NULL")
    wide = joint.groupBy("c").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first <> last")
    repeated = stored(alone.union(joint.select("ph", "c").join(wide.select("c", F.col("first.rk").alias("first")), "c").select("ph", "c", "first")), "passage-repeats")
    found = checked_join(slim, repeated, "ph")
    # Neighbours: within a document, paragraph number less rank is constant along a run.
    own = W.partitionBy("rk").orderBy("pos")
    found = found.dropDuplicates(["rk", "pos"]).withColumn("passage", F.col("pos") - F.row_number().over(own)).withColumn("kept", F.col("first") == F.col("rk"))
    whole = W.partitionBy("rk", "passage")
    found = found.withColumn("all", F.sum("n").over(whole)).where(F.col("all") >= min_words)
    # A run is cut where paragraphs that occur here first meet others, so that every paragraph is kept somewhere.
    found = found.withColumn("part", F.col("pos") - F.row_number().over(W.partitionBy("rk", "passage", "kept").orderBy("pos")))
    out = found.groupBy("rk", "passage", "kept", "part").agg(
        F.first("doc_id").alias("doc_id"), F.min("word").alias("word"), F.sum("n").alias("n_words"), F.min("a").alias("start"), F.max("b").alias("end"), F.min("c").alias("cluster"), F.first("all").alias("all"),
    )
    short = (F.col("n_words") < min_words) & (F.col("n_words") < F.col("all"))
    return out.select("doc_id", "rk", "passage", "word", "n_words", "start", "end", "cluster", (F.col("kept") | short).alias("kept"))


def op2_substring_dedup(spark, sf_dir) -> DataFrame:
    """Query: every passage that other documents have too, and whether it is the one to keep.

    A null or empty text, and an empty table, have no passages; repeated rows are one document, null ids are the highest."""
    found = passages(documents(spark, sf_dir))
    return found.select("doc_id", "word", "n_words", "start", "end", "cluster", "kept")
