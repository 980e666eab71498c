"""Exact N-gram Jaccard join of documents by T-occurrence search.

Two documents link when their sets of five-word shingles have a Jaccard similarity of at least
PERCENT / 100.  Such sets A and B share at least T(A) = ceil(0.8 |A|) shingles.  The join goes
through steps that each leave out only what cannot link:

1. Documents with equal sets form a class; from here on a class is one node.
2. In the order of the hashes, the first |A| - T(A) + k shingles of either set of a link have at
   least k in common.  Nodes keep on that have enough shingles in that prefix which some
   other node's prefix has as well.
3. Of those, nodes keep on that share at least T(A) of all their shingles with any others.
4. With the rarest first (shingles of COMMON nodes and more count as one), links share one of the first |A| - T(A) + 1 shingles.  Nodes
   that do are searched against each other by DivideSkip (``search``): short inverted
   lists are merged, long ones probed by binary search (the merge counts members in an array, not
   with a heap: same counts, and the README has what a heap costs).  First every node goes with the
   least node of the lists it shares most, in chunks; then nodes in lists that still hold
   different components go chunk against chunk.

Shingle counts travel as sorted arrays, pre-aggregated by batch: a shingle that a batch holds
several times is counted there and sent once, so a shingle of all documents makes one
entry a batch.  No step gathers a group, and links between documents already in one component,
which change nothing, are not looked for.

A null or empty text, or one without words, has an empty set and links with nothing.  Rows equal in id and
text, equal ids and null ids are rows of their own; a component's id is its least non-null one.  Words of any
length count whole.  An empty table gives an empty result; other columns stay as they are.  Shingles are
known by 64-bit hashes, sets by 128-bit digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import groups
from .common import checked_join, cut, discard, documents, shielded, ship, stored
from .components import components
from .text_arrays import U64, lean, lean_group, lean_key_group, shingles, words

WIDTH = 5
PERCENT = 80
#: Postings in a bucket, about, and members of a chunk that is searched at once.
BUCKET_POSTINGS = 400_000
#: Shingles that a task gathers before it sends them.
HELD_SHINGLES = 1_500_000
CHUNK = 2048
#: Followers of a list's least node that are searched at once with it.
FAN = 256
#: Nodes of a block of connected lists that is searched as a whole.
BLOCK = 8192
#: Lists at least so long are set aside and probed.
LONG_LIST = 1024
#: Shingles of so many nodes or more count as equally common.
COMMON = 64
#: Entries of a long list that cost as much to merge as one of its members costs to look up.
PROBE = 16
#: Balance of DivideSkip between merging and probing, a fixed value of the published method.
MU = 0.0085


def needed(n):
    """T: shingles that a set of n shares at least with any set it links with."""
    return (n * PERCENT + 99) // 100


def prefix_need(n):
    """k of step 2 for the smallest set that could link with a set of n."""
    return np.maximum(1, needed(n) // 10)


def prefix_length(n):
    return np.minimum(n, n - needed(n) + np.maximum(1, n // 10))


def sets_of(column):
    """The sorted set of shingle hashes of each text of a column."""
    for _, raw, offsets in groups(column):
        h, at = shingles(*words(raw, offsets), WIDTH)
        for d in range(len(at) - 1):
            yield np.unique(h[at[d] : at[d + 1]])


def row_key() -> Column:
    return F.xxhash64(F.lit(3), F.col("doc_id"), F.col("text"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, n, sig): size and digest of every text's set; no digest where it is empty."""

    def run(batches):
        for batch in batches:
            n, sig = [], []
            for s in sets_of(batch.column("text")):
                n.append(len(s))
                sig.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rk"), pa.array(n, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "rk", "n", "sig"])

    ship(docs.sparkSession)
    return docs.select("doc_id", row_key().alias("rk"), "text").mapInArrow(lean(run), "doc_id long, rk long, n long, sig binary")


_BLOCK = "bucket long, toks binary, nodes binary"


def _blocks(pairs, bucket_count: int, prefix: bool):
    """Rows of _BLOCK for (node, set) pairs: postings by bucket, sorted by shingle; and with a
    negative bucket those whose shingle the batch alone holds often enough (twice for step 2,
    COMMON times for step 3) for all that has to be known of it."""
    node = np.array([k for k, _ in pairs], np.int64)
    size = np.array([len(s) for _, s in pairs], np.int64)
    take = prefix_length(size) if prefix else size
    tok = np.concatenate([s[:t] for (_, s), t in zip(pairs, take, strict=True)]) if pairs else np.zeros(0, U64)
    own = np.repeat(node, take)
    order = np.lexsort((own, tok))
    tok, own = tok[order], own[order]
    new = np.ones(len(tok), bool)
    new[1:] = (tok[1:] != tok[:-1]) | (own[1:] != own[:-1])
    tok, own = tok[new], own[new]
    first = np.ones(len(tok), bool)
    first[1:] = tok[1:] != tok[:-1]
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(tok)))
    many = np.repeat(count >= (2 if prefix else COMMON), count)
    if many.any():
        yield -1 - int(own[many][0] % bucket_count), tok[many].tobytes(), own[many].tobytes()
        # One entry without a node stands for all of them in the shingle's bucket.
        keep = ~many | first
        tok, own = tok[keep], np.where(many, np.int64(-1), own)[keep]
    bucket = (tok % U64(bucket_count)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, tok, own = bucket[order], tok[order], own[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    for a, b in zip(at.tolist(), np.append(at, len(bucket))[1:].tolist(), strict=True):
        yield int(bucket[a]), tok[a:b].tobytes(), own[a:b].tobytes()


def _postings(docs: DataFrame, nodes: DataFrame, bucket_count: int, prefix: bool) -> DataFrame:
    """Blocks of the sets of the rows of ``docs`` whose key is in ``nodes`` (rk, node)."""

    def flushed(pairs):
        rows = list(_blocks(pairs, bucket_count, prefix))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["bucket", "toks", "nodes"])

    def run(batches):
        pairs, held = [], 0
        for batch in batches:
            for k, s in zip(batch.column("node").to_pylist(), sets_of(batch.column("text")), strict=True):
                pairs.append((k, s))
                held += len(s)
                if held > HELD_SHINGLES:
                    yield flushed(pairs)
                    pairs, held = [], 0
        if pairs:
            yield flushed(pairs)

    ship(docs.sparkSession)
    rows = checked_join(docs.select(row_key().alias("rk"), "text"), nodes.select("rk", "node"), "rk")
    return rows.select("node", "text").mapInArrow(lean(run), _BLOCK)


def _read(table: pa.Table):
    toks = np.frombuffer(b"".join(table.column("toks").to_pylist()), U64)
    nodes = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)
    return toks, nodes


def _shared_counts(blocks: DataFrame) -> DataFrame:
    """(node, shared): in how many of its postings a node meets another node."""

    def run(key, table):
        toks, nodes = _read(table)
        if key[0].as_py() >= 0:
            order = np.argsort(toks, kind="stable")
            toks, nodes = toks[order], nodes[order]
            same = np.zeros(len(toks), bool)
            same[1:] = toks[1:] == toks[:-1]
            same[:-1] |= same[1:].copy()
            nodes = nodes[same & (nodes >= 0)]
        node, count = np.unique(nodes, return_counts=True)
        return pa.table({"node": pa.array(node, pa.int64()), "part": pa.array(count, pa.int64())})

    parts = blocks.groupBy("bucket").applyInArrow(lean_key_group(run), "node long, part long")
    return parts.groupBy("node").agg(F.sum("part").alias("shared"))


def _shared_sets(blocks: DataFrame) -> DataFrame:
    """(node, part): of each bucket, a node's shingles that other nodes have too, each with
    the number of nodes that have it, COMMON at most."""

    def run(key, table):
        toks, nodes = _read(table)
        if key[0].as_py() < 0:
            df = np.full(len(toks), COMMON, U64)
        else:
            order = np.argsort(toks, kind="stable")
            toks, nodes = toks[order], nodes[order]
            start = np.flatnonzero(np.concatenate([[True], toks[1:] != toks[:-1]])) if len(toks) else np.zeros(0, np.int64)
            count = np.diff(np.append(start, len(toks)))
            weight = np.add.reduceat(np.where(nodes < 0, COMMON, 1), start) if len(toks) else count
            df = np.minimum(np.repeat(weight, count), COMMON)
            keep = (df > 1) & (nodes >= 0)
            toks, nodes, df = toks[keep], nodes[keep], df[keep].astype(U64)
        order = np.lexsort((toks, nodes))
        both = np.stack([toks[order], df[order]], axis=1)
        nodes = nodes[order]
        at = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else np.zeros(0, np.int64)
        parts = [both[a:b].tobytes() for a, b in zip(at.tolist(), np.append(at, len(nodes))[1:].tolist(), strict=True)]
        return pa.table({"node": pa.array(nodes[at], pa.int64()), "part": pa.array(parts, pa.binary())})

    return blocks.groupBy("bucket").applyInArrow(lean_key_group(run), "node long, part binary")


class Index:
    """Inverted lists over the sets of a chunk of nodes."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets], np.int64)
        tok = np.concatenate(sets) if sets else np.zeros(0, U64)
        own = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(tok, kind="stable")
        tok, self.members = tok[order], own[order]
        self.start = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]])) if len(tok) else np.zeros(0, np.int64)
        self.tok = tok[self.start]
        self.length = np.diff(np.append(self.start, len(tok)))
        self.count = len(sets)
        self.places = np.repeat(np.arange(len(self.start)), self.length) * self.count + self.members

    def search(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Members with at least ``least`` shingles of ``query``, and how many (DivideSkip).

        At most L of the longest lists are set aside.  A member of the answer is in least - L of the
        others, which are merged; those that are get looked up in the long ones by binary search.
        """
        if not len(self.tok) or least < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.tok, query), len(self.tok) - 1)
        at = at[self.tok[at] == query]
        if len(at) < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        long = at[self.length[at] >= LONG_LIST]
        if len(long):
            # The method's bound for L, and a quarter of T, so that merging leaves few to look up.
            most = min(least // 4, len(long), int(least / (MU * np.log2(int(self.length[long].max()) + 1) + 1)))
            long = long[np.argsort(-self.length[long], kind="stable")][:most]
        short, aside = np.setdiff1d(at, long, assume_unique=True), len(long)
        size = self.length[short]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        found = np.bincount(self.members[np.repeat(self.start[short], size) + place], minlength=self.count)
        out = np.flatnonzero(found >= least - aside)
        found = found[out]
        if aside and len(out) * PROBE > int(self.length[long].mean()):
            # So many members are still in question that merging the long lists as well is the cheaper way.
            size = self.length[long]
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            found = found + np.bincount(self.members[np.repeat(self.start[long], size) + place], minlength=self.count)[out]
            out, found = out[found >= least], found[found >= least]
        elif aside and len(out):
            # One binary search for each member still in question and each long list, all at once.
            wanted = (long[None, :] * self.count + out[:, None]).ravel()
            p = np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)
            found = found + (self.places[p] == wanted).reshape(len(out), aside).sum(axis=1)
            out, found = out[found >= least], found[found >= least]
        return out, found


def linked(n_a, n_b, both):
    """Whether sets of these sizes with ``both`` shingles in common reach the similarity."""
    return 100 * both >= PERCENT * (n_a + n_b - both)


def _search_groups(members: DataFrame) -> DataFrame:
    """Links (a, b) among members (g, i, j, node, comp, n, toks, asks, held, first): in each group the rows that
    ask are searched in the rows held, leaving out those of their own component."""

    def run(table):
        table = table.sort_by([("first", "descending")])  # a list's least node is likeliest to reach all
        node, comp, n = (table.column(c).to_numpy() for c in ("node", "comp", "n"))
        toks = [np.frombuffer(x, U64) for x in table.column("toks").to_pylist()]
        asks, held = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False)), np.flatnonzero(table.column("held").to_numpy(zero_copy_only=False))
        index = Index([toks[k] for k in held.tolist()])
        parent = {int(c): int(c) for c in np.unique(comp)}

        def find(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        a, b, left = [], [], len(parent)
        for q in asks.tolist():
            if left == 1:
                break
            hit, both = index.search(toks[q], int(needed(int(n[q]))))
            who = held[hit]
            ok = linked(int(n[q]), n[who], both) & (node[who] != node[q])
            for w in who[ok].tolist():
                x, y = find(int(comp[q])), find(int(comp[w]))
                if x != y:
                    parent[x] = y
                    left -= 1
                    a.append(int(node[q]))
                    b.append(int(node[w]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ship(members.sparkSession)
    return members.groupBy("g", "i", "j").applyInArrow(lean_group(run), "a long, b long")


def links_of(postings: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of different sets that join the same nodes as all links do.

    ``postings`` (tok, node, n): rare-first prefixes; ``sets`` (node, n, toks): shared shingles.
    """
    # With the least node of the lists it shares most: one chunk holds that node's followers.
    least = postings.groupBy("tok").agg(F.min("node").alias("pivot"), F.count("*").alias("m")).where("m > 1")
    near = postings.join(least, "tok").where(F.col("node") != F.col("pivot")).groupBy("node", "pivot").agg(F.count("*").alias("c"))
    best = cut(near.groupBy("node").agg(F.max(F.struct("c", (-F.col("pivot")).alias("p"))).alias("x")).select("node", (-F.col("x.p")).alias("pivot")))
    fans = best.groupBy("pivot").agg(F.count("*").alias("fans"))
    fans = fans.withColumn("chunks", F.ceil(F.col("fans") / FAN).cast("long"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    followers = best.join(fans, "pivot").select("pivot", "node", chunk.alias("i"), F.lit(False).alias("lead"))
    leaders = fans.select("pivot", F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("i"), F.lit(True).alias("lead"))
    rows = followers.union(leaders).join(sets, "node")
    rows = rows.select(
        F.col("pivot").alias("g"), "i", F.lit(0).cast("long").alias("j"), "node", F.col("node").alias("comp"), "n", "toks",
        F.col("lead").alias("asks"), F.lit(True).alias("held"), F.col("lead").alias("first"),
    )
    found = cut(_search_groups(rows))
    # Lists that still hold more than one component: those that share nodes make a block, and a
    # block's nodes are searched against each other once.  In a block that is too large for one task
    # each list is searched by itself, chunk against chunk.
    comp = components(found)
    marked = cut(postings.join(comp, "node", "left").select("tok", "node", "n", F.coalesce("root", "node").alias("comp")))
    mixed = marked.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.min("node").alias("least")).where("lo <> hi")
    rest = cut(marked.join(mixed.select("tok", "m", "least"), "tok"))
    block = components(rest.select("node", F.col("least").alias("other"))).select("node", F.col("root").alias("block"))
    block = block.join(block.groupBy("block").agg(F.count("*").alias("size")), "block")
    yes, zero = F.lit(True), F.lit(0).cast("long")
    near = block.where(F.col("size") <= BLOCK).select(F.col("block").alias("g"), zero.alias("i"), F.lit(-1).cast("long").alias("j"), "node", yes.alias("asks"), yes.alias("held"))
    far = rest.join(block.where(F.col("size") > BLOCK), "node").withColumn("chunks", F.ceil(F.col("m") / CHUNK).cast("long"))
    far = far.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks"))).withColumn("other", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    far = far.select(
        F.col("tok").alias("g"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node",
        (F.col("own") <= F.col("other")).alias("asks"), (F.col("own") >= F.col("other")).alias("held"),
    )
    again = near.union(far).join(sets, "node").join(comp.withColumnRenamed("root", "comp"), "node", "left")
    again = again.select("g", "i", "j", "node", F.coalesce("comp", "node").alias("comp"), "n", "toks", "asks", "held", F.lit(False).alias("first"))
    return found.union(cut(_search_groups(again)))


def join_similar(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc_id, rk, n, sig) of every row, (sig, component_id) of classes that are not alone).

    ``docs`` needs doc_id and text.  A null or empty text, or one without words, has an empty set
    and links with nothing.  Rows with the same id or a null one are rows of their own; the
    component's id is its least non-null one.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(classes(docs), "similar-rows")
    salt = 0
    while True:  # a node is a 64-bit hash of the digest, of another one if two classes meet
        cls = rows.where("n > 0").groupBy("sig").agg(F.min("rk").alias("rk"), F.min("doc_id").alias("low"), F.max("n").alias("n"), F.count("*").alias("copies"))
        cls = stored(cls.withColumn("node", F.shiftrightunsigned(F.xxhash64(F.lit(salt), "sig"), 1)), "similar-classes")
        if not cls.groupBy("node").count().where("count > 1").limit(1).count():
            break
        salt += 1
    total = cls.agg(F.sum("n")).first()[0] or 0
    met = _shared_counts(_postings(docs, cls, 16 + int(0.3 * total) // BUCKET_POSTINGS, True))
    need = F.greatest(F.lit(1), F.expr(f"((n * {PERCENT} + 99) div 100) div 10"))
    some = cut(cls.join(met, "node").where(F.col("shared") >= need).select("node", "rk", "n"))
    total = some.agg(F.sum("n")).first()[0] or 0
    parts = _shared_sets(_postings(docs, some, 16 + total // BUCKET_POSTINGS, False))
    kept = some.select("node", "n").join(parts.groupBy("node").agg(F.collect_list("part").alias("parts"), F.sum(F.expr("length(part) div 16")).alias("shared")), "node")
    kept = kept.where(F.col("shared") >= F.expr(f"(n * {PERCENT} + 99) div 100")).select("node", "n", "parts")

    def order(batches):
        for batch in batches:
            toks, first = [], []
            for n, parts in zip(batch.column("n").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                both = np.frombuffer(b"".join(parts), U64).reshape(-1, 2)
                tok, at = np.unique(both[:, 0], return_index=True)  # rows equal in id and text send a node twice
                df = both[at, 1]
                toks.append(tok.tobytes())
                first.append(tok[np.lexsort((tok, df))[: max(0, len(tok) - int(needed(n)) + 1)]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(toks, pa.binary()), pa.array(first, pa.list_(pa.int64()))], ["node", "n", "toks", "first"])

    sets = stored(kept.mapInArrow(lean(order), "node long, n long, toks binary, first array<long>"), "similar-sets")
    links = links_of(sets.select(F.explode("first").alias("tok"), "node", "n"), sets.select("node", "n", "toks"))
    comp = components(links)
    low = comp.join(cls.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component_id"))
    together = comp.join(low, "root").select("node", "component_id")
    groups_ = cut(cls.join(together, "node", "left").where("copies > 1 OR component_id IS NOT NULL").select("sig", F.coalesce("component_id", "low").alias("component_id")))
    discard(cls, sets)
    return rows, groups_


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that link, directly or over others, with one of lower id:
    one row of each component stays, columns as in ``docs``."""
    docs, back = shielded(docs, ("doc_id", "text"))
    rows, found = join_similar(docs)
    inside = checked_join(rows.where("n > 0"), found, "sig").select("doc_id", "rk", F.col("component_id").alias("c"), "sig")
    inside = stored(inside.withColumn("c", F.coalesce(F.col("c").cast("string"), F.hex("sig"))), "similar-members")
    key = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rk")
    stay = inside.groupBy("c").agg(F.min(key).alias("k")).select(F.col("c"), F.col("k.rk").alias("keep"))
    gone = cut(inside.join(stay, "c").where(F.col("rk") != F.col("keep")).select("rk").distinct())
    out = checked_join(docs.withColumn("_rk", row_key()), gone.withColumnRenamed("rk", "_rk"), "_rk", "left_anti")
    if inside.groupBy("rk").count().where("count > 1").limit(1).count():  # rows equal in id and text
        many = cut(inside.groupBy("rk").count().where("count > 1").select(F.col("rk").alias("_rk")))
        once = checked_join(out, many, "_rk", "left_semi").dropDuplicates(["_rk"])
        out = checked_join(out, many, "_rk", "left_anti").unionByName(once)
    return back(out)


def op10_ngram_jaccard(spark, sf_dir) -> DataFrame:
    """Contract query: set size and component of every document.

    One row for each row of the table, repeated rows included; a null or empty text has no set and is its own
    component, a null id takes part but is no component's id, an empty table gives no rows."""
    rows, found = join_similar(documents(spark, sf_dir))
    out = checked_join(rows, found, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
