"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with a bounded sample of its
labelled training texts, in lower case.  A text is encoded with every dictionary; the language of the
smallest encoding wins, the commoner language among equals.  Code lengths give the score: the share of
the winner when every language has the probability 2 ** -bits.  ``lang_sure`` rejects (``und``) where the
winner's margin over the next is narrower than MIN_MARGIN of the next's size.

A null text, or one without a letter, is ``und`` with score 0, and so is every text where nothing was learned
(an empty table, or one without labels).  A null lang labels nothing.  Repeated rows are predicted alike, and in
training count as often as they occur; null and equal ids are rows of their own, other columns are not read.  Whole texts are
encoded whatever their length; a training text of more than SAMPLE_TEXT bytes fills no dictionary.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, ship
from .text_arrays import lean

#: Bytes of text in a dictionary, rows sampled per language for it (on average), rows sampled of all
#: languages together, and the longest text that a sample takes.  These bound what the driver gathers and sends out.
DICTIONARY_BYTES = 192 << 10
SAMPLE_ROWS = 160
MOST_ROWS = 64_000
SAMPLE_TEXT = 16 << 10
LEVEL = 5
RUN = 6
MIN_MARGIN = 0.02
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """(language, dictionary) of each language in ``labelled`` (doc_id, text, lang), commonest first.

    A first pass counts the usable rows of each language, a second takes those whose hash is
    below a fraction that gives SAMPLE_ROWS of them on average (fewer where there are more than
    MOST_ROWS / SAMPLE_ROWS languages).
    """
    size = F.octet_length("text")
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (size > 0) & (size <= SAMPLE_TEXT))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    each = min(SAMPLE_ROWS, MOST_ROWS // len(counts))
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    part = F.coalesce(F.try_element_at(shares, F.col("lang")), F.lit(0.0))
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    rows = usable.withColumn("_draw", draw).where(F.col("_draw") < part).select("lang", "_draw", "text").collect()
    order = sorted(counts, key=lambda x: (-counts[x], x))
    return dictionaries({lang: [r["text"] for r in sorted(rows, key=lambda r: (r["_draw"], r["text"])) if r["lang"] == lang] for lang in order})


def plain(text: str) -> str:
    """Lower-case letters, everything between them one space."""
    return NO_LETTERS.sub(" ", text.lower())


def dictionaries(samples: dict[str, list[str]]) -> list[tuple[str, bytes]]:
    """A dictionary for each language of ``samples``, in their order.

    Labelled texts quote other languages and share whole passages with them.  So the plain text is
    taken apart into runs of RUN words; those likelier in another language's sample go, and
    the rest follow each other without repeats in the order of a checksum, so that no long passage is
    left for the coder to find.
    """
    runs = {}
    for lang, texts in samples.items():
        words = [plain(t).split() for t in texts]
        runs[lang] = [w[k : k + RUN] for w in words for k in range(0, len(w), RUN)]
    rate, within = {}, Counter()
    for lang, own in runs.items():
        seen = Counter(w for x in own for w in x)
        within.update(seen.keys())
        total = sum(seen.values()) + 1
        rate[lang] = ({w: math.log((n + 0.01) / total) for w, n in seen.items()}, math.log(0.01 / total))
    out = []
    for lang, own in runs.items():
        kept = set()
        for x in own:
            shared = [w for w in x if within[w] > 1]
            like = {k: sum(known.get(w, none) for w in shared) for k, (known, none) in rate.items()}
            if like[lang] >= max(like.values()):
                kept.add(" ".join(x).encode())
        if kept:
            body = b" ".join(sorted(kept, key=lambda x: (zlib.crc32(x), x)))
            out.append((lang, body[:DICTIONARY_BYTES]))
    return out


class Classifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in dictionaries]
        self.coders = []
        for _, body in dictionaries:
            shape = zstd.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(body), write_content_size=False, write_checksum=False, write_dict_id=False)
            content = zstd.ZstdCompressionDict(body.rjust(8, b" "), dict_type=zstd.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=shape)
            self.coders.append(zstd.ZstdCompressor(dict_data=content, compression_params=shape))

    def predict(self, text: str | None) -> tuple[str, float, str]:
        """(language, score, language or ``und`` if the margin is narrow)."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, UNKNOWN
        raw = plain(text).encode()
        sizes = [len(c.compress(raw)) for c in self.coders]
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        best = order[0]
        if len(order) == 1:
            return self.langs[best], 1.0, self.langs[best]
        least, second = sizes[best], sizes[order[1]]
        score = 1.0 / sum(2.0 ** max(-900.0, 8.0 * (least - s)) for s in sizes)
        sure = second - least >= MIN_MARGIN * second
        return self.langs[best], score, self.langs[best] if sure else UNKNOWN


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]]) -> DataFrame:
    """(doc_id, lang_pred, score, lang_sure) of every whole text; reads only ``text``.

    A null text, or one without a letter, is ``und`` with score 0, as is all without dictionaries.
    The dictionaries (DICTIONARY_BYTES for each language) go to the executors as a broadcast variable.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        model = Classifier(sent.value)
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.string()))]],
                ["doc_id", "lang_pred", "score", "lang_sure"],
            )

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, lang_pred string, score double, lang_sure string")


def op5_language_id(spark, sf_dir) -> DataFrame:
    """Contract query: predicted language of every whole text, learned from the training rows.

    One row for each row of the table, repeated rows included; a null id is no held-out one, a null text or one
    without a letter is ``und`` with score 0, an empty table gives no rows."""
    docs = documents(spark, sf_dir)
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_sure")
