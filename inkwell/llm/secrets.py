"""Secret scans: three fixed patterns and a linear-chain conditional random field.

Tokens are maximal runs of key characters (ASCII letters, digits, ``+/_.=-`` and bytes beyond ASCII)
or of other printable characters.  A line is a sequence; every token is tagged B (begin), I
(inside) or O (outside) from its shape, its neighbours and features of its file.  Feature
weights and transitions maximise the conditional likelihood of training lines, tags are decoded
by Viterbi.  A line is only decoded if some token could pay for leaving O, by a bound
that makes skipping exact.  Training takes lines of every length.

A null or empty text has no span; an empty table gives an empty result, and a field trained on made documents
alone.  Rows are scanned each by itself: repeated rows and equal or null ids get equal spans, other columns are not read.
Spans that start together are listed by kind, base kinds first.  A very long text is worked on alone, in memory in proportion to it.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import groups
from .common import documents, ship
from .text_arrays import lean

#: The base patterns, fixed values: kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
_ASSIGN = re.compile(BASE[0][1], re.I | re.A)
_ACCESS = re.compile(BASE[1][1])
_HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "crf")

#: Bounds of what training takes: made documents, corpus documents, characters of each.
MADE_DOCS = 400
SAMPLE_DOCS = 200
SAMPLE_CHARS = 4000
EPOCHS = 70
#: Added to the score of O when decoding: a span must be this much likelier (natural logarithm).
CAUTION = 2.0

Span = tuple[str, int, int]


def base_spans(text: str, runs: bool = True) -> list[Span]:
    """Spans of the base patterns, leftmost non-overlapping per kind; ``runs``: may hold long hex."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if runs:
        out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def ordered(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_DIGIT = _table("0123456789")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_HEXCH = _table("0123456789abcdef")
_SIGN = _table("+/_.=-")
_VOWEL = _table("aeiouAEIOU")
_KEYCH = _DIGIT | _UPPER | _LOWER | _SIGN | (np.arange(256) >= 0x80)
_BLANK = np.zeros(256, bool)
_BLANK[:33] = True
KEY_WORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "key", "auth", "bearer", "credential", "access_key", "private_key", "authorization")
FEATURES = (
    "one", "short", "len8", "len12", "len16", "len24", "len40", "digit", "mixed", "digits20", "cases", "hex", "number", "sign", "wide",
    "plain", "vowels", "changes", "punct", "glued", "prev_assign", "prev_key", "prev2_key", "prev3_key", "quoted", "next_end", "is_key", "doc_key", "doc_digits", "doc_punct", "long_word", "upper_digit",
)


def tokens(raw: np.ndarray, offsets: np.ndarray):
    """(start, end, text number, line number) of every token of a batch of texts."""
    kind = np.where(_BLANK[raw], 0, np.where(_KEYCH[raw], 1, 2)).astype(np.int8)
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = kind[1:] != kind[:-1]
    first[offsets[:-1][offsets[:-1] < n]] = True
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], n)
    solid = kind[begin] > 0
    begin, end = begin[solid], end[solid]
    doc = np.searchsorted(offsets, begin, "right") - 1
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, begin) + doc  # both grow along the batch, so the sum tells lines apart
    return begin, end, doc, line


def _count(mask: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
    return upto[end] - upto[begin]


def _shift(x: np.ndarray, k: int, line: np.ndarray) -> np.ndarray:
    """x of the k-th token before (k > 0) or after, False beyond the line."""
    out = np.zeros_like(x)
    if k > 0 and len(x) > k:
        out[k:] = x[:-k] & (line[k:] == line[:-k])
    elif k < 0 and len(x) > -k:
        out[:k] = x[-k:] & (line[:k] == line[-k:])
    return out


def features(raw: np.ndarray, offsets: np.ndarray, tok) -> np.ndarray:
    """One row of 0/1 features per token."""
    begin, end, doc, line = tok
    n = len(begin)
    f = np.zeros((n, len(FEATURES)), np.float32)
    if n == 0:
        return f
    put = lambda name, v: f.__setitem__((slice(None), FEATURES.index(name)), v)
    size = end - begin
    c = {k: _count(t[raw], begin, end) for k, t in (("d", _DIGIT), ("u", _UPPER), ("l", _LOWER), ("h", _HEXCH), ("s", _SIGN), ("v", _VOWEL))}
    wide = size - c["d"] - c["u"] - c["l"] - c["s"] > 0
    word = _KEYCH[raw[begin]]
    wide &= word
    change = np.zeros(len(raw), bool)
    change[1:] = _DIGIT[raw[1:]] != _DIGIT[raw[:-1]]
    changes = _count(change, np.minimum(begin + 1, end), end)
    letters = c["u"] + c["l"]
    key = np.zeros(n, bool)
    for w in sorted({len(w) for w in KEY_WORDS}):
        at = np.flatnonzero(word & (size == w))
        if len(at):
            low = raw[begin[at][:, None] + np.arange(w)] | 0x20
            for x in (x for x in KEY_WORDS if len(x) == w):
                key[at[(low == (np.frombuffer(x.encode(), np.uint8) | 0x20)).all(axis=1)]] = True
    last = raw[end - 1]
    sets = (last == ord(":")) | (last == ord("="))
    quote = (last == ord('"')) | (last == ord("'"))
    assign = sets | quote & (_count((raw == ord(":")) | (raw == ord("=")), begin, end) > 0)
    glued = np.zeros(n, bool)
    glued[1:] = (begin[1:] == end[:-1]) & (line[1:] == line[:-1])
    put("one", 1)
    put("short", size < 8)
    for a, b in ((8, 12), (12, 16), (16, 24), (24, 40), (40, 1 << 60)):
        put(f"len{a}", (size >= a) & (size < b))
    put("digit", c["d"] > 0)
    put("mixed", (c["d"] > 1) & (letters > 1))
    put("digits20", 5 * c["d"] > size)
    put("cases", (c["u"] > 0) & (c["l"] > 0) & (c["d"] > 0))
    put("hex", (c["h"] == size) & (c["d"] > 0) & (size >= 16))
    put("number", c["d"] + c["s"] == size)
    put("sign", c["s"] > 0)
    put("wide", wide)
    put("plain", letters == size)
    put("vowels", 10 * c["v"] > 3 * size)
    put("changes", changes >= 4)
    put("punct", ~word)
    put("glued", glued)
    put("prev_assign", _shift(assign, 1, line))
    put("prev_key", _shift(key, 1, line))
    put("prev2_key", _shift(key, 2, line))
    put("prev3_key", _shift(key, 3, line))
    put("quoted", _shift(quote, 1, line) & _shift((raw[begin] == ord('"')) | (raw[begin] == ord("'")), -1, line))
    follows = np.zeros(n, bool)
    follows[:-1] = line[:-1] == line[1:]
    put("next_end", ~follows)
    put("is_key", key)
    texts = len(offsets) - 1
    per = np.maximum(1, np.bincount(doc, minlength=texts))
    put("doc_key", (np.bincount(doc, weights=key, minlength=texts) > 0)[doc])
    put("doc_digits", (np.bincount(doc, weights=c["d"] > 0, minlength=texts) > 0.2 * per)[doc])
    put("doc_punct", (np.bincount(doc, weights=~word, minlength=texts) > 0.3 * per)[doc])
    put("long_word", (size >= 16) & (letters == size))
    put("upper_digit", (c["u"] + c["d"] == size) & (c["d"] > 0) & (c["u"] > 1))
    return f


O, B, I = 0, 1, 2  # noqa: E741
#: Transitions that cannot be: O to I, and I at the start of a line.
BARRED = -1e4


class Field:
    """The conditional random field: emission weights, transitions, scores of a first tag."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.weights, self.moves, self.start = weights, moves, start

    def tag(self, f: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Best tags of all tokens (Viterbi per line)."""
        tags = np.zeros(len(line), np.int8)
        if not len(line):
            return tags
        score = f @ self.weights
        score[:, O] += CAUTION
        # Leaving O for a run of tokens changes the score by the sum of their gains and of the
        # transitions, one more than there are tokens; if no token covers two transitions, O is best.
        move = max(0.0, float((self.moves - self.moves[O, O]).max()), float((self.start - self.start[O]).max()))
        gain = score[:, 1:].max(axis=1) - score[:, O]
        hot = np.unique(line[gain > -2 * move]) if move else np.unique(line[gain > 0])
        a, b = np.searchsorted(line, hot, "left"), np.searchsorted(line, hot, "right")
        for lo, hi in zip(a.tolist(), b.tolist(), strict=True):
            tags[lo:hi] = self._viterbi(score[lo:hi])
        return tags

    def _viterbi(self, score: np.ndarray) -> list[int]:
        s = score.tolist()
        m = self.moves.tolist()
        best = [self.start[k] + s[0][k] for k in range(3)]
        back = []
        for row in s[1:]:
            step, nxt = [], []
            for k in range(3):
                x = [best[j] + m[j][k] for j in range(3)]
                j = max(range(3), key=x.__getitem__)
                step.append(j)
                nxt.append(x[j] + row[k])
            back.append(step)
            best = nxt
        k = max(range(3), key=best.__getitem__)
        path = [k]
        for step in reversed(back):
            k = step[k]
            path.append(k)
        return path[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _by_length(line: np.ndarray) -> list[np.ndarray]:
    """Token numbers of lines of similar lengths, one table for each doubling of the length: a row
    for each line, -1 behind its end.  So no line is left out and padding at most doubles a table."""
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    size = np.diff(np.append(first, len(line)))
    kind = np.ceil(np.log2(size)).astype(np.int64)
    out = []
    for k in np.unique(kind).tolist():
        rows = np.flatnonzero(kind == k)
        place = np.arange(int(size[rows].max()))
        out.append(np.where(place < size[rows][:, None], first[rows][:, None] + place, -1))
    return out


def _forward_backward(e: np.ndarray, live: np.ndarray, m: np.ndarray, s: np.ndarray):
    """(probabilities of the tags of each token, expected transitions) of lines with emission scores e."""
    n, t, _ = e.shape
    a, b = np.zeros((n, t, 3)), np.zeros((n, t, 3))
    a[:, 0] = s + e[:, 0]
    for k in range(1, t):
        a[:, k] = np.where(live[:, k, None], _log_sum(a[:, k - 1, :, None] + m, 1) + e[:, k], a[:, k - 1])
    z = _log_sum(a[:, -1], 1)
    for k in range(t - 2, -1, -1):
        b[:, k] = np.where(live[:, k + 1, None], _log_sum(m + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2), 0.0)
    pairs = live[:, 1:] & live[:, :-1]
    after = e + b
    joint = np.array([[np.exp(a[:, :-1, i] + m[i, j] + after[:, 1:, j] - z[:, None])[pairs].sum() for j in range(3)] for i in range(3)])
    return np.exp(a + b - z[:, None, None]), joint


def fit(f: np.ndarray, line: np.ndarray, gold: np.ndarray, epochs: int = EPOCHS) -> Field:
    """Maximises the penalised conditional likelihood by Adam over forward-backward gradients.

    ``line`` numbers the lines in order.  Forward and backward run over all lines of similar lengths at once;
    features stay one row per token.
    """
    width = f.shape[1]
    tables = _by_length(line)
    follows = line[1:] == line[:-1]
    opens = np.concatenate([[True], ~follows])
    seen_w = f.T @ np.eye(3, dtype=np.float32)[gold]
    seen_m = np.bincount((gold[:-1] * 3 + gold[1:])[follows], minlength=9).reshape(3, 3)
    seen_s = np.bincount(gold[opens], minlength=3)
    barred = np.zeros((3, 3))
    barred[O, I] = BARRED
    bar0 = np.array([0.0, 0.0, BARRED])
    size = width * 3 + 12
    theta, m1, m2 = np.zeros(size), np.zeros(size), np.zeros(size)

    def split(x):
        return x[: width * 3].reshape(width, 3), x[width * 3 : -3].reshape(3, 3) + barred, x[-3:] + bar0

    for step in range(1, epochs + 1):
        w, m, s = split(theta)
        emit = f @ w.astype(np.float32)
        p, joint = np.zeros((len(f), 3), np.float32), np.zeros((3, 3))
        for table in tables:
            live = table >= 0
            own, moves = _forward_backward(np.where(live[:, :, None], emit[table], 0.0), live, m, s)
            p[table[live]] = own[live]
            joint += moves
        grad = np.concatenate([(seen_w - f.T @ p).ravel(), (seen_m - joint).ravel(), seen_s - p[opens].sum(axis=0)])
        grad = grad / len(f) * 100 - 1e-3 * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        theta = theta + 0.2 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    w, m, s = split(theta)
    return Field(w.astype(np.float32), m, s)


def made_documents(count: int = MADE_DOCS, seed: int = 20) -> list[tuple[str, list[tuple[int, int]]]]:
    """(text, secret spans) of made documents: prose, tables, addresses and numbers, with
    secrets in many surroundings."""
    r = random.Random(seed)
    letters, caps, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    pick = lambda s, n: "".join(r.choice(s) for _ in range(n))
    word = lambda: "".join(r.choice(["er", "ti", "on", "a", "the", "sch", "é", "ió", "n", "re", "lo"]) for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() + r.choice(["", "", "", ",", "."]) for _ in range(n))

    def secret() -> str:
        k = r.randint(0, 6)
        if k == 0:
            return pick("0123456789abcdef", r.choice([32, 40, 64]))
        if k == 1:
            return "AKIA" + pick(caps + digits, 16)
        if k == 2:
            return pick(letters + caps + digits + "+/", r.choice([24, 32, 40])) + r.choice(["", "=", "=="])
        if k == 3:
            return r.choice(["ghp_", "sk_live_", "xoxb-", "glpat-", "AIza"]) + pick(letters + caps + digits, r.randint(20, 36))
        if k == 4:
            return "eyJ" + pick(letters + caps + digits, 20) + "." + pick(letters + caps + digits + "_-", 30)
        return pick(letters + caps + digits + "!@#%&*", r.randint(12, 20)) + r.choice(digits) + r.choice(caps) + r.choice(letters)

    def near() -> str:
        return r.choice(["password = ", 'token = "', "secret: ", "api_key=", "Authorization: Bearer ", "pwd is ", "the key ", "credential ", "auth=", '"apikey": "', "private_key ", "login with ", ""])

    def decoy() -> str:
        k = r.randint(0, 9)
        name = word()
        return (
            f"{name}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com", f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}",
            pick(digits, 16), f"http://www.{name}.example.com/{word()}/{r.randint(1, 99)}", f"{r.randint(1, 28)}/{r.randint(1, 12)}/{r.randint(1900, 2030)}",
            word() + word() + word() + word(), prose(3).upper(), "###", f"{name}_{word()}_{r.randint(0, 9)}", f"10.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}",
        )[k]

    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(r.randint(2, 10)):
            text += prose(r.randint(1, 12)) + " "
            k = r.random()
            if k < 0.18:
                before, s = near(), secret()
                if before or len(s) >= 24:
                    text += before
                    spans.append((len(text), len(text) + len(s)))
                    text += s + ('"' if before.endswith('"') else "") + r.choice(["", " ", "."])
            elif k < 0.55:
                text += decoy() + " "
            elif k < 0.62:
                text += " | ".join(word() for _ in range(4)) + "### "
            text += prose(r.randint(0, 6)) + "\n"
        out.append((text, spans))
    return out


def train(sample: list[str], epochs: int = EPOCHS) -> Field:
    """Fits the field to made documents and to sampled texts tagged by the base patterns."""
    made = made_documents()
    for text in sample:
        spans = []
        for kind, a, b in base_spans(text):
            spans.append(_ASSIGN.match(text, a).span(2) if kind == "assign" else (a, b))
        made.append((text, spans))
    texts = [t for t, _ in made]
    f_all, line_all, gold_all, base = [], [], [], 0
    for row, raw, offsets in groups(pa.array(texts, pa.string())):
        tok = tokens(raw, offsets)
        begin, end, doc, line = tok
        gold = np.zeros(len(begin), np.int64)
        for d in range(len(offsets) - 1):
            text, spans = made[row + d]
            for a, b in spans:
                x, y = (offsets[d] + len(text[:p].encode()) for p in (a, b))
                inside = np.flatnonzero((begin < y) & (end > x))
                gold[inside] = I
                gold[inside[:1]] = B
        f_all.append(features(raw, offsets, tok))
        line_all.append(line + base)
        gold_all.append(gold)
        base += int(line[-1]) + 1 if len(line) else 0
    f, line, gold = np.concatenate(f_all), np.concatenate(line_all), np.concatenate(gold_all)
    return fit(f, line, gold, epochs)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, base array<struct>, added array<struct>) with kind, start and end of every span.

    Whole texts; a null text has none.  Spans of the field that touch a base span are not added.
    """

    def run(batches):
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            base_rows, added_rows = [], []
            for row, raw, offsets in groups(batch.column("text")):
                gaps = np.concatenate([[-1], np.flatnonzero(~_HEXCH[raw]), [len(raw)]])
                long = gaps[:-1][np.diff(gaps) > 32] + 1
                runs = np.zeros(len(offsets), bool)
                runs[np.searchsorted(offsets, long, "right") - 1] = True
                ends = np.searchsorted(offsets, gaps[1:][np.diff(gaps) > 32], "left")
                for a, b in zip(np.searchsorted(offsets, long, "right") - 1, ends, strict=True):
                    runs[a:b] = True  # a run may go on into later texts
                tok = tokens(raw, offsets)
                tags = field.tag(features(raw, offsets, tok), tok[3])
                begin, end, doc, _ = tok
                first = np.flatnonzero(tags == B)
                found: dict[int, list[tuple[int, int]]] = {}
                for k in first.tolist():
                    stop = k + 1
                    while stop < len(tags) and tags[stop] == I and doc[stop] == doc[k]:
                        stop += 1
                    d = int(doc[k])
                    at = int(offsets[d])
                    a = len(raw[at : begin[k]].tobytes().decode())
                    b = a + len(raw[begin[k] : end[stop - 1]].tobytes().decode())
                    found.setdefault(d, []).append((a, b))
                for d in range(len(offsets) - 1):
                    spans = base_spans(texts[row + d] or "", bool(runs[d]))
                    more = [("crf", a, b) for a, b in found.get(d, ()) if not any(a < y and x < b for _, x, y in spans)]
                    base_rows.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                    added_rows.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in more])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base_rows, span), pa.array(added_rows, span)], ["doc_id", "base", "added"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id long, base {kind}, added {kind}")


def sample(docs: DataFrame) -> list[str]:
    """At most about SAMPLE_DOCS texts of at most SAMPLE_CHARS characters, chosen by hash."""
    short = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    n = short.count()
    draw = F.pmod(F.xxhash64(F.lit(9), "doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    rows = short.where(draw < min(1.0, SAMPLE_DOCS / max(1, n))).collect()
    return sorted(r["text"] for r in rows)


def _joined(spans: Column) -> Column:
    place = lambda s: F.struct(s["start"].alias("a"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("k"), s["end"].alias("e"), s["kind"].alias("kind"))
    text = lambda s: F.concat_ws(":", s["kind"], s["a"], s["e"])
    return F.array_join(F.transform(F.array_sort(F.transform(spans, place)), text), ",")


def op4_secret_scan(spark, sf_dir) -> DataFrame:
    """Contract query: base counts and digest, and all spans, of every whole text.

    One row for each row of the table, repeated rows included; a null text has no span, an empty table gives no rows."""
    docs = documents(spark, sf_dir)
    found = scan(docs, train(sample(docs)))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k, *_ in BASE],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_crf"),
    )
