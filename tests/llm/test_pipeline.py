"""The pipeline, stage by stage."""

import hashlib

import corpus_pipeline as P
from inkwell.llm.common import documents, stored
from tests.compare import SMALL


def test_stages_and_run(spark):
    docs = documents(spark, str(SMALL))
    names = docs.columns
    counts = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, str(SMALL)), name)
        assert docs.columns == names
        counts.append(docs.count())
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert counts[1] < counts[0] and counts[2] <= counts[1] and counts[3] <= counts[2]
    last = P.STAGES[-1][1](spark, docs, str(SMALL))
    want = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in docs.collect())
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in last.collect()) == want
    assert sorted(map(tuple, P.run(spark, str(SMALL)).collect())) == sorted(map(tuple, last.collect()))


def brute_kept(rows):
    """Ids that the first three stages keep and their texts, by plain Python over small rows: base rules, equal lines, and n-gram components."""
    import re

    from tests.llm.test_results import brute_components

    word = re.compile(r"[^\x20\x09-\x0d]+")
    kept = {}
    for i, t in rows:
        w = word.findall(t or "")
        runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        again = {k + j for k, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)}
        if len(w) >= 10 and 100 * len(again) <= 20 * len(w):
            kept[i] = t
    seen, left = set(), {}
    for i in sorted(kept):
        own = []
        for x in kept[i].split("\n"):
            key = x.strip(" \t\n\x0b\x0c\r").lower()
            if not key or key not in seen:
                own.append(x)
            seen.add(key)
        if word.search("\n".join(own)):
            left[i] = "\n".join(own)
    first = {i: c for i, (_, c) in brute_components(left).items()}
    return {i: t for i, t in left.items() if first[i] == i}


def test_run_equals_brute_force(spark, tmp_path):
    """Every stage against plain Python on texts without fuzzy lines: what stays, how often, and its tokens."""
    from collections import Counter

    from inkwell.llm import mixing
    from tests.llm.frames import SCHEMA, prose
    from tests.llm.test_results import filled, tiktoken_coder

    shared = prose(2, 12)
    data = [(k, f"{prose(300 + 2 * k, 25 + k % 30)}\n{shared}\n{prose(301 + 2 * k, 20)}", "en", "abc"[k % 3], 0) for k in range(60)]
    data += [(100 + k, data[k][1], "en", "a", 0) for k in range(10)]  # copies
    data += [(200, "too short", "en", "a", 0), (201, "again and again and again and " * 9, "en", "b", 0), (202, None, "en", "c", 0), (203, "", None, None, 0)]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    kept = brute_kept([(r[0], r[1]) for r in data])
    source = {r[0]: r[3] for r in data}
    sizes, rows = Counter(), spark.createDataFrame([(i, t) for i, t in kept.items()], "doc_id long, text string")
    for i, t in kept.items():
        sizes[source[i]] += len(t.split())
    want, words = filled(sizes, mixing.WEIGHTS, mixing.MAX_EPOCHS), {i: len(t.split()) for i, t in kept.items()}
    key = {r["doc_id"]: r["k"] for r in rows.select("doc_id", mixing.row_key().alias("k")).collect()}
    coder, expected = tiktoken_coder(), Counter()
    for s in sizes:
        budget = int(want[s] + 1e-9)
        own = sorted((i for i in kept if source[i] == s), key=key.get)
        whole, rest = divmod(budget, sizes[s])
        for i in own:
            expected[coder_row(coder, i, kept[i])] += whole
            part = min(rest, words[i])
            rest -= part
            if part == words[i]:
                expected[coder_row(coder, i, kept[i])] += 1
            elif part:
                expected[coder_row(coder, i, " ".join(kept[i].split()[:part]))] += 1
    got = Counter(tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in P.run(spark, str(tmp_path)).collect())
    assert got == +expected


def coder_row(coder, i, text):
    ids = coder.encode_ordinary(text)
    return i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
