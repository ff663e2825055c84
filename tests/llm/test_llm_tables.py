"""Vector codes, the filter audit and repeated passages, against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolake.llm import codes, filter_audit, repeats
from geolake.llm.coding import packed, unpacked
from geolake.llm.shared import reachable

SPACE = "\x20\t\n\x0b\x0c\r"


@pytest.mark.parametrize("most", [0, 255, 256, 65536, 1 << 23, 1 << 24, 1 << 40])
def test_numbers_come_back_from_bytes(most):
    values = np.array([0, most, most // 2, 1 if most else 0])
    data, width = packed(values)
    assert unpacked(data, width).tolist() == values.tolist() and len(data) == 4 * width
    assert unpacked(*packed(values[:0])).tolist() == []


# --- vector codes -----------------------------------------------------------------------


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label), sound and sorted by id."""
    whole = [[int(np.floor(np.float64(x) * 256)) for x in v] for _, v, _ in rows]
    edges = [k * len(whole[0]) // parts for k in range(parts + 1)]
    books = [[v[a:b] for v in whole[:entries]] for a, b in zip(edges, edges[1:])]

    def nearest(p, x):
        return min((sum((i - j) ** 2 for i, j in zip(x, e)), k) for k, e in enumerate(books[p]))

    def assigned():
        return [[nearest(p, v[a:b]) for p, (a, b) in enumerate(zip(edges, edges[1:]))] for v in whole]

    for _ in range(rounds):
        told = assigned()
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            for k in range(len(books[p])):
                mine = [v[a:b] for v, t in zip(whole, told) if t[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    told = assigned()
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    error = [sum(d for d, _ in t) for t in told]
    by_label = Counter()
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    return [(i, "".join(f"{k:02x}" for _, k in t), e, by_label[label], digest) for (i, _, label), t, e in zip(rows, told, error)]


def coded(spark, rows, **options):
    reachable(spark)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({"own": F.lit(1), "error": F.lit("x")})
    return sorted((tuple(r) for r in codes.report(frame, **options).collect()), key=repr)


@pytest.mark.parametrize("n,dimension,spread", [(400, 64, 0.2), (700, 32, 0.01), (150, 64, 3.0)])
def test_codes_are_those_of_plain_rounds(spark, n, dimension, spread):
    rng = np.random.default_rng(n)
    centres = rng.normal(0, 1, (9, dimension))
    vectors = (centres[rng.integers(0, 9, n)] + rng.normal(0, spread, (n, dimension))).astype(np.float32)
    # many ties and repeated vectors
    vectors[n // 2 : n // 2 + 30] = vectors[3]
    rows = [(i * 3 - 20, [float(x) for x in v], [None, 1, 2][i % 3]) for i, v in enumerate(vectors)]
    shuffled = random.Random(1).sample(rows, n)
    bad = [(10**6, None, 1), (10**6 + 1, [float("nan")] * dimension, 1), (10**6 + 2, [1.0] * (dimension - 1) + [None], 2), (10**6 + 3, [float("inf")] * dimension, 2), (-10**6, [], 1)]
    assert coded(spark, shuffled + bad) == sorted(brute_codes(rows), key=repr)


def test_codes_of_few_repeated_and_no_vectors(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1), (2, [], None)]) == []
    same = [(5, [0.5] * 16, None), (5, [0.5] * 16, None), (None, [-0.25] * 16, 2)]
    assert coded(spark, same) == sorted(brute_codes([same[0], same[1], same[2]]), key=repr)
    # a vector of another length than the first one's goes
    mixed = [(1, [0.5] * 16, 1), (2, [0.5] * 20, 1), (3, [0.75] * 16, 1)]
    assert [r[0] for r in coded(spark, mixed)] == [1, 3]
    with pytest.raises(Exception, match="or more"):
        coded(spark, [(1, [1e9] * 16, 1)])


def test_bounds_never_hide_a_nearer_entry():
    """A part reassigned by its bounds has the entry, and a list in order, that comparison with all entries gives."""
    rng = np.random.default_rng(5)
    vecs = rng.integers(-200, 200, (500, 4))
    books = codes.Codebooks(rng.integers(-200, 200, (40, 4)), [0, 4])
    state, b = codes.fresh(books, vecs, 0, 10), 10
    looked = []
    for step in range(8):
        after = codes.Codebooks(books.entries + rng.integers(-6, 7, (40, 4)) // (1 + step), [0, 4])
        own, near, bounds, outer = state
        bounds, outer = codes.moved(near, bounds, outer, after.moves(books)[:, 0])
        *state, needed = codes.again(after, vecs, 0, own, near, bounds, outer)
        own, near, bounds, outer = state
        squares = after.distances(vecs, 0)
        assert (own == squares.argmin(axis=1)).all()
        true = np.sqrt(np.take_along_axis(squares, near, 1))
        assert (bounds <= true + 1e-9).all() and (np.diff(np.concatenate([bounds, outer[:, None]], axis=1), axis=1) >= 0).all()
        rest = squares.astype(float)
        np.put_along_axis(rest, np.concatenate([own[:, None], near], axis=1), np.inf, 1)
        assert (outer <= np.sqrt(rest.min(axis=1)) + 1e-9).all()
        looked.append((needed <= b).mean())
        books = after
    assert min(looked[2:]) > 0.5  # bounds do spare the full comparison
    assert codes.adapted([50, 40, 9, 1, 0, 0, 5], 5, 1) == 2 and codes.adapted([0, 0, 0, 10], 2, 1) in (1, 2)


# --- filter audit -----------------------------------------------------------------------


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = text.translate(str.maketrans(SPACE, " " * 6)).split(" ")
        words = [w for w in words if w]
        least = min((j for j, t, _ in rows if (t or "") == text and j is not None), default=None)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > least}
        docs.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in bad))
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels, **options):
    reachable(spark)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns({"shard": F.lit(1), "failed": F.lit(2), "digest": F.lit("x"), "part": F.lit("y")})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("part", F.lit(3))
    got = filter_audit.audit(docs, marks, **options).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}


def random_documents(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(90)] + ["Ähre", "naïve", "#tag", "A", "USA", "🙂", " x y"]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.25:
            text = rng.choice(rows)[1]
        else:
            words = rng.choices(vocabulary[: rng.choice([20, 90, 97])], k=rng.choice([0, 1, 150, 199, 200, 201, 260]))
            text = "".join(w + rng.choice(SPACE) * rng.choice([1, 1, 2]) for w in words)
            text = rng.choice(["", " "]) + text.lower() * rng.choice([1, 1, 2])
        rows.append((i, text, rng.choice(["en", "de", "", None])))
    return rows


@pytest.mark.parametrize("size", [1, 3000, 1 << 23])
def test_audit_is_that_of_all_orders(spark, size):
    rows = random_documents(3)
    rows += [(3, "short", "en"), (3, "short", "en"), (None, rows[5][1], "en"), (None, None, None), (900, None, "de"), (901, "", "de"), (-7, rows[9][1], "xx"), (902, "word " * 30000, "en")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 130, 2)] + [(4, None, 1), (4, 1, None), (None, 1, 1), (5000, 1, 1)]
    assert audited(spark, rows, labels, size=size) == brute_audit(rows, labels)


def test_audit_without_documents_or_labels(spark):
    assert audited(spark, [], []) == {}
    got = audited(spark, [(1, "one", None)], [])
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_matrix_holds_every_count(spark):
    reachable(spark)
    rows = random_documents(8, 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    ids, met = {}, {}
    for r in filter_audit.matrix(docs, size=4000).collect():
        columns, counts = unpacked(bytes(r.columns), r.wide), unpacked(bytes(r.counts), r.counted)
        for k, i in enumerate(r.doc_id):
            a, b = r.starts[k], r.starts[k + 1]
            assert (np.diff(columns[a:b]) > 0).all()
            met[i] = dict(zip(columns[a:b].tolist(), counts[a:b].tolist()))
    # a number stands for one word everywhere: words of one document with counts of their own pin numbers down
    for i, text, _ in rows:
        true = Counter(w for w in (text or "").translate(str.maketrans(SPACE, " " * 6)).split(" ") if w)
        assert sorted(true.values()) == sorted(met[i].values())
        for word, n in true.items():
            options = {c for c, m in met[i].items() if m == n}
            ids[word] = ids.get(word, options) & options
    assert all(ids.values())
    everywhere = set().union(*(m.keys() for m in met.values()))
    assert len(everywhere) == len(ids)


# --- repeated passages ------------------------------------------------------------------


def brute_repeats(rows, window):
    split = [[w for w in (t or "").translate(str.maketrans(SPACE, " " * 6)).split(" ") if w] for _, t in rows]
    seen = Counter(tuple(w[p : p + window]) for w in split for p in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def cut(spark, rows, **options):
    reachable(spark)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"block": F.lit(1), "at": F.lit(2), "starts": F.lit("x"), "n_words": F.lit(0)})
    return sorted((tuple(r) for r in repeats.without_repeats(docs, **options).collect()), key=repr)


def texts_with_passages(seed, window, n=70):
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(400)}"
    passages = [[word() for _ in range(rng.choice([window - 1, window, window + 1, 2 * window, 5 * window]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(5)):
            words += [word() for _ in range(rng.randrange(2 * window))]
            if rng.random() < 0.6:
                p = rng.choice(passages)
                words += p[rng.randrange(3) : len(p) - rng.randrange(3)]
        rows.append((i, rng.choice(SPACE).join(words) if rng.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("window,first,block", [(35, 9, 1 << 20), (35, 9, 300), (7, 2, 50), (3, 9, 20), (1, 9, 100)])
def test_every_repeated_window_goes(spark, window, first, block):
    rows = texts_with_passages(window + block, max(window, 2))
    rows += [(7, rows[11][1]), (7, rows[11][1]), (None, " ".join(["la"] * (3 * window))), (800, "la " * (window + 1)), (801, "la " * window if window > 1 else "alone"), (802, ""), (803, " \t\n")]
    assert cut(spark, rows, window=window, first=first, block=block) == brute_repeats(rows, window)


def test_repeats_of_one_document_and_of_none(spark):
    assert cut(spark, []) == []
    text = " ".join(f"w{k}" for k in range(35))
    assert cut(spark, [(1, text)]) == [(1, 35, 0, text)]
    assert cut(spark, [(1, text + " and " + text)]) == [(1, 71, 70, "and")]
    long = " ".join(f"x{k}" for k in range(60000))
    assert cut(spark, [(1, long), (2, "y " + long)]) == [(1, 60000, 60000, ""), (2, 60001, 60000, "y")]


@pytest.mark.parametrize("window,first", [(35, 9), (50, 6), (2, 1), (8, 8)])
def test_levels_at_most_double(window, first):
    found = repeats.levels(window, first)
    assert found[-1] == window and found[0] <= max(first, 1) and all(a < b <= 2 * a for a, b in zip(found, found[1:]))


# --- decoding ---------------------------------------------------------------------------


def test_decoding_of_missing_lists_and_strange_ids(spark):
    from geolake.llm import bpe

    reachable(spark)
    rows = [(1, [104, 105]), (2, None), (3, []), (4, [105]), (None, [104] * 1000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, ids array<int>").withColumn("decoded", F.lit("x"))
    table = {rank: token for token, rank in bpe.read_ranks(bpe.public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).items()}
    for size in (2, 256):
        got = {r.doc_id: r.decoded for r in bpe.decode(frame, rows=size).collect()}
        assert {k: None if v is None else bytes(v) for k, v in got.items()} == {i: None if ids is None else b"".join(table[t] for t in ids) for i, ids in rows}
    with pytest.raises(Exception):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id bigint, ids array<int>")).collect()
    assert bpe.decode(frame.limit(0)).count() == 0
