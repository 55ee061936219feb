import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from botiquin.llm import ball_codes, relative_lz, stripes
from botiquin.llm.ball_codes import Coding, Walk
from tests.llm import frames

# --- repeated word sequences ------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats_by_force(rows, size):
    """Words kept per row: every window against all windows of smaller ids."""
    words = [WORD.findall(row[1] or "") for row in rows]
    first = {}
    for row, found in zip(rows, words):
        for k in range(len(found) - size + 1):
            window = tuple(found[k : k + size])
            if row[0] is not None:
                first[window] = min(first.get(window, row[0]), row[0])
    kept = []
    for row, found in zip(rows, words):
        gone = set()
        for k in range(len(found) - size + 1):
            if row[0] is not None and first[tuple(found[k : k + size])] < row[0]:
                gone.update(range(k, k + size))
        kept.append((row[0], len(found), len(gone), " ".join(w for k, w in enumerate(found) if k not in gone)))
    return Counter(kept)


def removed(frame, **options):
    got = relative_lz.remove_repeats(frame, **options).select("row.doc_id", "n_words", "n_removed", "kept")
    return Counter(map(tuple, got.collect()))


def woven(seed, n_docs, letters):
    """Texts woven from a few passages, so that factors begin and end anywhere in each other."""
    draw = random.Random(seed)
    passages = [[draw.choice(letters) for _ in range(draw.randint(3, 40))] for _ in range(12)]
    rows = []
    for doc in range(n_docs):
        words = []
        for _ in range(draw.randint(0, 6)):
            passage = draw.choice(passages)
            a = draw.randrange(len(passage))
            words += passage[a : draw.randint(a, len(passage))]
            words += [f"own{draw.randrange(10**6)}"] * draw.randint(0, 2)
        rows.append((draw.choice([doc, doc, doc // 2, None]), " ".join(words), "en", "a", 1))
    return rows


@pytest.mark.parametrize(("seed", "letters", "size", "anchor", "block"), [
    (1, "ab", 4, 2, 8), (2, "abcdefgh", 6, 3, 16), (3, "abc", 13, 5, 128), (4, "abcdefghijklmnop", 5, 5, 4),
])
def test_repeats_like_brute_force(spark, seed, letters, size, anchor, block):
    rows = woven(seed, 120, letters)
    got = removed(frames.docs(spark, rows), size=size, anchor=anchor, block=block)
    assert got == repeats_by_force(rows, size)


def test_repeats_of_odd_rows(spark):
    rows = [*frames.ROWS, (8, "One two three four five six seven eight nine ten eleven twelve", "en", "a", 1),
            (9, frames.LONG[1000:] + " and more", "en", "a", 1), (10, "x " + frames.ROWS[0][1] + " y", "en", "a", 1)]
    assert removed(frames.clashing(spark, rows), size=11) == repeats_by_force(rows, 11)
    assert removed(frames.docs(spark, [])) == Counter()


def test_repeats_of_one_hot_passage_keep_the_first(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(k, f"a{k} b{k} {passage} c{k} d{k}", "en", "a", 1) for k in range(3000)]
    got = removed(frames.docs(spark, rows))
    assert got == Counter({(0, 64, 0, rows[0][1]): 1, **{
        (k, 64, 60, f"a{k} b{k} c{k} d{k}"): 1 for k in range(1, 3000)}})


def test_a_window_over_a_factor_end_is_looked_up():
    # The longest factor from 0 ends in the middle of another place of the block.
    block = np.array([1, 2, 3, 4, 5, 99, 98, 4, 5, 6, 7, 8], dtype=np.uint64)
    words = np.array([1, 2, 3, 4, 5, 6, 7, 8], dtype=np.uint64)
    index = relative_lz.Block(block, 4)
    windows = relative_lz.window_hashes(words, 4).tolist()
    assert list(index.factors(words, windows)) == [(0, 5), (3, 7), (4, 8)]


# --- codes of vectors -------------------------------------------------------------------------


def codes_by_force(rows, coding):
    """Codes of rows (id, vector, label) by comparing all parts with all entries."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [(r[0], [int(np.floor(float(np.float32(x)) * coding.scale)) for x in r[1]], r[2]) for r in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(whole[0][1])
    whole = [r for r in whole if len(r[1]) == dims]
    width = dims // coding.parts
    books, points = [], []
    for part in range(coding.parts):
        points.append([r[1][part * width : (part + 1) * width] for r in whole])
        books.append([list(p) for p in points[part][: coding.entries]])

    def near(part, p):
        return min((sum((x - y) ** 2 for x, y in zip(p, e)), k) for k, e in enumerate(books[part]))

    for _ in range(coding.rounds):
        for part in range(coding.parts):
            groups = defaultdict(list)
            for p in points[part]:
                groups[near(part, p)[1]].append(p)
            for k, group in groups.items():
                books[part][k] = [sum(column) // len(group) for column in zip(*group)]
    out, of_label = [], Counter()
    for i, row in enumerate(whole):
        found = [near(part, points[part][i]) for part in range(coding.parts)]
        error = sum(d for d, _ in found)
        of_label[row[2]] += error
        out.append((row[0], "".join(f"{k:02x}" for _, k in found), error, row[2]))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return Counter((i, c, e, of_label[label]) for i, c, e, label in out), hashlib.sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int"


def coded(spark, rows, coding):
    got, books = ball_codes.codes(spark.createDataFrame(rows, VECTORS), coding)
    rows = got.select("id", "code", "error", "label_error").collect()
    return Counter(map(tuple, rows)), ball_codes.digest(books)


def clusters(seed, n, dims=8):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, dims))
    vectors = centres[draw.integers(0, 5, n)] + draw.normal(size=(n, dims)) * draw.choice([0, 0.01, 0.3], (n, 1))
    return [(k * 3, v.tolist(), int(k % 4) or None) for k, v in enumerate(vectors.astype(np.float32))]


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_like_brute_force(spark, seed):
    coding = Coding(entries=16, chunk=100, leaf=4)
    rows = clusters(seed, 700)
    assert coded(spark, rows, coding) == codes_by_force(rows, coding)


def test_codes_of_odd_rows(spark):
    coding = Coding(entries=8, chunk=16, leaf=2)
    rows = clusters(3, 60) + [
        (0, [0.5] * 8, 1), (0, [-0.5] * 8, 1), (1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, 2),
        (1003, [float("inf")] + [0.0] * 7, 2), (1004, [1.0], 2), (1005, [], 3), (None, [0.25] * 8, None),
        (None, None, None), (5, [0.0] * 8, None),
    ] + [(7, [2.0] * 8, 9)] * 40
    assert coded(spark, rows, coding) == codes_by_force(rows, coding)
    assert coded(spark, [], coding) == (Counter(), hashlib.sha256(b"").hexdigest())
    # Fewer rows than entries; equal first entries, of which the lower one is taken.
    few = [(1, [1.0] * 4, 1), (2, [1.0] * 4, 1), (3, [2.0] * 4, 1)]
    assert coded(spark, few, coding) == codes_by_force(few, coding)
    with pytest.raises(ValueError, match="equal parts"):
        coded(spark, [(1, [1.0] * 6, 1)], coding)
    with pytest.raises(Exception, match="64 bits"):
        coded(spark, [(1, [1e9] * 4, 1)], coding)
    clash = spark.createDataFrame(few, VECTORS).withColumns({n: F.lit("x") for n in ("id", "vector", "code", "same")})
    assert ball_codes.codes(clash, coding)[0].count() == 3


def test_balls_hold_their_points_and_spare_comparisons():
    draw = np.random.default_rng(5)
    centres = draw.integers(-900, 900, (40, 6))
    points = centres[draw.integers(0, 40, 1024)] + draw.integers(-9, 9, (1024, 6))
    tree = ball_codes.build(points, 8)
    assert sorted(tree.order.tolist()) == list(range(1024))
    ordered = points[tree.order]
    for first, last, left, right, radius, total in zip(
        tree.first, tree.last, tree.left, tree.right, tree.radius, tree.sums
    ):
        assert (ordered[first:last].sum(axis=0) == total).all()
        far = np.sqrt(((ordered[first:last] - total / (last - first)) ** 2).sum(axis=1))
        assert far.max() <= radius + 1e-9
        if left >= 0:
            assert {tree.first[left], tree.last[left], tree.first[right], tree.last[right]} == {
                first, tree.last[left], tree.first[right], last}
    _, _, singles, _ = Walk(centres).run(tree, ordered)
    assert len(singles) < 300


# --- divergence of sources ----------------------------------------------------------------------


def divergences_by_force(rows, least_docs, top):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        of_docs = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in of_docs.items() if n >= least_docs)
        sources = sorted({d[1] for d in mine}, key=str.encode)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in sources}
        whole = sum(counts.values(), Counter())

        def share(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = share(whole)
        p = {s: share(counts[s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, s, part, item, value, rank))
    return Counter(out)


def spread(seed, n, sources):
    draw = random.Random(seed)
    words = [f"{c}{d}" for c in "abcdéß日X" for d in "efgh"]
    return [
        (k, " ".join(draw.choices(words[: 8 + k % 24], k=draw.randint(0, 30))) + draw.choice([" 7", "!", " don't"]),
         draw.choice(["en", "de", None, ""]), draw.choice([*sources, None]), 1)
        for k in range(n)
    ]


@pytest.mark.parametrize(("tile", "held"), [(64, 400_000), (2, 10), (3, 200)])
def test_divergences_like_brute_force(spark, tile, held):
    rows = spread(tile, 300, ["s1", "s2", "S3", "é", "日本", "t6", "t7"])
    got = stripes.divergences(frames.clashing(spark, rows), least_docs=5, tile=tile, most_held=held, top_terms=4)
    assert Counter(map(tuple, got.collect())) == divergences_by_force(rows, 5, 4)


def test_divergences_of_odd_rows(spark):
    rows = [*frames.ROWS, *frames.ROWS]
    got = stripes.divergences(frames.docs(spark, rows), least_docs=2)
    assert Counter(map(tuple, got.collect())) == divergences_by_force(rows, 2, 10)
    # No term is kept: pairs of value 0; one source alone has no rows.
    alone = [(1, "one", "en", "a", 1), (2, None, "en", "b", 1), (3, "two", "de", "a", 1)]
    got = stripes.divergences(frames.docs(spark, alone)).collect()
    assert sorted(map(tuple, got)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert stripes.divergences(frames.docs(spark, [])).count() == 0


def test_shares_of_huge_counts_are_exact():
    draw = random.Random(3)
    for _ in range(500):
        total, terms = draw.randrange(10 ** draw.randint(1, 15)), draw.randrange(1, 10**6)
        count = draw.randint(0, total)
        got = stripes.shares(np.array([count]), np.array([total]), np.array([terms]))[0]
        assert got == 1 + 10**9 * (count + 2) // (total + 2 * terms)
