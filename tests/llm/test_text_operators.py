import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from botiquin.llm import decontamination, jaccard, line_dedup, quality, words
from botiquin.llm.components import components
from botiquin.llm.jaccard import Similarity
from botiquin.llm.oracle import ORACLE
from botiquin.llm.queries import QUERIES
from botiquin.llm.tables import discard, intermediates, stored
from tests.compare import connect, difference
from tests.llm import frames

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


# --- decontamination ------------------------------------------------------------------------

ITEMS = "item_id string, text string"
PASSAGE = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu."


def items(spark):
    return spark.createDataFrame(
        [("10", PASSAGE), ("9", "short item"), ("9", "short item"), (None, "no id here"), ("8", None),
         ("7", ""), ("6", "!!")], ITEMS
    )


def test_hits(spark):
    rows = [
        (1, "x " + PASSAGE.upper() + " y", None, None, 1),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota", None, None, 1),
        (3, "one short-item, short item and NO ID here", None, None, 1),
        (4, None, None, None, 1), (5, "", None, None, 1), (None, "short item", None, None, 1),
        (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa beta gamma delta epsilon zeta eta "
            "theta iota kappa lambda", None, None, 1),
    ]
    got = {r.doc_id: r for r in decontamination.contamination(frames.docs(spark, rows), items(spark)).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items) == (14, 12, 1)
    assert got[1].items_sha256 == hashlib.sha256(b"10").hexdigest()
    assert not got[2].contaminated and got[2].n_hit == 0
    assert (got[3].n_words, got[3].n_hit, got[3].n_items) == (9, 7, 1)
    assert (got[4].n_words, got[5].n_words, got[None].n_hit) == (0, 0, 2)
    assert got[6].n_hit == 20
    blocks = decontamination.contamination(frames.docs(spark, rows), items(spark), most_words=5)
    assert {r.doc_id: r for r in blocks.collect()} == got


def test_passages_are_cut(spark):
    nested = PASSAGE.replace("zeta", "zeta " + PASSAGE + " ")
    rows = [(1, f"Before {PASSAGE} after.", "x", "y", 1), (2, PASSAGE, "x", "y", 1), (3, nested, "x", "y", 1),
            (4, None, None, None, None), (5, "", "", "", 0), (6, "clean  text,\nkept", "x", "y", 1)]
    frame = frames.clashing(spark, rows)
    got = decontamination.remove_passages(frame, items(spark))
    assert got.columns == frame.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] == "Before   after." or texts[1].split() == ["Before", ".", "after."]
    assert 2 not in texts and texts[4] is None and texts[5] == "" and texts[6] == "clean  text,\nkept"
    again = decontamination.contamination(got, items(spark))
    assert again.where("contaminated").count() == 0
    empty = decontamination.remove_passages(frames.docs(spark), spark.createDataFrame([], ITEMS))
    assert empty.count() == len(frames.ROWS)
    assert decontamination.contamination(frames.docs(spark, []), items(spark)).count() == 0


@pytest.mark.parametrize("most_words", [8, 1000])
def test_cuts_that_form_windows_of_other_blocks(spark, most_words):
    """A cut for one block of items joins the halves of another's window, again and again."""
    found = spark.createDataFrame([("a1", "one two three four"), ("b1", "x y z w"), ("c1", "p x y z w q")], ITEMS)
    rows = [(1, "q1 one two x y z w three four q2", "", "", 1), (2, "one x two three four y z w", "", "", 1),
            (3, "x y one x y z w two three four z w", "", "", 1), (4, "clean words", "", "", 1),
            (5, "p x one two three four y z w q", "", "", 1), (6, None, None, None, None)]
    got = decontamination.remove_passages(frames.docs(spark, rows), found, most_words=most_words)
    texts = {r.doc_id: r.text for r in got.collect()}
    assert {k: v.split() if v else v for k, v in texts.items()} == {
        1: ["q1", "q2"], 2: rows[1][1].split(), 4: ["clean", "words"], 6: None}


# --- line dedup -----------------------------------------------------------------------------


def test_later_windows_go(spark):
    a, b, c, d = (f"a line with some words, number {k}" for k in range(4))
    rows = [
        (2, "\n".join([a, b, c, d, "tail"]), None, None, 1),
        (1, "\n".join(["head", a, f"  {b} ", c]), None, None, 1),
        (3, "\n".join([a, b, c] * 2), None, None, 1),
        (4, "\n".join([a, b]), None, None, 1),
        (5, "\n\n\n\n", None, None, 1), (6, "\n\n\n\n", None, None, 1),
        (7, "\n".join([b, c, d]), None, None, 1),
        (None, "\n".join(["x", a, b, c]), None, None, 1),
    ]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.remove_repeated_lines(
        frames.clashing(spark, rows)).select("row.doc_id", "text", "n_lines", "n_removed").collect()}
    assert got[None] == (rows[7][1], 4, 0)          # no id comes first
    assert got[1] == ("head", 4, 3)
    assert got[2] == ("\n".join([d, "tail"]), 5, 3)
    assert got[3] == ("", 6, 6) or got[3][2] >= 3
    assert got[4] == ("\n".join([a, b]), 2, 0)
    assert got[5] == got[6] == ("\n\n\n\n", 5, 0)
    assert got[7] == ("", 3, 3)


def test_line_edges(spark):
    got = line_dedup.remove_repeated_lines(frames.clashing(spark))
    assert sorted(map(str, [(r[0], r[1]) for r in frames.ROWS])) == sorted(
        map(str, [tuple(r) for r in got.select("row.doc_id", "text").collect()]))
    assert got.where("n_removed > 0").count() == 0
    assert line_dedup.remove_repeated_lines(frames.docs(spark, [])).count() == 0
    lines = "\n".join(f"line {k} of a repeated and rather long document" for k in range(3000))
    two = frames.docs(spark, [(1, lines, None, None, 1), (2, "x\n" + lines + "\ny", None, None, 1)])
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(two).select("row.doc_id", "text").collect()}
    assert got == {1: lines, 2: "x\ny"}


def test_passages_within_lines_go(spark):
    a, b, c = (f"Sentence number {k} of a passage that repeats." for k in range(3))
    passage = f"{a} {b} {c}"
    rows = [
        (1, f"Only here. {passage} The end of the first.", None, None, 1),
        (2, f"Begins otherwise. {passage}\nNext line.", None, None, 1),
        (3, f"{a}\n{b} {c} Tail with no mark", None, None, 1),
        (4, passage, None, None, 1),
        (5, f"{a} {b}", None, None, 1),
        (6, "", None, None, 1), (7, None, None, None, 1), (8, "\n\n x. \n", None, None, 1),
    ]
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_passages(
        frames.clashing(spark, rows)).select("row.doc_id", "text").collect()}
    assert got == {
        1: rows[0][1], 2: "Begins otherwise.\nNext line.", 3: "Tail with no mark", 4: "", 5: rows[4][1],
        6: "", 7: None, 8: rows[7][1],
    }
    stage = corpus_pipeline.drop_repeated_lines(spark, frames.docs(spark, rows), FOLDER)
    assert {r.doc_id: r.text for r in stage.collect()} == {k: v for k, v in got.items() if k != 4}


def test_short_windows_of_words_go(spark):
    menu, rule = "Home\nNews\nHelp", "---\n***\n\n---"
    rows = [(1, f"{menu}\nfirst", None, None, 1), (2, f"second\n{menu}", None, None, 1),
            (3, "\n".join(["7"] * 9), None, None, 1), (4, rule, None, None, 1), (5, rule, None, None, 1)]
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_passages(
        frames.docs(spark, rows)).select("row.doc_id", "text").collect()}
    # Windows overlap: the first one of a run of equal lines is covered by the second but for a line.
    assert got == {1: rows[0][1], 2: "second", 3: "7", 4: rule, 5: rule}


# --- n-gram Jaccard join --------------------------------------------------------------------


def shingles(text, width):
    found = (text or "").encode().lower().split()
    if len(found) < width:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1))


def brute_components(rows, width, over, under):
    sets = {}
    for key, text in rows:
        sets.setdefault(shingles(text, width), []).append(key)
    distinct = [s for s in sets if s]
    parent = list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = set()
    for i in range(len(distinct)):
        for j in range(i):
            shared = len(distinct[i] & distinct[j])
            if under * shared >= over * (len(distinct[i]) + len(distinct[j]) - shared):
                links.add((j, i))
                parent[root(i)] = root(j)
    least = {}
    for i, s in enumerate(distinct):
        least[root(i)] = min([least.get(root(i), sets[s][0]), *sets[s]])
    where = {s: least[root(i)] for i, s in enumerate(distinct)}
    return {key: (len(shingles(t, width)), where.get(shingles(t, width), key)) for key, t in rows}, len(links)


def near_copies(seed=3, groups=12, words_each=(6, 220)):
    """Chains of edited copies, sets that share long passages, and sets of their own."""
    draw = random.Random(seed)
    rows, passage = [], [f"p{k}" for k in range(60)]
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(draw.randint(*words_each))]
        if g % 3 == 0:
            base[3:3] = passage
        for _ in range(draw.randint(1, 14)):
            rows.append((len(rows), " ".join(base)))
            for _ in range(draw.randint(0, 3)):
                base[draw.randrange(len(base))] = f"e{draw.random()}"
    draw.shuffle(rows)
    return [(k, text) for k, (_, text) in enumerate(rows)]


@pytest.mark.parametrize("width, over, under", [(4, 85, 100), (5, 4, 5), (1, 3, 5)])
def test_classes_against_brute_force(spark, width, over, under, monkeypatch):
    rows = near_copies()
    want, n_links = brute_components(rows, width, over, under)
    frame = frames.docs(spark, [(k, text, None, None, 1) for k, text in rows])
    alike = Similarity(width, over, under)
    got = {r.id: (r.n, r.component_id) for r in jaccard.classes(frame, alike).collect()}
    assert got == want
    links, members = jaccard.join(frame, alike)
    assert links.count() == links.distinct().count() == n_links
    assert members.count() == len(rows)


@given(st.integers(2, 700), st.integers(0, 10**6), st.sampled_from([(85, 100), (4, 5), (3, 5)]))
@settings(max_examples=150, deadline=None)
def test_linked_sets_share_a_signature(n, seed, threshold):
    """For any two sets at the threshold, in any mix of rare and frequent shingles."""
    over, under = threshold
    draw = np.random.default_rng(seed)
    least = -(-n * over // under)
    shared = draw.choice(2**62, size=least, replace=False).astype(np.uint64)
    mine = draw.choice(2**62, size=n - least, replace=False).astype(np.uint64) + np.uint64(2**62)
    whole = np.concatenate([shared, mine])
    other = shared
    owners = {int(s): int(draw.choice([2, 3, 9, 500])) for s in whole}

    def signed(members):
        members = sorted(members.tolist(), key=lambda s: (owners[s], s))
        count, need = len(members), -(-len(members) * over // under)
        kinds = np.array([owners[s] for s in members])
        found = np.array(members, dtype=np.uint64)
        steps = {jaccard._step(count), jaccard._step(need)}
        return {int(x) for s in steps for x in jaccard.prefix_signatures(count, need, kinds, found, s)}

    if under * len(other) >= over * len(whole) and len(other) > 1:
        assert signed(whole) & signed(other)


def test_keep_one(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text, "x", "s", 1), (3, text + " z", "x", "s", 1), (9, text.upper(), "x", "s", 1),
            (None, text, "x", "s", 1), (3, text + " z", "x", "s", 1), (7, "another text of its own words", "", "", 1),
            (8, None, None, None, None), (8, None, None, None, None), (4, "", "", "", 0)]
    frame = frames.clashing(spark, rows)
    got = jaccard.keep_one(frame)
    assert got.columns == frame.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["3", "4", "7", "8", "8"]
    assert jaccard.keep_one(frames.docs(spark, [])).count() == 0
    edges = jaccard.classes(frames.clashing(spark)).collect()
    assert len(edges) == len(frames.ROWS)
    assert {r.component_id for r in edges if r.id in (1, 2)} == {1}
    assert all(r.component_id == r.id for r in edges if r.n == 0)


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    edges += [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes():
    texts = pa.array(["One  two\tthree", None, "", "x" * 5, "one two three", "two"])
    hashes, cuts = words.token_hashes(texts, words.BLANK_SEPARATED)
    assert np.diff(cuts).tolist() == [3, 0, 0, 1, 3, 1]
    assert hashes[:3].tolist() == hashes[4:7].tolist() and hashes[7] == hashes[1]
    sliced, _ = words.token_hashes(texts.slice(4), words.BLANK_SEPARATED)
    assert sliced.tolist() == hashes[4:].tolist()
    marks, cuts = words.token_hashes(pa.array(["a,b é!!"]), words.WORDS_AND_MARKS)
    assert len(marks) == 5


# --- quality --------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(3)) == 0
    model = quality.fit(docs, labels.where(~held_out))
    judged = quality.classify(docs, model).select("row.doc_id", "log_weight", "key", "kept")
    kept = {(r.quality, r.toxic): r.share for r in judged.join(labels.where(held_out), "doc_id").groupBy(
        "quality", "toxic").agg(F.avg(F.col("kept").cast("double")).alias("share")).collect()}
    assert kept[(1, 0)] > 0.99 and kept[(0, 0)] < 0.1
    again = quality.fit(docs.repartition(5), labels.where(~held_out).repartition(3))
    assert again.cutoff == model.cutoff and (again.ratios == model.ratios).all()


def test_held_out_toxicity(spark):
    """Toxic documents of sound quality go, and hardly another one with them."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(3)) == 0
    model = quality.fit(docs, labels.where(~held_out))
    judged = quality.classify(docs, model).join(labels.where(held_out), F.col("row.doc_id") == F.col("doc_id"))
    mild = F.col("toxicity") <= model.most_toxic / quality.UNIT
    share = {r.toxic: r for r in judged.where("quality = 1").groupBy("toxic").agg(
        F.avg(F.col("kept").cast("double")).alias("kept"),
        F.avg(mild.cast("double")).alias("mild")).collect()}
    assert share[1].kept < 0.2 and share[1].mild < 0.2
    assert share[0].mild > 0.99 and share[0].kept > 0.98


def test_draw_is_gumbel_top_k(spark):
    keys = spark.range(5000).select((F.xxhash64("id") % 100_000_000).alias("key"))
    values = sorted((r.key for r in keys.collect()), reverse=True)
    for k in (1, 7, 2500, 5000):
        assert quality.kth_largest(keys, k) == values[k - 1]
    assert quality.kth_largest(keys, 5001) is None
    assert quality.best_threshold(np.array([1, 2, 3, 4]), np.array([False, False, True, True])) == 3
    assert quality.best_threshold(np.array([1, 2]), np.array([True, True])) is None


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (99, 1, 0), (3, None, 1), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    frame = frames.clashing(spark)
    for given_labels in (labels, labels.limit(0)):
        model = quality.fit(frame, given_labels)
        got = quality.classify(frame, model)
        assert got.count() == len(frames.ROWS)
        assert got.select("row.*").columns == frame.columns
        assert {r.log_weight for r in got.where("row.text is null or row.text = ''").collect()} == {0.0}
    assert quality.classify(frame, model).where("not kept").count() == 0
    empty = frames.docs(spark, [])
    assert quality.classify(empty, quality.fit(empty, labels)).count() == 0


# --- the pipeline ---------------------------------------------------------------------------


def test_stages(spark, tmp_path):
    """Each stage against what it promises on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination",
                     "packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        result = stage(spark, docs, FOLDER)
        if name != "packing":
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        after[name] = docs
    kept = [(r.doc_id, r.text) for r in after["line_dedup"].collect()]
    want, _ = brute_near(kept)
    assert {r.doc_id for r in after["ngram_jaccard_join"].collect()} == want
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    clean = after["benchmark_decontamination"]
    assert decontamination.contamination(clean, benchmark).where("contaminated").count() == 0
    repeated = Counter()
    for r in after["line_dedup"].collect():
        lines = [line.strip(" ") for line in (r.text or "").split("\n")]
        repeated.update("\n".join(lines[k : k + 3]) for k in range(len(lines) - 2))
    long = [w for w, n in repeated.items() if n > 1 and len(re.sub(r"[ \t\r\n]", "", w)) >= 30]
    assert not long
    assert docs.agg(F.sum("length")).first()[0] == docs.select("doc_id", "doc_tokens").distinct().agg(
        F.sum("doc_tokens")).first()[0]
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in clean.collect()}


def brute_near(rows):
    """Documents left of each group at five words and 0.8, by shared shingles."""
    sets = {key: shingles(text, 5) for key, text in rows}
    owners = defaultdict(list)
    for key, s in sets.items():
        for shingle in s:
            owners[shingle].append(key)
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key, s in sets.items():
        met = Counter(other for shingle in s for other in owners[shingle] if other < key)
        for other, shared in met.items():
            if 5 * shared >= 4 * (len(s) + len(sets[other]) - shared):
                x, y = root(key), root(other)
                parent[max(x, y)] = min(x, y)
    return {key for key in sets if root(key) == key}, sets


def test_pipeline_edges(spark):
    for frame in (frames.clashing(spark), frames.docs(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, frame, FOLDER)
            result.collect()
            if name != "packing":
                assert result.columns == frame.columns


def test_stage_two_works_out_its_lines_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 3


def test_weights_like_counting_in_plain_python(spark):
    """Counts, log ratios, weights, keys, cut and toxicity of the whole smallest tables, by loops."""
    import math

    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    options = quality.Settings(least=2.0, bits=14, toxic_bits=16)
    model = quality.fit(docs, labels, options)
    got = {(r.doc_id, r.text): r for r in quality.classify(docs, model).select(
        "row.doc_id", "row.text", "log_weight", "key", "toxicity", "kept").collect()}

    hashed = {}

    def hash_of(token):
        if token not in hashed:
            hashed[token] = int(words.token_hashes(pa.array([token]), words.WORDS_AND_MARKS)[0][0])
        return hashed[token]

    def grams(text):
        data = re.findall(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff \t-\r]+", (text or "").encode().lower())
        codes = [hash_of(token.decode()) for token in data]
        pairs = words.joined(np.array(codes, dtype=np.uint64), 2).tolist()
        return codes, [c >> (64 - options.bits) for c in codes] + [
            (c >> (64 - options.bits)) + (1 << options.bits) for c in pairs]

    sample = {r.id: r for r in quality.labelled_sample(labels, options, "doc_id").collect()}
    rows = [(r.doc_id, r.text, *grams(r.text)) for r in docs.collect()]
    raw, target = Counter(), Counter()
    for doc, _, _, found in rows:
        raw.update(found)
        if doc in sample and sample[doc].good and sample[doc].clean and sample[doc].fit:
            target.update(found)
    half = 1 << options.bits
    totals = [(sum(n for b, n in raw.items() if (b >= half) == p), sum(n for b, n in target.items() if (b >= half) == p))
              for p in (False, True)]
    ratio = {}
    for bucket, n in raw.items():
        of_raw, of_target = totals[bucket >= half]
        expected = n * (of_target / of_raw) if of_target else 0
        if of_target and expected >= options.least:
            ratio[bucket] = round(math.log((target[bucket] + options.smooth) / (expected + options.smooth)) * 65536)
    assert ratio and {b: int(model.ratios[b]) for b in ratio} == ratio
    assert np.count_nonzero(model.ratios) == sum(v != 0 for v in ratio.values())

    spotted, counted = {True: Counter(), False: Counter()}, Counter()
    for doc, _, codes, _ in rows:
        if doc in sample and sample[doc].fit:
            counted[sample[doc].clean] += 1
            spotted[sample[doc].clean].update({c >> (64 - options.toxic_bits) for c in codes})
    harsh = {}
    for bucket, n in spotted[False].items():
        if n >= options.least_toxic:
            value = round(math.log(((n + 1) / (counted[False] + 2)) / ((spotted[True][bucket] + 1) / (counted[True] + 2))) * 65536)
            if value > 0:
                harsh[bucket] = value
    for doc, text, codes, found in rows:
        total = sum(ratio.get(b, 0) for b in found)
        row = got[doc, text]
        assert row.log_weight == round(total / math.sqrt(max(len(codes), 1))) / 65536
        worst = sorted((harsh.get(b, 0) for b in {c >> (64 - options.toxic_bits) for c in codes}), reverse=True)
        assert row.toxicity == sum(worst[: options.strongest]) / 65536
    if model.cutoff is not None:
        keys = sorted((round(got[d, t].key * 65536) for d, t, _, _ in rows), reverse=True)
        passed = sum(round(got[d, t].key * 65536) >= model.cutoff for d, t, _, _ in rows)
        assert keys[passed - 1] >= model.cutoff > (keys[passed] if passed < len(keys) else -10**18)
    # The draw: the same variate for the same document, spread as a Gumbel variate is.
    noise = np.array([(r.key - r.log_weight) / options.temperature for r in got.values()])
    assert abs(noise.mean() - 0.5772) < 0.35 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.35


def test_intermediate_tables_go(spark):
    import os

    kept = stored(spark.range(3), "kept")
    with pytest.raises(RuntimeError), intermediates():
        inner, early = stored(spark.range(4), "inner"), stored(spark.range(5), "early")
        discard(early)
        assert not os.path.isdir(early.stored_at.removeprefix("file:")) and inner.count() == 4
        raise RuntimeError
    assert not os.path.isdir(inner.stored_at.removeprefix("file:"))
    assert kept.count() == 3
    discard(kept, early)
    assert not os.path.isdir(kept.stored_at.removeprefix("file:"))
