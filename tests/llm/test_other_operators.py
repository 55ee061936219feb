from collections import Counter
import numpy as np
import pytest
from pyspark.sql import functions as F

from botiquin.llm import hilbert, polytope, queries, secrets, url_rules
from botiquin.session import work_dir
from tests.llm import frames

FOLDER = "/root/testdata/sf0.01"


# --- Hilbert sharding -----------------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve(spark, dims, bits):
    """All cells once, and each step changes one coordinate by one."""
    side = 1 << bits
    cells = spark.range(side**dims).select(
        *[(F.floor(F.col("id") / side**d) % side).cast("int").alias(f"c{d}") for d in range(dims)]
    )
    place = hilbert.curve_place([F.col(f"c{d}") for d in range(dims)], bits)
    rows = cells.withColumn("place", place).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(side**dims))
    points = np.array([tuple(r)[:dims] for r in rows])
    assert (np.abs(np.diff(points, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    rows = queries.hilbert_sharding(spark, FOLDER).collect()
    counts = {}
    for r in rows:
        counts.setdefault(r.shard, []).append(r.slot)
    assert sorted(counts) == list(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1


def test_shard_edges_and_files(spark):
    frame = frames.clashing(spark)
    dims = [F.col("source"), F.col("lang"), hilbert.size_level(F.col("n_chars"))]
    got = hilbert.hilbert_shards(frame, dims, ["doc_id", "n_chars"], shards=4)
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [2, 3, 3, 3]
    path = work_dir(spark, "shards")
    plain = hilbert.hilbert_shards(frames.docs(spark), dims, ["doc_id", "n_chars"], shards=4)
    hilbert.write_shards(plain, path, rows_per_file=2)
    assert spark.read.parquet(path).count() == len(frames.ROWS)
    assert hilbert.hilbert_shards(frames.docs(spark, []), dims, ["doc_id"]).count() == 0


def test_shards_of_many_levels(spark):
    """Beyond the number of levels that are sent to all tasks the cells are the same."""
    level = F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("string"))
    rows = spark.range(120_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, level).alias("source"))
    dims = [F.col("source"), F.col("doc_id") % 7]

    def shards(**options):
        got = hilbert.hilbert_shards(rows, dims, ["doc_id"], **options)
        return got.select("row.doc_id", "curve", "shard", "slot")

    assert shards(most_levels=1000).exceptAll(shards(most_levels=1_000_000)).isEmpty()
    cells = {r.level: r.cell for r in hilbert.cells_of(rows, "source", 8).collect()}
    counts = Counter(r.source for r in rows.collect())
    before = 0
    for name in sorted(counts, key=lambda n: (n is not None, n or "")):
        assert cells[name] == before * 256 // 120_000
        before += counts[name]


# --- nearest neighbours ---------------------------------------------------------------------


def brute(ids, vectors, query, k=20):
    scores = vectors @ vectors[ids.index(query)]
    order = sorted((-s, i) for s, i in zip(scores.tolist(), ids) if i != query)
    return [(i, -s) for s, i in order[:k]]


def recall(spark, frame, ids, vectors, k=20):
    got = {}
    for r in polytope.nearest(frame, F.col("vec_id") % 20 == 0, k).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for query, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, min(k, len(ids) - 1) + 1))
        assert all((-a[2], a[1]) <= (-b[2], b[1]) for a, b in zip(found, found[1:]))
        want = brute(ids, vectors, query, k)
        at = dict(zip(ids, vectors @ vectors[ids.index(query)]))
        assert all(abs(at[i] - s) < 1e-9 for _, i, s in found)
        hit += sum(s >= want[-1][1] - 1e-12 for _, _, s in found)
        total += len(want)
    assert len(got) == sum(i % 20 == 0 for i in ids)
    return hit / total


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = frame.orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in rows], dtype=np.float64)
    assert recall(spark, frame, [r.vec_id for r in rows], vectors) > 0.95


def test_recall_with_lengths(spark):
    """Vectors of very different lengths, where the largest product favours the long ones."""
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(2000, 24)) * draw.uniform(0.3, 3.0, size=(2000, 1))
    frame = spark.createDataFrame(
        [(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>"
    )
    assert recall(spark, frame, list(range(2000)), vectors) > 0.9


def test_copies_and_odd_vectors(spark):
    draw = np.random.default_rng(4)
    one = draw.normal(size=8).tolist()
    rows = [(k, one) for k in range(100)]
    rows += [(k, draw.normal(size=8).tolist()) for k in range(100, 160)]
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] * 8),
             (280, [float("inf")] * 8), (300, [1.0, 2.0]), (None, one)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = polytope.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect()
    assert {r.query_id for r in got} == set(range(0, 160, 20))
    for query in range(0, 100, 20):
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)]
        assert mine == [k for k in range(21) if k != query][:20]
    few = polytope.nearest(frame.where("vec_id between 100 and 109"), F.col("vec_id") == 100, 20).collect()
    assert sorted(r.vec_id for r in few) == list(range(101, 110))
    assert polytope.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    """Different vectors with one product to the query, far more than an answer holds."""
    draw = np.random.default_rng(8)
    tied = draw.normal(size=(500, 7)).tolist()
    rows = [(0, [1.0] + [0.0] * 7)] + [(k, [1.0] + v) for k, v in enumerate(tied, 1)]
    draw.shuffle(rows[1:])
    frame = spark.createDataFrame([rows[0], *reversed(rows[1:])], "vec_id long, embedding array<double>")
    index = polytope.Index(tables=2, probes=1.0, block=100)
    got = polytope.nearest(frame, F.col("vec_id") % 501 == 0, 20, index).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(1, 21))


# --- URL rules ------------------------------------------------------------------------------


def test_host_and_path(spark):
    urls = {
        "http://A.Example.COM/en/1?x=/y#z": ("a.example.com", "/en/1"), "https://x.org": ("x.org", ""),
        "https://x.org?q=a://b/c": ("x.org", ""), "x.org/en": ("", ""), None: ("", ""), "": ("", ""),
        "a://b://c/d": ("b:", "//c/d"), "http:///p": ("", "/p"), "s://É.com/ü": ("É.com", "/ü"),
        "http://h#f/g": ("h", ""),
    }
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = frame.select("url", url_rules.host_of(F.col("url")).alias("h"), url_rules.path_of(F.col("url")).alias("p"))
    assert {r.url: (r.h, r.p) for r in rows.collect()} == urls


def given(host, path):
    best = None
    for verdict, h, p in queries.URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return best or (None, None)


def test_given_rules_on_all_pages(spark):
    for r in queries.url_association_rules(spark, FOLDER).collect():
        rule, verdict = given(r.host, r.path)
        assert r.rule == rule
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def brute_rules(transactions, support, confidence):
    """All combinations by counting, and the same pruning."""
    from itertools import combinations

    transactions = [(items, label) for items, label in transactions if label]
    n, rules = len(transactions), {}
    tokens = sorted({t for items, _ in transactions for t in items})
    for size in (1, 2, 3):
        for needed in combinations(tokens, size):
            fits = [label for items, label in transactions if set(needed) <= set(items)]
            for label in ("allow", "block"):
                both = sum(x == label for x in fits)
                share = sum(x == label for _, x in transactions) / n
                if both and both / n >= support and both / len(fits) >= confidence and (
                    both / len(fits) > share) and any(
                        t.split(":")[0] in ("tld", "domain", "label") for t in needed):
                    rules[(needed, label)] = both / len(fits)
    return {
        (needed, label): c for (needed, label), c in rules.items()
        if not any(l == label and set(f) < set(needed) and d >= c for (f, l), d in rules.items())
    }


def test_mined_rules_against_counting(spark):
    draw = np.random.default_rng(8)
    transactions = []
    for _ in range(400):
        tld, seg = draw.choice(["a", "b"]), draw.choice(["x", "y", "z"])
        bad = tld == "a" and seg == "x"
        label = None if draw.random() < 0.2 else "block" if bad or draw.random() < 0.02 else "allow"
        transactions.append(([f"path:{seg}", f"tld:{tld}"], label))
    frame = spark.createDataFrame(transactions, "tokens array<string>, label string")
    mining = url_rules.Mining(support=0.02, confidence=0.7)
    got = {(tuple(r.needed), r.says): r.confidence for r in url_rules.mine(frame, mining).collect()}
    want = brute_rules(transactions, 0.02, 0.7)
    assert got.keys() == want.keys() and (("path:x", "tld:a"), "block") in got
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_mined_rules_judge_other_urls(spark):
    labelled = [(f"http://h{k}.bad.org/casino/{k}", "block") for k in range(30)]
    labelled += [(f"http://h{k}.good.org/news/{k}", "allow") for k in range(30)]
    pages = [("http://new.bad.org/casino/77",), ("http://new.good.org/news/1",), ("http://else.net/casino/1",),
             (None,), ("no url",), ("http://new.bad.org/casino/77",), ("http://a.com/x",)]
    got = url_rules.judge(
        spark.createDataFrame(pages, "url string").withColumn("host", F.lit("clash")),
        queries.URL_RULES, spark.createDataFrame(labelled, "url string, label string"),
    ).collect()
    verdicts = {r.row.url: (r.verdict, r.rule) for r in got}
    assert len(got) == 7
    assert verdicts["http://new.bad.org/casino/77"] == ("block", None)
    assert verdicts["http://new.good.org/news/1"] == ("allow", None)
    assert verdicts["http://else.net/casino/1"] == verdicts[None] == verdicts["no url"] == ("allow", None)
    assert verdicts["http://a.com/x"] == ("allow", "com/")
    nothing = spark.createDataFrame([], "url string")
    assert url_rules.judge(nothing, queries.URL_RULES).count() == 0


def test_rules_judge_urls_held_out(spark):
    """Rules mined from half of the labelled pages, by their verdicts of the other half."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").distinct()
    host, path = url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))
    rule, label = url_rules.given_rule(host, path, queries.URL_RULES)
    labelled = pages.select("url", label.alias("label")).where("label is not null")
    half = F.pmod(F.xxhash64("url", F.lit("half")), F.lit(2)) == 0
    got = url_rules.judge(labelled.where(~half), [], labelled.where(half))
    rows = got.select("row.label", "verdict", "mined_confidence").collect()
    judged = [r for r in rows if r.mined_confidence]
    assert len(judged) > 0.8 * len(rows) and len({r.verdict for r in judged}) == 2
    assert sum(r.label == r.verdict for r in judged) > 0.95 * len(judged)
    # In the query rules judge pages that no given rule fits.
    open_rows = queries.url_association_rules(spark, "/root/testdata/sf0.1").where("rule is null").collect()
    assert sum(r.mined_confidence is not None for r in open_rows) > 0.3 * len(open_rows)


# --- secrets --------------------------------------------------------------------------------


def test_held_out_findings(spark):
    """Trained on two thirds of the plain findings, judged on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = secrets.dictionary(docs, "text", 3)
    found = secrets.label(secrets.featured(secrets.candidates(docs, "doc_id", "text", "source"), known)).cache()
    test = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    judged = secrets.scan(docs, found.where(~test)).select("value", F.col("is_secret").alias("said"))
    checked = found.where(test & F.col("is_secret").isNotNull()).select("value", "is_secret").distinct()
    rows = judged.distinct().join(checked, "value").collect()
    truths = [r for r in rows if r.is_secret]
    assert len(truths) > 10
    assert sum(r.said for r in truths) >= 0.95 * len(truths)
    lies = [r for r in rows if not r.is_secret]
    assert sum(not r.said for r in lies) >= 0.95 * len(lies)


def test_short_and_marked_secrets_are_candidates(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [
        (1, 'set password = "Sup3rS3cret" and pwd: \'a!b@c#d$e%f.g\' here', "src/a.py", None, 1),
        (2, f'  db_passwd=x9!k api_key="{key}"\nthe password is "two words 7" now', "src/b.py", None, 1),
        (3, 'the word Sup3rS3cret alone, "quoted" as well', "src/c.py", None, 1),
        (4, 'token "open', "src/d.py", None, 1),
    ]
    frame = frames.docs(spark, [(i, text, None, path, n) for i, text, path, _, n in rows])
    got = secrets.scan(frame).select("id", "word", "part", "value", "assigned", "quoted", "after_credential")
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, 3, -1, "Sup3rS3cret", 1, 1, 1), (1, 6, -2, "a!b@c#d$e%f.g", 1, 1, 1),
        (2, 1, -1, "x9!k", 1, 0, 1), (2, 2, 0, key, 1, 1, 1), (2, 6, -3, "two words 7", 0, 1, 1),
        (4, 1, -1, "open", 0, 1, 1),
    ]


def test_secret_edges(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [(1, f'token = "{key}" and again token = "{key}"', "x", "src/app.py", 1),
            (1, "a perfectly ordinaryandlonglongword here", "x", None, 1), *frames.ROWS]
    got = secrets.scan(frames.clashing(spark, rows))
    hits = [r for r in got.collect() if r.value == key]
    assert [r.word for r in sorted(hits, key=lambda r: r.word)] == [2, 7]
    assert all(r.is_secret for r in hits)
    assert secrets.scan(frames.docs(spark, [])).count() == 0


def planted(seed, n):
    """Texts with credentials, and with values of the same shapes that are none; and the truth."""
    draw = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def random_of(alphabet, size):
        return "".join(draw.choice(list(alphabet), size))

    def card():
        digits = [int(d) for d in random_of("0123456789", 15)]
        total = sum(d if i % 2 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(digits))
        return "".join(map(str, digits)) + str(-total % 10)

    kinds = [
        (True, 'api_key = "{}"', lambda: random_of(letters, 32)),
        (True, "Authorization: Bearer {} in the header", lambda: random_of(letters + "-_", 40)),
        (True, "export AWS_SECRET_ACCESS_KEY={}", lambda: random_of(letters + "+/", 40)),
        (True, "the password is '{}'", lambda: random_of(letters + "!@#%", 11)),
        (False, "as of commit {} this holds", lambda: random_of("0123456789abcdef", 40)),
        (False, "request id {} failed", lambda: "-".join(random_of("0123456789abcdef", k) for k in (8, 4, 4, 4, 12))),
        (False, "sha256 {} of the licence", lambda: random_of("0123456789abcdef", 64)),
        (False, "order {} was paid", card),
        (False, "see {} for more", lambda: "".join(draw.choice(["river", "mountain", "valley", "forest"], 5))),
    ]
    rows, truth = [], {}
    for k in range(n):
        is_secret, template, value = kinds[k % len(kinds)]
        made = value()
        truth[made] = is_secret
        rows.append((k, f"river and mountain, valley of forest {k % 7}. " + template.format(made), None, "src/a.py", 1))
    return rows, truth


def test_planted_kinds_held_out(spark):
    """Trained on true labels of half of the planted findings, judged on the other half's."""
    rows, truth = planted(3, 900)
    frame = frames.docs(spark, rows)
    known = secrets.dictionary(frame, "text", 3)
    found = secrets.featured(secrets.candidates(frame, "doc_id", "text", "source"), known)
    labels = spark.createDataFrame(list(truth.items()), "value string, is_secret boolean")
    labelled = found.join(labels, "value").where("id % 2 = 0")
    judged = secrets.scan(frame, labelled).where("id % 2 = 1").select("value", "is_secret").collect()
    judged = [(truth[r.value], r.is_secret) for r in judged if r.value in truth]
    assert {v for v, t in truth.items() if t} and len(judged) >= 400
    hits = sum(real and said for real, said in judged)
    assert hits >= 0.95 * sum(real for real, _ in judged)       # recall
    assert hits >= 0.95 * sum(said for _, said in judged)       # precision


def test_card_numbers_and_features(spark):
    values = {"4111111111111111": True, "4111111111111112": False, "79927398713": False, "4242424242424242": True,
              "x411111111111111": False, "": False}
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    got = frame.select("value", F.coalesce(secrets.card_number(F.col("value")), F.lit(False)).alias("card")).collect()
    assert {r.value: r.card for r in got} == values
    docs = frames.docs(spark, [(k, 'the word there "aB3-cD4=eF5/gH6+" there', None, "a/b/test.py", 1) for k in range(3)])
    known = secrets.dictionary(docs, "text", 3)
    row = secrets.featured(secrets.candidates(docs, "doc_id", "text", "source"), known).first()
    assert (row.chars, row.variety, row.covered_share, row.path_depth, row.path_example) == (16, 1.0, 0, 3, 1)
    pairs = row.features[len(secrets._SHAPE):][:16]
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" for c in row.value]
    counted = Counter(zip(kinds, kinds[1:]))
    assert [round(p * 15) for p in pairs] == [counted[a, b] for a in "aA0-" for b in "aA0-"]
    beside = row.features[len(secrets._SHAPE) + 16 :]
    assert len(beside) == 32 and sum(beside) == 2


@pytest.mark.parametrize("unit", ["a1B2c3D4e5F6g7H8 ", "a1B2c3D4e5F6g7H8,", 'token="short{}" ', "secret" * 3 + "."])
def test_work_in_proportion_to_the_text(spark, unit):
    import time

    def seconds(n):
        text = "".join(unit.format(k) for k in range(n))
        frame = frames.docs(spark, [(1, text, None, "x", 1)])
        start = time.perf_counter()
        rows = secrets.candidates(frame, "doc_id", "text", "source").count()
        return time.perf_counter() - start, rows

    seconds(10)
    took, rows = seconds(40_000)
    assert took < 10 and rows >= (40_000 if "secret" not in unit else 1)
