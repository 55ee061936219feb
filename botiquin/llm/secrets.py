"""Scanning texts for secrets, with a random forest that removes false findings.

Candidates are runs of 16 or more letters, digits and the marks of encoded values and, whatever
their length and marks, values that are assigned to a word for a credential or stand in quotes
behind one. A forest trained on labelled findings judges each by its shape and its surroundings:
length; character transitions, as the shares of the sixteen pairs of kinds (small and capital
letters, digits, marks) and as the mean log-probability of its letter pairs under the words of the
documents; coverage by a dictionary of these words; the path it was found under; and the words
beside it, hashed. All steps are DataFrame functions and Spark's own forest.

The dictionary are the words of three or more letters that at least ``least_docs`` documents have,
counted over all documents; letter pairs are counted over the dictionary. The forest is trained on
at most ``most_labelled`` findings of each kind, chosen by hash, a documented bound; every candidate
of every document is judged.

Without labelled findings from outside, ``label`` gives those that are plain by signs the forest
does not see: a quoted value assigned to a word for a credential is a secret; a number whose check
digit is right as that of a card, a UUID, a number or word of the dictionary alone, or one repeated
character is none. All others are left to the forest.

The work is in proportion to a text's length, whatever stands in it.

Defined cases: null and empty texts have no candidates. A null path counts as an empty one. Rows
with the same id and repeated rows are scanned each for itself, and a value that occurs again in a
text is a finding each time. With labels of one kind only there is no forest, and a candidate
counts as a secret unless it is labelled none. An empty table gives none. Only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import stored, worked_out

VALUE = "[A-Za-z0-9+/_=-]{16,}"

# Words that stand before credentials, and in paths or beside values that are only examples.
_NAMES = "secret|token|passw|pwd|credential|api.?key|access.?key|private.?key|auth|bearer"
CREDENTIAL = f"(?i)({_NAMES})"
EXAMPLE = "(?i)(example|sample|dummy|placeholder|test|mock|fixture|fake|xxxx)"

# A credential's name up to its value, and the value: up to the closing quote, or else up to a blank.
ASSIGNED = (
    f"((?i:{_NAMES})[A-Za-z0-9_.-]{{0,64}}[\"'\\]]{{0,2}}"
    "(?:[ \\t]*(?::=|=>|==?|:)[ \\t]*[\"']?|[ \\t]+(?:is[ \\t]+)?[\"']))"
    "(?:(?<=\")([^\"\\r\\n]+)\"|(?<=')([^'\\r\\n]+)'|([^ \\t\\r\\n\"',;]+))"
)
_BLANKS = "[ \\t\\r\\n]+"

_UUID = "(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
# Stands for assigned values in a text whose other words are numbered; taken out of texts before.
_MARK = "\u0001"
# Kinds of characters, and how many numbers the words beside a value are hashed to.
_KINDS = "aA0-"
_HASHED = 16

_SHAPE = [
    "chars", "variety", "digit_share", "upper_share", "is_hex", "covered_share", "pair_logp",
    "path_depth", "path_example", "beside_example",
]


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, words of the dictionary, and the forest."""

    most_labelled: int = 20_000
    least_docs: int = 3
    trees: int = 30
    depth: int = 6
    least_probability: float = 0.5
    seed: int = 5


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """One row per candidate: id, path, word (its number in the text), part, value, and what is around it.

    ``part`` numbers the runs of a word from 0; values found by their assignment have -1 and below,
    by their number in the text, and count as one word of it. An assigned value that is one long run
    is found as such only.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        F.translate(F.col(text_col), _MARK, " ").alias("text"),
    )

    def near(place: Column, shift: int) -> Column:
        return F.coalesce(F.get("words", place + shift), F.lit(""))

    def around(place: Column) -> list[Column]:
        before = F.concat_ws(" ", near(place, -3), near(place, -2), near(place, -1))
        return [place.alias("word"), before.alias("before"), near(place, 1).alias("after")]

    # Neighbours are picked before rows are made, so that no row carries the words of its text.
    split_up = worked_out(
        rows.where(F.col("text").rlike(VALUE)), ["id", "path"], words=F.split("text", _BLANKS)
    )
    every = F.sequence(F.lit(0), F.size("words") - 1)
    holding = F.transform(
        F.filter(every, lambda i: F.get("words", i).rlike(VALUE)),
        lambda i: F.struct(F.get("words", i).alias("whole"), *around(i)),
    )
    between = F.split("whole", VALUE, -1)
    runs = (
        split_up.select("id", "path", F.inline(holding))
        .withColumn("values", F.regexp_extract_all("whole", F.lit(VALUE), F.lit(0)))
    )
    runs = worked_out(runs, ["id", "path", "word", "before", "after", "values"], between=between)
    pieces = F.transform(
        "values",
        lambda value, i: F.struct(
            i.alias("part"), value.alias("value"), F.get("between", i).alias("left"),
            F.get("between", i + 1).alias("right"),
        ),
    )
    runs = runs.select("id", "path", "word", "before", "after", F.inline(pieces)).select(
        "id", "path", "word", "part", "value", "before", "after",
        F.concat_ws(" ", "before", "left").alias("context"),
        (F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']")).alias("quoted"),
    )

    # Each assigned value becomes a mark, so the n-th mark's word is where the n-th value stands.
    assigned = worked_out(
        rows.where(F.col("text").rlike(ASSIGNED)), ["id", "path"],
        words=F.split(F.regexp_replace("text", ASSIGNED, "$1" + _MARK), _BLANKS),
        matches=F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(0)),
    )
    def marks_in(word: Column) -> Column:
        return F.length(word) - F.length(F.translate(word, _MARK, ""))

    marks = F.flatten(
        F.transform(
            F.filter(every, lambda i: F.get("words", i).contains(_MARK)),
            lambda i: F.array_repeat(F.struct(*around(i)), marks_in(F.get("words", i))),
        )
    )
    assigned = worked_out(assigned, ["id", "path", "matches"], places=marks)
    found = F.transform(
        "matches",
        lambda match, n: F.struct(
            match.alias("match"), (-1 - n).alias("part"), F.get("places", n).alias("place")
        ),
    )
    assigned = (
        assigned.select("id", "path", F.inline(found))
        .select(
            "id", "path", "part", "place.word", "place.before", "place.after",
            F.regexp_extract("match", ASSIGNED, 1).alias("head"),
            F.concat(*(F.regexp_extract("match", ASSIGNED, k) for k in (2, 3, 4))).alias("value"),
        )
        .where(~F.col("value").rlike("^" + VALUE + "$"))
        .select(
            "id", "path", "word", "part", "value", "before", "after",
            F.concat_ws(" ", "before", "head").alias("context"),
            F.col("head").rlike("[\"']$").alias("quoted"),
        )
    )
    return runs.union(assigned)


def dictionary(docs: DataFrame, text_col: str, least_docs: int) -> DataFrame:
    """Words of three or more letters, in lower case, that enough documents have, and their number."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z]{3,}"), F.lit(0)))
    counts = docs.select(F.explode(words).alias("piece")).groupBy("piece").agg(F.count("*").alias("docs"))
    return counts.where(F.col("docs") >= least_docs)


def _pairs(word: Column) -> Column:
    """Neighbouring letters of a word."""
    return F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substr(word, i, F.lit(2)))


def pair_model(known: DataFrame) -> DataFrame:
    """Log-probability of each letter after another in the words of the dictionary.

    A row for each of the 676 pairs at most; one that no word has is as likely as half a finding.
    """
    counts = known.select("docs", F.explode(_pairs(F.col("piece"))).alias("pair")).groupBy("pair").agg(
        F.sum("docs").alias("n")
    )
    letters = F.sequence(F.lit(ord("a")), F.lit(ord("z")))
    every = known.sparkSession.range(1).select(F.explode(letters).alias("a")).select(
        "a", F.explode(letters).alias("b")
    ).select(F.concat(F.chr(F.col("a")), F.chr(F.col("b"))).alias("pair"))
    full = every.join(counts, "pair", "left").select(
        "pair", F.substring("pair", 1, 1).alias("first"), F.coalesce(F.col("n").cast("double"), F.lit(0.5)).alias("n")
    )
    of_first = full.groupBy("first").agg(F.sum("n").alias("total"))
    return full.join(of_first, "first").select("pair", F.log(F.col("n") / F.col("total")).alias("logp"))


def _beside(word: Column, kind: str) -> Column:
    """A neighbouring word as one of ``_HASHED`` flags."""
    number = F.pmod(F.xxhash64(F.lit(kind), word), F.lit(_HASHED))
    return F.transform(F.sequence(F.lit(0), F.lit(_HASHED - 1)), lambda i: (number == i).cast("double"))


def featured(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with their features as an array, and what ``label`` goes by."""
    pieces = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))
    # Values are distinct here, so one that is everywhere costs one row.
    values = stored(found.select("value").distinct().withColumn("pieces", pieces), "values")
    covered = (
        values.select("value", F.explode("pieces").alias("piece")).join(known, "piece")
        .groupBy("value").agg(F.sum(F.length("piece")).alias("covered"))
    )
    likely = (
        values.select("value", F.explode("pieces").alias("piece"))
        .select("value", F.explode(_pairs(F.col("piece"))).alias("pair"))
        # 676 rows at most.
        .join(F.broadcast(pair_model(known)), "pair")
        .groupBy("value").agg(F.avg("logp").alias("pair_logp"))
    )
    told = stored(values.join(covered, "value", "left").join(likely, "value", "left").drop("pieces"), "told")
    length = F.length("value")
    kinds = "value"
    for pattern, kind in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "0"), ("[^aA0]", "-")):
        kinds = F.regexp_replace(kinds, pattern, kind)

    def count(kind: str) -> Column:
        return F.length(F.regexp_replace("value", f"[^{kind}]", ""))

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    transitions = [
        F.regexp_count("kinds", F.lit(f"{a}(?={b})")) / F.greatest(length - 1, F.lit(1)) for a in _KINDS for b in _KINDS
    ]
    # The last word with letters before the value, the next one behind it, without their marks.
    word_before = F.lower(F.regexp_extract("context", "([\\p{L}_]{2,})[^\\p{L}]*$", 1))
    word_after = F.lower(F.regexp_extract("after", "[\\p{L}_]{2,}", 0))
    shaped = found.join(told, "value", "left").withColumn("kinds", kinds).select(
        "id", "path", "word", "part", "value", "context", "quoted",
        length.cast("double").alias("chars"),
        (F.size(F.array_distinct(F.split("value", ""))) / length).alias("variety"),
        (count("0-9") / length).alias("digit_share"),
        (count("A-Z") / length).alias("upper_share"),
        flag(F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("is_hex"),
        (F.coalesce("covered", F.lit(0)) / length).alias("covered_share"),
        F.coalesce("pair_logp", F.lit(0.0)).alias("pair_logp"),
        F.size(F.split("path", "/")).cast("double").alias("path_depth"),
        flag(F.col("path").rlike(EXAMPLE)).alias("path_example"),
        flag(F.concat_ws(" ", "before", "after").rlike(EXAMPLE)).alias("beside_example"),
        F.array(*transitions).alias("transitions"),
        F.concat(_beside(word_before, "before"), _beside(word_after, "after")).alias("beside"),
    )
    features = F.concat(F.array(*_SHAPE), "transitions", "beside").alias("features")
    return shaped.select(
        "id", "path", "word", "part", "value", *_SHAPE, features,
        flag(F.col("context").rlike(CREDENTIAL)).alias("after_credential"),
        flag(F.col("context").rlike("[=:]\\s*[\"']?$")).alias("assigned"),
        flag(F.col("quoted")).alias("quoted"),
    )


def card_number(value: Column) -> Column:
    """Whether 13 to 19 digits end in the check digit that payment cards have."""
    digits = F.transform(F.regexp_extract_all(F.reverse(value), F.lit("[0-9]"), F.lit(0)), lambda d: d.cast("int"))
    total = F.aggregate(
        F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))),
        F.lit(0), lambda n, d: n + d,
    )
    return value.rlike("^[0-9]{13,19}$") & (total % 10 == 0)


def label(found: DataFrame) -> DataFrame:
    """``is_secret``: true and false for plain findings, null for the others."""
    value = F.col("value")
    plain = (F.col("after_credential") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1)
    letters = F.regexp_replace("value", "[^A-Za-z]", "")
    none = (
        F.coalesce(card_number(value), F.lit(False)) | value.rlike(f"^{_UUID}$")
        | (F.col("digit_share") == 1) | (F.col("variety") * F.col("chars") <= 2)
        | ((F.length(letters) == F.col("chars")) & (F.col("covered_share") > 0))
    )
    return found.withColumn("is_secret", F.when(plain & ~none, True).when(none & ~plain, False))


def train(labelled: DataFrame, settings: Settings):
    """A forest from findings with ``features`` and ``is_secret``, or None with labels of one kind only."""
    order = F.xxhash64("value", "path", "word", "part", F.lit(settings.seed)).alias("order")
    known = labelled.where("is_secret is not null").select(
        "features", F.col("is_secret").cast("double").alias("label"), order
    )
    kinds = [known.where(F.col("label") == k).orderBy("order").limit(settings.most_labelled) for k in (0, 1)]
    # Bounded by most_labelled; one ordered partition makes the forest the same on every cluster.
    sample = stored(kinds[0].union(kinds[1]).coalesce(1).sortWithinPartitions("order", "features"), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=settings.trees, maxDepth=settings.depth,
        seed=settings.seed,
    )
    return forest.fit(sample.select("label", array_to_vector("features").alias("vector")))


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
) -> DataFrame:
    """All candidates with features, ``probability`` and ``is_secret``.

    ``labelled`` has the features and ``is_secret``, as ``featured`` and ``label`` give them.
    """
    known = stored(dictionary(docs, text_col, settings.least_docs), "dictionary")
    around = stored(candidates(docs, id_col, text_col, path_col), "candidates")
    found = stored(featured(around, known), "featured")
    plain = label(found)
    model = train(plain if labelled is None else labelled, settings)
    if model is None:
        secret = F.coalesce("is_secret", F.lit(True))
        return plain.withColumn("is_secret", secret).withColumn("probability", secret.cast("double"))
    judged = model.transform(found.withColumn("vector", array_to_vector("features")))
    probability = vector_to_array("probability")[1]
    return judged.select(*found.columns, probability.alias("probability")).withColumn(
        "is_secret", F.col("probability") >= settings.least_probability
    )
