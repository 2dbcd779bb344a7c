"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates: a run of at least ``SHORTEST`` key characters with a digit in it; a run after a
vendor's prefix, with or without digits; and what a secret's name is set to by ``:`` or ``=``, from
``SHORTEST_NAMED`` characters on. A name set by ``=`` is no part of the value. The texts between
candidates give each one's neighbourhood. Its features: length, shares of character
classes, transitions between classes, distinct characters, coverage by words (those of its own
document and a short list of identifiers' words), path marks, and the words beside it.

The forest is Spark's, trained on labelled findings. Where no labelled table is given, findings
of documents that are not held out label themselves where the case is plain: an assignment
to a name such as ``token`` or a vendor's prefix for a secret; digits alone, a name such as
``commit`` or ``uuid``, or a path for none. A plain case labels all findings of its value, in other
places and documents too, whose own neighbourhood says nothing: these labels do not come from
what the forest sees of them. At most ``MOST_FINDINGS`` are used, chosen by a hash.

Main path: DataFrame expressions and Spark's own learner.

Special cases: a null text has no findings; findings of a row without id have a null id; equal
findings are returned as often as they occur; without labelled findings of both kinds every
finding counts as a secret with probability 1; an empty table gives an empty result; columns
other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, apart_by, fold, table

SHORTEST = 16
MOST_FINDINGS = 20_000
THRESHOLD = 0.5
TREES = 24
TREE_DEPTH = 6
BEFORE, AFTER = 48, 24  # characters of the neighbourhood

KEY = r"[A-Za-z0-9+/_\-]"
SHORTEST_NAMED = 6

# Names that announce a secret or another long string, and vendors' prefixes.
SECRET_NAMES = (
    r"(?i)(secret|token|passw(or)?d|pwd|api[_-]?key|apikey|access[_-]?key|auth|credential|private)"
)
OTHER_NAMES = r"(?i)(commit|sha|md5|hash|checksum|digest|uuid|guid|version|build|rev|isbn|order|phone|tel|card)"
VENDORS = r"AKIA|ASIA|AIza|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|sk-|xox[abp]-|eyJ"
VENDOR = rf"^({VENDORS})"

SET = r"[:=]>?\s{0,3}[\"']?"
NAMED = rf"(?<={SECRET_NAMES.replace('(?i)(', '(?i:')}[\w\-]{{0,16}}[\"']?\s{{0,3}}{SET})"
CANDIDATE = (
    # The look-arounds in front fail at once for most places in prose.
    rf"(?<=[\s:=>\"'])(?=[!-~]{{{SHORTEST_NAMED}}})(?<={SET}){NAMED}"
    rf"[A-Za-z0-9!@#$%^&*+/_=\-.~?]{{{SHORTEST_NAMED - 1},}}[A-Za-z0-9!@#$%^&*+/_=\-~]"
    rf"|(?<!{KEY})(?:(?:{VENDORS}){KEY}[A-Za-z0-9+/_.\-]{{10,}}{KEY}"
    rf"|(?=[A-Za-z+/_\-]*+[0-9]){KEY}{{{SHORTEST},}}+(?!=[^\s=])={{0,2}})"
)
# Words that identifiers and paths are made of.
IDENTIFIER_WORDS = (
    "index user name file page item list data http https html json test example value table "
    "post image main content article default config path home local public static"
).split()

FEATURES = (
    "length digits upper lower other transitions distinct hexadecimal coverage slashes marks "
    "extension assigned quoted secret_name other_name digit_neighbour vendor letters_only"
).split()


def may_have_candidates(text: Column) -> Column:
    """Whether a text has what every candidate has one of: a digit, a sign that sets a name, or a
    vendor's prefix. Plain searches, much cheaper than the pattern where there is none."""
    likely = text.rlike("[0-9:=]")
    for vendor in VENDORS.split("|"):
        likely |= text.contains(vendor.split("[")[0])
    return likely


def findings(
    docs: DataFrame, id_col: str, text_col: str, carried: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, carried columns, number, value, before, after, words): all candidates of all
    texts."""
    text = F.col(text_col)
    held = docs.filter(may_have_candidates(text) & text.rlike(CANDIDATE)).select(
        F.col(id_col).cast("long").alias("doc_id"),
        *carried,
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("values"),
        F.split(text, CANDIDATE, -1).alias("between"),
    )
    # Words of the document that could make up a candidate, each once.
    runs = F.expr("flatten(transform(between, b -> regexp_extract_all(lower(b), '[a-z]{4,}', 0)))")
    found = held.select("doc_id", *carried, "values", "between", F.array_distinct(runs).alias("words"))
    needed = F.array_distinct(
        F.expr("flatten(transform(values, v -> regexp_extract_all(lower(v), '[a-z]{4,}', 0)))")
    )
    return (
        found.withColumn("words", F.array_intersect("words", needed))
        .select("doc_id", *carried, "between", "words", F.posexplode("values").alias("number", "value"))
        .select(
            "doc_id",
            *carried,
            "number",
            "value",
            F.expr(f"right(between[number], {BEFORE})").alias("before"),
            F.expr(f"left(between[number + 1], {AFTER})").alias("after"),
            "words",
        )
    )


def _count(pattern: str) -> Column:
    return F.length("value") - F.length(F.regexp_replace("value", pattern, ""))


def with_features(found: DataFrame) -> DataFrame:
    length = F.length("value").cast("double")
    known = F.concat(F.col("words"), F.array(*[F.lit(w) for w in IDENTIFIER_WORDS]))
    parts = F.expr("regexp_extract_all(lower(value), '[a-z]{4,}', 0)")
    covered = F.aggregate(
        F.filter(parts, lambda p: F.array_contains(known, p)),
        F.lit(0),
        lambda n, p: n + F.length(p),
    )
    columns = {
        "length": length,
        "digits": _count("[0-9]") / length,
        "upper": _count("[A-Z]") / length,
        "lower": _count("[a-z]") / length,
        "other": _count("[^A-Za-z0-9]") / length,
        "transitions": F.length(F.regexp_replace("value", "[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]+", "x")) / length,
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / length,
        "hexadecimal": F.col("value").rlike("^[0-9a-fA-F]+$"),
        "coverage": covered / length,
        "slashes": _count("/") / length,
        "marks": _count("[_=+\\-]") / length,
        "extension": F.col("after").rlike(r"^\.[a-z]{2,4}\b"),
        "assigned": F.col("before").rlike(r"[:=]\s*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$"),
        "secret_name": F.col("before").rlike(SECRET_NAMES),
        "other_name": F.col("before").rlike(OTHER_NAMES),
        "vendor": F.col("value").rlike(VENDOR),
        "letters_only": F.col("value").rlike("^[A-Za-z]?[a-z]*$"),
        "digit_neighbour": F.col("before").rlike(r"[0-9]\W*$") | F.col("after").rlike(r"^\W*[0-9]"),
    }
    return found.select("*", *[columns[n].cast("double").alias(n) for n in FEATURES])


def plain_cases(found: DataFrame) -> Column:
    """1.0 for a plain secret, 0.0 for plainly none, null for all others."""
    named = F.col("before").rlike(SECRET_NAMES + r"[\w\-]{0,16}[\"']?\s*[:=]\s*[\"']?$")
    # A word after a name may be prose: "the secret: patience".
    word = (F.col("letters_only") == 1) & (F.col("length") < SHORTEST)
    other = (
        F.col("value").rlike("^[0-9]+$")
        | F.col("before").rlike(OTHER_NAMES + r"[\w\-]{0,16}[\"']?\s*[:=#]?\s*[\"']?$")
        | (F.col("slashes") * F.col("length") >= 2)
        | (F.col("coverage") > 0.6)
    )
    secret = named & ~F.col("value").rlike("^[0-9]+$") & ~word
    return F.when(F.col("value").rlike(VENDOR) | secret, 1.0).when(other | (named & word), 0.0)


def labels_of_values(found: DataFrame) -> DataFrame:
    """The findings with ``label``: their own plain case's, else that of plain cases of the same
    value in any place, if these agree. Counts by value combine before they shuffle."""
    own = found.withColumn("own", plain_cases(found)).withColumn("of_value", F.xxhash64("value"))
    agreed = (
        own.filter("own IS NOT NULL")
        .groupBy("of_value")
        .agg(F.min("own").alias("least"), F.max("own").alias("most"))
        .filter("least = most")
        .select("of_value", F.col("least").alias("elsewhere"))
    )
    # Only findings that say nothing themselves look their value up.
    silent = own.filter("own IS NULL").join(agreed, "of_value", "left")
    named = own.filter("own IS NOT NULL").withColumn("elsewhere", F.lit(None).cast("double"))
    both = named.unionByName(silent)
    return both.withColumn("label", F.coalesce("own", "elsewhere")).drop("own", "elsewhere", "of_value")


def scan(
    docs: DataFrame,
    *,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_findings: int = MOST_FINDINGS,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, number (of the candidate in its text), value, before, probability, is_secret,
    after the columns of the documents that are ``carried``.

    ``labelled`` has (doc_id, number, label): findings that were judged, 1 for a secret.
    """
    work = Workspace(docs.sparkSession, "secret_scan")
    found = work.write(
        with_features(findings(docs, id_col, text_col, carried)).drop("words"), "findings"
    )
    if labelled is None:
        judged = labels_of_values(found)
    else:
        judged = found.join(
            labelled.select("doc_id", "number", F.col("label").cast("double")), ["doc_id", "number"]
        )
    sample = (
        judged.filter(F.col("label").isNotNull() & (fold("doc_id") != 0))
        .select("label", F.xxhash64("doc_id", "number").alias("order"), "doc_id", "number", *FEATURES)
        .orderBy("order", "doc_id", "number", *FEATURES)
        .limit(most_findings)
    )
    sample = work.write(sample.coalesce(1), "sample")  # the forest's draws follow the row order
    kinds = {r.label for r in sample.select("label").distinct().collect()}
    result = [*carried, "doc_id", "number", "value", "before"]
    if kinds != {0.0, 1.0}:
        return found.select(
            *result, F.lit(1.0).alias("probability"), F.lit(True).alias("is_secret")
        )
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=TREE_DEPTH, seed=5
    ).fit(vectors.transform(sample))
    # The copy lacks the training summary. That holds the session, which cannot be sent to
    # tasks once any query of it has observed a metric.
    forest = forest.copy()
    work.drop(sample)
    scored = forest.transform(vectors.transform(found))
    return scored.select(
        *result, vector_to_array("probability")[1].alias("probability")
    ).withColumn("is_secret", F.col("probability") >= THRESHOLD)


def redact(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """The documents with every secret found in their texts replaced; ``n_chars`` follows.

    Findings follow from the text alone, so they are joined back by its hash: every row has its
    own text's secrets replaced, with or without an id. They are put in order of falling length,
    so one that is part of another is replaced after it. Only rows that may have secrets are
    joined with them; the others are passed on.
    """
    hashed = F.xxhash64("text")
    secrets = (
        scan(docs.select("doc_id", "text", hashed.alias("of")), carried=("of",))
        .filter("is_secret")
        .groupBy("of")
        .agg(F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), False).alias("found"))
    )
    secrets = Workspace(docs.sparkSession, "redact").write(secrets, "secrets")
    concerned, others = apart_by(docs, hashed, secrets.select(F.col("of").alias("h")))
    rows = concerned.select(F.struct("*").alias("row"), hashed.alias("row_hash"))
    joined = rows.join(secrets, F.col("row_hash") == F.col("of"), "left")
    text = F.when(F.col("found").isNull(), F.col("row.text")).otherwise(
        F.aggregate(F.col("found.value"), F.col("row.text"), lambda t, v: F.replace(t, v, F.lit(mark)))
    )
    changed = {"text": text}
    if "n_chars" in docs.columns:
        size = F.when(F.col("found").isNull(), F.col("row.n_chars")).otherwise(F.length(text))
        changed["n_chars"] = size.cast(dict(docs.dtypes)["n_chars"])
    cleaned = joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return cleaned.unionByName(others)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
