"""Quality rules whose cut-offs come from the corpus: quantile sketches per language and source.

Every document gets a few counts. A sketch of each rate is kept per (language, source) as a
histogram whose buckets grow with the value (exact below 64, then 32 buckets per power of
two, so a quantile is at most 1/32 too low). Histograms merge by adding, so they are a
grouped count: it combines before the shuffle, a hot source arrives as a few hundred rows
per task, and quantiles are read off a running sum. Groups with few documents use the
merged sketch of their language, and of all documents beyond that. The cut-offs are joined
back to the documents.

A document fails a rate that lies above median + max(floor, spread x twice the distance from the
first quartile to the median), and for two-sided rates below the mirrored bound: a rule that cuts
tails only where they are clearly apart, so a clean group loses nothing. The spread of each bound is
read on the other side of the median, where junk beyond the bound does not widen it, so a
group of which nearly half is junk is cut like a clean one. Where that side is wider than the floor
all the same, as when more than half is junk, the bound goes no further than that of the language's
merged sketch. Main path: DataFrame expressions only.

Special cases: a null text has no words; null language or source are groups of their own;
repeated rows are judged row by row; an empty table gives an empty result; columns other
than the four named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rate:
    """A rate in whole numbers, with the least distance from the median that can fail."""

    name: str
    numerator: str
    denominator: str
    scale: int
    floor: int
    low_too: bool = False


RATES = (
    Rate("word_length", "word_chars", "n_words", 1000, 1500, low_too=True),
    Rate("symbol_rate", "n_symbols", "n_words", 10_000, 1000),
    Rate("dup_line_rate", "n_dup_lines", "n_lines", 10_000, 3000),
    Rate("repeat_rate", "n_repeat_words", "n_words", 10_000, 2000),
)
SPREAD = 6
LEAST_DOCUMENTS = 100
QUARTILES = {"q1": 25, "q2": 50, "q3": 75}
LEVELS = ("source", "language", "all")


def counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The counts of every document, from its whole text.

    Repeated windows: three-word windows are compared by 64-bit hashes. Where two agree, the
    hashes are sorted with their places, so that equal ones are neighbours. The places left,
    in order, cover min(3, distance to the next) words each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col("lang").alias("lang"),
        F.col("source").alias("source"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    counted = split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.expr("aggregate(words, 0L, (n, w) -> n + length(w))").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(words) < 4 THEN array() ELSE transform(sequence(0, size(words) - 3),"
            " i -> xxhash64(words[i], words[i + 1], words[i + 2])) END"
        ).alias("hashes"),
    ).drop("lines")
    windows = counted.select(
        "*",
        F.expr(
            "CASE WHEN size(hashes) > size(array_distinct(hashes)) THEN"
            " sort_array(transform(hashes, (h, i) -> struct(h AS w, i AS at))) END"
        ).alias("windows"),
    ).drop("words", "hashes")
    places = windows.select(
        "*",
        F.expr(
            "sort_array(transform(filter(windows, (x, i) ->"
            " (i > 0 AND windows[greatest(i - 1, 0)].w = x.w) OR (i + 1 < size(windows)"
            " AND windows[least(i + 1, size(windows) - 1)].w = x.w)), x -> x.at))"
        ).alias("places"),
    ).drop("windows")
    covered = F.expr(
        "CASE WHEN coalesce(size(places), 0) <= 0 THEN 0L ELSE 3L + aggregate("
        "sequence(0, size(places) - 1), 0L, (n, i) -> n + CASE WHEN i + 1 < size(places)"
        " THEN least(3, places[least(i + 1, size(places) - 1)] - places[i]) ELSE 0 END) END"
    )
    return places.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines",
        "n_dup_lines", covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rate(r: Rate) -> Column:
    return F.when(
        F.col(r.denominator) > 0, F.expr(f"({r.numerator} * {r.scale}) div {r.denominator}")
    )


def bucket(value: Column) -> Column:
    """The lower end of the sketch's bucket: all but the six leading bits are zero."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n): the mergeable histograms of passing documents."""
    values = F.array(
        *[F.struct(F.lit(r.name).alias("rate"), rate(r).alias("value")) for r in RATES]
    )
    return (
        counted.filter(~base_failed())
        .select("lang", "source", F.explode(values).alias("v"))
        .filter(F.col("v.value").isNotNull())
        .groupBy("lang", "source", F.col("v.rate").alias("rate"), bucket(F.col("v.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame) -> DataFrame:
    """Each sketch at its own level and merged into the coarser ones."""
    levels = F.array(
        F.struct(F.lit("source").alias("level"), F.col("lang").alias("lang"), F.col("source").alias("source")),
        F.struct(F.lit("language").alias("level"), F.col("lang").alias("lang"), F.lit(None).cast("string").alias("source")),
        F.struct(F.lit("all").alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
    )
    return (
        sketch.select(F.explode(levels).alias("g"), "rate", "bucket", "n")
        .groupBy("g", "rate", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def bounds(sketch: DataFrame) -> DataFrame:
    """(level, lang, source, documents, rate, low, high) from the quartiles of each sketch."""
    running = merged(sketch).selectExpr(
        "g", "rate", "bucket",
        "sum(n) OVER (PARTITION BY g, rate ORDER BY bucket) AS below",
        "sum(n) OVER (PARTITION BY g, rate) AS total",
    )
    quartiles = running.groupBy("g", "rate").agg(
        F.max("total").alias("documents"),
        *[
            F.min(F.when(100 * F.col("below") >= q * F.col("total"), F.col("bucket"))).alias(name)
            for name, q in QUARTILES.items()
        ],
    )
    floor = F.lit(0)
    for r in RATES:
        floor = F.when(F.col("rate") == r.name, r.floor).otherwise(floor)
    floor = floor.cast("long")
    below, above = F.col("q2") - F.col("q1"), F.col("q3") - F.col("q2")
    own = quartiles.select(
        "g.level", "g.lang", "g.source", "documents", "rate", floor.alias("floor"),
        (below > floor).alias("wide_below"), (above > floor).alias("wide_above"),
        (F.col("q2") - F.greatest(floor, 2 * SPREAD * above)).alias("low"),
        (F.col("q2") + F.greatest(floor, 2 * SPREAD * below)).alias("high"),
    )
    of_language = own.filter("level = 'language'").select(
        F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"),
        F.col("low").alias("l_low"), F.col("high").alias("l_high"),
    )
    # A row per language and rate meets one per source and rate.
    same = F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rate") == F.col("l_rate"))
    joined = own.join(of_language, same & (F.col("level") == "source"), "left")
    low = F.when(F.col("wide_above"), F.greatest("low", "l_low")).otherwise(F.col("low"))
    high = F.when(F.col("wide_below"), F.least("high", "l_high")).otherwise(F.col("high"))
    low_too = F.col("rate").isin([r.name for r in RATES if r.low_too])
    return joined.select(
        "level", "lang", "source", "documents", "rate", F.when(low_too, low).alias("low"), high.alias("high")
    )


def cutoffs(bound: DataFrame) -> DataFrame:
    """One row per (level, lang, source) with the bounds of all rates."""
    columns = []
    for r in RATES:
        mine = F.col("rate") == r.name
        columns += [
            F.max(F.when(mine, F.col("low"))).alias(f"{r.name}_low"),
            F.max(F.when(mine, F.col("high"))).alias(f"{r.name}_high"),
        ]
    return bound.groupBy("level", "lang", "source").agg(
        F.max("documents").alias("documents"), *columns
    )


def judge(counted: DataFrame, cuts: DataFrame) -> DataFrame:
    """Join each document with the cut-offs of its group, or the first merged one with enough."""
    names = [f"{r.name}_{side}" for r in RATES for side in ("low", "high")]

    def level(name: str) -> DataFrame:
        packed = F.struct("documents", *names).alias(name)
        return cuts.filter(F.col("level") == name).select(
            F.col("lang").alias(f"{name}_lang"), F.col("source").alias(f"{name}_source"), packed
        )

    by_source, by_language, overall = (level(name) for name in LEVELS)
    # Few rows per language; the choice is made per group, so documents are joined once.
    chosen = (
        by_source.join(
            by_language, F.col("source_lang").eqNullSafe(F.col("language_lang")), "left"
        )
        .crossJoin(F.broadcast(overall))  # one row
        .select(
            "source_lang",
            "source_source",
            F.when(F.col("source.documents") >= LEAST_DOCUMENTS, F.col("source"))
            .when(F.col("language.documents") >= LEAST_DOCUMENTS, F.col("language"))
            .otherwise(F.col("all"))
            .alias("cut"),
        )
    )
    joined = counted.join(
        chosen,
        counted.lang.eqNullSafe(chosen.source_lang)
        & counted.source.eqNullSafe(chosen.source_source),
        "left",
    )
    outside = F.lit(False)
    for r in RATES:
        value = rate(r)
        outside |= F.coalesce(value > F.col(f"cut.{r.name}_high"), F.lit(False))
        outside |= F.coalesce(value < F.col(f"cut.{r.name}_low"), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~outside).alias("kept"),
    )


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base rules and the adaptive verdict of every document."""
    work = Workspace(docs.sparkSession, "quality_rules")
    counted = work.write(counts(docs, id_col, text_col), "counts")
    return judge(counted, cutoffs(bounds(sketches(counted))))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def q(name: str, percent: int) -> str:
        return f"min(CASE WHEN 100 * below >= {percent} * total THEN bucket END) AS {name}"

    floors = " ".join(f"WHEN '{r.name}' THEN {r.floor}" for r in RATES)
    two_sided = ", ".join(f"'{r.name}'" for r in RATES if r.low_too)
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{r.name}' AS rate, ({r.numerator} * {r.scale}) // {r.denominator} AS value"
        f" FROM counted WHERE NOT base_failed AND {r.denominator} > 0"
        for r in RATES
    )
    outside = " OR ".join(
        f"coalesce((c.{r.numerator} * {r.scale}) // nullif(c.{r.denominator}, 0) > {r.name}_high, false)"
        f" OR coalesce((c.{r.numerator} * {r.scale}) // nullif(c.{r.denominator}, 0) < {r.name}_low, false)"
        for r in RATES
    )
    picked = ", ".join(
        f"max(CASE WHEN rate = '{r.name}' THEN {side} END) AS {r.name}_{side}"
        for r in RATES
        for side in ("low", "high")
    )
    return rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
places AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM split WHERE len(w) >= 3),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY 1),
plain AS (
  SELECT s.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
counted AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM plain),
rates AS ({values}),
bucketed AS (
  SELECT lang, source, rate,
    (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS bucket FROM rates),
levels AS (
  SELECT 'source' AS level, lang, source, rate, bucket FROM bucketed
  UNION ALL SELECT 'language', lang, NULL, rate, bucket FROM bucketed
  UNION ALL SELECT 'all', NULL, NULL, rate, bucket FROM bucketed),
sketch AS (SELECT level, lang, source, rate, bucket, count(*) AS n FROM levels GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS below,
    sum(n) OVER (PARTITION BY level, lang, source, rate) AS total FROM sketch),
quartiles AS (
  SELECT level, lang, source, rate, max(total) AS documents, {", ".join(q(n, p) for n, p in QUARTILES.items())}
  FROM running GROUP BY ALL),
floors AS (SELECT *, CASE rate {floors} END AS f FROM quartiles),
own AS (
  SELECT *, q2 - greatest(f, 2 * {SPREAD} * (q3 - q2)) AS o_low, q2 + greatest(f, 2 * {SPREAD} * (q2 - q1)) AS o_high
  FROM floors),
bounded AS (
  SELECT o.*, CASE WHEN o.q3 - o.q2 > o.f AND m.f IS NOT NULL THEN greatest(o.o_low, m.o_low) ELSE o.o_low END AS b_low,
    CASE WHEN o.q2 - o.q1 > o.f AND m.f IS NOT NULL THEN least(o.o_high, m.o_high) ELSE o.o_high END AS b_high
  FROM own o LEFT JOIN own m ON o.level = 'source' AND m.level = 'language'
    AND o.lang IS NOT DISTINCT FROM m.lang AND o.rate = m.rate),
cuts AS (
  SELECT level, lang, source, max(documents) AS documents, {picked} FROM (
    SELECT *, CASE WHEN rate IN ({two_sided}) THEN b_low END AS low, b_high AS high FROM bounded)
  GROUP BY ALL),
ranked AS (
  SELECT s.lang AS s_lang, s.source AS s_source, c.* FROM cuts s JOIN cuts c ON c.level = CASE
    WHEN s.documents >= {LEAST_DOCUMENTS} THEN 'source'
    WHEN (SELECT max(documents) FROM cuts x WHERE x.level = 'language' AND x.lang IS NOT DISTINCT FROM s.lang)
      >= {LEAST_DOCUMENTS} THEN 'language' ELSE 'all' END
    AND (c.level = 'all' OR c.lang IS NOT DISTINCT FROM s.lang)
    AND (c.level <> 'source' OR c.source IS NOT DISTINCT FROM s.source)
  WHERE s.level = 'source')
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({outside}) AS kept
FROM counted c LEFT JOIN ranked r ON c.lang IS NOT DISTINCT FROM r.s_lang AND c.source IS NOT DISTINCT FROM r.s_source
"""


SQL = _sql()
