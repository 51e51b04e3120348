"""Quality rules whose thresholds follow the corpus.

Five counts are taken of every text by expressions. Each rate made of them is summed
up, per language and source, in a mergeable quantile sketch: a histogram with bins of
1/64 relative width, whose partial counts add up in any order to the same result, so a
repeated or recovered job gives the same thresholds. A rate far outside the quartiles
of its own group is rejected. Groups are pre-aggregated before the shuffle; a group
that is a third of all rows costs no more than its number of bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.llm.shared import materialise
from pagewell.llm.words import NOT_BLANK, words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GROUP = ("lang", "source")
#: rate: (numerator, denominator, scale, smallest quartile distance that counts, lower fence too)
RATES = {
    "word_length": ("word_chars", "n_words", 1000, 500, True),
    "symbols": ("n_symbols", "word_chars", 1_000_000, 10_000, False),
    "dup_lines": ("n_dup_lines", "n_words", 1_000_000, 10_000, False),
    "repeats": ("n_repeat_words", "n_words", 1_000_000, 80_000, False),
}
#: A value is an outlier beyond so many quartile distances.
REACH = 4
#: A group is judged by its own texts and so many more that are spread like its parent's:
#: those of its language, which has so many spread like the corpus's.
PARENT_TEXTS = 200
#: Thresholds of so many groups are broadcast (about 100 bytes each); more are joined.
BROADCAST_GROUPS = 50_000
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `COUNTS` and `base_failed` added; columns of these names are replaced.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word
    that equal an earlier line), n_repeat_words (words inside 3-word windows that occur
    twice or more in the text). A null or empty text counts 0 throughout and fails the
    base rules. Windows are told apart by 64-bit hashes. All work is done row by row;
    nothing is shuffled.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (*COUNTS, "base_failed")]
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda line: line.rlike(NOT_BLANK))
    w, h, p, s = (F.col(f"_pw_{x}") for x in ("words", "windows", "pairs", "starts"))
    first = docs.select(*keep, words(content).alias("_pw_words"), lines.alias("_pw_lines"),
                        F.regexp_count(content, F.lit("[#*$%&|<>]")).alias("_pw_symbols"))
    windows = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    hashed = first.select(*keep, "_pw_words", "_pw_lines", "_pw_symbols", windows.alias("_pw_windows"))
    # Only texts with a repeated window are sorted.
    pairs = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    sorted_ = hashed.select(
        *keep, F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.col("_pw_symbols").cast("long").alias("n_symbols"),
        (F.size("_pw_lines") - F.size(F.array_distinct("_pw_lines"))).cast("long").alias("n_dup_lines"),
        pairs.alias("_pw_pairs"))
    starts = F.sort_array(F.transform(
        F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])),
        lambda x: x["i"]))
    started = sorted_.select(*keep, *COUNTS[:4], starts.alias("_pw_starts"))
    covered = F.aggregate(
        s, F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda a, x: F.struct((x + 3).alias("end"),
                              (a["sum"] + F.least(F.lit(3), x + 3 - a["end"])).alias("sum")),
        lambda a: a["sum"])
    counted = started.select(
        *keep, *COUNTS[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    # A generator of one row: filters on the counts stay above it, where they would else be
    # pushed below and repeat the expressions that make the counts.
    row = F.array(F.struct(*COUNTS, failed.alias("base_failed")))
    return counted.select(*keep, F.inline(row))


def _rate(name: str) -> Column:
    top, bottom, scale, _, _ = RATES[name]
    return F.expr(f"({top} * {scale}L) div greatest({bottom}, 1L)")


def sketch_bin(value: Column) -> Column:
    """The bin of a non-negative integer: itself below 128, else its 7 leading bits."""
    e = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return (e * 64 + F.call_function("shiftright", value, e)).cast("int")


def bin_end(bin_: Column) -> Column:
    """The largest integer of a bin."""
    e = F.greatest(F.floor(bin_ / 64).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", (bin_ - e * 64 + 1).cast("long"), e) - 1


def sketch(measured: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Bins and counts per group and rate, of the texts that pass the base rules.

    Sketches of several tables merge by adding the counts of equal keys.
    """
    rates = F.array(*(F.struct(F.lit(n).alias("rate"), sketch_bin(_rate(n)).alias("bin"))
                      for n in RATES))
    return (measured.where(~F.col("base_failed"))
            .select(*group, F.explode(rates).alias("r"))
            .groupBy(*group, "r.rate", "r.bin").agg(F.count(F.lit(1)).alias("texts")))


def _totals(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    return bins.groupBy(*keys, "rate", "bin").agg(F.sum("texts").alias("texts"))


def _running(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`all` texts of a group and rate, and `upto` each bin; one row per bin."""
    by = Window.partitionBy(*keys, "rate")
    return bins.select(
        *keys, "rate", "bin", "texts", F.sum("texts").over(by).alias("all"),
        F.sum("texts").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))


def _with_parent(bins: DataFrame, parent: DataFrame, keys: Sequence[str], above: Sequence[str]) -> DataFrame:
    """The sketch `bins` of `keys` and `PARENT_TEXTS` texts with the parent's quantiles."""
    share = F.expr(f"({PARENT_TEXTS}L * upto) div `all` - ({PARENT_TEXTS}L * (upto - texts)) div `all`")
    typical = _running(parent, above).select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(above)),
        F.col("rate").alias("_rate"), F.col("bin"), share.alias("texts")).where("texts > 0")
    groups = bins.select(*keys, "rate").distinct()
    same = F.col("rate") == F.col("_rate")
    for i, k in enumerate(above):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    added = groups.join(typical, same).select(*keys, "rate", "bin", "texts")
    return _totals(bins.select(*keys, "rate", "bin", "texts").unionByName(added), keys)


def _fences(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wide rows `keys, <rate>_low, <rate>_high`."""
    quartiles = _running(bins, keys).groupBy(*keys, "rate").agg(*(
        bin_end(F.min(F.when(F.col("upto") * 100 >= F.col("all") * q, F.col("bin")))).alias(f"q{q}")
        for q in (25, 75)))
    smallest = F.create_map(*(F.lit(x) for n, r in RATES.items() for x in (n, r[3])))
    reach = F.greatest(F.col("q75") - F.col("q25"), smallest[F.col("rate")].cast("long")) * REACH
    fenced = quartiles.select(*keys, "rate", (F.col("q25") - reach).alias("low"),
                              (F.col("q75") + reach).alias("high"))
    return fenced.groupBy(*keys).agg(*(
        F.max(F.when(F.col("rate") == n, F.col(side))).alias(f"{n}_{side}")
        for n in RATES for side in ("low", "high")))


def thresholds(bins: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """One row per group of the sketch, with the fences it is judged by.

    A group's fences follow its own texts and `PARENT_TEXTS` more that are spread like those
    of the first group column, which in turn has as many that are spread like the corpus's.
    So a group of a few texts is judged nearly as its language, a large one by itself, and
    no size switches between them. An empty sketch has no thresholds.
    """
    above, parent = [], _totals(bins, [])
    for depth in sorted({1, len(group)}):
        keys = list(group[:depth])
        parent, above = _with_parent(_totals(bins, keys), parent, keys, above), keys
    return _fences(parent, group)


def judge(measured: DataFrame, fences: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """`measured` with `kept`: the base rules hold and every rate is inside its fences.

    Null languages and sources are groups of their own.
    """
    names = [f"{n}_{side}" for n in RATES for side in ("low", "high")]
    side = fences.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(group)),
                         *(F.col(n).alias(f"_f_{n}") for n in names))
    same = F.lit(True)
    for i, k in enumerate(group):
        same = same & measured[k].eqNullSafe(F.col(f"_k{i}"))
    if fences.count() <= BROADCAST_GROUPS:
        side = F.broadcast(side)
    inside = F.lit(True)
    for name, (*_, both) in RATES.items():
        inside = inside & (_rate(name) <= F.col(f"_f_{name}_high"))
        if both:
            inside = inside & (_rate(name) >= F.col(f"_f_{name}_low"))
    columns = [F.col(f"`{c}`") for c in measured.columns if c != "kept"]
    return measured.join(side, same, "left").select(
        *columns, (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"))


def fit(measured: DataFrame) -> DataFrame:
    """The thresholds of the measured texts, as a small table."""
    return materialise(thresholds(materialise(sketch(measured), "sketch")), "thresholds")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    from pagewell.llm.shared import table

    docs = table(spark, sf_dir, "documents")
    measured = materialise(measure(docs.select("doc_id", "lang", "source", "text")).drop("text"), "measured")
    return judge(measured, fit(measured)).select("doc_id", *COUNTS, "base_failed", "kept")


def _blend_sql(keys: str, name: str, above: str, parent: str) -> str:
    """The sketch `name` of `keys`, with texts that are spread like those of `parent`."""
    by, up = f"{keys}, rate", f"{above}, rate" if above else "rate"
    same = " AND ".join(f"g.{k} IS NOT DISTINCT FROM p.{k}" for k in up.split(", "))
    return f"""
{name}_p AS (
  SELECT {up}, bin, {PARENT_TEXTS} * upto // n_all - {PARENT_TEXTS} * (upto - texts) // n_all AS texts FROM (
    SELECT *, sum(texts) OVER (PARTITION BY {up}) AS n_all,
      sum(texts) OVER (PARTITION BY {up} ORDER BY bin) AS upto FROM {parent})),
{name} AS (
  SELECT {by}, bin, sum(texts) AS texts FROM (
    SELECT {by}, bin, texts FROM bins UNION ALL
    SELECT {', '.join('g.' + k for k in by.split(', '))}, p.bin, p.texts
    FROM (SELECT DISTINCT {by} FROM bins) g JOIN {name}_p p ON {same} WHERE p.texts > 0)
  GROUP BY {by}, bin)"""


def _fence_sql(keys: str, bins: str, name: str) -> str:
    by = f"{keys}, rate"
    end = lambda q: (f"(((q{q} - 64 * greatest(q{q} // 64 - 1, 0)) + 1)::BIGINT << greatest(q{q} // 64 - 1, 0)) - 1")
    floors = " ".join(f"WHEN '{n}' THEN {r[3]}" for n, r in RATES.items())
    wide = ", ".join(f"max(CASE WHEN rate = '{n}' THEN {side} END) AS {n}_{side}"
                     for n in RATES for side in ("low", "high"))
    return f"""
{name}_run AS (
  SELECT {by}, bin, sum(texts) OVER (PARTITION BY {by}) AS n_all,
    sum(texts) OVER (PARTITION BY {by} ORDER BY bin) AS upto FROM {bins}),
{name}_q AS (
  SELECT {by}, min(CASE WHEN upto * 100 >= n_all * 25 THEN bin END) AS q25,
    min(CASE WHEN upto * 100 >= n_all * 75 THEN bin END) AS q75
  FROM {name}_run GROUP BY {by}),
{name}_v AS (SELECT {by}, {end(25)} AS v25, {end(75)} AS v75 FROM {name}_q),
{name}_w AS (SELECT {by}, v25 - r AS low, v75 + r AS high FROM (
  SELECT *, {REACH} * greatest(v75 - v25, CASE rate {floors} END) AS r FROM {name}_v)),
{name} AS (SELECT {keys}, {wide} FROM {name}_w GROUP BY {keys})"""


def _sql() -> str:
    blanks = r"[\x20\x09-\x0D]+"
    value = {n: f"(({r[0]} * {r[2]}) // greatest({r[1]}, 1))" for n, r in RATES.items()}
    bins = " UNION ALL ".join(
        f"SELECT lang, source, '{n}' AS rate, {v} AS x FROM measured WHERE NOT base_failed"
        for n, v in value.items())
    tests = " AND ".join(
        f"{value[n]} <= a.{n}_high" + (f" AND {value[n]} >= a.{n}_low" if r[4] else "")
        for n, r in RATES.items())
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{blanks}'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT row_id, i, [words[i], words[i + 1], words[i + 2]] AS w
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
repeated AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT i + d) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS d) GROUP BY row_id),
counted AS (
  SELECT doc_id, lang, source, len(words) AS n_words,
    coalesce(length(list_aggregate(words, 'string_agg', '')), 0) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (row_id)),
measured AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM counted),
bins AS (
  SELECT lang, source, rate, greatest(length(bin(x)) - 7, 0) * 64 + (x >> greatest(length(bin(x)) - 7, 0)) AS bin,
    count(*) AS texts FROM ({bins}) GROUP BY ALL),
corpus AS (SELECT rate, bin, sum(texts) AS texts FROM bins GROUP BY rate, bin),
{_blend_sql('lang', 'of_lang', '', 'corpus')},
{_blend_sql('lang, source', 'of_source', 'lang', 'of_lang')},
{_fence_sql('lang, source', 'of_source', 'a')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({tests}, true) AS kept
FROM measured m LEFT JOIN a ON m.lang IS NOT DISTINCT FROM a.lang AND m.source IS NOT DISTINCT FROM a.source"""


QUERIES = {"op8_quality": op8_quality}
SQL = {"op8_quality": _sql()}
