"""Multivariate outliers among text statistics, by a minimum covariance determinant per language and source.

Every text gives five statistics; their logarithms, in integer units, are the vector. Per (lang, source) the half of
the vectors whose covariance has the least determinant is sought: from each of four starts (the half nearest to the
coordinate-wise medians, by four kinds of distance) concentration steps follow, that is, the half is estimated and
replaced by the half nearest to the estimate by Mahalanobis distance, until no half changes; the start that ends with
the least determinant wins. Vectors beyond ``CUTOFF`` of its estimate, made consistent for normal data, are outliers.

Where a statistic hardly varies in the half (most texts repeat no line), its variance is raised to the square of a
least spread, about the step that one symbol, line or repeat makes; others are left as estimated. What other statistics
leave of a variance is at least a quarter of that square, so that no direction is singular. Groups of fewer than
``MIN_GROUP`` texts take the estimate of all texts of their language, or of all texts if those are too few as well.

Medians, halves and sums are of integers, hence exact and the same in every run; all are aggregates that merge
before the shuffle, so a source with a third of all rows is no hot spot. DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scaling import cut_lineage, lookup_join
from .common import SPACE, stored, table

#: Units of one e-fold; least spreads of the five statistics in e-folds: words, word length, symbols per 100
#: characters, repeated lines, repeated words per 100.
UNIT, SPREADS = 1024, (0.05, 0.04, 0.25, 0.35, 0.7)
#: Chi-squared with 5 degrees of freedom exceeds this with probability 0.0001.
CUTOFF = 25.745
#: Makes the covariance of the nearer half of normal data consistent: 0.5 / P(chi2_7 <= median of chi2_5).
CONSISTENCY = 1.9122
#: Concentration steps end when no half changes; halves with tied distances might take turns, so there are at most these.
MAX_STEPS = 16
#: Up to so many groups their estimates are broadcast.
MOST_GROUPS = 1000
#: Fewest texts for an estimate of their own: ten for each statistic.
MIN_GROUP = 50
DIM = range(5)
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_q_`` columns: the five counts, base_failed, and the vector f0..f4 (of all rows). Null text: no words."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({
        "_q_w": F.filter(F.split(body, SPACE), lambda x: x != ""),
        "_q_lines": F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "_q_n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long")})
    rows = rows.withColumns({
        "_q_n_words": F.size("_q_w").cast("long"),
        "_q_word_chars": F.length(F.array_join("_q_w", "")).cast("long"),
        "_q_n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        # hashes of the three-word windows with their places, in order: equal windows become neighbours
        "_q_z": F.expr("""sort_array(transform(if(size(_q_w) < 3, array(), sequence(0, size(_q_w) - 3)),
            i -> struct(xxhash64(get(_q_w, i), get(_q_w, i + 1), get(_q_w, i + 2)) as h, i as p)))""")})
    rows = rows.withColumn("_q_places", F.expr("""sort_array(transform(filter(_q_z,
        (x, i) -> (i > 0 and get(_q_z, i - 1).h = x.h) or get(_q_z, i + 1).h <=> x.h), x -> x.p))"""))
    rows = rows.withColumn("_q_n_repeat_words", F.expr("""aggregate(_q_places, struct(0L as n, -3 as e),
        (a, p) -> struct(a.n + (p + 3 - greatest(a.e, p)) as n, p + 3 as e), a -> a.n)"""))
    return (rows.withColumns({"_q_base_failed": F.expr(
        f"_q_n_words < {MIN_WORDS} or 100 * _q_n_repeat_words > {MAX_REPEAT_PERCENT} * _q_n_words")}
        | {f"_q_f{i}": F.expr(f"cast(floor({UNIT} * {e} + 0.5) as bigint)") for i, e in enumerate(_VECTOR)})
        .drop("_q_w", "_q_lines", "_q_z", "_q_places"))


_VECTOR = ["ln(greatest(_q_n_words, 1))", "ln(greatest(_q_word_chars, 1) / greatest(_q_n_words, 1))",
           "ln(1 + 100 * _q_n_symbols / greatest(_q_word_chars, 1))", "ln(1 + _q_n_dup_lines)",
           "ln(1 + 100 * _q_n_repeat_words / greatest(_q_n_words, 1))"]

# --- the algebra, as SQL text; each list may use the names before it --------

_square = lambda e: f"({e}) * ({e})"
_LEAST = [f"{UNIT * x!r}e0" for x in SPREADS]
#: Deviations from the medians by robust spreads, and the four distances made of them.
SCALED = [f"(f{i} - m{i}) / greatest(1.4826e0 * s{i}, {_LEAST[i]}) AS z{i}" for i in DIM]
_STARTS = [" + ".join(_square(f"z{i}") for i in DIM), " + ".join(f"abs(z{i})" for i in DIM),
           "greatest({})".format(", ".join(f"abs(z{i})" for i in DIM)),
           " + ".join(f"{_square(f'z{i}')} / (1 + {_square(f'z{i}')})" for i in DIM)]
START = [*SCALED, "CASE {} END AS d".format(" ".join(f"WHEN s = {k} THEN {e}" for k, e in enumerate(_STARTS)))]
BIN = "CAST(floor(64 * ln(1 + d)) AS BIGINT)"
SUMS = ["count(*) AS n", *[f"sum(f{i}) AS t{i}" for i in DIM],
        *[f"sum(f{i} * f{j}) AS t{i}{j}" for i in DIM for j in range(i + 1)]]
TOTALS = [e.rpartition(" AS ")[2] for e in SUMS]
_double = lambda e: f"CAST({e} AS DOUBLE)"
MEANS = [f"{_double(f't{i}')} / n AS m{i}" for i in DIM]


def _cholesky() -> list[str]:
    """l_ij of the covariance, its diagonal at least that of the least spreads, row by row; and half its log determinant."""
    out = []
    for i in DIM:
        for j in range(i + 1):
            cov = f"{CONSISTENCY}e0 * ({_double(f't{i}{j}')} / n - m{i} * m{j})"
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            if i == j:
                square = f"{_LEAST[i]} * {_LEAST[i]}"
                out.append(f"sqrt(greatest(greatest({cov}, {square}){less}, {square} / 4)) AS l{i}{i}")
            else:
                out.append(f"({cov}{less}) / l{j}{j} AS l{i}{j}")
    return [*out, "{} AS size".format(" + ".join(f"ln(l{i}{i})" for i in DIM))]


CHOLESKY = _cholesky()
SOLVE = [f"(f{i} - m{i}{''.join(f' - l{i}{k} * y{k}' for k in range(i))}) / l{i}{i} AS y{i}" for i in DIM]
DISTANCE = [*SOLVE, " + ".join(f"y{i} * y{i}" for i in DIM) + " AS d"]
ESTIMATE = [*[f"m{i}" for i in DIM], *[f"l{i}{j}" for i in DIM for j in range(i + 1)]]


def _rounds(expressions: list[str]) -> list[dict[str, str]]:
    """Expressions by name, in as few rounds as there may be: each uses only names of earlier ones."""
    place, rounds = {}, []
    for e in expressions:
        value, _, name = e.rpartition(" AS ")
        place[name] = at = 1 + max((place[w] for w in re.findall(r"\w+", value) if w in place), default=-1)
        rounds += [{}] * (at == len(rounds))
        rounds[at] = rounds[at] | {name: value}
    return rounds


def _step_by_step(df: DataFrame, expressions: list[str]) -> DataFrame:
    for added in _rounds(expressions):  # a projection for each round: the driver plans all steps anew
        df = df.withColumns({name: F.expr(value) for name, value in added.items()})
    return df


def _fewest(groups: DataFrame) -> bool:
    """Whether estimates for all starts of these groups are few enough to be broadcast (about 250 bytes each)."""
    return groups.limit(MOST_GROUPS + 1).count() <= MOST_GROUPS


def _with(rows: DataFrame, params: DataFrame, few: bool, keys: tuple[str, ...] = ("g",)) -> DataFrame:
    """Rows beside the parameters of their group; of many groups through salted keys, as a group may be hot."""
    if few:
        return rows.join(F.broadcast(params), list(keys))
    left = rows.withColumn("salt", F.pmod(F.hash(*[f"f{i}" for i in DIM]), F.lit(64)))
    right = params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    return left.join(right, [*keys, "salt"]).drop("salt")


def estimates(vectors: DataFrame) -> DataFrame:
    """(g, m0.., l00..): location and Cholesky factor of each group; ``vectors`` holds g and f0..f4."""
    middle = lambda e, name: F.expr(f"percentile({e}, 0.5)").alias(name)
    centre = cut_lineage(vectors.groupBy("g").agg(*[middle(f"f{i}", f"m{i}") for i in DIM]))
    few = _fewest(centre)
    apart = _with(vectors, centre, few).groupBy("g").agg(*[middle(f"abs(f{i} - m{i})", f"s{i}") for i in DIM])
    starts = F.explode(F.sequence(F.lit(0), F.lit(len(_STARTS) - 1)))
    params, distance, before = cut_lineage(centre.join(apart, "g").withColumn("s", starts)), START, None
    for _ in range(MAX_STEPS):
        binned = _step_by_step(_with(vectors, params, few), distance).withColumn("b", F.expr(BIN)).select(*vectors.columns, "s", "b")
        border = binned.groupBy("g", "s").agg(middle("b", "half"))
        near = _with(binned, border, few, ("g", "s")).filter("b <= half")
        sums = near.groupBy("g", "s").agg(*[F.expr(e.rpartition(" AS ")[0]).alias(t) for e, t in zip(SUMS, TOTALS)])
        params, distance = cut_lineage(_step_by_step(sums, MEANS + CHOLESKY)), DISTANCE
        now = params.agg(F.bit_xor(F.xxhash64("g", "s", *TOTALS))).first()[0]
        if now == before:  # no half has changed
            break
        before = now
    best = params.groupBy("g").agg(F.min(F.struct("size", "s", *ESTIMATE)).alias("b"))
    return cut_lineage(best.select("g", *[F.col(f"b.{c}").alias(c) for c in ESTIMATE]))


def _keyed(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(own, g) for every group of ``vectors`` (own, lang, f0..f4), and the rows of each estimate g."""
    sizes = cut_lineage(vectors.groupBy("own", "lang").agg(F.count(F.lit(1)).alias("n")))
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    chosen = cut_lineage(sizes.join(langs, "lang").select("own", "lang", F.when(F.col("n") >= MIN_GROUP, F.col("own")).when(
        F.col("n_lang") >= MIN_GROUP, F.col("lang")).otherwise("all").alias("g")))
    fs, salt = [f"f{i}" for i in DIM], ["f0", "f1"]
    own = lookup_join(vectors, chosen.filter("g = own").select("own", "g"), ["own"], salt)
    lang = lookup_join(vectors, chosen.filter("g = lang").select("lang", "g").distinct(), ["lang"], salt)
    members = own.select("g", *fs).unionByName(lang.select("g", *fs))
    if not chosen.filter("g = 'all'").isEmpty():
        members = members.unionByName(vectors.select(F.lit("all").alias("g"), *fs))
    # stored, so that each step's plan is a scan, without the joins and unions above
    return chosen.select("own", "g"), stored(members, "vectors")


def assess(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
           carry: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (of the columns ``carry``, if given) with ``_q_`` columns: counts, base_failed, distance (squared; null if base failed), kept.

    Rows that fail the base rules take no part in the estimates. A null language or source is a group of its own.
    Every row gives one row; an empty table gives none. The rows are stored once, so that texts are measured once.
    """
    of_lang = F.to_json(F.struct(F.col(lang).alias("l")))
    measured = with_statistics(docs, text).withColumns({"_q_lang": of_lang, "_q_own": F.concat(
        of_lang, F.to_json(F.struct(F.col(source).alias("s"))))})
    own = [c for c in measured.columns if c.startswith("_q_")]
    rows = stored(measured.select(*(docs.columns if carry is None else carry), *own), "statistics")
    vectors = rows.filter("not _q_base_failed").select(
        F.col("_q_own").alias("own"), F.col("_q_lang").alias("lang"), *[F.col(f"_q_f{i}").alias(f"f{i}") for i in DIM])
    chosen, members = _keyed(vectors)
    params = chosen.join(estimates(members), "g")
    named = params.select(F.col("own").alias("_q_own"), *[F.col(c).alias(f"_q_{c}") for c in ESTIMATE])
    far = lookup_join(rows, named, ["_q_own"], ["_q_f0", "_q_f1", "_q_n_symbols"], how="left")
    for e in DISTANCE:
        value, _, name = re.sub(r"\b([fmlyd]\d*)\b", r"_q_\1", e).rpartition(" AS ")
        far = far.withColumn(name, F.expr(value))
    far = far.withColumn("_q_distance", F.when(~F.col("_q_base_failed"), F.col("_q_d")))
    return far.withColumn("_q_kept", F.coalesce(F.col("_q_distance") <= CUTOFF, F.lit(False)))


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return assess(docs, carry=["doc_id"]).select(
        "doc_id", *[F.col(f"_q_{c}").alias(c) for c in STATISTICS], F.col("_q_base_failed").alias("base_failed"),
        F.col("_q_kept").alias("kept"))


def _nested(expressions: list[str], source: str) -> str:
    """Each expression in a select around those before it, so that none is written out many times."""
    for e in expressions:
        source = f"(SELECT *, {e} FROM {source})"
    return source


def _sql() -> str:
    steps, source, distance = [], "starts", START
    for k in range(MAX_STEPS):
        sums = f"(SELECT g, s, {', '.join(SUMS)} FROM b{k} JOIN h{k} USING (g, s) WHERE b <= half GROUP BY g, s)"
        steps.append(f"""b{k} AS MATERIALIZED (SELECT g, s, f0, f1, f2, f3, f4, {BIN} AS b FROM {_nested(distance, f"(FROM v JOIN {source} USING (g))")}),
h{k} AS MATERIALIZED (SELECT g, s, quantile_cont(b, 0.5) AS half FROM b{k} GROUP BY g, s),
e{k} AS MATERIALIZED (FROM {_nested(MEANS + CHOLESKY, sums)})""")
        source, distance = f"e{k}", DISTANCE
    med = ", ".join(f"quantile_cont(f{i}, 0.5) AS m{i}" for i in DIM)
    mad = ", ".join(f"quantile_cont(abs(f{i} - m{i}), 0.5) AS s{i}" for i in DIM)
    vector = ", ".join(f"CAST(floor({UNIT} * {e.replace('_q_', '')} + 0.5) AS BIGINT) AS f{i}" for i, e in enumerate(_VECTOR))
    return rf"""
WITH base AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM base)),
windows AS (SELECT r, i, w || chr(10) || lead(w) OVER p || chr(10) || lead(w, 2) OVER p AS win FROM words WINDOW p AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows WHERE win IS NOT NULL) WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY r),
counts AS (SELECT r, count(*) AS n, sum(length(w)) AS c FROM words GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
stats AS (SELECT base.*, coalesce(counts.n, 0) AS n_words, CAST(coalesce(counts.c, 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM base LEFT JOIN counts USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    coalesce(lang, chr(0)) AS l, coalesce(lang, chr(0)) || chr(10) || coalesce(source, chr(0)) AS own, {vector} FROM stats),
sizes AS (SELECT own, l, count(*) AS n, sum(count(*)) OVER (PARTITION BY l) AS n_lang FROM judged WHERE NOT base_failed GROUP BY own, l),
chosen AS (SELECT own, l, CASE WHEN n >= {MIN_GROUP} THEN own WHEN n_lang >= {MIN_GROUP} THEN l ELSE chr(1) END AS g FROM sizes),
v AS MATERIALIZED (
  SELECT g, f0, f1, f2, f3, f4 FROM judged JOIN chosen USING (own) WHERE NOT base_failed AND g = own
  UNION ALL SELECT g, f0, f1, f2, f3, f4 FROM judged JOIN (SELECT DISTINCT l, g FROM chosen WHERE g = l) USING (l) WHERE NOT base_failed
  UNION ALL SELECT chr(1), f0, f1, f2, f3, f4 FROM judged WHERE NOT base_failed AND EXISTS (FROM chosen WHERE g = chr(1))),
meds AS (SELECT g, {med} FROM v GROUP BY g),
centre AS (SELECT * FROM meds JOIN (SELECT g, {mad} FROM v JOIN meds USING (g) GROUP BY g) USING (g)),
starts AS MATERIALIZED (SELECT *, unnest(range({len(_STARTS)})) AS s FROM centre),
{', '.join(steps)},
best AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY g ORDER BY size, s) = 1),
far AS (SELECT r, d FROM {_nested(DISTANCE, "(FROM judged JOIN chosen USING (own) JOIN best USING (g) WHERE NOT base_failed)")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(d <= {CUTOFF}, false) AS kept
FROM judged LEFT JOIN far USING (r)
"""


OP1_SQL = _sql()
