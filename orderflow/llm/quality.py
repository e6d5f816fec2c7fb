"""Quality rules: fixed ones, and robust multivariate outliers per language and source.

The statistics of every whole text are transformed to a vector. Per group of
language and source, the minimum covariance determinant estimate gives centre
and scatter of the vectors: concentration steps move to the mean and covariance
of the three quarters of the rows that are nearest, from two starts, of which
the one of the smaller determinant stays; a last step reweights. Rows far from
their group's centre by Mahalanobis distance are rejected.

A step is one pass over the vectors, for all groups together: rows are added up
by group and bin of their distance, and the nearest bins that hold three
quarters of a group are its next estimate. So a group may be of any size, and
nothing but sums per bin leaves a task. The share that is kept ends at a bin's
edge, so it is three quarters or little more.

Each statistic has a least scatter, added to the estimate; it keeps those that
are zero in most texts from making the estimate singular. Every group has its
own estimate. From ``FULL_ROWS`` rows on that is what its rows are judged by; in
smaller groups centre and scatter are blended with those of all rows of the
language, in even steps down to ``NO_ROWS`` rows, of which three quarters hardly
span five dimensions and one bad row is too many. Languages of few rows are
blended in the same way with all rows. So no verdict jumps as a group grows.

Results are defined as follows. A null text has no words and fails the fixed
rules, as do empty and wordless ones. Null languages and sources are values
like others. Rows that fail the fixed rules take no part in the estimates.
Equal rows get equal results. An empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from orderflow.llm.common import map_texts, pick, ship
from orderflow.session import staged

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: Share of words, in per cent, that may stand in repeated windows.
MOST_REPEATED = 50

#: Statistics of the vector and the scatter that each has at least.
SCATTER = {"length": 0.5, "word": 0.08, "symbols": 0.25, "lines": 0.4, "repeats": 0.4}
KEPT_SHARE = 0.75
#: A row is rejected beyond this squared distance; 1 in ten million of a normal group is.
CUTOFF = 40.9
REWEIGHT = 0.975
STEPS = 6
#: Rows from which a group's own estimate counts in full, and up to which it doesn't count.
FULL_ROWS = 24
NO_ROWS = 8
#: Estimates, of some 250 bytes each, that are sent to every task; beyond, rows are joined
#: with them by group and salt, of which there are so many.
SENT_ESTIMATES = 100_000
SALTS = 256
#: Bins of the distance per doubling, and of a statistic per unit.
DISTANCE_BINS = 16
STATISTIC_BINS = 64

NAMES = list(SCATTER)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
SUMS = ["n", *[f"s{i}" for i in range(len(NAMES))], *[f"s{i}_{j}" for i, j in PAIRS]]


def text_statistics(text: str | None) -> tuple[int, ...]:
    """Words, their characters, symbols, repeated lines, words in repeated windows, lines with a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        often = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
        covered = np.zeros(len(words), dtype=bool)
        for shift in range(3):
            covered[shift : shift + len(often)] |= often
        repeated = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def chi_square(x: float, degrees: int) -> float:
    """Share of a chi-square distribution below ``x``, by its series."""
    if x <= 0:
        return 0.0
    a, half = degrees / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= half / k
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi_square_point(share: float, degrees: int) -> float:
    """Where a chi-square distribution has ``share`` below."""
    low, high = 0.0, 500.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return low


def _widening(share: float) -> float:
    """What makes up for the tails that an estimate from the nearest ``share`` doesn't see."""
    return share / chi_square(chi_square_point(share, len(NAMES)), len(NAMES) + 2)


def _vector() -> list[Column]:
    """Transformed statistics; rounded, so that sums don't depend on the last digits."""
    words, chars = F.col("n_words"), F.col("word_chars")
    ratio = lambda part, whole, scale: F.log1p(scale * part / F.greatest(whole, F.lit(1)))
    found = [
        F.log(F.greatest(words, F.lit(1))),
        F.log(F.greatest(chars, F.lit(1)) / F.greatest(words, F.lit(1))),
        ratio(F.col("n_symbols"), chars, 100.0),
        ratio(F.col("n_dup_lines"), F.col("n_lines"), 10.0),
        ratio(F.col("n_repeat_words"), words, 10.0),
    ]
    return [F.round(v, 6).alias(f"z{i}") for i, v in enumerate(found)]


def own_weight(n: float) -> float:
    """Share that a group of so many rows has in the estimate it is judged by."""
    return min(1.0, max(0.0, (n - NO_ROWS) / (FULL_ROWS - NO_ROWS)))


def _grouped(rows: DataFrame) -> DataFrame:
    """The group of each language and source that has rows to judge, and those it is blended with.

    What a language needs comes from sums that tasks begin, so a language of many
    sources, web domains for example, is in no task alone.
    """
    counts = rows.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = staged(counts, "counts")
    part = lambda c: F.coalesce(F.to_json(F.struct(c)), F.lit("{}"))
    found = counts.select(
        F.col("lang").alias("of_lang"),
        F.col("source").alias("of_source"),
        F.concat(F.lit("1"), part("lang"), part("source")).alias("group"),
        F.concat(F.lit("2"), part("lang")).alias("lang_group"),
        "n",
    )
    languages = found.groupBy("lang_group").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    return _beside(found, staged(languages, "languages"), "lang_group").select(
        "of_lang",
        "of_source",
        "group",
        "n",
        "n_lang",
        F.when(F.col("least") < FULL_ROWS, F.col("lang_group")).alias("wider"),
        F.when(F.col("n_lang") < FULL_ROWS, F.lit("3")).alias("widest"),
    )


def _sums() -> list[Column]:
    z = [F.col(f"z{i}") for i in range(len(NAMES))]
    return [
        F.count("*").cast("double").alias("n"),
        *[F.sum(v).alias(f"s{i}") for i, v in enumerate(z)],
        *[F.sum(z[i] * z[j]).alias(f"s{i}_{j}") for i, j in PAIRS],
    ]


def _distance() -> Column:
    gap = [F.col(f"z{i}") - F.col(f"m{i}") for i in range(len(NAMES))]
    return sum(
        (gap[i] * gap[j] * F.col(f"p{i}_{j}") * (1 if i == j else 2) for i, j in PAIRS),
        start=F.lit(0.0),
    )


_ESTIMATE = ", ".join(
    ["start int", "group string", "det double"]
    + [f"m{i} double" for i in range(len(NAMES))]
    + [f"p{i}_{j} double" for i, j in PAIRS]
)


def _estimate_row(start: int, group: str, mean: np.ndarray, scatter: np.ndarray) -> list:
    scatter = scatter + np.diag(np.square(list(SCATTER.values())))
    precise = np.round(np.linalg.inv(scatter), 9)
    det = round(float(np.linalg.slogdet(scatter)[1]), 9)
    return [start, group, det, *np.round(mean, 9).tolist(), *[float(precise[i, j]) for i, j in PAIRS]]


def _estimates(sums: DataFrame, share: float) -> DataFrame:
    """Centre and inverse scatter from the sums of each start and group; few rows."""
    widening = _widening(share) if share < 1 else 1.0

    def run(frames):
        import pandas as pd

        columns = [c.split()[0] for c in _ESTIMATE.split(", ")]
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                n = row.n
                mean = np.array([getattr(row, f"s{i}") for i in range(len(NAMES))]) / n
                scatter = np.zeros((len(NAMES), len(NAMES)))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = getattr(row, f"s{i}_{j}") / n - mean[i] * mean[j]
                out.append(_estimate_row(row.start, row.group, mean, widening * scatter))
            yield pd.DataFrame(out, columns=columns)

    return staged(sums.select("start", "group", *SUMS).mapInPandas(run, _ESTIMATE), "estimates")


def _median_start(vectors: DataFrame) -> DataFrame:
    """Medians and median deviations of each group, from counts per bin of each statistic."""
    dims = F.array(*[F.struct(F.lit(i).alias("dim"), F.floor(F.col(f"z{i}") * STATISTIC_BINS).cast("long").alias("bin")) for i in range(len(NAMES))])
    bins = vectors.select("group", F.inline(dims)).groupBy("group", "dim", "bin").agg(F.count("*").alias("n"))

    def run(frame):
        import pandas as pd

        centre, spread = np.zeros(len(NAMES)), np.zeros(len(NAMES))
        for dim, part in frame.groupby("dim"):
            part = part.sort_values("bin")
            value, n = (part["bin"].to_numpy() + 0.5) / STATISTIC_BINS, part["n"].to_numpy()
            centre[dim] = value[np.searchsorted(np.cumsum(n), n.sum() / 2)]
            order = np.argsort(np.abs(value - centre[dim]), kind="stable")
            at = np.searchsorted(np.cumsum(n[order]), n.sum() / 2)
            spread[dim] = 1.4826 * abs(value[order[at]] - centre[dim])
        row = _estimate_row(1, frame["group"].iloc[0], centre, np.diag(spread**2))
        return pd.DataFrame([row], columns=[c.split()[0] for c in _ESTIMATE.split(", ")])

    # A group has as many rows here as its statistics have bins.
    return staged(bins.groupBy("group").applyInPandas(run, _ESTIMATE), "medians")


def _beside(rows: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows with the one row of ``few`` for their ``key``, without bringing a key's rows together.

    ``few`` is a written table, so that counting it costs nothing; beyond a bound
    it isn't sent to every task, but each of its rows joins a share of its key's.
    """
    if few.count() <= SENT_ESTIMATES:
        return rows.join(F.broadcast(few), key, how)
    salted = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(salted, [key, "salt"], how).drop("salt")


def _beside_estimates(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    return _beside(rows, estimates, "group", how)


def _nearest(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Sums over the nearest rows of each start and group: whole bins, up to the kept share."""
    joined = _beside_estimates(vectors, estimates)
    bin_of = F.floor(F.log2(_distance() + 1e-6) * DISTANCE_BINS).cast("int")
    bins = joined.groupBy("start", "group", bin_of.alias("bin")).agg(*_sums())
    whole = Window.partitionBy("start", "group")
    earlier = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    near = bins.select(
        "*",
        F.coalesce(F.sum("n").over(earlier), F.lit(0.0)).alias("before"),
        F.sum("n").over(whole).alias("all"),
    ).where(F.col("before") < KEPT_SHARE * F.col("all"))
    return near.groupBy("start", "group").agg(*[F.sum(c).alias(c) for c in SUMS])


def robust_estimates(vectors: DataFrame) -> DataFrame:
    """Centre and inverse scatter of each group of ``vectors`` (``group``, ``z0``...)."""
    plain = vectors.groupBy("group").agg(*_sums()).withColumn("start", F.lit(0))
    estimates = _estimates(plain, 1.0).unionByName(_median_start(vectors))
    for _ in range(STEPS):
        estimates = _estimates(_nearest(vectors, estimates), KEPT_SHARE)
    best = estimates.groupBy("group").agg(F.min_by("start", F.struct("det", "start")).alias("start"))
    estimates = staged(estimates.join(best, ["group", "start"]), "best")
    inside = _beside_estimates(vectors, estimates).where(_distance() <= chi_square_point(REWEIGHT, len(NAMES)))
    weighted = inside.groupBy("group").agg(*_sums()).withColumn("start", F.lit(0))
    again = _estimates(weighted, REWEIGHT)
    # A group without a row inside keeps its estimate.
    kept = estimates.join(again.select("group"), "group", "left_anti")
    return staged(again.unionByName(kept), "estimates")


def blended_estimates(groups: DataFrame, estimates: DataFrame) -> DataFrame:
    """The estimate by which each of ``groups`` is judged."""
    parts = F.array(*[f"m{i}" for i in range(len(NAMES))], *[f"p{i}_{j}" for i, j in PAIRS])
    under = lambda key, name: estimates.select(F.col("group").alias(key), parts.alias(name))
    joined = groups.select("group", "n", "n_lang", "wider", "widest").join(under("group", "own"), "group")
    # One estimate per language, and one of all rows.
    joined = _beside(joined, under("wider", "of_wider").where("wider like '2%'"), "wider", "left")
    joined = _beside(joined, under("widest", "of_widest").where("widest = '3'"), "widest", "left")

    def run(frames):
        import pandas as pd

        columns = [c.split()[0] for c in _ESTIMATE.split(", ")]
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                centre = scatter = None
                for n, found in ((None, row.of_widest), (row.n_lang, row.of_wider), (row.n, row.own)):
                    if found is None:
                        continue
                    precise = np.zeros((len(NAMES), len(NAMES)))
                    for (i, j), value in zip(PAIRS, found[len(NAMES) :], strict=True):
                        precise[i, j] = precise[j, i] = value
                    own = np.array(found[: len(NAMES)]), np.linalg.inv(precise)
                    weight = 1.0 if centre is None else own_weight(n)
                    centre = own[0] if weight == 1 else weight * own[0] + (1 - weight) * centre
                    scatter = own[1] if weight == 1 else weight * own[1] + (1 - weight) * scatter
                least = np.diag(np.square(list(SCATTER.values())))
                out.append(_estimate_row(0, row.group, centre, scatter - least))
            yield pd.DataFrame(out, columns=columns)

    return staged(joined.mapInPandas(run, _ESTIMATE), "blended")


def judge_quality(
    df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str
) -> DataFrame:
    """Every row's id and statistics, whether it fails the fixed rules, its distance, and the verdict."""
    ship(df.sparkSession)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    results = [StructField(c, LongType()) for c in columns]

    def start():
        return lambda texts: list(zip(*map(text_statistics, texts))) if texts else [[]] * len(columns)

    rows = pick(df, id=id_col, text=text_col, lang=lang_col, source=source_col).select(
        F.struct("id", *[F.col(c).cast("string").alias(c) for c in ("lang", "source")]).alias("key"),
        "text",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    rows = staged(
        map_texts(rows, "key", "text", results, start).select(
            "key.*", *columns, failed.alias("base_failed"), *_vector()
        ),
        "statistics",
    )
    groups = staged(_grouped(rows), "groups")
    rows = staged(
        rows.join(
            groups,
            rows["lang"].eqNullSafe(groups["of_lang"]) & rows["source"].eqNullSafe(groups["of_source"]),
            "left",
        ).drop("of_lang", "of_source", "n", "n_lang"),
        "vectors",
    )
    wanted = F.explode(F.array_compact(F.array("group", "wider", "widest"))).alias("group")
    vectors = rows.where("not base_failed").select(wanted, *[f"z{i}" for i in range(len(NAMES))])
    estimates = blended_estimates(groups, robust_estimates(vectors))
    distance = F.when(~F.col("base_failed"), F.round(_distance(), 6))
    return (
        _beside_estimates(rows, estimates, "left")
        .withColumn("distance", distance)
        .select(
            F.col("id").alias(id_col),
            *columns[:5],
            "base_failed",
            (~F.col("base_failed") & (F.col("distance") <= CUTOFF)).alias("kept"),
            "distance",
        )
    )
