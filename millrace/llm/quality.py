"""Quality rules: robust multivariate outliers within each language and source.

Base statistics are counted per text. Texts that pass the base limits then form, per (language,
source), a cloud of transformed statistic vectors. The minimum-covariance-determinant estimate of
that cloud is found by concentration steps from three deterministic starts, and texts whose
Mahalanobis distance is beyond a chi-squared limit are rejected.

Every concentration step is a pair of grouped sums over all rows: a histogram of distances, which
gives the distance that holds ``SUBSET`` of a group, and the moments of the rows within it. Hot
groups are summed in the tasks that read them, and no group meets in one task.

Cases: a null or empty text has no words and fails the base limits; a null language or source is a
group of its own; groups of fewer than ``LEAST_GROUP`` texts are joined by language, and what is then
still too small is joined to one; if that is too small too, its texts are kept. Repeated rows count
as often as they occur. Extra columns are ignored by ``statistics`` and passed on by ``accepted``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import codes, fresh, slices, written

SYMBOLS = "#*$%&|<>"
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

#: Dimensions of the vector and the least standard deviation that is assumed for each.
#: A text that differs from its group in one dimension only, and by less than the floor times the root
#: of ``LIMIT``, is kept whatever the group: up to 50.7 % of duplicate lines and 48.2 % of repeated words.
FLOORS = {"length": 0.5, "symbols": 0.05, "lines": 0.1, "repeats": 0.095, "upper": 0.1}
#: Words of typical length added to each text, so that short texts do not stand out by chance.
PRIOR_WORDS, PRIOR_LENGTH = 50, 5.0
#: Share of a group that the estimate is formed by: the least, so that outliers need half of a group to form it.
SUBSET = 0.5
LEAST_GROUP = 50
TAIL = 1e-4
GAIN = 1e-3  # least fall of the logarithm of the determinant that a step is repeated for
BINS = 64  # of distances, for each doubling

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*COUNTS, "n_lines", "n_upper"]
MEASURE_TYPE = "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"


def repeated(word_codes: np.ndarray, distinct: int) -> int:
    """Words within three-word windows that the text holds twice or more."""
    if len(word_codes) < 4:
        return 0
    c = word_codes.astype(np.int64)
    windows = (c[:-2] * distinct + c[1:-1]) * distinct + c[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    marked = np.zeros(len(c), dtype=bool)
    for shift in range(3):
        marked[shift : len(c) - 2 + shift] |= again
    return int(marked.sum())


def measured(texts: list[str | None]) -> list[tuple[int, ...]]:
    """The measures of each text; a null text counts as empty."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    numbers, distinct = codes([w for words in split for w in words])
    out, at = [], 0
    for text, words in zip(texts, split, strict=True):
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        own = numbers[at : at + len(words)]
        at += len(words)
        if len(distinct) > 2_000_000:  # three numbers would not fit 64 bits
            own, local = codes(words)
        else:
            local = distinct
        lines = [line for line in raw.split(b"\n") if line.strip()]
        out.append(
            (
                len(words),
                len(text) - sum(raw.count(s) for s in SPACES),
                sum(text.count(s) for s in SYMBOLS),
                len(lines) - len(set(lines)),
                repeated(own, len(local)),
                len(lines),
                len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            )
        )
    return out


def with_measures(frame: DataFrame, text: str, name: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and the measures of ``text`` as a struct column ``name``."""
    narrow = frame.select(*[F.col(f"`{k}`") for k in keep if k != text], F.col(f"`{text}`").cast("string").alias(text))
    types = [(f.name, f.dataType.simpleString()) for f in narrow.schema.fields if f.name in keep]
    struct = pa.struct([(m, pa.int64()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, narrow_at):
            rows = measured(part.column(narrow_at).to_pylist())
            columns = [np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)]
            value = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(struct))
            kept = [(n, part.column(i)) for i, n in enumerate(part.schema.names) if n in keep]
            yield pa.RecordBatch.from_arrays([*[c for _, c in kept], value], names=[*[n for n, _ in kept], name])

    narrow_at = narrow.columns.index(text)
    schema = ", ".join([*[f"`{n}` {t}" for n, t in types], f"`{name}` {MEASURE_TYPE}"])
    return narrow.mapInArrow(run, schema)


def vector(m: Column) -> list[Column]:
    """The transformed statistics: a shrunken mean word length, roots of the shares of symbols and
    capitals, which are small, and the shares of duplicate lines and repeated words, which are not:
    their roots would let some duplicate lines weigh nearly as much as a text of nothing else."""

    def share(part: str, whole: str) -> Column:
        return m[part] / F.greatest(m[whole], F.lit(1))

    length = (m["word_chars"] + PRIOR_WORDS * PRIOR_LENGTH) / (m["n_words"] + PRIOR_WORDS)
    return [
        length,
        F.sqrt(share("n_symbols", "word_chars")),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        F.sqrt(share("n_upper", "word_chars")),
    ]


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def chi_squared(x: float, k: int) -> float:
    """The chi-squared distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 1
    while term > total * 1e-16:
        term *= z / (a + n)
        total += term
        n += 1
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi_squared_quantile(p: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(middle, k) < p else (low, middle)
    return high


SIZE = len(FLOORS)
PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
#: Makes the covariance of the inner part that of the whole, for a normal cloud.
CONSISTENCY = SUBSET / chi_squared(chi_squared_quantile(SUBSET, SIZE), SIZE + 2)
LIMIT = chi_squared_quantile(1 - TAIL, SIZE)


def group_keys(counts: DataFrame) -> DataFrame:
    """(lang, source, gid): gid is null where even all small groups together are too small."""
    small = F.col("n") < LEAST_GROUP
    by_lang = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang"))
    levels = counts.withColumn("level", F.when(~small, 0).when(by_lang >= LEAST_GROUP, 1).otherwise(2))
    rest = levels.where("level = 2").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rest_n"))
    gid = F.to_json(
        F.struct(
            "level",
            F.when(F.col("level") < 2, F.col("lang")).alias("lang"),
            F.when(F.col("level") == 0, F.col("source")).alias("source"),
        )
    )
    enough = (F.col("level") < 2) | (F.col("rest_n") >= LEAST_GROUP)
    return levels.join(rest).select("lang", "source", F.when(enough, gid).alias("gid"))


def distance(x: list[Column], centre: Column, inverse: Column) -> Column:
    d = [x[i] - centre[i] for i in range(SIZE)]
    terms = [(1 if i == j else 2) * d[i] * d[j] * inverse[k] for k, (i, j) in enumerate(PAIRS)]
    return sum(terms[1:], terms[0])


def moments(x: list[Column]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(v) for v in x]).alias("sums"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in PAIRS]).alias("products"),
    ]


def fitted(frame: DataFrame) -> DataFrame:
    """(gid, start, centre, inverse, logdet) from rows (gid, start, n, sums, products)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.diag(np.array(list(FLOORS.values())) ** 2)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                mean = np.array(row["sums"]) / row["n"]
                cov = np.zeros((SIZE, SIZE))
                for value, (i, j) in zip(row["products"], PAIRS, strict=True):
                    cov[i, j] = cov[j, i] = value / row["n"] - mean[i] * mean[j]
                values, axes = np.linalg.eigh(cov)
                cov = CONSISTENCY * (axes * np.maximum(values, 0)) @ axes.T + floor
                inverse = np.linalg.inv(cov)
                out.append(
                    {
                        "gid": row["gid"],
                        "start": row["start"],
                        "centre": [float(f"{v:.10g}") for v in mean],
                        "inverse": [float(f"{inverse[i, j]:.10g}") for i, j in PAIRS],
                        "logdet": round(float(np.linalg.slogdet(cov)[1]), 9),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=types)

    types = pa.schema(
        [
            ("gid", pa.string()),
            ("start", pa.int32()),
            ("centre", pa.list_(pa.float64())),
            ("inverse", pa.list_(pa.float64())),
            ("logdet", pa.float64()),
        ]
    )
    return frame.select("gid", "start", "n", "sums", "products").mapInArrow(
        run, "gid string, start int, centre array<double>, inverse array<double>, logdet double"
    )


def middles(long: DataFrame, step: float) -> DataFrame:
    """The median of ``v`` per (gid, k), to a multiple of ``step``."""
    counted = long.groupBy("gid", "k", F.floor(F.col("v") / step).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("gid", "k")
    running = counted.withColumn("below", F.sum("n").over(order.orderBy("bin"))).withColumn("all", F.sum("n").over(order))
    return running.where(2 * F.col("below") >= F.col("all")).groupBy("gid", "k").agg(
        ((F.min("bin") + 0.5) * step).alias("v")
    )


def per_group(long: DataFrame, name: str) -> DataFrame:
    """Rows (gid, k, v) as one array per gid."""
    return long.groupBy("gid").agg(
        F.array(*[F.max(F.when(F.col("k") == i, F.col("v"))) for i in range(SIZE)]).alias(name)
    )


def starts(work: DataFrame) -> DataFrame:
    """Moments of three starts: scaled box, signs, and medians with scaled deviations alone."""
    x = [F.col("x")[i] for i in range(SIZE)]
    long = work.select("gid", F.posexplode("x").alias("k", "v"))
    median = written(per_group(middles(long, 1 / 256), "m"), "mcd-median")
    off = work.join(median, "gid").select(
        "gid", F.posexplode(F.array(*[F.abs(x[i] - F.col("m")[i]) for i in range(SIZE)])).alias("k", "v")
    )
    scale = median.join(per_group(middles(off, 1 / 256), "s"), "gid")
    floors = list(FLOORS.values())
    scale = scale.withColumn("s", F.array(*[F.sqrt((1.4826 * F.col("s")[i]) ** 2 + floors[i] ** 2) for i in range(SIZE)]))
    scale = written(scale, "mcd-scale")
    placed = work.join(scale, "gid")
    z = [(x[i] - F.col("m")[i]) / F.col("s")[i] for i in range(SIZE)]
    norm = F.greatest(F.sqrt(sum([v * v for v in z[1:]], z[0] * z[0])), F.lit(1e-9))
    signs = [F.col("m")[i] + F.col("s")[i] * z[i] / norm * math.sqrt(SIZE) for i in range(SIZE)]
    box = placed.where(F.greatest(*[F.abs(v) for v in z]) <= 2).groupBy("gid").agg(*moments(x))
    signed = placed.groupBy("gid").agg(*moments(signs))
    m = [F.col("m")[i] for i in range(SIZE)]
    plain = scale.select(
        "gid",
        F.lit(1).cast("bigint").alias("n"),
        F.col("m").alias("sums"),
        F.array(*[m[i] * m[j] + (F.col("s")[i] ** 2 if i == j else F.lit(0.0)) for i, j in PAIRS]).alias("products"),
    )
    together = plain.withColumn("start", F.lit(0))
    for number, one in ((1, signed), (2, box)):
        together = together.unionByName(one.withColumn("start", F.lit(number)))
    return fitted(together)


def concentrated(work: DataFrame, fits: DataFrame) -> DataFrame:
    """One concentration step of every start. The rows meet the estimates twice, where they are read:
    to count distances, and to sum up those within. No row moves to another task for it."""
    x = [F.col("x")[i] for i in range(SIZE)]
    d = distance(x, F.col("centre"), F.col("inverse"))
    bin_ = F.floor(F.log2(F.greatest(d, F.lit(1e-6))) * BINS)
    counted = work.join(fits, "gid").groupBy("gid", "start", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("gid", "start")
    running = counted.withColumn("below", F.sum("n").over(order.orderBy("bin"))).withColumn("all", F.sum("n").over(order))
    cut = running.where(F.col("below") >= SUBSET * F.col("all")).groupBy("gid", "start").agg(F.min("bin").alias("last"))
    cut = written(fits.join(cut, ["gid", "start"]), "mcd-cut")
    inner = work.join(cut, "gid").where(bin_ <= F.col("last"))
    return fitted(inner.groupBy("gid", "start").agg(*moments(x)))


def improved(better: DataFrame, fits: DataFrame) -> DataFrame:
    """Steps that made the determinant fall. It is bounded from below by the floors and falls by a
    least amount each time, so repeating the step for these alone comes to an end for every start."""
    old = fits.select("gid", "start", F.col("logdet").alias("old"))
    return better.join(old, ["gid", "start"]).where(F.col("logdet") < F.col("old") - GAIN).drop("old")


def statistics(frame: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and a struct ``m`` of measures, for all rows, written once."""
    return written(with_measures(frame, text, "m", keep), "measures")


def fit(stats: DataFrame) -> DataFrame:
    """(lang, source, centre, inverse) from rows (lang, source, m); centre is null for tiny groups."""
    passing = stats.where(~base_failed(F.col("m")))
    counts = passing.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    keys = written(group_keys(counts), "mcd-keys")
    work = same_group(passing, keys).where(F.col("gid").isNotNull())
    work = written(work.select("gid", F.array(*vector(F.col("m"))).alias("x")), "mcd-vectors")
    fits = written(starts(work), "mcd-fit")
    fits = moving = written(concentrated(work, fits), "mcd-fit")
    while moving.count():
        moving = written(improved(concentrated(work, moving), moving), "mcd-fit")
        fits = fits.join(moving, ["gid", "start"], "left_anti").unionByName(moving)
        fits = written(fits, "mcd-best")
    best = fits.groupBy("gid").agg(F.min(F.struct("logdet", "start", "centre", "inverse")).alias("best"))
    return keys.join(best, "gid", "left").select("lang", "source", "best.centre", "best.inverse")


def same_group(frame: DataFrame, groups: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The frame joined to a row per (lang, source), nulls being equal; groups may lack a key."""
    g_lang, g_source = fresh("g_lang", frame.columns), fresh("g_source", frame.columns)
    groups = groups.withColumnsRenamed({"lang": g_lang, "source": g_source})
    on = F.col(f"`{lang}`").eqNullSafe(F.col(g_lang)) & F.col(f"`{source}`").eqNullSafe(F.col(g_source))
    return frame.join(groups, on, "left").drop(g_lang, g_source)


def near(m: Column, centre: Column, inverse: Column) -> Column:
    """Within the limit of its group; true where the group has no estimate."""
    return F.coalesce(distance(vector(m), centre, inverse) <= LIMIT, F.lit(True))


def judged(stats: DataFrame) -> DataFrame:
    """Rows of ``statistics`` with base_failed, distance (squared; null: not estimated) and kept."""
    groups = fit(stats.select("lang", "source", "m"))
    m = F.col("m")
    joined = same_group(stats, groups).withColumn("base_failed", base_failed(m))
    kept = ~F.col("base_failed") & near(m, F.col("centre"), F.col("inverse"))
    far = distance(vector(m), F.col("centre"), F.col("inverse"))
    return joined.withColumn("distance", far).withColumn("kept", kept).drop("centre", "inverse")


def accepted(frame: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``frame`` that the rules keep, with the columns of ``frame``."""
    keys = frame.select(
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").alias("text"),
    )
    groups = written(fit(statistics(keys, ["lang", "source"])), "mcd-groups")
    m, centre, inverse = (fresh(n, frame.columns) for n in ("m", "centre", "inverse"))
    groups = groups.withColumnsRenamed({"centre": centre, "inverse": inverse})
    joined = same_group(with_measures(frame, text, m, frame.columns), groups, lang, source)
    good = ~base_failed(F.col(m)) & near(F.col(m), F.col(centre), F.col(inverse))
    return joined.where(good).select(*[F.col(f"`{c}`") for c in frame.columns])
