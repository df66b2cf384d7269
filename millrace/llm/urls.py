"""URL filters: host and path rules, and for the rest a character language-model ratio.

Two smoothed variable-order Markov models are fitted, one on the URLs that a rule allows and one on
those that a rule blocks. Spark counts the n-grams of all of them, each distinct URL once, however
many rows repeat it. A model blends the orders 0 to ``ORDER`` by Witten-Bell weights: the more distinct
characters have followed a context, the more the next shorter context counts. A URL without a rule
is allowed if its length-normalised log-likelihood difference reaches the limit at which the held-out
fifth of the ruled URLs, chosen by hash, is best told apart by models of the other four. Characters
are the bytes of UTF-8. The models hold every n-gram that was counted, so they grow with the distinct
n-grams of the data; the driver gathers them and sends them to the tasks.

Cases: a null URL, or one without ``://``, has an empty host and path, so no rule fits; the model
judges its text (null: empty). If only one side has URLs to learn from, the rest gets that side's
verdict; with none on either, it is allowed. Repeated rows are judged alike. Extra columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, slices, written

ORDER = 4
HELD_OUT = 5
STEP = 1 / 4096  # of the scores between which the limit is sought
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]  # verdict, host and path


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), "^[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(verdict, rule) of the longest rule that fits; null if none does."""
    choice = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0] == "block")):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        choice = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(choice)
    return choice


def spread(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked URLs in one array, the places to score, and where each URL's places begin."""
    marked = [b"\x02" * ORDER + u + b"\x03" for u in urls]
    text = np.frombuffer(b"".join(marked), dtype=np.uint8)
    lengths = np.array([len(m) for m in marked], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    scored = np.ones(len(text), dtype=bool)
    for k in range(ORDER):
        scored[begins + k] = False
    return text, np.flatnonzero(scored), begins - ORDER * np.arange(len(urls))


def grams(text: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the number of the context and that of the context with its next character."""
    context = np.zeros(len(places), dtype=np.int64)
    following = text[places].astype(np.int64)
    for order in range(ORDER + 1):
        if order:
            context = context * 257 + text[places - order] + 1
        yield context, context * 256 + following


def counted(urls: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the distinct n-grams in order and how often each occurs."""
    text, places, _ = spread(urls)
    return [np.unique(both, return_counts=True) for _, both in grams(text, places)]


def found(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number stands among the sorted values, and whether it does."""
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


class Markov:
    """A variable-order model of byte strings, from the strings or from their n-grams' counts."""

    def __init__(self, urls: list[bytes], counts: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.tables = []
        for both, times in counts or counted(urls):
            context, first = np.unique(both // 256, return_index=True)
            kinds = np.diff(np.append(first, len(both)))
            self.tables.append((both, times, context, np.add.reduceat(times, first), kinds))

    def logs(self, text: np.ndarray, places: np.ndarray) -> np.ndarray:
        p = np.full(len(places), 1 / 256)
        for (context, both), (pairs, times, contexts, total, kinds) in zip(grams(text, places), self.tables, strict=True):
            at, known = found(contexts, context)
            which, seen = found(pairs, both)
            weight = kinds[at]
            blended = (np.where(seen, times[which], 0) + weight * p) / (total[at] + weight)
            p = np.where(known, blended, p)
        return np.log(np.maximum(p, 1e-12))


def limit_between(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The cut that best tells apart numbers of good and bad scores per cut; of equals, the nearest to 0."""
    right = 1 - (np.cumsum(good) - good) / good.sum() + (np.cumsum(bad) - bad) / bad.sum()
    best = cuts[right >= right.max() - 1e-12]
    return float(best[np.argmin(np.abs(best))])


def limit_of(scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The limit from distinct scores and how many good and bad URLs have each."""
    cuts, at = np.unique(np.append(scores, 0.0), return_inverse=True)
    weights = [np.bincount(at, np.append(n, 0), minlength=len(cuts)) for n in (good, bad)]
    return limit_between(cuts, *weights)


class Ratio:
    """Two models and the limit between them."""

    def __init__(self, allowed: list[bytes], blocked: list[bytes]):
        self.only = None
        if not allowed or not blocked:
            self.only = "block" if blocked else "allow"
            return
        kept = [[u for i, u in enumerate(urls) if i % HELD_OUT] or urls for urls in (allowed, blocked)]
        held = [urls[::HELD_OUT] for urls in (allowed, blocked)]
        self.models = [Markov(urls) for urls in kept]
        good, bad = (self.scores(urls) for urls in held)
        one, none = np.ones, np.zeros
        self.limit = limit_of(
            np.concatenate([good, bad]),
            np.concatenate([one(len(good)), none(len(bad))]),
            np.concatenate([none(len(good)), one(len(bad))]),
        )
        self.models = [Markov(urls) for urls in (allowed, blocked)]

    @classmethod
    def of(cls, models: list[Markov], limit: float = 0.0) -> Ratio:
        ratio = cls([], [])
        ratio.only, ratio.models, ratio.limit = None, models, limit
        return ratio

    def scores(self, urls: list[bytes]) -> np.ndarray:
        """Mean over the characters of the log-likelihood difference, allowed less blocked."""
        if not urls:
            return np.zeros(0)
        text, places, begins = spread(urls)
        gain = self.models[0].logs(text, places) - self.models[1].logs(text, places)
        return np.add.reduceat(gain, begins) / np.diff(np.append(begins, len(places)))


def gram_counts(ruled: DataFrame) -> DataFrame:
    """(part, ord, gram, n) over all rows (part, url)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1):
            parts, texts = np.asarray(rows.column(0)), rows.column(1).cast(pa.large_binary())
            for part in np.unique(parts):
                for order, (both, times) in enumerate(counted(texts.filter(pa.array(parts == part)).to_pylist())):
                    numbers = [np.full(len(both), v, dtype=np.int32) for v in (part, order)]
                    arrays = [pa.array(c) for c in (*numbers, both, times.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["part", "ord", "gram", "n"])

    rows = ruled.select("part", "url").mapInArrow(run, "part int, ord int, gram bigint, n bigint")
    return rows.groupBy("part", "ord", "gram").agg(F.sum("n").alias("n"))


def score_counts(ruled: DataFrame, ratio: Ratio) -> DataFrame:
    """(part, score, n) of all rows (part, url), scores in whole steps of ``STEP``."""
    shared = ruled.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1):
            scores = shared.value.scores(rows.column(1).cast(pa.large_binary()).to_pylist())
            bins = np.floor(scores / STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(bins)], names=["part", "score"])

    rows = ruled.select("part", "url").mapInArrow(run, "part int, score bigint")
    return rows.groupBy("part", "score").agg(F.count(F.lit(1)).alias("n"))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order and their counts, summed over the parts."""
    both, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return both, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def learned(rows: DataFrame) -> Ratio:
    """Models of all URLs that a rule decides, and their limit, from rows (url, fit).

    The URLs have four parts: those allowed and, from 2 on, those blocked; of both, the odd part is held out.
    """
    ruled = rows.where("fit is not null").select("url", (F.col("fit")["verdict"] == "block").cast("int").alias("side"))
    held = (F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0).cast("int")
    ruled = written(ruled.distinct().select((2 * F.col("side") + held).alias("part"), "url"), "ruled-urls")
    table = gram_counts(ruled).toArrow()
    part, order, gram, n = (np.asarray(table[c]) for c in ("part", "ord", "gram", "n"))
    have = np.unique(part).tolist()
    sides = [[p for p in have if p // 2 == side] for side in (0, 1)]
    if not all(sides):
        return Ratio([], [b""] if sides[1] else [])

    def model(parts: list[int]) -> Markov:
        own = [[(part == p) & (order == k) for p in parts] for k in range(ORDER + 1)]
        return Markov([], [merged([(gram[o], n[o]) for o in one]) for one in own])

    fitted = Ratio.of([model(side[:1]) for side in sides])
    bins = score_counts(ruled.where(F.col("part").isin([side[-1] for side in sides])), fitted).toArrow()
    scores, times, blocked = np.asarray(bins["score"]) * STEP, np.asarray(bins["n"]), np.asarray(bins["part"]) > 1
    return Ratio.of([model(side) for side in sides], limit_of(scores, times * ~blocked, times * blocked))


def filtered(frame: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """The frame with host, path, rule, score (null where a rule decides) and verdict."""
    text = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    learn = frame.select(text.alias("url"))
    ratio = learned(learn.withColumn("fit", fitting(host_of(F.col("url")), path_of(F.col("url")), rules)))
    shared = frame.sparkSession.sparkContext.broadcast(ratio)
    fit, score = fresh("fit", frame.columns), fresh("score", frame.columns)
    added = ["host", "path", "rule", "score", "verdict"]
    kept = [c for c in frame.columns if c.lower() not in added]
    ruled = frame.select(
        *[F.col(f"`{c}`") for c in kept],
        host_of(text).alias("host"),
        path_of(text).alias("path"),
        fitting(host_of(text), path_of(text), rules).alias(fit),
        text.alias(score),
    )
    at, fit_at = ruled.columns.index(score), ruled.columns.index(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, at):
            rest = np.asarray(batch.column(fit_at).is_null())
            out = np.full(batch.num_rows, np.nan)
            if model.only is None and rest.any():
                texts = batch.column(at).cast(pa.large_binary()).filter(pa.array(rest)).to_pylist()
                out[rest] = model.scores(texts)
            columns = [*batch.columns[:at], pa.array(out, mask=np.isnan(out))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ruled.schema.fields[:-1])
    scored = ruled.mapInArrow(run, f"{types}, `{score}` double")
    if ratio.only is None:
        judged = F.when(F.col(score) >= ratio.limit, "allow").otherwise("block")
    else:
        judged = F.lit(ratio.only)
    return scored.select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col(fit)["rule"].alias("rule"),
        F.col(score).alias("score"),
        F.coalesce(F.col(fit)["verdict"], judged).alias("verdict"),
    )
