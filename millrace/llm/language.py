"""Language identification by a linear-chain conditional random field over the words of a text.

A word's score for each language sums learned weights of its affixes and character n-grams (n-grams
of the word between two marks), of the whole word, and of the language that a lexicon gives it. With
learned transitions between neighbouring words, forward-backward gives each word's label
probabilities in the light of the whole text. A text's language is the one with the largest sum
over its words; its score is the mean probability of that language.

The field is fitted by stochastic gradients on at most ``SAMPLE`` texts per language, of each a run of
``RUN`` words at a hashed place. Runs of different languages are joined at random, so that the
transitions see code-switched text.

Cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing can
be learned from. Words without a letter are passed over. Ties go to the first language by code point.
Repeated rows and extra columns pass; a clashing output name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

SAMPLE = 400
RUN = 60
SLOTS = 1 << 16
ORDERS = (1, 2, 3, 4)
SEQUENCES, LENGTH, EPOCHS, BATCH, RATE = 2400, 40, 3, 64, 0.15
LEXICON_TIMES = 2
UNKNOWN = "und"
CHUNK_WORDS = 60_000
#: Characters of distinct words, or of one word, that are spelled at a time; and of texts read at a time.
PART_CHARS = 200_000
SLICE = 1_000_000


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of the words in one array, and where each word's slots begin.

    The first slot of a word is the whole word's; the others are those of its marked n-grams.
    """
    marked = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(begins + lengths, lengths) - np.arange(len(marked))
    found, owners = [], []
    value = np.zeros(len(marked), dtype=np.uint64)
    longest = int(lengths.max()) if len(words) else 0
    text = marked.astype(np.uint64)
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(text), dtype=np.uint64)
        shifted[: len(text) - order + 1] = text[order - 1 :]
        value = value * np.uint64(0x100000001B3) + shifted + np.uint64(1)
        if order in ORDERS and order <= longest:
            whole = left >= order
            found.append(mix(value[whole] + np.uint64(order)))
            owners.append(owner[whole])
    full = np.add.reduceat((text + np.uint64(7)) * powers(np.arange(len(text)) - np.repeat(begins, lengths)), begins) if len(words) else text
    found.append(mix(full * np.uint64(31) + np.uint64(99)))
    owners.append(np.arange(len(words)))
    owners_all = np.concatenate(owners)
    order = np.argsort(owners_all, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owners_all[order], np.arange(len(words)))


POWER = np.uint64(0x9E3779B97F4A7C15)


def spelled_in_parts(word: str) -> Iterator[np.ndarray]:
    """The slots of one long word as ``spelled`` gives them, a part of the word at a time and the whole word's last."""
    ahead = max(ORDERS) - 1
    whole, weight = np.zeros(1, dtype=np.uint64), 1
    for start in range(0, len(word) + 2, PART_CHARS):
        marked = ("\x02" * (start == 0)) + word[max(0, start - 1) : start - 1 + PART_CHARS + ahead]
        if start - 1 + PART_CHARS + ahead > len(word):
            marked += "\x03"
        text = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        own = min(PART_CHARS, len(text))
        value = np.zeros(len(text), dtype=np.uint64)
        for order in range(1, min(ahead + 1, len(text)) + 1):
            value = value[: len(text) - order + 1] * np.uint64(0x100000001B3) + text[order - 1 :] + np.uint64(1)
            if order in ORDERS:
                yield mix(value[:own] + np.uint64(order))
        steps = powers(np.arange(own)) * np.uint64(weight)
        whole = whole + ((text[:own] + np.uint64(7)) * steps).sum(dtype=np.uint64)
        weight = weight * pow(int(POWER), PART_CHARS, 1 << 64) % (1 << 64)
    yield mix(whole * np.uint64(31) + np.uint64(99))


def powers(exponents: np.ndarray) -> np.ndarray:
    table = np.full(int(exponents.max()) + 1 if len(exponents) else 1, POWER, dtype=np.uint64)
    table[0] = 1
    return np.cumprod(table)[exponents]


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((value ^ (value >> np.uint64(29))) >> np.uint64(13)).astype(np.int64) & (SLOTS - 1)


def usable(word: str) -> bool:
    return any(c.isalpha() for c in word)


class Field:
    """A linear-chain field: weights of slots and of lexicon labels, and transitions."""

    def __init__(self, labels: list[str], runs: list[tuple[str, list[str]]]):
        self.labels = labels
        size = len(labels)
        self.slots = np.zeros((SLOTS, size), dtype=np.float32)
        self.listed = np.zeros((size + 1, size), dtype=np.float32)
        self.moves = np.zeros((size, size))
        by_label = {name: [words for lang, words in runs if lang == name and words] for name in labels}
        by_label = {name: own for name, own in by_label.items() if own}
        self.labels_seen = sorted(by_label)
        self.lexicon = self.listed_words(by_label)
        if len(self.labels_seen) > 1:
            self.train(by_label)

    def listed_words(self, by_label: dict[str, list[list[str]]]) -> dict[str, int]:
        """Words that are found ``LEXICON_TIMES`` or more times, with the label that has most of them."""
        times: dict[str, dict[str, int]] = {}
        for name, own in by_label.items():
            for word in (w for words in own for w in words):
                seen = times.setdefault(word, {})
                seen[name] = seen.get(name, 0) + 1
        best = {w: max(sorted(t), key=lambda k: t[k]) for w, t in times.items() if sum(t.values()) >= LEXICON_TIMES}
        return {w: self.labels.index(name) for w, name in best.items() if 2 * times[w][name] > sum(times[w].values())}

    def listing(self, words: list[str]) -> np.ndarray:
        return np.array([self.lexicon.get(w, len(self.labels)) for w in words], dtype=np.int64)

    def emissions(self, words: list[str]) -> np.ndarray:
        """The scores of the labels for each word, from about ``PART_CHARS`` characters at a time."""
        out = np.zeros((len(words), len(self.labels)), dtype=np.float32)
        ends = np.cumsum([len(w) + 2 for w in words])
        at = 0
        while at < len(words):
            end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_CHARS, side="right"))
            if end > at:
                slots, begins = spelled(words[at:end])
                out[at:end] = np.add.reduceat(self.slots[slots], begins, axis=0)
            else:
                end = at + 1
                for slots in spelled_in_parts(words[at]):
                    out[at] += self.slots[slots].sum(axis=0)
            at = end
        return out + self.listed[self.listing(words)] if words else out

    def train(self, by_label: dict[str, list[list[str]]]) -> None:
        rng = np.random.default_rng(11)
        names = self.labels_seen
        sequences = []
        for _ in range(SEQUENCES):
            words, marks = [], []
            while len(words) < LENGTH:
                name = names[rng.integers(len(names))]
                source = by_label[name][rng.integers(len(by_label[name]))]
                take = int(rng.integers(5, LENGTH + 1))
                start = int(rng.integers(max(1, len(source) - take + 1)))
                piece = source[start : start + take]
                words += piece
                marks += [self.labels.index(name)] * len(piece)
            sequences.append((words[:LENGTH], marks[:LENGTH]))
        vocabulary: dict[str, int] = {}
        coded = np.array([[vocabulary.setdefault(w, len(vocabulary)) for w in words] for words, _ in sequences])
        marked = np.array([marks for _, marks in sequences])
        words = list(vocabulary)
        slots, begins = spelled(words)
        ends = np.append(begins[1:], len(slots))
        listing = self.listing(words)
        squares = [np.full(w.shape, 1e-6, dtype=np.float32) for w in (self.slots, self.listed, self.moves)]
        size = len(self.labels)
        for _ in range(EPOCHS):
            order = rng.permutation(len(coded))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                used, place = np.unique(coded[rows], return_inverse=True)
                pick = np.concatenate([slots[begins[u] : ends[u]] for u in used])
                counts = ends[used] - begins[used]
                first = np.cumsum(counts) - counts
                scores = np.add.reduceat(self.slots[pick], first, axis=0) + self.listed[listing[used]]
                emitted = scores[place.reshape(len(rows), LENGTH)].transpose(1, 0, 2).astype(np.float64)
                truth = marked[rows].T
                marginals, pairs = posterior(emitted, self.moves)
                error = marginals
                np.put_along_axis(error, truth[:, :, None], np.take_along_axis(error, truth[:, :, None], 2) - 1, 2)
                flat = error.transpose(1, 0, 2).reshape(-1, size)
                by_word = np.zeros((len(used), size))
                np.add.at(by_word, place.reshape(-1), flat)
                seen = np.bincount((truth[:-1] * size + truth[1:]).reshape(-1), minlength=size * size)
                scale = 1 / len(rows)
                self.step(squares[0], self.slots, pick, np.repeat(by_word, counts, axis=0) * scale)
                self.step(squares[1], self.listed, listing[used], by_word * scale)
                change = (pairs - seen.reshape(size, size)) * scale
                squares[2] += change**2
                self.moves -= RATE * change / np.sqrt(squares[2])

    @staticmethod
    def step(squares: np.ndarray, weights: np.ndarray, places: np.ndarray, change: np.ndarray) -> None:
        """An adaptive gradient step on some rows of the weights."""
        touched, where = np.unique(places, return_inverse=True)
        total = np.zeros((len(touched), weights.shape[1]))
        np.add.at(total, where, change)
        squares[touched] += (total**2).astype(np.float32)
        weights[touched] -= (RATE * total / np.sqrt(squares[touched])).astype(np.float32)


def forward_backward(emitted: np.ndarray, moves: np.ndarray, lengths: np.ndarray | None = None):
    """Scaled forward and backward messages of (time, text, label) scores."""
    steps, texts, size = emitted.shape
    potential = np.exp(emitted - emitted.max(axis=2, keepdims=True))
    transfer = np.exp(moves - moves.max())
    forward, backward = np.empty_like(potential), np.empty_like(potential)
    message = potential[0] / potential[0].sum(axis=1, keepdims=True)
    forward[0] = message
    for t in range(1, steps):
        message = (message @ transfer) * potential[t]
        message /= message.sum(axis=1, keepdims=True)
        forward[t] = message
    back = np.full((texts, size), 1 / size)
    backward[-1] = back
    turned = transfer.T
    for t in range(steps - 2, -1, -1):
        back = (potential[t + 1] * back) @ turned
        back /= back.sum(axis=1, keepdims=True)
        if lengths is not None:
            back[lengths <= t + 1] = 1 / size
        backward[t] = back
    return potential, transfer, forward, backward


def posterior(emitted: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word, and expected transitions over all texts."""
    potential, transfer, forward, backward = forward_backward(emitted, moves)
    marginals = forward * backward
    marginals /= marginals.sum(axis=2, keepdims=True)
    ahead = potential[1:] * backward[1:]
    norm = np.einsum("tbi,ij,tbj->tb", forward[:-1], transfer, ahead)
    pairs = np.einsum("tbi,tbj->ij", forward[:-1] / norm[:, :, None], ahead) * transfer
    return marginals, pairs


def marginals_of(field: Field, texts: list[list[int]], scores: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, label probabilities of its words) for texts given as numbers of scored words."""
    order = sorted((i for i, t in enumerate(texts) if len(t)), key=lambda i: (len(texts[i]), i))
    at = 0
    while at < len(order):
        end, shortest = at + 1, len(texts[order[at]])
        while end < len(order):
            longest = len(texts[order[end]])
            if longest > 2 * shortest + 16 or (end - at + 1) * longest > CHUNK_WORDS:
                break
            end += 1
        chunk = order[at:end]
        lengths = np.array([len(texts[i]) for i in chunk])
        emitted = np.zeros((int(lengths.max()), len(chunk), scores.shape[1]))
        for k, i in enumerate(chunk):
            emitted[: lengths[k], k] = scores[texts[i]]
        _, _, forward, backward = forward_backward(emitted, field.moves, lengths)
        both = forward * backward
        both /= both.sum(axis=2, keepdims=True)
        for k, i in enumerate(chunk):
            yield i, both[: lengths[k], k]
        at = end


def read(field: Field, texts: list[str | None], runs: bool) -> list[tuple[str, float, list]]:
    """(language, score, runs of (words, label)) of each text."""
    return [found[:3] for found in weighed(field, texts, runs)]


def weighed(field: Field, texts: list[str | None], runs: bool) -> list[tuple[str, float, list, float]]:
    """(language, score, runs of (words, label), mean certainty of its words) of each text."""
    split = [(t or "").lower().split() for t in texts]
    flat = np.empty(sum(map(len, split)), dtype=object)
    flat[:] = [w for words in split for w in words]
    numbers, distinct = pd.factorize(flat)
    good = np.array([usable(w) for w in distinct], dtype=bool)
    renumbered = np.cumsum(good) - 1
    kept = [w for w, g in zip(distinct, good, strict=True) if g]
    scores = field.emissions(kept).astype(np.float64)
    coded, at = [], 0
    for words in split:
        own = numbers[at : at + len(words)]
        at += len(words)
        coded.append(renumbered[own[good[own]]] if len(own) else own)
    out: list[tuple[str, float, list, float]] = [(UNKNOWN, 0.0, [], 0.0)] * len(texts)
    if not field.labels_seen:
        return out
    for i, probabilities in marginals_of(field, coded, scores):
        mean = probabilities.mean(axis=0)
        best = int(mean.argmax())
        spans = []
        if runs:
            each = probabilities.argmax(axis=1)
            cuts = np.flatnonzero(np.diff(each)) + 1
            spans = [
                {"words": int(b - a), "lang": field.labels[each[a]]}
                for a, b in zip([0, *cuts], [*cuts, len(each)], strict=True)
            ]
        out[i] = (field.labels[best], min(1.0, float(mean[best])), spans, float(probabilities.max(axis=1).mean()))
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(frame: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Field:
    """A field learned from at most ``sample`` texts per language, none of them held out.

    Only counts per language and the chosen runs of words reach the driver.
    """
    rows = frame.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("key").isNotNull() & ~held_out(F.col("key")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return Field([], [])
    # A text's rank within its language is estimated from its hash, so one top list serves all languages.
    share = F.create_map(*[F.lit(v) for name in labels for v in (name, float(counts[name]))])[F.col("lang")]
    rank = (F.xxhash64("key").cast("double") / float(2**64) + 0.5) * share
    top = rows.select("key", "lang", rank.alias("rank")).distinct().orderBy("rank", "key").limit(sample * len(labels))
    chosen = [r["key"] for r in top.collect()]
    words = F.split(F.trim("text"), r"\s+")
    start = F.pmod(F.xxhash64("key"), F.greatest(F.size(words) - RUN, F.lit(0)) + 1) + 1
    picked = rows.where(F.col("key").isin(chosen)).select("key", "lang", F.slice(words, start.cast("int"), RUN).alias("words"))
    picked = picked.groupBy("key").agg(F.min(F.struct("lang", "words")).alias("one"))
    runs = sorted((r["key"], r["one"]["lang"], r["one"]["words"]) for r in picked.collect())
    return Field(labels, [(name, [w.lower() for w in words or [] if usable(w)]) for _, name, words in runs])


def identified(frame: DataFrame, field: Field, text: str = "text", runs: bool = False) -> DataFrame:
    """The frame with lang_pred and score, and with ``runs`` the runs of words of one language."""
    added = ["lang_pred", "score", *(["runs"] if runs else [])]
    kept = [c for c in frame.columns if c.lower() not in added]
    base = frame.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text)
    shared = frame.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("words", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at, SLICE):
            found = read(shared.value, part.column(at).to_pylist(), runs)
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            if runs:
                new.append(pa.array([f[2] for f in found], span))
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *added])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    more = ", runs array<struct<words:int,lang:string>>" if runs else ""
    return base.mapInArrow(run, f"{types}, lang_pred string, score double{more}")


def accepted(frame: DataFrame, field: Field, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose words are each of a language that is known with at least ``least`` on the mean, with
    the columns of the frame. Code-switched texts pass, among however many languages they switch.
    """
    at = frame.columns.index(text)
    shared = frame.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at, SLICE):
            found = weighed(shared.value, part.column(at).to_pylist(), False)
            good = [lang != UNKNOWN and sure >= least for lang, _, _, sure in found]
            yield part.filter(pa.array(good, pa.bool_()))

    return frame.mapInArrow(run, frame.schema)
