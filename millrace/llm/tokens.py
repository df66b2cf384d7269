"""Token ids of texts by a public byte-level tokenizer, each distinct unit of a slice encoded once.

A byte-level tokenizer never joins what stands before white space with it. So a text is cut before
every space that follows a visible character, and the ids of the pieces do not depend on their
neighbours. Arrow cuts the texts and numbers the distinct pieces; only these are encoded. Texts in
which white space stands before a space are cut by a pattern instead, and texts with one of the
separators U+001C to U+001F, which libraries class differently, are encoded in one piece.

The merges of a tokenizer file are applied by ``tiktoken`` where the file's ids follow its merge order
and its other settings are those of plain byte-level encoding, which gives the same ids several times
faster, and by ``tokenizers`` otherwise.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

UNIT = re.compile(r"\s*\S+|\s+")
#: RE2 patterns: white space of any kind before a space, and the separators.
SPACED = r"[\s\x0b\x1c-\x1f\x{85}\pZ] "
SEPARATED = r"[\x1c-\x1f]"
#: The pattern by which byte-level tokenizers cut texts before merging (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Cached units of a worker, and the longest unit that is cached; what does not fit is encoded anew.
MOST_UNITS, LONGEST_UNIT = 300_000, 48

END = 0  # closes each document
ID = np.dtype("<u4")


def byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others are numbered from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Token bytes and ids, if merging by id is what the file says."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    ordered = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    ordered = ordered and not spec.get("normalizer") and model.get("type", "BPE") == "BPE" and not model.get("dropout")
    if not ordered or model.get("ignore_merges"):
        return None
    letters, vocabulary = byte_of(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [vocabulary["".join(p)] for p in pairs]
    if merged != sorted(merged) or (merged and merged[0] < 256):
        return None
    used = {"".join(p) for p in pairs} | set(letters)
    return {bytes(letters[c] for c in token): vocabulary[token] for token in used}


class Encoder:
    """Encodes texts; one per path and worker, see ``encoder``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        ranks = ranks_of(path)
        self.fast = ranks and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def plain(self, texts: list[str]) -> list[bytes]:
        if self.fast:
            return [np.array(self.fast.encode_ordinary(t), dtype=ID).tobytes() for t in texts]
        return [np.array(e.ids, dtype=ID).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def units(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units."""
        known = self.known
        missing = [u for u in units if u not in known]
        extra = dict(zip(missing, self.plain(missing), strict=True))
        room = MOST_UNITS - len(known)
        if room > 0:
            known.update((u, ids) for u, ids in list(extra.items())[:room] if len(u) <= LONGEST_UNIT)
        return [extra[u] if u in extra else known[u] for u in units]

    def slowly(self, text: str) -> np.ndarray:
        pieces = [text] if re.search(SEPARATED, text) else UNIT.findall(text)
        found = dict(zip(distinct := list(dict.fromkeys(pieces)), self.units(distinct), strict=True))
        return np.frombuffer(b"".join(found[p] for p in pieces), dtype=ID)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers, closed by ``END``; null counts as empty."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        slow = np.asarray(pc.match_substring_regex(texts, f"{SPACED}|{SEPARATED}"))
        split = pc.split_pattern(pc.if_else(pa.array(slow), "", texts), " ")
        counts = np.asarray(pc.list_value_length(split), dtype=np.int64)
        begins = np.cumsum(counts) - counts
        coded = split.flatten().dictionary_encode()
        number = np.asarray(coded.indices, dtype=np.int32) * 2 + 1
        number[begins] -= 1  # the first piece of a text has no space before it
        used, where = unique_small(number, 2 * len(coded.dictionary))
        names = coded.dictionary.to_pylist()
        del split, coded, number
        blobs = self.units([names[n >> 1] if n % 2 == 0 else f" {names[n >> 1]}" for n in used.tolist()])
        ids = np.frombuffer(b"".join(blobs), dtype=ID)
        lengths = np.array([len(b) for b in blobs], dtype=np.int64) // ID.itemsize
        starts = np.cumsum(lengths) - lengths
        piece = lengths[where]
        ends = np.cumsum(piece)
        at = np.repeat(starts[where] - (ends - piece), piece)
        at += np.arange(len(at))
        flat = ids[at]
        del at
        bounds = np.append((ends - piece)[begins], len(flat))
        out = []
        for i in range(len(texts)):
            own = self.slowly(texts[i].as_py()) if slow[i] else flat[bounds[i] : bounds[i + 1]]
            out.append(np.append(own, ID.type(END)))
        return out


def unique_small(values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``top`` in order, and each value's place among them."""
    seen = np.zeros(top, dtype=bool)
    seen[values] = True
    places = np.cumsum(seen) - 1
    return np.flatnonzero(seen), places[values]


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]
