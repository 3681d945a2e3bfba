"""Byte-level BPE of whole texts from pieces that are encoded once.

The pre-tokenizer of a byte-level BPE never puts a character that is not white space and
a white-space character that follows it into one unit, so a text may be cut there. Each
piece (white space, then the characters up to the next white space) is encoded by the
``tokenizers`` library once and remembered; a text is the concatenation of its pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The characters of Unicode's White_Space property, as the pre-tokenizer's \s has them.
WHITE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

# A Latin letter always ends a unit where one of these ASCII characters follows it.
UNIT = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-/:-@\[-`{-~0-9])")
# Texts that a plain split before each blank and line feed could cut inside white space.
RUNS = "[" + WHITE.replace("\t-\r", r"\x09-\x0D") + "][ \n]|\x00"

#: Units that one call of the encoder gets, short and so of about equal bytes, and bytes of text taken at once.
CALL, GROUP = 256, 4 << 20
#: Bytes of remembered pieces of a worker, in each of two generations, and what an entry takes besides its text. Longer pieces are not kept.
MEMORY, ENTRY, LONGEST = 64 << 20, 180, 64

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """One tokenizer of a Python worker, with the ids of pieces as little-endian 32-bit bytes.

    Arrow splits texts and finds the distinct pieces of a group; only these are looked up.
    New pieces are encoded many at a time. Those that a blank or line feed sets apart are one text, cut afterwards
    by the bytes that each id stands for; others are joined by a special token of the tokenizer,
    which the library always makes a unit of its own, and cut at its id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        plain = [(token.content, at) for at, token in sorted(added.items()) if not (token.lstrip or token.rstrip or token.normalized or token.single_word)]
        self.added = [token.content for token in added.values()]
        self.mark, self.mark_id = plain[0] if plain else ("", -1)
        # A byte-level vocabulary writes each byte as one character; without a normalizer, ids stand for the bytes of the text.
        self.spans = np.zeros(0, np.int64)
        if self.tokenizer.normalizer is None:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.spans = np.zeros(1 + max([*vocabulary.values(), *added], default=0), np.int64)
            self.spans[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _alone(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _cut(self, call: list[str], ids: np.ndarray) -> np.ndarray | None:
        """The number of ids up to the end of each unit of a joined call; None if an id crosses an end."""
        joined = "".join(call)
        ends = np.cumsum([len(unit) for unit in call] if joined.isascii() else [len(unit.encode()) for unit in call])
        reached = np.cumsum(self.spans[ids])
        at = np.searchsorted(reached, ends)
        whole = len(reached) and reached[-1] == ends[-1] and np.array_equal(reached[at], ends)
        return at + 1 if whole else None

    def _encode(self, units: list[str]) -> dict[str, bytes]:
        """The ids of distinct units."""
        found: dict[str, bytes] = {}
        apart, marked = [], units
        if len(self.spans):
            apart = [unit for unit in units if unit[0] in " \n" and not unit[-1].isspace()]
            if self.added and any(token in "".join(apart) for token in self.added):
                apart = [unit for unit in apart if not any(token in unit for token in self.added)]
            marked = list(set(units).difference(apart))
        for low in range(0, len(apart), CALL):
            call = apart[low : low + CALL]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(call)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = self._cut(call, ids)
            if ends is None:
                marked += call
                continue
            data, ends = ids.tobytes(), (4 * ends).tolist()
            found.update(zip(call, [data[a:b] for a, b in zip([0, *ends], ends)]))
        if not self.mark:
            found.update((unit, self._alone(unit)) for unit in marked)
            return found
        for low in range(0, len(marked), CALL):
            call = marked[low : low + CALL]
            joined = self.mark.join(call)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            if len(cuts) != len(call) - 1:  # a unit holds the token's own string
                found.update((unit, self._alone(unit)) for unit in call)
                continue
            data = ids.tobytes()
            found.update(zip(call, [data[a:b] for a, b in zip([0, *(cut + 4 for cut in cuts)], [*cuts, len(data)])]))
        return found

    def _look_up(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of distinct pieces; units inside new pieces are remembered as well."""
        if self.held > MEMORY:
            self.young, self.old, self.held = {"": b""}, self.young, 0
        young, old, long = self.young, self.old, {}

        def new(found: list[str]) -> list[str]:
            found = [piece for piece in found if piece not in young]
            young.update([(piece, old[piece]) for piece in found if piece in old])
            return [piece for piece in found if piece not in old]

        def learn(found: dict[str, bytes]) -> None:
            self.held += ENTRY * len(found) + sum(map(len, found)) + sum(map(len, found.values()))
            if max(map(len, found), default=0) > LONGEST:
                long.update((piece, ids) for piece, ids in found.items() if len(piece) > LONGEST)
                found = {piece: ids for piece, ids in found.items() if len(piece) <= LONGEST}
            young.update(found)

        fresh = new(pieces)
        split = UNIT.split
        if self.added and any(token in "".join(fresh) for token in self.added):
            cut = [[piece] if any(token in piece for token in self.added) else split(piece) for piece in fresh]
        else:
            cut = [split(piece) for piece in fresh]
        learn(self._encode(new(list({unit for units in cut for unit in units}))))
        learn({piece: b"".join([young[unit] if unit in young else long[unit] for unit in units]) for piece, units in zip(fresh, cut) if len(units) > 1})
        return {**young, **long} if long else young

    def _pieces(self, texts: pa.Array) -> pa.ListArray:
        """Each text's pieces."""
        lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n"), "\0")
        runs = pc.match_substring_regex(texts, RUNS)
        if not pc.any(runs).as_py():
            return lists
        cut = [PIECE.findall(text.as_py()) if run else None for text, run in zip(texts, runs.to_pylist())]
        return pc.if_else(runs, pa.array(cut, lists.type), lists)

    def encode(self, texts: pa.Array) -> Iterator[tuple[memoryview, np.ndarray]]:
        """For groups of texts in turn: the ids of all, and where each text's bytes begin and the last end."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        low = 0
        while low < len(texts):
            start = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, start + GROUP, side="right")))
            lists = self._pieces(texts.slice(low, high - low))
            coded = lists.flatten().dictionary_encode()
            known = self._look_up(distinct := coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            ids = pa.array(list(map(known.__getitem__, distinct)), pa.large_binary()).take(coded.indices)
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            _, offsets, data = ids.buffers()
            offsets = np.frombuffer(offsets, dtype=np.int64) if len(ids) else np.zeros(1, np.int64)
            yield memoryview(data) if data is not None else memoryview(b""), offsets[at + ids.offset]
            low = high


def encoder(path: str) -> Encoder:
    """The worker's encoder for this tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Gives back what the worker remembers, for work of another kind that starts in it."""
    _encoders.clear()
