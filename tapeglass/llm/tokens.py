"""Token ids of whole texts with the `tokenizers` library, which sees each distinct piece of text once.

Both tokenizers split a text at white space, and words from punctuation, before they look at anything else. So the
ids of a text are those of its chunks between single spaces, and those of a chunk are those of its pieces in order: words
with at most ASCII signs behind them, what is behind, and whatever else there is. Chunks and pieces repeat often; their
ids are kept in bounded tables per worker, and Arrow finds the distinct chunks of some thousand texts and puts their
ids together, so that Python sees each of them once. A word of plain letters goes to the library's model directly,
past the splitting and normalising that leave it as it is; a few of each worker's first words are held against the
whole tokenizer, which takes them all if one differs. Texts with the strings of special tokens or with rare white space
are encoded whole.
"""

from __future__ import annotations

import itertools
import os
import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

KEPT_PIECES = 1_000_000
#: Texts that are encoded together, at most, and their bytes, if there is more than one.
TEXTS_AT_ONCE, BYTES_AT_ONCE = 4096, 12_000_000

# A space joins the word after it, and of a longer run of white space the last one stays apart, as in the
# tokenizer's own pattern. That holds for the four common characters; texts with others are encoded whole.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Signs behind a word are no part of it; an apostrophe may begin an ending of the tokenizer's own.
SIGNS = r"!-&(-/:-@\[-`{-~"
WORD = rf"[{LETTERS}]+(?=[{SIGNS}]*(?:[ \t\n\r]|$))"
PATTERNS = {
    "dropped": rf"{WORD}|[^ \t\n\r]+",
    "kept": rf" ?{WORD}| ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+",
}
OTHER_SPACES = "".join(map(chr, [0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Words that a worker encodes both ways.
COMPARED = 200

_ENCODERS: dict = {}


class Encoder:
    """Ids of texts as little-endian bytes, `width` bytes an id."""

    def __init__(self, path: str, spaces: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.pieces = re.compile(PATTERNS[spaces]).findall
        # Texts that hold one of these are encoded whole; looking for single strings is faster than one pattern.
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = [*special, *(OTHER_SPACES if spaces == "kept" else "")]
        self.plain = re.compile(f"[{LETTERS}]+").fullmatch
        self.word = re.compile(WORD).match
        # The characters that stand for the bytes of a letter, by the library's own mapping.
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {code: shown(chr(code))[0][0] for code in [32, *range(0xC0, 0x100)]}
        self.direct, self.compared = True, 0
        self.lower = spaces == "dropped"
        self.lead = "" if spaces == "dropped" else " "
        self.end = np.array([end_id], self.dtype).tobytes()
        self.parts: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _lowered(self, text: str) -> str:
        """The tokenizer lower-cases; doing so first makes pieces meet. Beyond Latin-1 languages differ in how."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def _split(self, text: str) -> tuple[str, str | None]:
        """The text up to the first chunk, and chunks between single spaces, which are encoded alike wherever they
        stand; None if there are none or there is no telling."""
        if self.lower:
            return "", self._lowered(text).replace("\n", " ").replace("\t", " ").replace("\r", " ")
        if "  " in text or "\n \n" in text or "\t" in text or "\r" in text:
            return text, None
        # Nothing stands before the first word, not even a space.
        first, space, rest = text.partition(" ")
        return first, rest if space else None

    def _library(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, by one call of the whole tokenizer."""
        import numpy as np

        encoded = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(pieces))
        raw = np.array(encoded.ids, self.dtype).tobytes()
        ends = (np.cumsum(counts) * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _modelled(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of words of plain letters behind `lead`, nothing or a space, by the tokenizer's model."""
        tokenize, shown, lower, kind = self.tokenizer.model.tokenize, self.shown, self.lower, self.dtype.char
        lead = lead and shown[32]
        made = []
        for word in words:
            if lower:
                word = word.lower()
            if not word.isascii():
                word = word.translate(shown)
            made.append(array(kind, [token.id for token in tokenize(lead + word)]).tobytes())
        return made

    def _is_word(self, chunk: str) -> bool:
        return chunk.isalpha() and (chunk.isascii() or self.plain(chunk) is not None)

    def _learn_words(self, words: list[str]) -> None:
        """Ids of chunks that are words."""
        if self.direct and self.compared < COMPARED:
            few = words[:COMPARED]
            self.direct = self._modelled(few, self.lead) == self._library([self.lead + word for word in few])
            self.compared += len(few)
        made = self._modelled(words, self.lead) if self.direct else self._library([self.lead + word for word in words])
        self.chunks.update(zip(words, made))

    def _learn_parts(self, pieces: set[str]) -> None:
        """Ids of pieces of other chunks and texts; after a line end a word has no space before it."""
        words = [p for p in pieces if self._is_word(p)] if self.direct and self.compared else []
        if words:
            self.parts.update(zip(words, self._modelled(words, "")))
        if others := list(pieces.difference(words)):
            self.parts.update(zip(others, self._library(others)))

    def _learn(self, chunks: list[str], pieces: list[list[str]]) -> None:
        """Ids of new chunks, and of the pieces of other texts."""
        known, parts, word = self.chunks, self.parts, self.word
        words, cut = set(), {}
        others, stems, rests = [], [], []
        for chunk in chunks:
            if self._is_word(chunk):
                words.add(chunk)
                continue
            if found := word(chunk):
                # A word and what is behind it are pieces of their own.
                stem = found[0]
                rest = chunk[len(stem) :]
                if stem not in known:
                    words.add(stem)
            else:
                stem, rest = "", self.lead + chunk
            others.append(chunk)
            stems.append(stem)
            rests.append(rest)
            if rest not in parts and rest not in cut:
                cut[rest] = self.pieces(rest)
        if words:
            self._learn_words(list(words))
        if new := set().union(*cut.values(), *pieces).difference(parts):
            self._learn_parts(new)
        made = {rest: b"".join([parts[p] for p in own]) for rest, own in cut.items()}
        for chunk, stem, rest in zip(others, stems, rests):
            behind = made[rest] if rest in made else parts[rest]
            known[chunk] = known[stem] + behind if stem else behind

    def _joined(self, texts: list[str], pieces: list[list[str]]) -> list[bytes]:
        """Ids of texts of chunks; those of the pieces of other texts are learned with them."""
        import pyarrow as pa
        import pyarrow.compute as pc

        parted = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = parted.flatten().dictionary_encode()
        # Through numpy, which makes the strings several times faster than `to_pylist`.
        chunks, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.chunks
        found = list(map(known.get, chunks))
        self._learn([chunk for chunk, ids in zip(chunks, found) if ids is None], pieces)
        made = [known[chunk] if ids is None else ids for chunk, ids in zip(chunks, found)]
        ids = pa.array(made, pa.large_binary()).take(coded.indices)
        return pc.binary_join(pa.ListArray.from_arrays(parted.offsets, ids), pa.scalar(b"", pa.large_binary())).to_pylist()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id after them; NULL counts as empty."""
        import numpy as np

        for table in (self.parts, self.chunks):
            if len(table) > KEPT_PIECES:
                # Common ones came first; what came late is rare and makes room.
                kept = dict(itertools.islice(table.items(), KEPT_PIECES // 2))
                table.clear()
                table.update(kept)
        made = [b""] * len(texts)
        split: dict[int, str] = {}
        first: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if text is None or text == "":
                continue
            if any(sign in text for sign in self.odd):
                made[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
                continue
            start, rest = self._split(text)
            first[i] = self.pieces(start)
            if rest is not None:
                split[i] = rest
        joined = dict(zip(split, self._joined(list(split.values()), list(first.values()))))
        part = self.parts.__getitem__
        for i, own in first.items():
            made[i] = b"".join(map(part, own)) + joined.get(i, b"")
        return [ids + self.end for ids in made]


def encoder(path: str, spaces: str, end_id: int) -> Encoder:
    """The worker's encoder of this tokenizer file."""
    key = (path, spaces, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def slices(batch) -> Iterator:
    """Parts of a (key, text) record batch that are encoded at once."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BYTES_AT_ONCE, "right"))
        to = max(at + 1, min(at + TEXTS_AT_ONCE, full))
        yield batch.slice(at, to - at)
        at = to


def encoded_batches(batches, path: str, spaces: str, end_id: int) -> Iterator[tuple[list, list[bytes], Encoder]]:
    """Keys and ids of the (key, text) record batches of one task, some texts at a time."""
    own = encoder(path, spaces, end_id)
    for batch in batches:
        for part in slices(batch):
            yield part.column(0).to_pylist(), own.encode(part.column(1).to_pylist()), own


def narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
