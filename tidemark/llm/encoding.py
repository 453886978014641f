"""Token ids of whole texts, exactly as the tokenizers library gives them."""

from __future__ import annotations

import hashlib
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"

# A worker remembers this many pieces. A full memory takes no more, and after
# as many further new pieces it is emptied and learns afresh.
MEMORY = 500_000
RENEW = 4_000_000
LONGEST_KEPT = 48

_UNSAFE = re.compile(r" \s|\s ")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Latin letters with ASCII marks after them, twice at most with a line break
# between: the splitter cuts these exactly at the group borders.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ɏ]+"
_MARKS = r"([!-&(-/:-@\[-`{-~]{0,6})"
_PLAIN = re.compile(rf"({_LETTERS}){_MARKS}(?:(\n)({_LETTERS}){_MARKS})?")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: its version."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class Unsafe(Exception):
    """A piece that may not be encoded on its own."""


class Memory(dict):
    """Ids of pieces; a new piece is encoded when it is asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.fresh = encode, 0

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise Unsafe
        ids = self.encode(piece)
        self.fresh += 1
        if len(self) < MEMORY and len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts piece by piece and remembers the ids of frequent pieces.

    The byte-level splitter always cuts before a single blank between two
    characters that are not white space. So the ids of a text are those of its
    blank-separated pieces in order, each piece but the first with its blank.
    Special strings hold no blank, so they stay within a piece. Plain words go
    to the library's model at once, all other pieces through its whole
    encoder. Ids are held as little-endian unsigned 32-bit bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kind = type(self.tokenizer.pre_tokenizer)
        if kind is not pre_tokenizers.ByteLevel or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path}: only byte-level splitting without a normaliser can go piece by piece")
        self.tokenize = self.tokenizer.model.tokenize
        # The letters that stand for bytes, read off the library's own splitter.
        splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: splitter.pre_tokenize_str(chr(i))[0][0] for i in range(1, 0x250)}
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(True))]
        self.marks: dict[str, bytes] = {}
        self.first = Memory(lambda piece: self._piece("", piece))
        self.later = Memory(lambda piece: self._piece(" ", piece))

    def _word(self, word: str) -> bytes:
        ids = self.as_bytes
        return b"".join([ids[t.id] for t in self.tokenize(word.translate(self.letters))])

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[mark] = self._word(mark)
        return self.marks[mark]

    def _piece(self, blank: str, piece: str) -> bytes:
        match = _PLAIN.fullmatch(piece)
        if match is None:
            ids = self.as_bytes
            return b"".join([ids[i] for i in self.tokenizer.encode(blank + piece, add_special_tokens=False).ids])
        word, mark, line, next_word, next_mark = match.groups()
        found = self._word(blank + word) if not mark else self.later[word] if blank else self.first[word]
        if mark:
            found += self._mark(mark)
        if line:
            found += self._mark("\n") + self.first[next_word]
            if next_mark:
                found += self._mark(next_mark)
        return found

    def encode(self, text: str) -> bytes:
        """Ids of one text."""
        found = []
        for k, piece in enumerate(_SAFE_SPACE.split(text)):
            try:
                found.append(self.later[piece] if k else self.first[piece])
            except Unsafe:  # only the ends of a text can be so
                found.append(self._piece(" " if k else "", piece))
        return b"".join(found)

    def _forget(self) -> None:
        if self.later.fresh > RENEW:
            for memory in (self.first, self.later):
                memory.clear()
                memory.fresh = 0

    def encode_all(self, texts: pa.Array, counts_only: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Offsets of each text's ids, one more than there are texts, and all ids one after the other.

        Null counts as empty. Each distinct piece of the batch is looked up once.
        """
        self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy()
        starts = starts - starts[0]
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        table, odd = [], np.zeros(len(coded.dictionary) + len(texts), bool)
        for k, piece in enumerate(coded.dictionary.to_pylist()):
            try:
                table.append(self.later[piece])
            except Unsafe:
                odd[k] = True
                table.append(b"")
        # A first piece has no blank before it, so each text gets an entry of its own for it.
        codes = codes.copy()
        heads = pc.take(coded.dictionary, pa.array(codes[starts[:-1]])).to_pylist()
        codes[starts[:-1]] = np.arange(len(texts)) + len(coded.dictionary)
        for k, piece in enumerate(heads, len(coded.dictionary)):
            try:
                table.append(self.first[piece])
            except Unsafe:
                odd[k] = True
                table.append(b"")
        if odd.any():
            bad = np.unique(np.searchsorted(starts, np.flatnonzero(odd[codes]), "right") - 1)
            keep = np.ones(len(codes), bool)
            for k in bad:
                keep[starts[k] + 1 : starts[k + 1]] = False
                table[len(coded.dictionary) + k] = self.encode(texts[int(k)].as_py())
            left = np.concatenate([[0], np.cumsum(keep)])
            codes, starts = codes[keep], left[starts]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        lengths = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        offsets = ends[starts]
        if counts_only:
            return offsets, None
        flat = np.frombuffer(b"".join(table), "<u4")
        shift = (np.cumsum(sizes) - sizes)[codes] - ends[:-1]
        return offsets, flat[np.arange(ends[-1]) + np.repeat(shift, lengths)]


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker, kept between tasks."""
    shelf = sys.modules.setdefault("_tidemark_encoders", types.ModuleType("_tidemark_encoders")).__dict__
    if path not in shelf:
        shelf[path] = Encoder(path)
    return shelf[path]
