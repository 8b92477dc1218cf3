"""Token ids by a public tokenizer, for use inside tasks, in bounded memory."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A blank before another white space character may belong to the same piece of the
# tokenizer's pattern; any other blank always starts a new piece.
_BLANK_RUN = re.compile(r" \s| $")
#: Parts after which an encoder starts its memo anew and keeps the one before for look-ups.
PARTS_KEPT = 500_000
#: Parts the tokenizer gets in one string, short so that its tables of positions stay in the caches.
PARTS_AT_ONCE = 200
_encoders: dict[tuple[str, int], Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Memo:
    """Distinct parts by their row, and the ids of all rows one after another."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ids = np.zeros(0, dtype="<u4")
        self.lengths = np.zeros(0, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.rows)

    def find(self, parts: list[str]) -> np.ndarray:
        """The row of each part, -1 if it is not here."""
        return np.fromiter(map(self.rows.get, parts, repeat(-1)), dtype=np.int64, count=len(parts))

    def add(self, parts: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The rows that new parts take."""
        self.rows.update(zip(parts, range(len(self.rows), len(self.rows) + len(parts)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.lengths = np.concatenate([self.lengths, lengths])
        return np.arange(len(self.lengths) - len(parts), len(self.lengths))


def gathered(ids: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs that stand one after another in `ids`, those of the rows, and how long each is."""
    begins = np.cumsum(lengths) - lengths
    taken = lengths[rows]
    ends = np.cumsum(taken)
    places = np.repeat(begins[rows] - ends + taken, taken)
    places += np.arange(len(places))
    return ids[places], taken


class Encoder:
    """Ids of whole texts as the tokenizers library gives them; no special token is added.

    Byte-level BPE encodes each piece of its split pattern alone, and every blank that
    stands alone starts a piece. So a text is cut at its blanks and each distinct part is
    encoded once and remembered; parts not seen for a while are forgotten. Texts with runs of white space go to the tokenizer whole, and
    so do texts that hold an added token, such as an end marker, since that is matched first.
    """

    def __init__(self, path: str, parts_kept: int = PARTS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values() if token.content]
        self._tokenizer.model._resize_cache(0)  # the memo below stands in for it
        self.size = size = self._tokenizer.get_vocab_size()
        blank = self._tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        tokens = (self._tokenizer.id_to_token(i) or "" for i in range(size))
        self._starts = np.fromiter((t.startswith(blank) for t in tokens), dtype=bool, count=size)
        self._parts_kept = parts_kept
        self._memo, self._older = _Memo(), _Memo()

    def _whole(self, text: str) -> np.ndarray:
        encoded = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype="<u4")

    def _learned(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts with a blank before each, one after another, and how many each has."""
        found, lengths = [], []
        for begin in range(0, len(parts), PARTS_AT_ONCE):
            some = parts[begin : begin + PARTS_AT_ONCE]
            text = " " + " ".join(some)
            if not any(token in text for token in self._added):
                ids = self._whole(text)
                cuts = np.flatnonzero(self._starts[ids])
                if len(cuts) == len(some):
                    found.append(ids)
                    lengths.append(np.diff(cuts, append=len(ids)))
                    continue
            # Parts of different texts would make up an added token, or can't be told apart.
            alone = [self._whole(" " + part) for part in some]
            found += alone
            lengths.append([len(ids) for ids in alone])
        return np.concatenate(found), np.concatenate(lengths)

    def _rows(self, parts: list[str]) -> np.ndarray:
        """The rows of distinct parts in the memo, which gets those that it lacks from the one
        before or from the tokenizer."""
        memo, older = self._memo, self._older
        rows = memo.find(parts)
        missing = np.flatnonzero(rows < 0)
        absent = [parts[i] for i in missing.tolist()]
        old = older.find(absent)
        known, new = np.flatnonzero(old >= 0), np.flatnonzero(old < 0)
        if len(known):
            rows[missing[known]] = memo.add([absent[i] for i in known.tolist()], *gathered(older.ids, older.lengths, old[known]))
        if len(new):
            learned = [absent[i] for i in new.tolist()]
            rows[missing[new]] = memo.add(learned, *self._learned(learned))
        return rows

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        if len(self._memo) > self._parts_kept:
            self._older, self._memo = self._memo, _Memo()
        cut, heads, whole = [], [], {}
        for i, text in enumerate(texts):
            if _BLANK_RUN.search(text) or any(token in text for token in self._added):
                whole[i] = self._whole(text)
                text = ""
            head, _, rest = text.partition(" ")
            heads.append(head)
            cut.append(rest if len(head) < len(text) else None)
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        counts = pc.list_value_length(lists).fill_null(0).to_numpy()
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # at once, unlike to_pylist
        rows = self._rows(distinct)[coded.indices.to_numpy()]
        ids, lengths = gathered(self._memo.ids, self._memo.lengths, rows)
        encoded = self._tokenizer.encode_batch_fast(heads, add_special_tokens=False)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)].tolist()
        out, begin = [], 0
        for i, end in enumerate(ends):
            first = whole[i] if i in whole else np.array(encoded[i].ids, dtype="<u4")
            out.append(first.tobytes() + ids[begin:end].tobytes())
            begin = end
        return out


def encoder(path: str, parts_kept: int = PARTS_KEPT) -> Encoder:
    """The process's encoder; Spark keeps Python workers, and so its memo, across tasks."""
    if (path, parts_kept) not in _encoders:
        _encoders[path, parts_kept] = Encoder(path, parts_kept)
    return _encoders[path, parts_kept]


def forget() -> None:
    """Give back the memory that encoders of an earlier step hold in this process.

    Spark keeps Python workers for the next steps of a session, which need their own memory.
    """
    if _encoders:
        _encoders.clear()
        pa.default_memory_pool().release_unused()


def chunks(texts: pa.Array, most_chars: int = 300_000) -> Iterator[list[str]]:
    """The texts in order, null as empty, in lists of about so many characters.

    Only a few hundred texts at a time are turned into Python strings.
    """
    out: list[str] = []
    size = 0
    for begin in range(0, len(texts), 256):
        for text in texts.slice(begin, 256).to_pylist():
            out.append(text or "")
            size += len(out[-1])
            if size >= most_chars:
                yield out
                out, size = [], 0
    if out:
        yield out
