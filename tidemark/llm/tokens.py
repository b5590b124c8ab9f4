"""Token ids of texts with a public tokenizer, encoding each distinct word once per worker.

Both tokenizers split a text before they merge: no token crosses a space that stands between two
characters that are not white space. Texts are cut there, pieces looked up by a 128-bit hash among those met of
late, and only others encoded, many at a time. The look-up is arrays of some 50 bytes a piece and bounded in number,
and texts are encoded in slices of about ``SLICE`` characters, so a worker's memory is bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from tokenizers import Tokenizer

from tidemark.llm.common import AFTER_TASK

KEPT_PIECES = 1_200_000  # of a generation; some 50 bytes each
MERGED_PIECES = 1 << 15
IDLE_PIECES = 1_200_000  # kept between tasks
SLICE = 4 << 20  # characters encoded at a time
LONG_PIECE = 200  # characters; longer pieces are encoded but not kept
_FIRST = "\x02"  # marks the first piece of a text, which follows no space


def _runs(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` that begin and size name, one after another."""
    ends = np.cumsum(size)
    return ids[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Table:
    """Token ids by the hash of a piece, in arrays sorted by its first half."""

    def __init__(self) -> None:
        self.first = self.second = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.first)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Row of every hash, or -1."""
        if not len(self.first):
            return np.full(len(first), -1)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return np.where((self.first[at] == first) & (self.second[at] == second), at, -1)

    def add(self, first: np.ndarray, second: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        whole = np.concatenate([self.first, first])
        order = np.argsort(whole, kind="stable")
        self.first = whole[order]
        self.second = np.concatenate([self.second, second])[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, size])[order]


class Generation:
    """Up to ``KEPT_PIECES`` pieces: a table, a small one that takes new pieces and is merged into it, the ids."""

    def __init__(self) -> None:
        self.table, self.latest = Table(), Table()
        self.ids = np.zeros(0, "<u4")
        self.used = 0

    def __len__(self) -> int:
        return len(self.table) + len(self.latest)

    def find(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids of every hash; -1 where it is not known."""
        begin, size = np.full(len(first), -1, np.int64), np.zeros(len(first), np.int64)
        for table in (self.table, self.latest):
            row = table.find(first, second)
            here = np.flatnonzero(row >= 0)
            begin[here], size[here] = table.begin[row[here]], table.size[row[here]]
        return begin, size

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(ids), self.used // 2), "<u4")])
        self.ids[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += len(ids)
        self.latest.add(first, second, begin, size.astype(np.int32))
        if len(self.latest) > max(MERGED_PIECES, len(self.table) // 8):
            self.table.add(self.latest.first, self.latest.second, self.latest.begin, self.latest.size)
            self.latest = Table()


    def first_learnt(self, most: int) -> Generation:
        """The pieces that came first, which are the frequent ones."""
        few = Generation()
        columns = [np.concatenate([getattr(t, n) for t in (self.table, self.latest)]) for n in ("first", "second", "begin", "size")]
        first, second, begin, size = (c[np.argsort(columns[2])[:most]] for c in columns)
        few.add(first, second, _runs(self.ids, begin, size.astype(np.int64)), size.astype(np.int64))
        return few


class Pieces:
    """Pieces met of late: when a generation is full it becomes the old one, and the one before it goes."""

    def __init__(self) -> None:
        self.young, self.old = Generation(), Generation()

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def shrink(self) -> None:
        """Keep a moderate number until the next task."""
        if len(self) > IDLE_PIECES:
            self.young, self.old = (self.old if len(self.old) else self.young).first_learnt(IDLE_PIECES // 2), Generation()

    def ids(self, first: np.ndarray, second: np.ndarray, learn: Callable[[np.ndarray], tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and how many each has.

        ``learn`` gives the ids of the pieces of some places, their sizes, and which of them are to be kept.
        """
        known = [(g.ids, *g.find(first, second)) for g in (self.young, self.old)]
        unseen = np.flatnonzero((known[0][1] < 0) & (known[1][1] < 0))
        if len(unseen):
            ids, sizes, kept = learn(unseen)
            begin, size = np.full(len(first), -1, np.int64), np.zeros(len(first), np.int64)
            begin[unseen], size[unseen] = np.cumsum(sizes) - sizes, sizes
            known.append((ids, begin, size))
            keep = unseen[kept]
            self.young.add(first[keep], second[keep], _runs(ids, begin[keep], size[keep]), size[keep])
        source = np.select([begin >= 0 for _, begin, _ in known], range(len(known)))
        total = np.choose(source, [size for _, _, size in known])
        starts = np.cumsum(total) - total
        out = np.empty(int(total.sum()), "<u4")
        for k, (ids, begin, size) in enumerate(known):
            mine = np.flatnonzero(source == k)
            places = np.repeat(starts[mine] - (np.cumsum(size[mine]) - size[mine]), size[mine])
            out[places + np.arange(len(places))] = _runs(ids, begin[mine], size[mine])
        if len(self.young) > KEPT_PIECES:
            self.young, self.old = Generation(), self.young
        return out, total


def _hashes(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(p.encode("utf-8", "surrogatepass")) for p in pieces]), np.uint64)
    return both[::2], both[1::2]


class WordEncoder:
    """``encode`` gives the ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.pieces = Pieces()
        # a piece keeps the space before it if that decides its tokens
        self.spaced = self._ids("a b") != self._ids("a") + self._ids("b")
        last = "</w>"  # as both files write it
        vocabulary = self.tokenizer.get_vocab()
        self.line_end = self._ids("a\nb")[1] if self.spaced else None
        space = self.tokenizer.id_to_token(self._ids(" ")[0]) if self.spaced else None
        size = max(vocabulary.values()) + 1
        # tokens that begin with a space, and tokens that end a word
        self.starts, self.ends = np.zeros(size, bool), np.zeros(size, bool)
        for token, number in vocabulary.items():
            self.starts[number] = self.spaced and token.startswith(space)
            self.ends[number] = not self.spaced and token.endswith(last)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        """Whether every space and line end of the text cuts: each stands between characters that are no white space."""
        return (
            text.replace("\n", "").isprintable()  # then spaces and line ends are the only white space
            and "  " not in text and "\n\n" not in text and " \n" not in text and "\n " not in text
            and text[0] not in " \n" and text[-1] not in " \n"
        )

    def _cut(self, text: str) -> list[str]:
        """Pieces of any text that joined by spaces give the text; each but the first follows a space that cuts."""
        out: list[str] = []
        pending: list[str] = []
        for piece in text.split(" "):
            # a space next to white space or an end of the text does not cut
            if pending and (not piece or not pending[-1] or piece[0].isspace() or pending[-1][-1].isspace()):
                pending.append(piece)
            else:
                if pending:
                    out.append(" ".join(pending))
                pending = [piece]
        out.append(" ".join(pending))
        out[0] = _FIRST + out[0]
        return out

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of unseen pieces, many in one text where the tokens show where each begins or ends."""
        out: list[bytes] = [b""] * len(pieces)
        kinds: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            kinds.setdefault(self._kind(p), []).append(k)
        odd = kinds.pop(0, [])
        for kind, same in kinds.items():
            for start in range(0, len(same), 2000):
                some = same[start : start + 2000]
                leads = [self._lead(pieces[k]) for k in some]
                ids = np.frombuffer(self._bytes([("" if self.spaced else " ").join(leads)])[0], "<u4")
                if self.spaced:
                    at = np.flatnonzero(self.starts[ids] if kind == 1 else ids == self.line_end)
                else:
                    at = np.concatenate([[0], np.flatnonzero(self.ends[ids])[kind - 1 :: kind] + 1])[:-1]
                if len(at) != len(some):  # a character that the tokenizer reads differently
                    odd += some
                    continue
                packed, cuts = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                for k, (a, b) in zip(some, pairwise(cuts), strict=True):
                    out[k] = packed[a:b]
        for k, ids in zip(odd, self._bytes([self._lead(pieces[k]) for k in odd]), strict=True):
            out[k] = ids
        return out

    def _kind(self, piece: str) -> int:
        """With spaces kept: 1 begins with its space, 2 with a line end. Without: the number of words. 0: neither."""
        if " " in piece or piece[:1] == _FIRST:
            return 0
        if self.spaced:
            if piece.isprintable():
                return int(piece != "")
            return 2 if piece[0] == "\n" and len(piece) > 1 and piece[1:].isprintable() else 0
        if piece[:1] == "\n":
            piece = piece[1:]
        if piece.isalpha():
            return int(piece.isascii() or piece.lower().isalpha())
        return 2 if piece[-1:] in (",", ".") and piece[:-1].isalpha() and (piece.isascii() or piece[:-1].lower().isalpha()) else 0

    def _lead(self, piece: str) -> str:
        """The piece as it stands in its text, with the space before it if there is one."""
        if piece[:1] == _FIRST:
            return piece[1:]
        return f" {piece}" if self.spaced and piece[:1] != "\n" else piece

    def _looked_up(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and how many each has."""

        def learn(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            pieces = [distinct[k] for k in places.tolist()]
            found = self._learn(pieces)
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            kept = [k for k, p in enumerate(pieces) if len(p) <= LONG_PIECE and p[:1] != _FIRST]
            return np.frombuffer(b"".join(found), "<u4"), sizes, np.array(kept, np.int64)

        return self.pieces.ids(*_hashes(distinct), learn)

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Texts that every space and line end cuts; each distinct piece of them is handled once."""
        cut = pc.split_pattern(pa.array([_FIRST + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        ids, sizes = self._looked_up(coded.dictionary.to_pylist())
        count = sizes[which]
        ends = np.cumsum(count)
        ids = _runs(ids, (np.cumsum(sizes) - sizes)[which], count).tobytes()
        cuts = [0, *(4 * ends[cut.offsets.to_numpy()[1:] - 1]).tolist()]
        return [ids[a:b] for a, b in pairwise(cuts)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of all texts, some at a time; a text longer than a slice is one by itself."""
        out: list[bytes] = []
        start = size = 0
        for k, text in enumerate(texts):
            more = len(text or "")
            if size and size + more > SLICE:
                out += self._encode(texts[start:k])
                start, size = k, 0
            size += more
        return out + self._encode(texts[start:])

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        plain = [k for k, t in enumerate(texts) if t and self._plain(t)]
        out = [b""] * len(texts)
        for k, ids in zip(plain, self._encode_plain([texts[k] for k in plain]) if plain else [], strict=True):
            out[k] = ids
        rest = [k for k in set(range(len(texts))).difference(plain) if texts[k]]
        marked = [k for k in rest if _FIRST in texts[k]]
        for k, ids in zip(marked, self._bytes([texts[k] for k in marked]), strict=True):
            out[k] = ids
        rest = [k for k in rest if _FIRST not in texts[k]]
        cut = [self._cut(texts[k]) for k in rest]
        distinct = list(set(chain.from_iterable(cut)))
        ids, sizes = self._looked_up(distinct)
        ids, cuts = ids.tobytes(), [0, *(4 * np.cumsum(sizes)).tolist()]
        found = {p: ids[a:b] for p, (a, b) in zip(distinct, pairwise(cuts), strict=True)}
        for k, pieces in zip(rest, cut, strict=True):
            out[k] = b"".join(map(found.__getitem__, pieces))
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    """The worker's encoder for a file of the public tokenizers, or for a path."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(name if "/" in name else public_tokenizers.path(name))
    return _encoders[name]


def _shrink() -> None:
    for known in _encoders.values():
        known.pieces.shrink()


AFTER_TASK.append(_shrink)
