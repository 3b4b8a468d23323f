"""SentencePiece encoding and decoding for merge-type (BPE) models, in time linear in the text.

Merging pairs by score gives every text one sequence of tokens, and every prefix of that sequence is
the sequence of the text it covers. So it is enough to know the *last* token of every prefix: an
automaton over the vocabulary finds the tokens that end at a position, and the one that belongs there
is the one that may follow the last token of the prefix before it. Two tokens may follow each other if
merging their joint text gives just the two. The ids are read off backwards from the end of the text.

Whether a pair may stand together is found by taking both tokens apart along the edge where they meet:
in every state the two symbols at the edge pass through at the same time, a token made of both must not
come before the merge that used one of them up. That needs tokens whose own merges come in order of
their scores; for others (runs of spaces share one score) the joint text is merged outright. Answers
are remembered.

The model's own normaliser prepares a text. Texts are cut where no token of the vocabulary reaches
across: in front of space marks, behind letters and around characters that it does not hold, as far as
the vocabulary allows it. Parts met again are looked up.

Defined results: a null or empty text has only the begin and end ids; characters that are not in the
vocabulary become byte tokens, or the unknown id if the model has none; decoding a null gives null, and
bytes that are no UTF-8 give replacement characters. Repeated rows are encoded row by row, empty tables
give no rows, and columns are replaced only by name. A text of any length is encoded whole; memory is
in proportion to the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, functions as F, types as T

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED = 1 << 17  # a worker keeps up to twice as many parts, and eight times as many pairs
LONGEST_REMEMBERED = 64
GROUP = 1 << 22

_ABSENT = float("inf")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCoder:
    """Encodes and decodes whole texts with a merge-type model file."""

    def __init__(self, path: str):
        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        size = range(sp.get_piece_size())
        self.bytes_of: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        for i in size:
            if sp.is_byte(i):
                self.bytes_of[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.id_of[sp.id_to_piece(i)] = i
        # the lower, the earlier; characters are there from the start
        self.rank_of = {p: -sp.get_score(i) for p, i in self.id_of.items()}
        self.spines: dict[str, tuple | None] = {}
        self.answers = 0
        self.factors = np.random.default_rng(1).integers(1 << 63, size=1 << 12, dtype=np.uint64) * 2 + 1
        self.known: dict[str, bytes] = {}  # ids of pieces met lately
        self.older: dict[str, bytes] = {}  # and of those met before
        self.automaton = ahocorasick.Automaton()
        self.after: dict[str, dict[str, bool]] = {}  # per token whether it may follow those asked for
        for p in self.id_of:
            if len(p) == 1 or self._merged(p) == [p]:  # others never come out of merging
                self.automaton.add_word(p, (p, len(p), self.after.setdefault(p, {})))
        self.automaton.make_automaton()
        self.kinds = self._kinds()
        self.bits = {p: np.array(i, dtype="<u4").tobytes() for p, i in self.id_of.items()}
        self.surface = self._surface(size)
        self.drops_first_space = sp.decode([self.id_of[SPACE]]) == "" if SPACE in self.id_of else False

    def _kinds(self) -> np.ndarray:
        """The kind of every code point. No token of the vocabulary reaches from anything into a space
        mark (2), from other characters (0) into a mark (1), or across a character it does not hold (3).
        """
        kinds = np.zeros(0x110000, dtype=np.uint8)
        next_to = {(a, b) for p in self.id_of for a, b in zip(p, p[1:])}
        if not any(b == SPACE != a for a, b in next_to):
            held = {c for p in self.id_of for c in p}
            marks = {c for c in held - {SPACE} if not c.isalpha()}
            while out := {b for a, b in next_to if b in marks and a not in marks and a != SPACE}:
                marks -= out
            kinds[:] = 3
            kinds[[ord(c) for c in held]] = 0
            kinds[[ord(c) for c in marks]] = 1
            kinds[ord(SPACE)] = 2
        return kinds

    def _surface(self, ids) -> list[bytes]:
        sp, byte_at = self.library, {i: b for b, i in self.bytes_of.items()}
        control = lambda i: sp.is_control(i)
        return [
            bytes([byte_at[i]]) if i in byte_at else b"" if control(i)
            else sp.decode([i]).encode() if sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE, " ").encode()
            for i in ids
        ]

    # Merging as it is defined: the best-scored neighbouring pair first, the leftmost of equal ones.

    def _merged(self, text: str) -> list[str]:
        return self._steps(text)[0]

    def _steps(self, text: str) -> tuple[list[str], list[float], list[list[str]]]:
        """The tokens of a short text, the ranks of its merges in time, and the symbols after each."""
        symbols, ranks, states = list(text), [], []
        while len(symbols) > 1:
            options = [self.rank_of.get(a + b, _ABSENT) for a, b in zip(symbols, symbols[1:])]
            best = min(options)
            if best == _ABSENT:
                break
            k = options.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            ranks.append(best)
            states.append(list(symbols))
        return symbols, ranks, states

    def _spines(self, token: str) -> tuple | None:
        """What stands at the left and at the right edge of a token while it is merged, with the rank
        that made it, the last first; None if its merges are not in strict order of rank."""
        if token not in self.spines:
            _, ranks, states = self._steps(token)
            if any(b <= a for a, b in zip(ranks, ranks[1:])):
                self.spines[token] = None
            else:
                edges = []
                for at in (0, -1):
                    seen = [(token[at], -_ABSENT)]
                    for rank, symbols in zip(ranks, states):
                        if symbols[at] != seen[-1][0]:
                            seen.append((symbols[at], rank))
                    edges.append(seen[::-1])
                self.spines[token] = tuple(edges)
        return self.spines[token]

    def _pair(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends with just these two tokens."""
        a, b = self._spines(left), self._spines(right)
        if a is None or b is None:
            return self._merged(left + right) == [left, right]
        outer, inner = a[1], b[0]  # right edge of the left token, left edge of the right one
        i = j = 0
        until_left = until_right = _ABSENT  # ranks of the merges that use the two symbols up
        while True:
            (x, made_x), (y, made_y) = outer[i], inner[j]
            rank = self.rank_of.get(x + y, _ABSENT)
            # of equal ranks the left one is merged first
            if rank < until_left and rank <= until_right and rank != _ABSENT:
                return False
            if made_x == made_y == -_ABSENT:
                return True
            if made_y >= made_x:
                j, until_right = j + 1, made_y
            else:
                i, until_left = i + 1, made_x

    def may_follow(self, left: str, right: str) -> bool:
        if self.answers >= 8 * REMEMBERED:
            self.answers = 0
            for known in self.after.values():
                known.clear()
        self.answers += 1
        fits = self.after[right][left] = self._pair(left, right)
        return fits

    def tokens(self, text: str) -> list[str]:
        """The tokens of a normalised text; a character outside the vocabulary is a token of its own."""
        last: list[str | None] = [None] * (len(text) + 1)  # the last token of the prefix of each length
        for at, (token, size, after) in self.automaton.iter(text):
            at += 1
            if last[at] is None:
                if at > size:
                    start = at - size
                    before = last[start] or text[start - 1]  # where nothing fits the character is unknown
                    fits = after.get(before)
                    if not fits and (fits is not None or not self.may_follow(before, token)):
                        continue
                last[at] = token
        out, end = [], len(text)
        while end:
            token = last[end] or text[end - 1]
            out.append(token)
            end -= len(token)
        return out[::-1]

    def _part(self, part: str) -> bytes:
        """The ids of a part of a piece that is not among those met lately."""
        found = self.older.get(part)
        if found is None:
            found = b"".join([self.bits.get(t) or self._spelled(t) for t in self.tokens(part)])
        if len(part) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[part] = found
        return found

    def _spelled(self, unknown: str) -> bytes:
        spelled = [self.bytes_of[b] for b in unknown.encode("utf-8", "replace")] if self.bytes_of else [self.unknown]
        return np.array(spelled, dtype="<u4").tobytes()

    def encode(self, texts: Iterable[str | None], ends: bool = True) -> Iterator[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit numbers, with begin and end ids if ``ends``.

        Texts are taken in groups of about ``GROUP`` characters; what a group repeats is worked out once.
        """
        held, size = [], 0
        for t in texts:
            held.append(self.library.normalize(t) if t else "")
            size += len(held[-1])
            if size >= GROUP:
                yield from self._encoded(held, ends)
                held, size = [], 0
        yield from self._encoded(held, ends)

    def _parts(self, text: str, edges: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """A text, cut at ``edges`` and where no token reaches across: the different parts, which of them
        each part is, and where each begins."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = self.kinds[code]
        now, before = kind[1:], kind[:-1]
        new = np.zeros(len(code), dtype=bool)
        new[1:] = ((now == 2) & (before != 2)) | ((now == 1) & (before == 0)) | (now == 3) | (before == 3)
        new[edges[edges < len(code)]] = True
        starts = np.flatnonzero(new)
        lengths = np.diff(starts, append=len(code))
        at = np.arange(len(code)) - np.repeat(starts, lengths)
        hashes = np.add.reduceat((code + np.uint64(1)) * self.factors[at % len(self.factors)], starts)
        which, _ = pd.factorize(hashes)
        first = np.zeros(which.max() + 1, dtype=np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        like = first[which]
        alike = (lengths == lengths[like]).all() and (code == code[np.repeat(starts[like], lengths) + at]).all()
        if not alike:  # two parts of one hash
            parts = [text[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist())]
            number = {p: k for k, p in enumerate(dict.fromkeys(parts))}
            return list(number), np.array([number[p] for p in parts]), starts
        return [text[a : a + n] for a, n in zip(starts[first].tolist(), lengths[first].tolist())], which, starts

    def _encoded(self, plain: list[str], ends: bool) -> Iterator[bytes]:
        begin, end = (np.array(i, dtype="<u4").tobytes() if ends else b"" for i in (self.begin, self.end))
        edges = np.cumsum([0, *map(len, plain)])
        ids, cuts = np.zeros(0, dtype="<u4"), edges
        if edges[-1]:
            parts, which, starts = self._parts("".join(plain), edges)
            coded = [self.known.get(p) or self._part(p) for p in parts]
            sizes = np.array([len(c) // 4 for c in coded])
            offsets, n = np.cumsum(sizes) - sizes, sizes[which]
            upto = np.cumsum(n)
            ids = np.frombuffer(b"".join(coded), dtype="<u4")[np.arange(upto[-1]) + np.repeat(offsets[which] - upto + n, n)]
            cuts = np.concatenate([[0], upto])[np.searchsorted(starts, edges)]
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = ids[a:z].tobytes()
            yield begin + (own if self.bytes_of else self._one_unknown(own)) + end

    def _one_unknown(self, ids: bytes) -> bytes:
        """Runs of unknown characters have one id in a model without byte tokens."""
        read = np.frombuffer(ids, dtype="<u4")
        again = np.zeros(len(read), dtype=bool)
        again[1:] = (read[1:] == self.unknown) & (read[:-1] == self.unknown)
        return read[~again].tobytes()

    def decode(self, ids) -> str:
        surface = self.surface
        text = b"".join(map(surface.__getitem__, ids))
        if self.drops_first_space and text.startswith(b" "):
            text = text[1:]
        return text.decode("utf-8", "replace")


_CODERS: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """One coder per worker process and file."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def encode(text: str = "text", path: str | None = None, ends: bool = True) -> Column:
    """Ids of the column ``text`` as binary: little-endian, unsigned 32 bits each.

    ``path`` is a merge-type model file that every executor can open.
    """
    path = path or model_path()

    @F.pandas_udf(T.BinaryType())
    def ids(texts: pd.Series) -> pd.Series:
        c = coder(path)
        return pd.Series(list(c.encode(texts, ends)), dtype=object)

    return ids(F.col(f"`{text}`"))


def decode(ids: Column | str, path: str | None = None) -> Column:
    """The text of a column of binary ids as ``encode`` gives them."""
    path = path or model_path()

    @F.pandas_udf(T.StringType())
    def text(rows: pd.Series) -> pd.Series:
        c = coder(path)
        return pd.Series([None if r is None else c.decode(np.frombuffer(r, dtype="<u4").tolist()) for r in rows], dtype=object)

    return text(F.col(f"`{ids}`") if isinstance(ids, str) else ids)
