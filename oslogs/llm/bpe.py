"""Byte-level BPE, shared by the token operators: the vocabulary, and pre-tokens of many texts at once.

Texts are taken as one array of code points per slice of about a million. The pre-token pattern of the vocabulary
(contractions, then runs of letters, numbers, other signs and white space, with one blank before a run) becomes a few
comparisons of neighbouring character classes, and equal pre-tokens are found by a position-free polynomial hash and then
compared letter by letter, so that each different pre-token is encoded once per slice and a collision can't pass.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
SLICE = 1_000_000  # code points that are worked on at a time
CACHE = 300_000  # pre-tokens that a worker remembers between slices; beyond that it starts again from the vocabulary

# Fixed values of the format: white space of Unicode, contractions.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_MULTIPLIER = 0x9E3779B97F4A7C15


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens as bytes, merges by rank, and the added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        of = {c: b for b, c in enumerate(byte_letters())}
        self.bytes: dict[int, bytes] = {i: bytes(of[c] for c in t) for t, i in model["vocab"].items() if all(c in of for c in t)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        ids = model["vocab"]
        self.base = np.array([ids[c] for c in byte_letters()], np.int64)
        self.size = max(self.bytes) + 1
        #: left and right token and the token they make, by rank
        self.merges: list[tuple[int, int, int]] = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.append((ids[left], ids[right], ids[left + right]))
        #: rank of a pair, by left * size + right
        self.ranks = {a * self.size + b: r for r, (a, b, _) in enumerate(self.merges)}

    def splitter(self) -> re.Pattern | None:
        return re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank first, leftmost first."""
        base, ranks, size, merges = self.base, self.ranks, self.size, self.merges
        ids = [int(base[b]) for b in word]
        while len(ids) > 1:
            found = [ranks.get(a * size + b, 1 << 30) for a, b in zip(ids, ids[1:])]
            best = min(found)
            if best == 1 << 30:
                break
            a, b, made = merges[best]
            out, i, n = [], 0, len(ids)
            while i < n:
                if i + 1 < n and ids[i] == a and ids[i + 1] == b:
                    out.append(made)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids


class Rounds:
    """Ids of many pre-tokens at once, for Encoder: every round makes the next merge of every word."""

    NONE = 1 << 40

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.made = np.array([m for _, _, m in vocabulary.merges], np.int64)
        keys = np.fromiter(vocabulary.ranks, np.int64, len(vocabulary.ranks))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank_of = np.fromiter(vocabulary.ranks.values(), np.int64, len(keys))[order]
        self.first = self._search((vocabulary.base[:, None] * vocabulary.size + vocabulary.base).ravel())

    def _search(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], self.NONE)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where((left < 0) | (right < 0), self.NONE, self._search(left * self.vocabulary.size + right))

    def flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each word has."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length)
        # a wall (-1) stands before every word, so that no pair crosses it
        symbols = np.full(len(raw) + len(words), -1, np.int64)
        place = np.arange(len(raw)) + np.repeat(np.arange(1, len(words) + 1), length)
        symbols[place] = self.vocabulary.base[raw]
        rank = np.full(len(symbols), self.NONE)
        rank[place[:-1]] = self.first[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        rank[place[ends - 1]] = self.NONE
        number = np.arange(len(words))
        over: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(number):
            walls = np.flatnonzero(symbols == -1)
            size = np.diff(walls, append=len(symbols))
            least = np.minimum.reduceat(rank, walls)
            open_ = least < self.NONE
            if not open_.all():
                mine = np.repeat(open_, size)
                rest = symbols[~mine]
                over.append((number[~open_], size[~open_] - 1, rest[rest >= 0]))
                symbols, rank, number, size, least = symbols[mine], rank[mine], number[open_], size[open_], least[open_]
                if not len(number):
                    break
            here = np.flatnonzero(rank == np.repeat(least, size))
            first = np.diff(here, prepend=-2) > 1  # of equal pairs that overlap, every second one
            turn = np.arange(len(here)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            here = here[turn % 2 == 0]
            symbols[here] = self.made[rank[here]]
            kept = np.ones(len(symbols), bool)
            kept[here + 1] = False
            here -= np.arange(len(here))
            symbols, rank = symbols[kept], rank[kept]
            right = np.append(symbols[1:], -1)
            rank[here] = self._ranks(symbols[here], right[here])
            rank[here - 1] = self._ranks(symbols[here - 1], symbols[here])
        order = np.concatenate([n for n, _, _ in over])
        sizes = np.concatenate([n for _, n, _ in over])
        begin = np.cumsum(sizes) - sizes
        back = np.argsort(order)
        return np.concatenate([x for _, _, x in over])[ragged(begin[back], sizes[back])], sizes[back]


_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _CLASSES:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
        table[WHITE] = SPACE
        _CLASSES.append(table)
    return _CLASSES[0]


def starts(chars: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point; firsts: where each piece of text (never empty) begins."""
    n = len(chars)
    kind = classes()[chars]
    new = np.zeros(n + 1, bool)
    new[firsts] = True
    edge = new.copy()  # pieces don't see each other
    edge[n] = True
    new[1:n] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~edge[1:n])  # ends of white space before something else
    new[last] = True
    new[last[chars[last] == 32] + 1] = False
    quote = np.flatnonzero(chars == 39)
    if len(quote):
        quote = quote[new[quote] & ~edge[quote + 1]]
        quote = quote[kind[quote + 1] == LETTER]
        padded = np.concatenate([chars, np.zeros(2, chars.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        whole = ~edge[np.minimum(quote + 2, n)]
        length = np.zeros(len(quote), np.int64)
        for text in CONTRACTIONS:
            hit = (one == ord(text[0])) if len(text) == 1 else (one == ord(text[0])) & (two == ord(text[1])) & whole
            length[hit] = len(text) + 1
        quote, length = quote[length > 0], length[length > 0]
        new[quote + 1] = False
        new[quote[length == 3] + 2] = False
        new[quote + length] = True
    return np.flatnonzero(new[:n])


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int):
        if len(self.up) < n:
            inverse = pow(_MULTIPLIER, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _MULTIPLIER, np.uint64))])
                self.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, inverse, np.uint64))])
        return self.up[:n], self.down


_POWERS = _Powers()


def hashes(chars: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span that depends on its letters alone."""
    up, down = _POWERS.to(len(chars) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[: len(chars)], out=total[1:])
        return (total[end] - total[begin]) * down[begin]


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of all elements of spans, span after span."""
    ends = np.cumsum(length)
    return np.repeat(begin - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Parts of a long text, cut before a single blank between two words, where no pre-token runs on."""
    begin = 0
    while len(text) - begin > size:
        cut = re.compile(r"(?<=\w) (?=\w)").search(text, begin + size)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


class Encoder:
    """Ids of texts. rest.flat(words) gives the ids of pre-tokens, as bytes, that are no single known token.

    Without ``shortcut`` only added tokens are known, and every pre-token goes to ``rest``, each different one once.
    """

    def __init__(self, vocabulary: Vocabulary, rest, shortcut: bool = True):
        self.vocabulary, self.rest = vocabulary, rest
        self.special = vocabulary.splitter()
        whole = whole_tokens(vocabulary) if shortcut else list(vocabulary.added.items())
        whole = whole or [("", 0)]  # equal to no pre-token
        self.letters = np.frombuffer("".join(t for t, _ in whole).encode("utf-32-le"), np.uint32)
        length = np.array([len(t) for t, _ in whole], np.int64)
        ends = np.cumsum(length)
        keys = hashes(self.letters, ends - length, ends)
        order = np.argsort(keys)
        self.known, self.known_at, self.known_length = keys[order], (ends - length)[order], length[order]
        self.known_id = np.array([i for _, i in whole], np.int64)[order]
        self.clear()

    def clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used, self.first, self.size = 0, np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _learn(self, words: list[str]) -> np.ndarray:
        """Entries of these pre-tokens, which the vocabulary does not hold whole."""
        if len(self.seen) + len(words) > CACHE:
            self.clear()
        new = [w for w in words if w not in self.seen]
        if new:
            ids, sizes = self.rest.flat([w.encode() for w in new])
            at = len(self.seen)
            while at + len(new) > len(self.first):
                self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
            total = int(sizes.sum())
            while self.used + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used : self.used + total] = ids
            self.first[at : at + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.size[at : at + len(new)] = sizes
            self.used += total
            self.seen.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))

    def _pieces(self, pieces: list[str], only_counts: bool = False) -> tuple[np.ndarray | None, np.ndarray]:
        """Ids of all pieces (none empty, specials as they are) in order, and how many each has."""
        joined = "".join(pieces)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        firsts = np.cumsum(length) - length
        begin = starts(chars, firsts)
        special = np.fromiter((p in self.vocabulary.added for p in pieces), bool, len(pieces))
        if special.any():
            inside = np.searchsorted(firsts, begin, "right") - 1
            begin = begin[~special[inside] | (begin == firsts[inside])]
        end = np.append(begin[1:], len(chars))
        keys, at, which = np.unique(hashes(chars, begin, end), return_index=True, return_inverse=True)
        n_of = end - begin
        place = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        first_begin, first_n = begin[at], n_of[at]
        whole = (self.known[place] == keys) & (self.known_length[place] == first_n)
        idx = np.flatnonzero(whole)
        same = self.letters[ragged(self.known_at[place[idx]], first_n[idx])] == chars[ragged(first_begin[idx], first_n[idx])]
        if not same.all():
            whole[idx[np.unique(np.repeat(np.arange(len(idx)), first_n[idx])[~same])]] = False
        same = chars[ragged(first_begin[which], n_of)] == chars if (n_of == first_n[which]).all() else np.zeros(1, bool)
        if not same.all():  # two pre-tokens share a hash: tell them apart by their letters
            words = [joined[b:e] for b, e in zip(begin, end)]
            number: dict[str, int] = {}
            which = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
            rest = list(number)
            whole, ids = np.zeros(len(rest), bool), np.zeros(len(rest), np.int64)
        else:
            ids = self.known_id[place]
            rest = [joined[b : b + n] for b, n in zip(first_begin[~whole].tolist(), first_n[~whole].tolist())]
        entry = self._learn(rest)
        sizes, where = np.ones(len(ids), np.int64), np.zeros(len(ids), np.int64)
        sizes[~whole], where[~whole] = self.size[entry], self.first[entry]
        token_sizes = sizes[which]
        ends = np.append(np.searchsorted(begin, firsts[1:]), len(begin))
        counts = np.diff(np.concatenate([[0], np.cumsum(token_sizes)])[ends], prepend=0)
        if only_counts:
            return None, counts
        pool = np.concatenate([self.pool[: self.used], ids.astype(np.int32)])
        where[whole] = self.used + np.flatnonzero(whole)
        return pool[ragged(where[which], token_sizes)], counts

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order (null: none)."""
        for parts in self._texts(texts, False):
            yield parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def counts(self, texts: list[str | None]) -> Iterator[int]:
        """How many ids each text has, in order."""
        return (int(sum(parts)) for parts in self._texts(texts, True))

    def _texts(self, texts: list[str | None], only_counts: bool) -> Iterator[list]:
        pieces: list[str] = []
        owners: list[int] = []
        done, held, waiting = 0, 0, {}

        def flush() -> None:
            nonlocal held
            if pieces:
                ids, sizes = self._pieces(pieces, only_counts)
                for owner, part in zip(owners, sizes if only_counts else np.split(ids, np.cumsum(sizes)[:-1])):
                    waiting.setdefault(owner, []).append(part)
            pieces.clear()
            owners.clear()
            held = 0

        def ready(upto: int) -> Iterator[list]:
            nonlocal done
            while done < upto:
                yield waiting.pop(done, [])
                done += 1

        for i, text in enumerate(texts):
            if held + len(text or "") > SLICE:
                flush()
                yield from ready(i)
            for part in self.special.split(text) if text and self.special and any(s in text for s in self.vocabulary.added) else [text or ""]:
                for piece in slices(part) if part not in self.vocabulary.added else [part]:
                    if piece:
                        pieces.append(piece)
                        owners.append(i)
                        held += len(piece)
                    if held > SLICE:
                        flush()
        flush()
        yield from ready(len(texts))


def whole_tokens(vocabulary: Vocabulary) -> list[tuple[str, int]]:
    """The vocabulary's strings that stand for themselves: one pre-token, which the merges turn into this very token.

    Proved once per vocabulary, without any corpus: the string must be valid text, the pre-token pattern must not cut
    it, and merging its bytes must end in one id. Added tokens stand for themselves as well.
    """
    out = [(t, i) for t, i in vocabulary.added.items()]
    candidates = []
    for i, raw in vocabulary.bytes.items():
        if i in vocabulary.added.values():
            continue
        try:
            candidates.append((raw.decode(), i, raw))
        except UnicodeDecodeError:
            continue
    chars = np.frombuffer("".join(t for t, _, _ in candidates).encode("utf-32-le"), np.uint32)
    length = np.array([len(t) for t, _, _ in candidates], np.int64)
    firsts = np.cumsum(length) - length
    cut = np.bincount(np.searchsorted(firsts, starts(chars, firsts), "right") - 1, minlength=len(firsts))
    out += [(t, i) for (t, i, raw), n in zip(candidates, cut) if n == 1 and vocabulary.merged(raw) == [i]]
    return out
