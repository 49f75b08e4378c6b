"""Language-model scores by online logistic mixing of context predictors, bit by bit.

Each predictor is one order of context: the last few bytes, hashed, and for every such context how often each byte followed in
all training texts. A byte is predicted as eight bits down the tree of its values; every predictor gives the logit of the next
bit from the counts below the node. A gate, the number of orders that know the node together with the number of the bit, picks
the weights by which the logits are added, and weights learn from every bit that is read. A last stage refines the mixed logit
by a curve that is learned in the same way. Weights start each stretch of ``STRETCH`` bytes from those that fit all training
texts, each byte without its own share of the counts: the logits of all their bits are summed up in cells of rounded logits, and
weights are fitted to these cells. The curve starts as a straight line. Counts come from all training texts, too.

Counts never stand in one place: texts lie in blocks of about ``BLOCK`` bytes, and each block fetches the counts of the contexts
and words that occur in it. All logits are those of the bit that was read: curve and weights are symmetric, so the other bit has
exactly the complement.
"""

from __future__ import annotations

import collections
import math
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oslogs.llm.bpe import ragged
from oslogs.llm.common import map_batches, written

ORDERS = (2, 3, 5)
BLOCK = 1 << 25  # bytes of text that fetch their counts together
SEGMENT = 1 << 14  # bytes of a text after which it is cut at the next white space
STRETCH = 1 << 10  # bytes over which weights adapt before they start anew
STRIP = 1 << 21  # bytes whose contexts are held at a time
READ = 1 << 22  # bytes that are read side by side
LEVELS = 18  # logits are rounded to whole numbers up to this one, either way, to tell cells apart
FORCE = 0.02  # with which first weights are held near even ones, for each bit read
KNOTS, STEP, STEEPEST = 16, 0.5, 8.0  # of the refining curve
PRIOR = 0.3  # added to both counts of a bit
ADAPT = 0.006  # rate of learning
LEAST = 2.0**-20
WORD, END_BYTES, ZERO_BYTES = -1, -2, -3  # rows of counts that are no context

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_HASH = 0x9E3779B97F4A7C15 >> 9 | 1
_EQUAL_BITS = np.array([8 - x.bit_length() for x in range(256)])  # leading bits that two bytes share, by their xor

_SEGMENT_ROW = "block bigint, row bigint, doc_id bigint, held_out boolean, seg bigint, head binary, body binary"


def segments(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """Texts in lower case (A-Z only) as UTF-8, with a zero byte at the end, cut behind white space; head: the bytes before."""

    def rows(batches):
        base = TaskContext.get().partitionId() << 32
        block, held, row = base, 0, base
        fold = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        for batch in batches:
            out = collections.defaultdict(list)
            for doc_id, held_out_, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw, at, seg = (text or "").encode().translate(fold) + b"\0", 0, 0
                while at < len(raw):
                    cut = _WHITE.search(raw, at + SEGMENT)
                    end = cut.end() if cut else len(raw)
                    if held and held + end - at > BLOCK:
                        block, held = block + 1, 0
                    held += end - at
                    for name, value in zip(_NAMES, (block, row, doc_id, held_out_, seg, raw[max(0, at - max(ORDERS)) : at], raw[at:end])):
                        out[name].append(value)
                    at, seg = end, seg + 1
                    if len(out["body"]) >= 1000:
                        yield out
                        out = collections.defaultdict(list)
                row += 1
            if out:
                yield out

    few = docs.select(docs[id_col].cast("bigint").alias("doc_id"), held_out.alias("held_out"), docs[text_col].alias("text"))
    size = few.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = few.coalesce(max(1, math.ceil(size / BLOCK)))
    return written(map_batches(few, rows, _SEGMENT_ROW), "segments", "zstd")


_NAMES = [part.split()[0] for part in _SEGMENT_ROW.split(", ")]


def contexts(heads: list[bytes], bodies: list[bytes], order: int) -> np.ndarray:
    """(hash of the last ``order`` bytes) * 256 + byte, for every byte of the bodies; zeros stand before a text."""
    most = max(ORDERS)
    raw = np.frombuffer(b"".join(h.rjust(most, b"\0") + b for h, b in zip(heads, bodies)), np.uint8)
    length = _lengths(bodies)
    at = ragged(np.cumsum(length + most) - length, length)
    value = np.full(len(raw), order, np.uint64)
    for back in range(order, 0, -1):
        value[most:] = value[most:] << np.uint64(8) | raw[most - back : len(raw) - back]
    hashed = value[at] * np.uint64(_HASH) & np.uint64((1 << 54) - 1)
    return (hashed << np.uint64(8) | raw[at]).astype(np.int64)


def strips(sizes: np.ndarray, size: int) -> list[np.ndarray]:
    """Consecutive rows, in parts of about so many bytes."""
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1) if len(sizes) else []


def _lengths(bodies: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, bodies), np.int64, len(bodies))


def tally(heads: list[bytes], bodies: list[bytes], order: int, train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often each occurs where it is learned from."""
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in strips(_lengths(bodies), STRIP):
        i, j = part[0], part[-1] + 1
        flag = np.repeat(np.array(train[i:j], np.int64), _lengths(bodies[i:j]))
        keys = contexts(heads[i:j], bodies[i:j], order) << 1 | flag
        keys.sort()
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.where(keys[begin] & 1, np.diff(begin, append=len(keys)), 0)
        keys = np.concatenate([found, keys[begin] >> 1])
        turn = np.argsort(keys, kind="stable")
        keys, n = keys[turn], np.concatenate([counts, n])[turn]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        found, counts = keys[begin], np.add.reduceat(n, begin)
    return found, counts


def _seen(rows: DataFrame) -> DataFrame:
    """block, key, first, word, n: bytes after contexts and words that occur in a block, with their number in training texts.

    Held-out texts give rows of number 0; first marks one row per context and block. Ends of texts, and zero bytes of texts and
    ends, have keys of their own.
    """

    def flush(block, heads, bodies, train):
        for order in ORDERS:
            keys, n = tally(heads, bodies, order, train)
            first = np.append(True, keys[1:] >> 8 != keys[:-1] >> 8)
            yield {"block": np.full(len(keys), block), "key": keys, "first": first, "word": [None] * len(keys), "n": n}
        count = collections.Counter()
        for body, is_train in zip(bodies, train):
            found = _WORD.findall(body[:-1] if body.endswith(b"\0") else body)
            if is_train:
                count.update(found)
            else:
                count.update(dict.fromkeys(found, 0))
        learned = [body for body, is_train in zip(bodies, train) if is_train]
        special = [sum(body.endswith(b"\0") for body in learned), sum(body.count(b"\0") for body in learned)]
        yield {"block": [block] * 2, "key": [END_BYTES, ZERO_BYTES], "first": [False] * 2, "word": [None] * 2, "n": special}
        yield {"block": [block] * len(count), "key": [WORD] * len(count), "first": [False] * len(count), "word": list(count), "n": list(count.values())}

    def run(batches):
        now, heads, bodies, train, size = None, [], [], [], 0
        for batch in batches:
            for block, head, body, held_out in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if bodies and (block != now or size > BLOCK):
                    yield from flush(now, heads, bodies, train)
                    heads, bodies, train, size = [], [], [], 0
                now = block
                heads.append(head), bodies.append(body), train.append(not held_out)
                size += len(body)
        if bodies:
            yield from flush(now, heads, bodies, train)

    return written(map_batches(rows.select("block", "head", "body", "held_out"), run, "block bigint, key bigint, first boolean, word binary, n bigint"), "seen", "zstd")


def _lexicon(seen: DataFrame, words: DataFrame) -> DataFrame:
    """block, ctx, counts (n * 256 + byte), home, word, n: what each block needs to know; home: one block of each context."""
    ctx = F.shiftright("key", 8).alias("ctx")
    # the second grouping needs no further shuffle: rows are dealt by context already
    edges = seen.where("key >= 0 and n > 0").select(ctx, "key", "n", "block").repartition("ctx").groupBy("ctx", "key").agg(F.sum("n").alias("n"), F.min("block").alias("least"))
    table = edges.groupBy("ctx").agg(F.collect_list(F.col("n") * 256 + F.col("key") % 256).alias("counts"), F.min("least").alias("least"))  # 256 bytes at most
    none = lambda kind: F.lit(None).cast(kind)
    byte_counts = seen.where("first").select("block", ctx).join(table, "ctx").select("block", "ctx", "counts", (F.col("block") == F.col("least")).alias("home"), none("binary").alias("word"), none("bigint").alias("n"))
    word_counts = seen.where(F.col("key") == WORD).select("block", "word").join(words.where("n > 0"), "word")
    return byte_counts.unionByName(word_counts.select("block", none("bigint").alias("ctx"), none("array<bigint>").alias("counts"), F.lit(False).alias("home"), "word", "n"))


class _Places:
    """Positions of numbers in a list without repeats, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.mask = keys, (1 << max(4, (4 * len(keys)).bit_length())) - 1
        self.table = np.full(self.mask + 1, -1, np.int32)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = self.table[slot] < 0
            self.table[slot[free]] = rest[free]
            lost = self.table[slot] != rest
            rest, slot = rest[lost], slot[lost] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(32)).astype(np.int64) & self.mask

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Where each of these numbers, all of which are in the list, stands."""
        slot = self._slot(keys)
        found = self.table[slot]
        rest = np.flatnonzero(self.keys[found] != keys)
        while len(rest):
            slot[rest] = slot[rest] + 1 & self.mask
            found[rest] = self.table[slot[rest]]
            rest = rest[self.keys[found[rest]] != keys[rest]]
        return found


def logits(keys: np.ndarray, ctx: np.ndarray, first: np.ndarray, counts: np.ndarray, own: int) -> np.ndarray:
    """The logit of each of the eight bits of a key's byte after its context; 0 where nothing was seen.

    ctx: known contexts, sorted; first, counts: their counts, in stretches. own: taken from the count of the byte itself, for
    texts that were counted themselves.
    """
    at = np.minimum(np.searchsorted(ctx, keys >> 8), max(len(ctx) - 1, 0))
    known = ctx[at] == keys >> 8 if len(ctx) else np.zeros(len(keys), bool)
    out = np.zeros((len(keys), 8), np.float32)
    idx = np.flatnonzero(known)
    size = np.diff(first)
    for part in np.array_split(idx, max(1, len(idx) >> 13)):
        n_of = size[at[part]]
        packed = counts[ragged(first[at[part]], n_of)]
        equal = _EQUAL_BITS[(packed & 255) ^ np.repeat(keys[part] & 255, n_of)]
        table = np.bincount(np.repeat(np.arange(len(part)), n_of) * 9 + equal, packed >> 8, len(part) * 9).reshape(-1, 9)
        below = table[:, ::-1].cumsum(1)[:, ::-1]  # texts that agree in at least so many bits
        if own:
            below = np.maximum(below - own, 0)
        out[part] = np.log((below[:, 1:] + PRIOR) / (below[:, :-1] - below[:, 1:] + PRIOR))
    return out


class Mixer:
    """Weights by gate and the refining curve, and how they read texts."""

    def __init__(self, weights: np.ndarray | None = None, curve: np.ndarray | None = None):
        gates = (len(ORDERS) + 1) * 8
        self.weights = np.full((gates, len(ORDERS)), 1.0 / 3, np.float32) if weights is None else weights
        self.curve = np.tile(np.arange(KNOTS + 1, dtype=np.float32) * np.float32(STEP), (gates, 1)) if curve is None else curve

    def read(self, tables: list[np.ndarray], places: list[np.ndarray], begin: np.ndarray, end: np.ndarray, rate: float, teach: bool = False) -> np.ndarray:
        """log2 of the probability of each stretch; with ``teach``, this mixer then holds the mean of what they learned.

        All stretches take their next byte at once, and its eight bits too: each has weights and a curve of its own, so none
        waits for what another one teaches.
        """
        lanes = np.argsort(begin - end, kind="stable")  # longest first, so that those still read come first
        size, begin, gates, kinds = (end - begin)[lanes], begin[lanes], len(self.weights), len(ORDERS)
        weights = np.tile(self.weights.T, (1, len(lanes)))  # by order, then by lane and gate
        curve = np.tile(self.curve, (len(lanes), 1)).ravel()
        used = np.zeros(gates * len(lanes) if teach else 0, np.int64)
        bits = np.zeros(len(lanes))
        own = (np.arange(len(lanes))[:, None] * gates + np.arange(8)).ravel()
        rate = np.float32(rate)
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t))
            at = begin[:n] + t
            x = np.empty((kinds, n * 8), np.float32)
            for row, table, place in zip(x, tables, places):
                table.take(place.take(at), 0, out=row.reshape(n, 8), mode="clip")
            gate = own[: n * 8] + (x != 0).sum(0, dtype=np.int8).astype(np.int64) * 8
            w = np.empty_like(x)
            for now, kept in zip(w, weights):
                kept.take(gate, out=now, mode="clip")
            mixed = (w * x).sum(0).clip(0.01 - STEEPEST, STEEPEST - 0.01)
            # the curve is odd: it holds one side, and the sign of the logit turns it
            share = np.abs(mixed) * np.float32(1 / STEP)
            knot = share.astype(np.int64)
            share -= knot
            knot += gate * (KNOTS + 1)
            low, high = curve.take(knot), curve.take(knot + 1)
            sign = np.sign(mixed)
            p = 1 / (1 + np.exp((mixed + sign * (low + share * (high - low))) * np.float32(-0.5)))
            p.clip(LEAST, 1 - LEAST, out=p)
            fours = p[::4] * p[1::4] * p[2::4] * p[3::4]
            bits[:n] += np.log2(fours[::2]) + np.log2(fours[1::2])
            error = rate * (1 - p)
            x *= error
            w += x
            for now, kept in zip(w, weights):
                kept[gate] = now
            sign *= error * 4
            high += sign * share
            sign *= 1 - share
            low += sign
            curve[knot] = low
            curve[knot + 1] = high
            if teach:
                used[gate] += 1
        if teach:
            by_gate = used.reshape(-1, gates)
            total = by_gate.sum(0)
            met = total > 0
            new_weights = np.einsum("klg,lg->gk", weights.reshape(kinds, -1, gates), by_gate)[met] / total[met, None]
            new_curve = np.einsum("lgc,lg->gc", curve.reshape(-1, *self.curve.shape), by_gate)[met] / total[met, None]
            self.weights, self.curve = self.weights.copy(), self.curve.copy()
            self.weights[met], self.curve[met] = new_weights, new_curve
        result = np.empty(len(lanes))
        result[lanes] = bits
        return result


class Reader:
    """A block's texts with the logits of all that occurs in them."""

    def __init__(self, texts: pa.Table, lexicon: pa.Table):
        self.heads, self.bodies = texts.column("head").to_pylist(), texts.column("body").to_pylist()
        known = lexicon.filter(lexicon.column("ctx").is_valid()).combine_chunks()
        ctx, counts = known.column("ctx").to_numpy(), known.column("counts").combine_chunks()
        if len(ctx):
            flat, offset = counts.values.to_numpy(zero_copy_only=False), counts.offsets.to_numpy()
        else:
            flat, offset = np.zeros(0, np.int64), np.zeros(1, np.int64)
        order = np.argsort(ctx, kind="stable")
        if len(order):
            order = order[np.append(True, ctx[order][1:] != ctx[order][:-1])]
        size = np.diff(offset)[order]
        flat, ctx, first = flat[ragged(offset[:-1][order], size)], ctx[order], np.concatenate([[0], np.cumsum(size)])
        self.places, self.tables = [], []
        for k in ORDERS:
            kinds, _ = tally(self.heads, self.bodies, k, [False] * len(self.bodies))
            self.places.append(_Places(kinds))
            self.tables.append(logits(kinds, ctx, first, flat, 0))

    def read(self, mixer: Mixer, rate: float) -> np.ndarray:
        """log2 of the probability of each segment."""
        out = np.zeros(len(self.bodies))
        for part in strips(_lengths(self.bodies), READ):
            length = _lengths([self.bodies[i] for i in part])
            places = [np.empty(length.sum(), np.int32) for _ in ORDERS]
            at = 0
            for strip in strips(length, STRIP):
                i, j = part[strip[0]], part[strip[-1]] + 1
                n = int(length[strip].sum())
                for k, find, place in zip(ORDERS, self.places, places):
                    place[at : at + n] = find(contexts(self.heads[i:j], self.bodies[i:j], k))
                at += n
            parts = -(-length // STRETCH)
            owner = np.repeat(np.arange(len(part)), parts)
            turn = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = (np.cumsum(length) - length)[owner]
            begin = start + turn * STRETCH
            out[part] = np.bincount(owner, mixer.read(self.tables, places, begin, np.minimum(begin + STRETCH, start + length[owner]), rate), len(part))
        return out


def paths(ctx: np.ndarray) -> np.ndarray:
    """The bytes of contexts from the last one back, then their order: sorted, each context follows its own endings."""
    most = max(ORDERS)
    value = ctx.astype(np.uint64) * np.uint64(pow(_HASH, -1, 1 << 54)) & np.uint64((1 << 54) - 1)
    out = np.zeros(len(ctx), np.uint64)
    for order in ORDERS:
        at = np.flatnonzero(value >> np.uint64(8 * order) == order)
        for back in range(order):
            out[at] |= (value[at] >> np.uint64(8 * back) & np.uint64(255)) << np.uint64(8 * (most - 1 - back) + 3)
        out[at] |= np.uint64(order)
    return out.astype(np.int64)


class Evidence:
    """How often logits of the orders meet in the bits of training texts, and their sums, by cells of rounded logits."""

    def __init__(self):
        self.levels = 2 * LEVELS + 2  # the last one: nothing was seen
        self.sums = np.zeros((1 + len(ORDERS), 8 * self.levels ** len(ORDERS)))
        self.path, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, path: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Contexts by ``paths``, sorted and possibly repeated, with their counts. Endings may have come with an earlier call."""
        path, size, flat = np.concatenate([self.path, path]), np.concatenate([self.size, size]), np.concatenate([self.flat, flat])
        new, old = np.append(True, path[1:] != path[:-1])[: len(path)], len(self.path)
        first = np.concatenate([[0], np.cumsum(size)])
        order, row = path & 7, np.arange(len(path))
        last = {k: np.maximum.accumulate(np.where((order == k) & new, row, -1)) for k in ORDERS}
        most = max(ORDERS)
        whole = np.flatnonzero((order == most) & new & (row >= old))
        n_of = size[whole]
        packed, owner = flat[ragged(first[whole], n_of)], np.repeat(whole, n_of)
        byte, n = packed & 255, (packed >> 8).astype(float)
        cell, every = np.zeros((len(packed), 8), np.int64), []
        for k in ORDERS:
            keys, back = np.unique(last[k][owner] << 8 | byte, return_inverse=True)
            x = logits(keys, row, first, flat, 1)
            level = np.where(x == 0, self.levels - 1, np.clip(np.rint(x), -LEVELS, LEVELS) + LEVELS).astype(np.int64)
            cell = cell * self.levels + level[back]
            every.append(x[back])
        cell = (cell * 8 + np.arange(8)).ravel()
        n = np.repeat(n, 8)
        found, back = np.unique(cell, return_inverse=True)
        self.sums[0, found] += np.bincount(back, n, len(found))
        for total, x in zip(self.sums[1:], every):
            total[found] += np.bincount(back, n * x.ravel(), len(found))
        kept = np.unique([at[-1] for at in last.values() if len(at) and at[-1] >= 0]).astype(np.int64)
        self.path, self.size, self.flat = path[kept], size[kept], flat[ragged(first[kept], size[kept])]

    def rows(self) -> dict:
        cell = np.flatnonzero(self.sums[0])
        return {"cell": cell, "n": self.sums[0, cell]} | {f"x{k}": x[cell] for k, x in zip(ORDERS, self.sums[1:])}


def evidence(lexicon: DataFrame) -> DataFrame:
    """cell, n, and the sum of each order's logits: all bits of all training texts, each without its own count."""

    def placed(batches):
        for batch in batches:
            yield {"path": paths(batch.column(0).to_numpy()), "counts": batch.column(1)}

    def run(batches):
        found = Evidence()
        for batch in batches:
            counts = batch.column(1)
            offset = counts.offsets.to_numpy()
            found.add(batch.column(0).to_numpy(), np.diff(offset), counts.values.to_numpy(zero_copy_only=False)[offset[0] : offset[-1]])
        yield found.rows()

    family = F.shiftright("path", 8 * (max(ORDERS) - min(ORDERS)) + 3)
    homes = map_batches(lexicon.where("home").select("ctx", "counts"), placed, "path bigint, counts array<bigint>")
    sums = ["n", *(f"x{k}" for k in ORDERS)]
    cells = map_batches(homes.repartition(family).sortWithinPartitions("path"), run, "cell bigint, " + ", ".join(f"{c} double" for c in sums))
    return cells.groupBy("cell").agg(*(F.sum(c).alias(c) for c in sums))


def fitted(x: np.ndarray, n: np.ndarray, start: np.ndarray, force: float) -> np.ndarray:
    """The w of least sum of n * log(1 + exp(-(x w))) + force / 2 * |w - start|^2, by damped Newton steps."""

    def loss(w: np.ndarray) -> float:
        return float(n @ np.logaddexp(0, -(x @ w)) + force / 2 * ((w - start) ** 2).sum())

    w = start.astype(float)
    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (n * (1 - p)) - force * (w - start)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + force * np.eye(len(w)), slope)
        while (then := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step /= 2
        if then > now:
            break
        w, gain, now = w + step, now - then, then
        if gain <= 1e-12 * now:
            break
    return w


def taught(lexicon: DataFrame) -> Mixer:
    """The mixer whose weights fit the bits of all training texts, each without its own share of the counts.

    Its curve is straight: texts bend it as they are read. Weights are held near even ones, since a byte's own text may
    hold its context more often than once, which makes long contexts look surer than they are elsewhere.
    """
    cells, mixer = evidence(lexicon).orderBy("cell").toArrow(), Mixer()  # rounded logits: their number has a bound
    cell, n = cells.column("cell").to_numpy(), cells.column("n").to_numpy()
    x = np.stack([cells.column(f"x{k}").to_numpy() / n for k in ORDERS], 1)
    levels, known, rest = 2 * LEVELS + 2, np.zeros(len(cell), np.int64), cell // 8
    for _ in ORDERS:
        known += rest % levels != levels - 1
        rest = rest // levels
    gates = known * 8 + cell % 8
    for gate in np.unique(gates[known > 0]):
        at = np.flatnonzero(gates == gate)
        mixer.weights[gate] = fitted(x[at], n[at], mixer.weights[gate], FORCE * n[at].sum())
    return mixer


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every whole text.

    Texts that are not held out are learned from; a null ``held_out`` counts as false. score is log10 of the probability of the
    text in lower case, with its end; base_score that of its words and end, each by its count plus one. A null text counts as an
    empty one. Rows are treated alone: equal rows stay and score alike up to rounding and where their stretches begin, which is
    decided by the text alone. An empty table gives an empty one. Other columns are not read.
    """
    rows = segments(docs, F.coalesce(held_out, F.lit(False)), id_col, text_col)
    seen = _seen(rows)
    words = written(seen.where(F.col("key") == WORD).groupBy("word").agg(F.sum("n").alias("n")), "words")
    known = words.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    special = {row.key: row.n for row in seen.where("key < -1").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    ends, nuls = special.get(END_BYTES, 0), special.get(ZERO_BYTES, 0)
    n, v = (known.n or 0) + ends, (known.v or 0) + (ends > 0)
    lexicon = written(_lexicon(seen, words), "lexicon", "zstd")
    mixer = taught(lexicon)
    end_here, nul_here = math.log10((ends + 1) / (nuls + 2)), math.log10((nuls - ends + 1) / (nuls + 2))  # what a zero byte is

    def score(texts: pa.Table, known_here: pa.Table) -> pa.Table:
        bodies = texts.column("body").to_pylist()
        is_word = known_here.column("word").is_valid()
        named = known_here.filter(is_word)
        count = dict(zip(named.column("word").to_pylist(), named.column("n").to_pylist()))
        log2 = Reader(texts, known_here).read(mixer, ADAPT)
        out = collections.defaultdict(list)
        for body, value in zip(bodies, (log2 * math.log10(2)).tolist()):
            seg_last = body.endswith(b"\0")  # other segments end with white space
            found = _WORD.findall(body[:-1] if seg_last else body)
            c = np.array([count.get(w, 0) for w in found] + [ends] * seg_last, float)
            out["n_tokens"].append(len(c))
            out["n_known"].append(int((c > 0).sum()))
            out["base_score"].append(float(np.log10((c + 1) / (n + v + 1)).sum()))
            inside = body.count(b"\0") - seg_last
            out["score"].append(value + seg_last * end_here + inside * nul_here)
            out["n_bytes"].append(len(body) - seg_last)
        return pa.table({"row": texts.column("row"), "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out")} | {c: out[c] for c in ("n_bytes", "n_tokens", "n_known", "base_score", "score")})

    schema = "row bigint, doc_id bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    parts = rows.groupBy("block").cogroup(lexicon.drop("home").groupBy("block")).applyInArrow(score, schema)
    sums = parts.groupBy("row", "doc_id", "held_out").agg(*(F.sum(c).alias(c) for c in ("n_bytes", "n_tokens", "n_known", "base_score", "score")))
    per_byte = F.when(F.col("n_bytes") > 0, -F.col("score") / math.log10(2) / F.col("n_bytes"))
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score", per_byte.alias("bits_per_byte"))
