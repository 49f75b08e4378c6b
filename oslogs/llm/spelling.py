"""Groups of spelling variants: words that are one letter apart, found in a trie of letter-group counts.

Letters are dealt into twelve groups of about equal use. A word's path in the trie is how many of its letters each group has,
group after group. One inserted, deleted or replaced letter adds at most one to one count and takes at most one from another, so
a search goes down the trie with one surplus and one deficit to spend; the words of the leaves that it reaches are compared
letter by letter. The trie never stands in one place: its leaves, in depth-first order, are cut into blocks of about ``BLOCK``
words. A first descent over the cuts alone tells which blocks a word can reach, a second one inside each block ends in leaves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oslogs.llm.bpe import ragged
from oslogs.llm.common import map_batches, written

GROUPS, BITS = 12, 5
MOST = (1 << BITS) - 1  # counts beyond are kept as this; two counts never differ more for it, so no near word is lost
BLOCK = 20_000  # words of one block of the trie
SLICE = 100_000  # words that look into one block within one task
STRIDE = 8_192  # words that descend at a time
WIDE = 64  # letters of a word that are compared as one row of an array; longer words are compared as strings

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(docs: DataFrame, least_letters: int = 6, least_n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the runs of Latin letters, some of them with a planted slip, that are long and frequent enough.

    A run is a slip if 199 divides the crc32 of ``id:run``: it then loses one letter. A null text has no runs; a null id counts
    as an empty one.
    """
    run, key = F.col("run"), F.concat(F.coalesce(F.col("id"), F.lit("")), F.lit(":"), F.col("run"))
    lowered = F.translate(docs[text_col], UPPER, LOWER)
    pattern = "([A-Za-zÀ-ÿ]{%d,})" % least_letters
    runs = docs.select(docs[id_col].cast("string").alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(pattern), 1)).alias("run"))
    hashed = runs.withColumn("h", F.crc32(key.cast("binary")))
    at = (F.col("h") % F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    found = hashed.select(F.when(F.col("h") % 199 == 0, short).otherwise(run).alias("word")).where(F.length("word") >= least_letters)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def letter_groups(found: DataFrame) -> dict[str, int]:
    """The group of each letter: the most used ones are dealt first, one a group, then back again.

    One row per different letter comes to the driver.
    """
    letters = found.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    order = [row.letter for row in sorted(letters.collect(), key=lambda row: (-row["count"], row.letter)) if row.letter]
    turn = [*range(GROUPS), *reversed(range(GROUPS))]
    return {letter: turn[i % len(turn)] for i, letter in enumerate(order)}


def codes(found: list[str], groups: dict[str, int]) -> np.ndarray:
    """The path of each word as one number: its counts from the first group on, five bits each."""
    table = np.zeros(max(map(ord, groups), default=0) + 1, np.int64)
    for letter, group in groups.items():
        table[ord(letter)] = group
    letters = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(found)), np.fromiter(map(len, found), np.int64, len(found)))
    counts = np.bincount(owner * GROUPS + table[letters], minlength=len(found) * GROUPS).reshape(-1, GROUPS)
    return np.minimum(counts, MOST) @ (1 << (BITS * np.arange(GROUPS - 1, -1, -1)))


def _descend(code: np.ndarray, level: int, frontier: tuple) -> tuple:
    """One level down: the same count, one more if no surplus is spent, one less if a surplus but no deficit is.

    Of two near words, the one with the smaller path looks for the other, so a deficit comes after a surplus only.
    """
    who, prefix, surplus, deficit = frontier
    count = code[who] >> (BITS * (GROUPS - 1 - level)) & MOST
    more = ~surplus & (count < MOST)
    less = surplus & ~deficit & (count > 0)
    down = prefix << BITS | count
    return (
        np.concatenate([who, who[more], who[less]]), np.concatenate([down, down[more] + 1, down[less] - 1]),
        np.concatenate([surplus, np.ones(more.sum(), bool), surplus[less]]), np.concatenate([deficit, deficit[more], np.ones(less.sum(), bool)]),
    )


def _root(n: int) -> tuple:
    return np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)


def reach(code: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, block): the blocks that each word's search can end in; cuts: the first path of every block but the first."""
    frontier, found = _root(len(code)), []
    for level in range(GROUPS):
        frontier = _descend(code, level, frontier)
        rest = BITS * (GROUPS - 1 - level)
        first = np.searchsorted(cuts, frontier[1] << rest, "right")
        last = np.searchsorted(cuts, (frontier[1] + 1 << rest) - 1, "right")
        done = first == last  # the subtree lies in one block
        found.append(frontier[0][done] * (len(cuts) + 1) + first[done])
        frontier = tuple(x[~done] for x in frontier)
    pairs = np.unique(np.concatenate(found))
    return pairs // (len(cuts) + 1), pairs % (len(cuts) + 1)


def one_apart(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced letter."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Leaves:
    """The words of one block, in the order of their paths."""

    def __init__(self, found: list[str], code: np.ndarray):
        order = np.argsort(code, kind="stable")
        self.words, self.code = [found[i] for i in order], code[order]
        self.place = order
        self.letters, self.length = self._rows(self.words)

    @staticmethod
    def _rows(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        length = np.fromiter(map(len, found), np.int64, len(found))
        rows = np.zeros((len(found), WIDE), np.uint16)
        fits = np.flatnonzero(length <= WIDE)
        chars = np.frombuffer("".join(found[i] for i in fits).encode("utf-16-le"), np.uint16)
        rows[np.repeat(fits, length[fits]), ragged(np.zeros(len(fits), np.int64), length[fits])] = chars
        return rows, length

    def near(self, asked: list[str], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked, word of the block): pairs that are one letter apart; of two equal paths the smaller word asks."""
        frontier = _root(len(asked))
        for level in range(GROUPS):
            frontier = _descend(code, level, frontier)
            rest = BITS * (GROUPS - 1 - level)
            begin = np.searchsorted(self.code, frontier[1] << rest)
            end = np.searchsorted(self.code, frontier[1] + 1 << rest)
            frontier = tuple(x[end > begin] for x in frontier)
        begin = np.searchsorted(self.code, frontier[1])
        count = np.searchsorted(self.code, frontier[1], "right") - begin
        rows, length = self._rows(asked)
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        ends = np.cumsum(count)
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, 1 << 18), "right"))
        for part in np.split(np.arange(len(count)), cuts[1:]):
            who = np.repeat(frontier[0][part], count[part])
            at = ragged(begin[part], count[part])
            keep = np.abs(length[who] - self.length[at]) <= 1
            keep = np.flatnonzero(keep)[self._verify(rows, length, asked, who[keep], at[keep])]
            who, at = who[keep], at[keep]
            twice = np.flatnonzero(code[who] == self.code[at])
            drop = [i for i in twice if asked[who[i]] > self.words[at[i]]]
            out.append((np.delete(who, drop), self.place[np.delete(at, drop)]))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def _verify(self, rows, length, asked, who, at) -> np.ndarray:
        a, b, n, m = rows[who], self.letters[at], length[who], self.length[at]
        same = a == b
        head = np.where(same.all(1), WIDE, same.argmin(1))
        # the tail of the longer word is read one letter on
        longer_b, longer_a = m > n, n > m
        one = np.zeros((len(who), 1), np.uint16)
        left = np.where(longer_a[:, None], np.concatenate([a[:, 1:], one], 1), a)
        right = np.where(longer_b[:, None], np.concatenate([b[:, 1:], one], 1), b)
        differs = left != right
        tail = np.where(differs.any(1), WIDE - differs[:, ::-1].argmax(1), 0)  # from here on both are equal
        good = np.where(n == m, (differs.sum(1) == 1), tail <= head)
        long = np.flatnonzero((n > WIDE) | (m > WIDE))
        good[long] = [one_apart(asked[who[i]], self.words[at[i]]) for i in long]
        return good


def near_words(found: DataFrame) -> DataFrame:
    """word, other, other_n: every ordered pair of words that are one letter apart; words and n from ``found``.

    A block and the words that may reach it form one group; where more than ``SLICE`` words do, they are dealt over several
    groups that all hold the block. Cuts and letter groups are all that comes to the driver: one number per ``BLOCK`` words.
    """
    groups = letter_groups(found)
    total = found.count()
    if not total:
        return found.select("word", F.col("word").alias("other"), F.col("n").alias("other_n"))

    def paths(batches):
        for batch in batches:
            yield {"word": batch.column(0), "n": batch.column(1), "code": codes(batch.column(0).to_pylist(), groups)}

    coded = written(map_batches(found.select("word", "n"), paths, "word string, n bigint, code bigint"), "paths")
    blocks = math.ceil(total / BLOCK)
    shares = [i / blocks for i in range(1, blocks)]
    found_cuts = coded.agg(F.percentile_approx("code", shares, max(10_000, 10 * blocks)).alias("cuts")).first().cuts if shares else []
    cuts = np.unique(np.array(found_cuts, np.int64))

    def routes(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, STRIDE):
                part = batch.slice(begin, STRIDE)
                code = part.column(2).to_numpy()
                who, block = reach(code, cuts)
                asks = np.arange(len(who) + len(code)) < len(who)
                who, block = np.concatenate([who, np.arange(len(code))]), np.concatenate([block, np.searchsorted(cuts, code, "right")])
                rows = part.take(pa.array(who))
                yield {"block": block, "asks": asks, "word": rows.column(0), "n": rows.column(1), "code": rows.column(2)}

    routed = written(map_batches(coded, routes, "block bigint, asks boolean, word string, n bigint, code bigint"), "routes")
    sizes = routed.where("asks").groupBy("block").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    slices = F.when(F.col("asks"), F.array(F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("slices") - 1))
    dealt = routed.join(sizes, "block").select("block", F.explode(slices).alias("slice"), "asks", "word", "n", "code")

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        inside, asked = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
        leaves = Leaves(inside.column("word").to_pylist(), inside.column("code").to_numpy())
        looks, code = asked.column("word").to_pylist(), asked.column("code").to_numpy()
        found_pairs = [leaves.near(looks[i : i + STRIDE], code[i : i + STRIDE]) for i in range(0, len(looks), STRIDE)]
        who = np.concatenate([np.zeros(0, np.int64), *(w + i * STRIDE for i, (w, _) in enumerate(found_pairs))])
        at = np.concatenate([np.zeros(0, np.int64), *(a for _, a in found_pairs)])
        one, two = asked.take(pa.array(who)), inside.take(pa.array(at))
        both = zip(("word", "other", "other_n"), (("word", "word"), ("word", "word"), ("n", "n")))
        columns = {
            name: pa.concat_arrays([x.combine_chunks() for x in (
                (one.column("word"), two.column("word")) if name == "word" else
                (two.column("word"), one.column("word")) if name == "other" else (two.column("n"), one.column("n")))])
            for name, _ in both
        }
        return pa.table(columns)

    return dealt.groupBy("block", "slice").applyInArrow(search, "word string, other string, other_n bigint")


def variants(found: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word: its commonest near word if that has ``ratio`` times its count.

    Ties go to the smallest word. The root is where the forms of forms end. Counts grow by the ratio with every form, so the
    number of forms on the way to a root, and the rounds of pointer jumping that find it, follow from the largest count.
    """
    found = written(found.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_words(found).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = found.join(near, "word", "left")
    is_form = -F.col("best.n") >= F.col("n") * ratio
    classed = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    up = classed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    largest = classed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(largest, ratio)))
    for _ in range(math.ceil(math.log2(steps))):
        on = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = written(up.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return classed.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
