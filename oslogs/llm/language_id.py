"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is cut into windows; in each, one network runs forward and one backward, and a softmax on both states labels every
byte. The mean of a document's byte labels is its language. Both networks are trained together in numpy, by
backpropagation through time, on windows of a bounded sample of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oslogs.llm.common import filter_batches, map_batches

ROWS_PER_LANGUAGE = 600  # rows of each language, at most, that the network is fitted to, chosen by a hash of their id
TRAIN_ROWS = 12_000  # rows in all, at most
WINDOW = 96  # bytes
WINDOWS_PER_ROW = 4
STATES = 8  # of each direction
EPOCHS = 5
BATCH = 256
AT_A_TIME = 2048  # windows
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in windows (padded with zeros), and for each window its text's number and how many bytes are real."""
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    count = -(-length // WINDOW)
    rows = np.zeros(int(count.sum()) * WINDOW, np.uint8)
    first = (np.cumsum(count) - count) * WINDOW
    raw = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum(length) - length
    rows[np.arange(len(raw)) + np.repeat(first - at, length)] = raw
    owner = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return rows.reshape(-1, WINDOW), owner, np.minimum(length[owner] - place * WINDOW, WINDOW)


class Network:
    """Weights: for both directions what a byte adds to the gates (table) and what the state adds (u); then the softmax."""

    def __init__(self, languages: list[str], seed: int = 3):
        rng, h = np.random.default_rng(seed), STATES
        self.languages = languages
        self.p = {
            "table": rng.normal(0, 0.3, (2, 256, 3 * h)).astype(np.float32),
            "u": rng.normal(0, 1 / np.sqrt(h), (2, h, 3 * h)).astype(np.float32),
            "w": rng.normal(0, 0.3, (2 * h, max(1, len(languages)))).astype(np.float32),
            "b": np.zeros(max(1, len(languages)), np.float32),
        }

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        np.negative(x, out=x)
        with np.errstate(over="ignore"):  # beyond the range the result is 0, as it should be
            np.exp(x, out=x)
        x += 1
        return np.reciprocal(x, out=x)

    def _run(self, rows: np.ndarray, keep: bool = False):
        """States of both directions at every place, places x windows x 2 states; with what backpropagation needs."""
        h, n = STATES, len(rows)
        both = np.stack([rows.T, rows[:, ::-1].T])  # direction, step, window
        state = np.zeros((2, n, h), np.float32)
        out = np.empty((WINDOW, n, 2 * h), np.float32)
        kept = []
        table, u = self.p["table"], self.p["u"]
        x = np.empty((2, n, 3 * h), np.float32)
        for t in range(WINDOW):
            for k in range(2):
                np.take(table[k], both[k, t], axis=0, out=x[k], mode="clip")
            s = np.matmul(state, u)
            gates = self._sigmoid(x[..., : 2 * h] + s[..., : 2 * h])
            update, reset = gates[..., :h], gates[..., h:]
            new = reset * s[..., 2 * h :]
            new += x[..., 2 * h :]
            new *= 2
            new = self._sigmoid(new)
            new *= 2
            new -= 1  # tanh
            before = state
            state = before - new
            state *= update
            state += new
            out[t, :, :h] = state[0]
            out[WINDOW - 1 - t, :, h:] = state[1]
            if keep:
                kept.append((before, update, reset, s[..., 2 * h :], new))
        return out, both, kept

    def _labels(self, out: np.ndarray) -> np.ndarray:
        z = out.reshape(-1, 2 * STATES) @ self.p["w"] + self.p["b"]
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        return z.reshape(*out.shape[:2], -1)

    def pooled(self, rows: np.ndarray, real: np.ndarray) -> np.ndarray:
        """For each window the sum of its real bytes' label probabilities."""
        labels = self._labels(self._run(rows)[0])
        labels *= (np.arange(WINDOW)[:, None] < real[None, :])[..., None]
        return labels.sum(0)

    def gradients(self, rows: np.ndarray, real: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        h = STATES
        out, both, kept = self._run(rows, keep=True)
        d = self._labels(out)
        d[:, np.arange(len(rows)), truth] -= 1
        d *= ((np.arange(WINDOW)[:, None] < real[None, :]) / max(1, real.sum()))[..., None]
        flat = d.reshape(-1, d.shape[-1])
        g = {"w": out.reshape(-1, 2 * h).T @ flat, "b": flat.sum(0)}
        back = (flat @ self.p["w"].T).reshape(WINDOW, len(rows), 2 * h)
        u = self.p["u"]
        g["u"] = np.zeros_like(u)
        x = np.empty((WINDOW, 2, len(rows), 3 * h), np.float32)
        later = np.zeros((2, len(rows), h), np.float32)
        for t in range(WINDOW - 1, -1, -1):
            before, update, reset, part, new = kept[t]
            dh = later + np.stack([back[t, :, :h], back[WINDOW - 1 - t, :, h:]])
            dz = dh * (before - new) * update * (1 - update)
            dn = dh * (1 - update) * (1 - new * new)
            dr = dn * part * reset * (1 - reset)
            gates = np.concatenate([dz, dr, dn * reset], axis=2)
            g["u"] += np.matmul(before.transpose(0, 2, 1), gates)
            later = dh * update + np.matmul(gates, u.transpose(0, 2, 1))
            x[t, ..., : 2 * h], x[t, ..., 2 * h :] = gates[..., : 2 * h], dn
        g["table"] = np.empty_like(self.p["table"])
        for k in range(2):
            which, values = both[k].ravel(), x[:, k].reshape(-1, 3 * h)
            g["table"][k] = np.stack([np.bincount(which, values[:, c], 256) for c in range(3 * h)], 1)
        return g

    def train(self, rows: np.ndarray, real: np.ndarray, truth: np.ndarray, seed: int = 5) -> None:
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        batch = min(BATCH, max(16, len(rows) // 16))
        rounds = EPOCHS * (1 if len(rows) >= 4000 else 3)
        for epoch in range(rounds):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                i = order[at : at + batch]
                step += 1
                rate = 0.02 * (1 - epoch / rounds) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                for k, g in self.gradients(rows[i], real[i], truth[i]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= (rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """Language and probability of every whole text; a text that is null or has no letter is UNKNOWN at 0."""
        has = [bool(t) and bool(self.languages) and _LETTER.search(t) is not None for t in texts]
        total = np.zeros((len(texts), max(1, len(self.languages))))
        held: list[bytes] = []
        owners: list[int] = []

        def flush() -> None:
            rows, owner, real = windows_of(held)
            mine = np.array(owners)[owner]
            for at in range(0, len(rows), AT_A_TIME):
                part = slice(at, at + AT_A_TIME)
                np.add.at(total, mine[part], self.pooled(rows[part], real[part]))
            held.clear()
            owners.clear()

        size = 0
        for i, text in enumerate(texts):
            if has[i]:
                held.append(text.encode())
                owners.append(i)
                size += len(held[-1])
                if size > AT_A_TIME * WINDOW * 4:
                    flush()
                    size = 0
        if held:
            flush()
        for i, known in enumerate(has):
            if known:
                share = total[i] / total[i].sum()
                best = int(share.argmax())
                yield self.languages[best], float(min(1.0, share[best]))
            else:
                yield UNKNOWN, 0.0


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = ROWS_PER_LANGUAGE) -> Network:
    """A network for the languages of df's rows, fitted to at most ``per_language`` rows of each.

    Rows with a null id, text or language don't count. The rows are chosen by id and language alone; of each text the driver
    gets a few windows, at places set by a hash, and never a whole text.
    """
    key, text, lang = (F.col(f"`{c}`") for c in (id_col, text_col, lang_col))
    known = df.where(key.isNotNull() & text.isNotNull() & lang.isNotNull()).select(key.cast("bigint").alias("id"), lang.cast("string").alias("lang"), text.alias("text"))
    # first within parts of each language, so that no task ranks what all tasks have found of a frequent one
    few = known.select("id", "lang", F.pmod(F.xxhash64("id", "lang"), F.lit(64)).alias("part"))
    for keys in (("lang", "part"), ("lang",)):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id")
        few = few.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_language)
    few = few.orderBy("rn", "lang", "id").limit(TRAIN_ROWS).select("id", "lang").distinct()

    def cut(batches):
        for batch in batches:
            rows, real, lang = [], [], []
            for key, text, name in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found, _, size = windows_of([text.encode()])
                for i in np.unique(np.linspace(0, len(found) - 1, min(len(found), WINDOWS_PER_ROW)).astype(int)) if len(found) else ():
                    rows.append(found[i].tobytes())
                    real.append(int(size[i]))
                    lang.append(name)
            yield {"bytes": rows, "real": real, "lang": lang}

    picked = known.join(F.broadcast(few), ["id", "lang"]).select("id", "text", "lang")
    got = map_batches(picked, cut, "bytes binary, real int, lang string").toArrow().sort_by([("lang", "ascending"), ("bytes", "ascending")])
    names = sorted(set(got.column("lang").to_pylist()))
    network = Network(names)
    if got.num_rows:
        rows = np.frombuffer(b"".join(got.column("bytes").to_pylist()), np.uint8).reshape(-1, WINDOW)
        number = {name: i for i, name in enumerate(names)}
        network.train(rows, got.column("real").to_numpy(), np.array([number[x] for x in got.column("lang").to_pylist()]))
    return network


def languages(df: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred and score of every row's whole text.

    A text that is null or has no letter is "und" with score 0. Repeated rows stay; an empty table gives an empty one; other
    columns are not read.
    """

    def rows(batches):
        for batch in batches:
            found = list(network.predict(batch.column(1).to_pylist()))
            yield {"id": batch.column(0), "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    few = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_batches(few, rows, "id bigint, lang_pred string, score double").withColumnRenamed("id", id_col)


def recognised(df: DataFrame, network: Network, text_col: str = "text", least: float = 0.35) -> DataFrame:
    """The rows, with all columns, whose language is known with a probability of at least ``least``.

    A text that is null or has no letter is not. A network that knows no language keeps every row.
    """
    if not network.languages:
        return df
    return filter_batches(df, text_col, lambda texts: [x != UNKNOWN and s >= least for x, s in network.predict(texts)])
