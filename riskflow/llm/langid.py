"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of UTF-8 bytes in both directions, labels every position with
language probabilities, and the document's probabilities are their mean over the positions of
letters. It is trained in numpy by backpropagation through time (Adam) on windows of a bounded
sample of documents; predictions read every byte of every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, learnable, ship

#: Bytes of a window, hidden units per direction, windows that run side by side.
SPAN, HIDDEN, SIDE = 128, 16, 2048
#: Training documents per language and in all, windows cut from each.
PER_LANGUAGE, SAMPLE, CUTS = 600, 20_000, 4
#: Adam steps, windows per step, learning rate.
STEPS, BATCH, RATE = 260, 96, 0.02
#: Tasks that the rows of one language are dealt over while the sample is drawn.
SALTS = 64
UNKNOWN = "und"
SEED = 5

_LETTER = np.zeros(256, np.float32)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1


def _cell(xg, xn, h, ug, un):
    """One step of the gated unit: gates (update, reset), candidate, its recurrent part, state.
    The gates are piecewise linear sigmoids, the candidate is x / (1 + |x|): both cost a few
    passes over memory, where the exponentials would take most of the time."""
    k = h.shape[1]
    g = h @ ug
    g += xg
    g *= 0.25
    g += 0.5
    np.clip(g, 0, 1, out=g)
    a = h @ un
    n = a * g[:, k:]
    n += xn
    n /= np.abs(n) + 1
    new = h - n
    new *= g[:, :k]
    new += n
    return g, n, a, new


class Network:
    """Weights by name: ``x*`` and ``c*`` inputs per byte of the gates and the candidate, ``u*``
    and ``r*`` their recurrent parts, ``v*`` output; f and b are the two directions."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * (1 / np.sqrt(HIDDEN))).astype(np.float32)
        self.languages = languages
        self.w = {f"{k}{d}": draw(*s) for d in "fb" for k, s in
                  (("x", (256, 2 * HIDDEN)), ("c", (256, HIDDEN)), ("u", (HIDDEN, 2 * HIDDEN)),
                   ("r", (HIDDEN, HIDDEN)), ("v", (HIDDEN, len(languages))))}
        self.w["o"] = np.zeros(len(languages), np.float32)

    def _steps(self, data: np.ndarray, d: str, back: bool):
        """Steps of one direction over bytes (time, side): (time, state before, *cell)."""
        x, c, u, r = (self.w[k + d] for k in "xcur")
        h = np.zeros((data.shape[1], HIDDEN), x.dtype)
        for t in (reversed(range(len(data))) if back else range(len(data))):
            step = _cell(x.take(data[t], axis=0), c.take(data[t], axis=0), h, u, r)
            yield t, h, *step
            h = step[-1]

    def _grad_run(self, data, d, steps, dh_out, grads):
        """Backpropagation through time of one direction; ``dh_out``: gradient of each state."""
        u, r, k = self.w["u" + d], self.w["r" + d], HIDDEN
        du, dr, carry = np.zeros_like(u), np.zeros_like(r), np.zeros_like(dh_out[0])
        dx, dc = np.empty((*data.shape, 2 * k), u.dtype), np.empty((*data.shape, k), u.dtype)
        for t, before, g, n, a, _ in reversed(steps):
            dh = dh_out[t] + carry
            dn = dh * (1 - g[:, :k]) * np.square(1 - np.abs(n))
            dg = np.concatenate([dh * (before - n), dn * a], axis=1) * ((g > 0) & (g < 1)) * 0.25
            da = dn * g[:, k:]
            dx[t], dc[t] = dg, dn
            du += before.T @ dg
            dr += before.T @ da
            carry = dh * g[:, :k] + dg @ u.T + da @ r.T
        flat = data.ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
        for name, rows in (("x", dx.reshape(-1, 2 * k)), ("c", dc.reshape(-1, k))):
            grads[name + d] = np.zeros_like(self.w[name + d])
            grads[name + d][flat[order][first]] = np.add.reduceat(rows[order], first)
        grads["u" + d], grads["r" + d] = du, dr

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over all positions of letters and its gradients."""
        sf, sb = list(self._steps(data, "f", False)), list(self._steps(data, "b", True))
        hf, hb = np.stack([s[-1] for s in sf]), np.stack([s[-1] for s in sb][::-1])
        logits = hf @ self.w["vf"] + hb @ self.w["vb"] + self.w["o"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        weight = _LETTER[data]
        weight = (weight / max(1.0, weight.sum())).astype(np.float32)
        side = np.arange(data.shape[1])
        loss = float(-(np.log(p[:, side, label] + 1e-9) * weight).sum())
        p[:, side, label] -= 1
        p *= weight[:, :, None]
        grads = {"o": p.sum(axis=(0, 1)), "vf": np.einsum("tbh,tbl->hl", hf, p), "vb": np.einsum("tbh,tbl->hl", hb, p)}
        self._grad_run(data, "f", sf, p @ self.w["vf"].T, grads)
        self._grad_run(data, "b", sb, p @ self.w["vb"].T, grads)
        return loss, grads

    def fit(self, windows: np.ndarray, label: np.ndarray, steps: int = STEPS) -> None:
        """``windows``: bytes (window, SPAN), 0 beyond the text's end."""
        rng = np.random.default_rng(SEED + 1)
        m = {k: np.zeros_like(x) for k, x in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        groups = [np.flatnonzero(label == i) for i in range(len(self.languages))]
        for step in range(1, steps + 1):
            lang = rng.integers(0, len(groups), BATCH)  # every language as often as any other
            pick = np.array([rng.choice(groups[i]) for i in lang])
            data = np.ascontiguousarray(windows[pick].T)
            short = rng.random(BATCH) < 0.25  # texts of a few words occur too
            data[:, short] *= np.arange(SPAN)[:, None] < rng.integers(4, 33, int(short.sum()))
            _, grads = self.gradients(data, label[pick])
            rate = RATE * (1 - 0.9 * step / steps)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g / max(1.0, norm)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.w[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)

    def label_windows(self, data: np.ndarray) -> np.ndarray:
        """Sums over letter positions of the language probabilities: bytes (SPAN, side) -> (side, languages)."""
        states = np.empty((len(data), data.shape[1], 2 * HIDDEN), np.float32)
        for d, at, back in (("f", 0, False), ("b", HIDDEN, True)):
            for t, *_, h in self._steps(data, d, back):
                states[t, :, at:at + HIDDEN] = h
        weights = np.concatenate([self.w["vf"], self.w["vb"]])
        # states lie within -1 and 1, so the exponentials stay in range after this shift
        p = states.reshape(-1, 2 * HIDDEN) @ weights
        p += self.w["o"] - np.abs(weights).sum(axis=0).max() / 4
        np.clip(p, -80, 80, out=p)
        np.exp(p, out=p)
        p *= (_LETTER[data].ravel() / (p @ np.ones(p.shape[1], np.float32)))[:, None]
        return p.reshape(len(data), data.shape[1], -1).sum(axis=0, dtype=np.float64)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its probability for every text; ``und`` and 0 without a letter."""
        total = np.zeros((len(texts), len(self.languages)))
        count, owner, rows = np.zeros(len(texts)), [], []

        def flush():
            data = np.zeros((len(rows), SPAN), np.uint8)
            for i, x in enumerate(rows):
                data[i, :len(x)] = x
            np.add.at(total, owner, self.label_windows(np.ascontiguousarray(data.T)))
            np.add.at(count, owner, _LETTER[data].sum(axis=1))
            owner.clear()
            rows.clear()

        named = [t is not None and any(map(str.isalpha, t)) for t in texts]
        for i, t in enumerate(texts):
            if not named[i] or not self.languages:
                continue
            data = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
            for at in range(0, len(data), SPAN):
                owner.append(i)
                rows.append(data[at:at + SPAN])
                if len(rows) == SIDE:
                    flush()
        if rows:
            flush()
        best = total.argmax(axis=1) if self.languages else np.zeros(len(texts), int)
        found = [n and bool(self.languages) for n in named]
        share = [float(total[i, best[i]] / count[i]) if ok else 0.0 for i, ok in enumerate(found)]
        return [self.languages[best[i]] if ok else UNKNOWN for i, ok in enumerate(found)], [min(1.0, s) for s in share]


def training_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """(lang, data): ``CUTS`` windows at places spread evenly over each sampled document. At most
    ``PER_LANGUAGE`` documents of a language (the first by a hash of the id) and ``SAMPLE`` in
    all are read; only rows that may be learned from, with a language and a text. Of the rows
    that share an id and a language only the smallest text is read, so the bounds hold."""
    # first among the rows of a language that share a salt, then among the few that are left
    salt = F.pmod("h", F.lit(SALTS))
    near = F.row_number().over(Window.partitionBy("lang", "salt").orderBy("h", "k"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "k"))
    ids = (docs.select(F.col(id_col).alias("k"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"))
           .where(F.col("lang").isNotNull() & learnable("k") & F.col(text_col).isNotNull()).distinct()
           .withColumn("salt", salt).withColumn("r", near).where(F.col("r") <= PER_LANGUAGE)
           .withColumn("r", rank).where(F.col("r") <= PER_LANGUAGE)
           .orderBy("r", "h", "k").limit(SAMPLE).select("k", F.col("lang").alias("l")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    texts = (rows.where("lang IS NOT NULL AND text IS NOT NULL")
             .join(F.broadcast(ids), (F.col("id") == F.col("k")) & (F.col("lang") == F.col("l")))
             .groupBy("k", "lang").agg(F.min("text").alias("text")))

    def run(batches):
        for b in batches:
            lang, data = [], []
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                places = {max(0, (len(raw) - SPAN) * i // (CUTS - 1)) for i in range(CUTS)} if raw else ()
                for at in sorted(places):
                    lang.append(name)
                    data.append(raw[at:at + SPAN])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(data, pa.binary())], names=["lang", "data"])

    return texts.select("lang", "text").mapInArrow(run, "lang string, data binary")


def train(docs: DataFrame, **columns: str) -> Network:
    """A network for the languages of the sample; without any, one that answers ``und``."""
    ship(docs.sparkSession)
    rows = sorted((r["lang"], bytes(r["data"])) for r in training_windows(docs, **columns).toLocalIterator())
    languages = sorted({r[0] for r in rows})
    net = Network(languages)
    if len(languages) > 1:
        windows = np.zeros((len(rows), SPAN), np.uint8)
        for i, (_, x) in enumerate(rows):
            windows[i, :len(x)] = np.frombuffer(x, np.uint8)
        net.fit(windows, np.array([languages.index(r[0]) for r in rows]))
    return net


def identify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs``. Null texts and texts without a letter
    are ``und`` with score 0; repeated rows are labelled alike; an empty table gives no rows."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            lang, score = net.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify_documents(docs: DataFrame) -> DataFrame:
    out = identify(docs, train(docs))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
