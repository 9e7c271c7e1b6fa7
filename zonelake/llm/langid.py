"""Language ID by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled rows and
then labels every byte position of every whole text; the position probabilities are averaged per document.

* Texts are read in consecutive windows of ``WINDOW`` bytes that together cover the whole text; the state
  starts anew in each window, so memory is bounded for texts of any length.
* Gates are piecewise linear (hard sigmoid, hard tanh): exact to differentiate and cheap to evaluate.
* Sample: per language the ``PER_LANG`` training rows with the smallest hash of their id, up to ``PIECES``
  evenly spaced windows of each.  These bounds are parameters and do not grow with the input.  Rows are
  for training if ``crc32(id as text) % 4 != 2``, lang and text are not null.

Defined results: ``und`` with score 0 if the text is null or has no letter (``\\p{L}``), and for every row
if nothing could be learned; a null id is neither held out nor learned from; repeated rows are all
returned; an empty table gives an empty result; lang, source and id are never inputs of a prediction;
ties between languages go to the first in alphabetical order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import bound_batches, fresh, load

WINDOW, UNITS = 128, 8
PER_LANG, PIECES = 400, 6
EPOCHS, BATCH, RATE = 12, 256, 0.02
WINDOWS_AT_ONCE = 2048
UND = "und"
LEAST_SCORE, LIFT = 0.3, 1.2  # a text in two or three of the languages reaches this


# --- network -----------------------------------------------------------------------------
# Direction 0 reads a window forwards, direction 1 backwards; byte tables of both are stacked, so byte b
# of direction 1 is row 256 + b.  Per step: z, r = gates; n = candidate; h <- h + z * (n - h).

def new_network(langs: list[str], units: int = UNITS, seed: int = 11) -> dict:
    rng = np.random.default_rng(seed)
    w = {f"E{g}": rng.normal(0, 0.3, (512, units)) for g in "zrn"}
    w |= {f"U{g}": rng.normal(0, 0.3, (2, units, units)) for g in "zrn"}
    w |= {"O": rng.normal(0, 0.3, (2, units, len(langs))), "b": np.zeros(len(langs))}
    w["Ez"] += 0.3
    w["Er"] += 0.5
    return {"langs": langs, **{k: v.astype(np.float32) for k, v in w.items()}}


def _steps(windows: np.ndarray) -> np.ndarray:
    """Byte-table rows (step, direction, window)."""
    at = np.empty((windows.shape[1], 2, len(windows)), np.intp)
    at[:, 0] = windows.T
    at[:, 1] = windows.T[::-1]
    at[:, 1] += 256
    return at


def position_probabilities(net: dict, windows: np.ndarray) -> np.ndarray:
    """Probabilities (language, position, window) of every byte position."""
    at = _steps(windows)
    length, _, n = at.shape
    shape = (2, n, net["Uz"].shape[1])
    h, out = np.zeros(shape, np.float32), net["O"].transpose(0, 2, 1).copy()
    x, z, r, c = (np.empty(shape, np.float32) for _ in range(4))
    logits = np.empty((length, 2, out.shape[1], n), np.float32)
    for t in range(length):
        for gate, u in (("z", z), ("r", r), ("n", c)):
            np.matmul(h, net["U" + gate], out=u)
        np.take(net["Ez"], at[t], axis=0, out=x, mode="clip")
        z += x
        np.clip(z, 0, 1, out=z)
        np.take(net["Er"], at[t], axis=0, out=x, mode="clip")
        r += x
        np.clip(r, 0, 1, out=r)
        c *= r
        np.take(net["En"], at[t], axis=0, out=x, mode="clip")
        c += x
        np.clip(c, -1, 1, out=c)
        c -= h
        c *= z
        h += c
        np.matmul(out, h.transpose(0, 2, 1), out=logits[t])
    total = logits[:, 0]
    total += logits[::-1, 1]
    total += net["b"][:, None]
    np.clip(total, -30, 30, out=total)
    np.exp(total, out=total)
    total /= sum(total[:, k] for k in range(total.shape[1]))[:, None]
    return total.transpose(1, 0, 2)


def _gradients(net: dict, windows: np.ndarray, used: np.ndarray, label: np.ndarray) -> tuple[dict, float]:
    """Backpropagation through time of the mean cross entropy of the used positions."""
    at = _steps(windows)
    length, _, n = at.shape
    units = net["Uz"].shape[1]
    h = np.zeros((length + 1, 2, n, units), np.float32)
    kept = []
    for t in range(length):
        az = h[t] @ net["Uz"] + net["Ez"][at[t]]
        ar = h[t] @ net["Ur"] + net["Er"][at[t]]
        un = h[t] @ net["Un"]
        z, r = np.clip(az, 0, 1), np.clip(ar, 0, 1)
        an = r * un + net["En"][at[t]]
        c = np.clip(an, -1, 1)
        h[t + 1] = h[t] + z * (c - h[t])
        kept.append((az, ar, an, un, z, r, c))
    logits = h[1:, 0] @ net["O"][0] + (h[1:, 1] @ net["O"][1])[::-1] + net["b"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    weight = (used.T / used.sum()).astype(np.float32)
    loss = -float((weight * np.log(np.maximum(p[:, np.arange(n), label], 1e-9))).sum())
    p[:, np.arange(n), label] -= 1
    d_out = p * weight[:, :, None]
    grad = {k: np.zeros_like(v) for k, v in net.items() if k != "langs"}
    grad["b"] = d_out.sum(axis=(0, 1))
    d_dir = (d_out, d_out[::-1])
    for d in (0, 1):
        grad["O"][d] = np.einsum("tnu,tnc->uc", h[1:, d], d_dir[d], optimize=True)
    back = np.zeros((2, n, units), np.float32)
    for t in range(length - 1, -1, -1):
        az, ar, an, un, z, r, c = kept[t]
        back = back + np.stack([d_dir[d][t] @ net["O"][d].T for d in (0, 1)])
        d_z = back * (c - h[t]) * ((az > 0) & (az < 1))
        d_n = back * z * ((an > -1) & (an < 1))
        d_r = d_n * un * ((ar > 0) & (ar < 1))
        d_un = d_n * r
        back = back * (1 - z)
        for gate, d_in, d_pre in (("z", d_z, d_z), ("r", d_r, d_r), ("n", d_n, d_un)):
            rows = at[t].ravel()
            flat = d_in.reshape(-1, units)
            for u in range(units):
                grad["E" + gate][:, u] += np.bincount(rows, flat[:, u], 512)
            grad["U" + gate] += h[t].transpose(0, 2, 1) @ d_pre
            back = back + d_pre @ net["U" + gate].transpose(0, 2, 1)
    return grad, loss


def train(net: dict, windows: np.ndarray, used: np.ndarray, label: np.ndarray, epochs: int = EPOCHS,
          batch: int = BATCH, rate: float = RATE, seed: int = 5) -> list[float]:
    """Adam over shuffled batches; changes ``net`` in place and returns the loss of each epoch."""
    rng, step, losses = np.random.default_rng(seed), 0, []
    names = [k for k in net if k != "langs"]
    first, second = ({k: np.zeros_like(net[k]) for k in names} for _ in range(2))
    for epoch in range(epochs):
        order, total = rng.permutation(len(windows)), 0.0
        for i in range(0, len(order), batch):
            part = order[i:i + batch]
            grad, loss = _gradients(net, windows[part], used[part], label[part])
            total += loss * len(part)
            step += 1
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            pace = rate * (1 - 0.9 * epoch / epochs)
            for k in names:
                g = grad[k] * min(1.0, 1.0 / max(size, 1e-9))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                net[k] -= pace * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
        losses.append(total / max(1, len(order)))
    return losses


# --- windows and pooling -----------------------------------------------------------------

def cut_windows(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts as windows: bytes (window, position), used bytes per window, index of the text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // window)
    rows = np.zeros((int(counts.sum()), window), np.uint8)
    starts = np.cumsum(counts) - counts
    flat = rows.reshape(-1)
    for i, t in enumerate(texts):
        flat[starts[i] * window:starts[i] * window + len(t)] = np.frombuffer(t, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    used = np.minimum(window, sizes[owner] - (np.arange(len(rows)) - starts[owner]) * window)
    return rows, used, owner


def pooled(net: dict, texts: list[bytes]) -> np.ndarray:
    """Mean position probabilities (text, language); zeros for an empty text."""
    rows, used, owner = cut_windows(texts)
    sums = np.zeros((len(texts), len(net["langs"])))
    position = np.arange(rows.shape[1])[:, None]
    for i in range(0, len(rows), WINDOWS_AT_ONCE):
        part = slice(i, i + WINDOWS_AT_ONCE)
        p = position_probabilities(net, rows[part])
        if (used[part] < rows.shape[1]).any():
            p = p * (position < used[part])
        whole = p.sum(axis=1)
        for k in range(len(sums[0])):
            sums[:, k] += np.bincount(owner[part], whole[k], len(texts))
    return sums / np.maximum(1, [len(t) for t in texts])[:, None]


# --- operator ----------------------------------------------------------------------------

def held_out(id_col: str):
    """True for the rows kept from training; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_pieces(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
                    per_lang: int = PER_LANG, pieces: int = PIECES) -> list[tuple[str, list[str]]]:
    """The bounded labelled sample: (lang, windows of the text), ``per_lang`` rows of each language at most."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"),
                       F.col(lang_col).cast("string").alias("l"))
    rows = rows.where(F.col("i").isNotNull() & F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out("i"))
    # a share of the ids by hash first: about four times the rows wanted of a language reach its ranking
    share = rows.groupBy("l").agg(F.least(F.lit(1.0), 4.0 * per_lang / F.count(F.lit(1))).alias("share"))
    # one row per language, as many as the network has outputs
    few = rows.select("i", "l").join(F.broadcast(share), "l").where(F.abs(F.xxhash64("i") / 2.0**63) <= F.col("share"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.abs(F.xxhash64("i") / 2.0**63), "i"))
    picked = few.withColumn("k", rank).where(F.col("k") <= per_lang).select("i", "l").distinct()
    size = F.char_length("t")
    cut = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)),
                      lambda k: F.col("t").substr((size * k / pieces).cast("int") + 1, F.lit(WINDOW)))
    chosen = rows.join(F.broadcast(picked), ["i", "l"]).groupBy("l", "i").agg(F.min(cut).alias("cut"))
    return [(r.l, [p for p in r.cut if p]) for r in chosen.orderBy("l", F.xxhash64("i"), "i").collect()]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          epochs: int = EPOCHS) -> dict | None:
    """The trained network, or None if there is no labelled row to learn from."""
    sample = [(lang, p.encode()[:WINDOW]) for lang, cuts in training_pieces(docs, id_col, text_col, lang_col)
              for p in dict.fromkeys(cuts)]
    if not sample:
        return None
    langs = sorted({lang for lang, _ in sample})
    rows, used, owner = cut_windows([p for _, p in sample])
    label = np.array([langs.index(lang) for lang, _ in sample])[owner]
    count = np.bincount(label, minlength=len(langs))
    weight = (count.sum() / len(langs) / count)[label]  # every language weighs the same
    net = new_network(langs)
    train(net, rows, (np.arange(WINDOW) < used[:, None]) * weight[:, None], label, epochs)
    return net


def has_letter(text_col: str):
    return F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))


def with_language(docs: DataFrame, net: dict | None, text_col: str, lang_out: str, score_out: str) -> DataFrame:
    """``docs`` with the predicted language and its score; reads nothing but the text."""
    bound_batches(docs.sparkSession)
    (both,) = fresh(docs, "predicted")
    if net is None:
        return docs.withColumns({lang_out: F.lit(UND), score_out: F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        p = pooled(net, [(t or "").encode() for t in texts])
        best = p.argmax(axis=1)
        return pd.DataFrame({"lang": [net["langs"][k] for k in best], "score": np.clip(p.max(axis=1), 0, 1)})

    known = has_letter(text_col)
    named = docs.withColumn(both, predict(F.col(text_col).cast("string")))
    return named.withColumns({
        lang_out: F.when(known, F.col(both)["lang"]).otherwise(F.lit(UND)),
        score_out: F.when(known, F.col(both)["score"]).otherwise(F.lit(0.0))}).drop(both)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score."""
    net = learn(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return with_language(rows, net, "text", "lang_pred", "score").drop("text")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    least_score: float = LEAST_SCORE, languages: list[str] | None = None) -> DataFrame:
    """``docs`` without the rows that have no letter, whose score is under ``least_score`` (with many languages:
    under ``LIFT`` times that of a uniform guess) or whose language is not in ``languages`` (default: all
    learned).  If nothing could be learned every row with a letter stays.  All columns unchanged."""
    net = learn(docs, id_col, text_col, lang_col)
    if net is None:
        return docs.where(has_letter(text_col))
    lang, score = fresh(docs, "lang", "score")
    named = with_language(docs, net, text_col, lang, score)
    stays = (F.col(lang) != UND) & (F.col(score) >= min(least_score, LIFT / len(net["langs"])))
    if languages is not None:
        stays &= F.col(lang).isin(list(languages))
    return named.where(stays).drop(lang, score)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    return identify(load(spark, sf_dir, "documents"))
