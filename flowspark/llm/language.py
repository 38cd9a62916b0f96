"""Language of code-switched text by a linear-chain conditional random field over words.

A word is a run of letters. Its features are hashed affixes (2 to 4 bytes at either end), byte trigrams with the word's
edges, and the word itself (the learned lexicon); a transition matrix is learned with them. Forward-backward gives every
word's probability of each language; a document's language is the one with most expected letters and its score that share.

The model is fitted on at most `MAX_DOCS` documents, some hundreds of each language first: from each, two stretches of words drawn anywhere in the text are
joined with stretches of other documents, so that transitions between languages occur in the fitting data. Prediction
covers every whole text; the chain runs over blocks of `BLOCK` words, so a text of any length takes bounded memory.

Defined results: a null text, an empty one and one without letters are `und` with score 0; with no language to learn from
everything is `und`; ties go to the first language in order; null ids are not held out but are not learned from;
repeated rows get equal results. An empty table gives an empty table. Language, source and id are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.labelled import bounded_sample, held_out, named, one_each
from flowspark.llm.toxicity import lowered
from flowspark.llm.words import BASE, IS_LETTER, SLICE, held_powers, inverse, mixed, slices, spans

MAX_DOCS = 8_000
STRETCH = 24
BLOCK = 128
BITS = 17
EPOCHS = 6
AFFIXES = (2, 3, 4)
UND = "und"


def padded(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters, everything else a blank, a blank around each text; word spans and their text numbers."""
    low = lowered(data)
    low[~IS_LETTER[low]] = 32
    low = np.insert(low, ends, 32)
    shifted = ends + np.arange(len(ends))
    first, last = spans(low, np.array([0, len(low)]), IS_LETTER)
    return low, np.stack([first, last]), np.searchsorted(shifted, first, "right") - 1


def features(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram index at every byte, and words x (affixes, word) indices; index 2**BITS stands for no feature."""
    first, last = span
    shift = np.uint64(64 - BITS)
    wide = low.astype(np.uint64)
    tri = np.full(len(low), 1 << BITS, np.int64)
    if len(low) > 2:
        tri[:-2] = (mixed((wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]) >> shift).astype(np.int64)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((wide + np.uint64(1)) * held_powers(BASE, len(low)), out=total[1:])
    back = held_powers(inverse(BASE), len(low) + 1)

    def piece(a: np.ndarray, b: np.ndarray, tag: int, fits: np.ndarray) -> np.ndarray:
        h = mixed(((total[b] - total[a]) * back[a] + np.uint64(tag)) * np.uint64(0xCA5A826395121157))
        return np.where(fits, (h >> shift).astype(np.int64), 1 << BITS)

    columns = [piece(first, last, 1, np.ones(len(first), bool))]
    for size in AFFIXES:
        fits = last - first >= size
        columns.append(piece(first, np.minimum(first + size, last), 10 + size, fits))
        columns.append(piece(np.maximum(last - size, first), last, 20 + size, fits))
    return tri, np.stack(columns, 1)


@dataclass
class Tagger:
    """weights: (2**BITS + 1) x languages, the last row zero; moves: log transition weights."""

    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, low: np.ndarray, span: np.ndarray) -> np.ndarray:
        """Words x languages, in runs of words of about a slice."""
        out = np.empty((span.shape[1], len(self.languages)))
        i = 0
        while i < span.shape[1]:
            a = int(span[0, i]) - 1
            j = max(i + 1, int(np.searchsorted(span[1], a + SLICE, "right")))
            part = span[:, i:j] - a
            tri, whole = features(low[a:int(span[1, j - 1]) + 1], part)
            total = np.zeros((len(tri) + 1, len(self.languages)))
            np.cumsum(self.weights[tri], axis=0, out=total[1:])
            out[i:j] = total[np.maximum(part[1] - 1, part[0])] - total[part[0] - 1] + self.weights[whole].sum(1)
            i = j
        return out

    def marginals(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """Forward-backward over sequences at starts of the given sizes: word marginals, log partition sum, expected moves."""
        n, steps = len(self.languages), int(sizes.max())
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        live = np.searchsorted(-sizes, -np.arange(steps), "left")  # sequences longer than t come first
        move = np.exp(self.moves)
        peak = scores.max(1)
        e = np.exp(scores - peak[:, None])
        ahead, norm = np.zeros_like(scores), np.ones(len(scores))
        for t in range(steps):
            at = starts[:live[t]] + t
            x = e[at] * (ahead[at - 1] @ move if t else 1.0)
            norm[at] = x.sum(1)
            ahead[at] = x / norm[at][:, None]
        post, moved = np.zeros_like(scores), np.zeros((n, n))
        behind = np.ones((len(starts), n))
        for t in range(steps - 1, -1, -1):
            m = live[t]
            at = starts[:m] + t
            post[at] = ahead[at] * behind[:m]
            post[at] /= post[at].sum(1, keepdims=True)
            if t:
                right = e[at] * behind[:m] / norm[at][:, None]
                moved += (ahead[at - 1].T @ right) * move
                behind[:m] = right @ move.T
        return post, float(np.log(norm).sum() + peak.sum()), moved

    def shares(self, column: pa.Array) -> np.ndarray:
        """Texts x languages: share of the expected letters; rows of zeros where there is no letter."""
        out = np.zeros((len(column), len(self.languages)))
        for i, j, data, ends in slices(column):
            low, span, owner = padded(data, ends)
            if not span.shape[1]:
                continue
            post, _, _ = self.marginals(self.emissions(low, span), *_blocks(owner))
            weight = (span[1] - span[0]).astype(float)
            for c in range(out.shape[1]):
                out[i:j, c] = np.bincount(owner, post[:, c] * weight, minlength=j - i)
        total = out.sum(1, keepdims=True)
        return np.divide(out, total, out=np.zeros_like(out), where=total > 0)


def _blocks(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of at most BLOCK words of one text."""
    head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    size = np.diff(np.r_[head, len(owner)])
    many = -(-size // BLOCK)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    starts = np.repeat(head, many) + nth * BLOCK
    return starts, np.minimum(BLOCK, np.repeat(head + size, many) - starts)


def fit(stretches: list[str], tags: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 1) -> Tagger:
    """Conditional likelihood by adaptive gradient steps over sequences of three stretches each, in random order."""
    rng = np.random.default_rng(seed)
    n = len(languages)
    model = Tagger(languages, np.zeros(((1 << BITS) + 1, n)), np.zeros((n, n)))
    ends = np.cumsum([0, *(len(s.encode()) for s in stretches)])
    low, span, owner = padded(np.frombuffer("".join(stretches).encode(), np.uint8), ends)
    if not span.shape[1]:
        return model
    cuts = np.searchsorted(owner, np.arange(len(stretches) + 1))
    tri, whole = features(low, span) if len(low) < SLICE else _joined_features(low, span)
    seen_w, seen_m = np.full_like(model.weights, 1e-2), np.full_like(model.moves, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(stretches))
        for at in range(0, len(order), 300):
            chosen = order[at:at + 300]
            words = np.concatenate([np.arange(cuts[s], cuts[s + 1]) for s in chosen])
            if not len(words):
                continue
            label = np.repeat(tags[chosen], np.diff(cuts)[chosen])
            group = np.repeat(np.arange(len(chosen)) // 3, np.diff(cuts)[chosen])
            starts, sizes = _blocks(group)
            length = span[1, words] - span[0, words]
            base = np.repeat(span[0, words] - 1 - np.cumsum(length) + length, length) + np.arange(length.sum())
            word_of = np.concatenate([np.repeat(np.arange(len(words)), length), np.repeat(np.arange(len(words)), whole.shape[1])])
            index = np.concatenate([tri[base], whole[words].ravel()])
            scores = np.stack([np.bincount(word_of, model.weights[index, c], minlength=len(words)) for c in range(n)], 1)
            post, _, moved = model.marginals(scores, starts, sizes)
            slope = -post
            slope[np.arange(len(words)), label] += 1
            inner = np.ones(len(words), bool)
            inner[starts] = False
            right = np.flatnonzero(inner)
            true = np.zeros((n, n))
            np.add.at(true, (label[right - 1], label[right]), 1)
            used, where = np.unique(index, return_inverse=True)
            g = np.stack([np.bincount(where, slope[word_of, c], minlength=len(used)) for c in range(n)], 1) - 0.02 * model.weights[used]
            seen_w[used] += g * g
            model.weights[used] += 0.3 * g / np.sqrt(seen_w[used])
            m = true - moved - 0.1 * model.moves
            seen_m += m * m
            model.moves += 0.1 * m / np.sqrt(seen_m)
            model.weights[-1] = 0
    return model


def _joined_features(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """features over a longer buffer, run by run."""
    tri, whole, i = np.full(len(low), 1 << BITS, np.int64), [], 0
    while i < span.shape[1]:
        a = int(span[0, i]) - 1
        j = max(i + 1, int(np.searchsorted(span[1], a + SLICE, "right")))
        t, w = features(low[a:int(span[1, j - 1]) + 1], span[:, i:j] - a)
        tri[a:a + len(t)] = t
        whole.append(w)
        i = j
    return tri, np.concatenate(whole)


def learn(docs: DataFrame, max_docs: int = MAX_DOCS) -> Tagger:
    """Fit on at most max_docs documents with a language that are not held out. docs: doc_id, text, lang."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = bounded_sample(usable.select("doc_id", "lang"), max_docs, "lang").select("doc_id")

    @F.pandas_udf("array<string>")
    def stretches(text: pd.Series) -> pd.Series:
        out = []
        for t in text.fillna(""):
            words = t.split()
            rng = np.random.default_rng(len(t))
            starts = rng.integers(0, max(1, len(words) - STRETCH + 1), 2)
            out.append([" ".join(words[s:s + STRETCH]) for s in dict.fromkeys(starts.tolist())])
        return pd.Series(out)

    drawn = named(usable.select("doc_id", "text", "lang"), sample).select("doc_id", "lang", stretches("text").alias("drawn"))
    got = one_each(drawn).select("lang", F.explode("drawn").alias("stretch")).toPandas().sort_values(["lang", "stretch"])
    languages = sorted(set(got["lang"]))
    number = {name: i for i, name in enumerate(languages)}
    return fit(got["stretch"].tolist(), got["lang"].map(number).to_numpy(np.int64), languages)


def with_language(docs: DataFrame, model: Tagger, text_col: str = "text", out: str = "_language") -> DataFrame:
    """docs with a struct (lang_pred, score) of every whole text; no shuffle."""
    @F.pandas_udf("lang_pred string, score double")
    def judged(text: pd.Series) -> pd.DataFrame:
        lang, score = [UND] * len(text), np.zeros(len(text))
        if model.languages:
            share = model.shares(pa.array(text, pa.string()))
            for i, t in enumerate(text):
                if share[i].any() and any(c.isalpha() for c in t):
                    best = int(share[i].argmax())
                    lang[i], score[i] = model.languages[best], share[i, best]
        return pd.DataFrame({"lang_pred": lang, "score": np.clip(score, 0, 1)})

    return docs.withColumn(out, judged(F.col(f"`{text_col}`")))


def op6_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    judged = with_language(docs.select("doc_id", "text"), learn(docs))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_language.lang_pred").alias("lang_pred"),
                         F.col("_language.score").alias("score"))
