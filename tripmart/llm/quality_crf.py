"""Quality rules by line sequence labelling: a linear-chain conditional random field.

Every line with a word is content or boilerplate. The lines of a document are a chain:
what a line looks like (symbols, capitals, digits, repeated words, its length and
ending, ``FEATURES``) and its neighbours' labels decide together.

1. Counting. One pass over the whole texts, in Arrow batches, counts words, symbols,
   repeated lines and repeated 8-word windows, and makes each line's features.
2. Fitting. Documents with a quality label are the training set: the lines of good ones
   count as content, of bad ones as boilerplate. At most ``SAMPLE`` labelled documents
   of at most ``LINES`` lines are used, those with the smallest hash of the id, so reruns
   agree; only their lines' features (8 bytes a line) reach the driver, where the
   likelihood is climbed for a fixed number of steps.
3. Labelling. Viterbi decoding gives each document its most likely chain of labels. The
   share of words in content lines decides: under ``SHARE`` the document goes.

Documents also go that fail the base rules: under ``MIN_WORDS`` words, or more than
``REPEATED`` per cent of the words inside 8-word windows that the text holds twice.

Defined cases: null text is the empty one, has no words and fails the base rules; a text
without lines has content share 0; labels that are null or of unknown documents teach
nothing; a document with two labels counts as bad; without labels of both kinds nothing can be
learned and all lines are content. Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import id_type, mix, read, slices
from tripmart.llm._grams import every_hash, prefix, text_buffer, word_bounds, word_hashes

SAMPLE, LINES = 4000, 512
STEPS, RATE, RIDGE = 150, 0.2, 1e-4
SHARE = 0.5
MIN_WORDS, REPEATED, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
SLICE = 1 << 21

FEATURES = (
    "always", "words <= 2", "words <= 5", "words <= 15", "words > 60", "symbols > 0", "symbols > 0.2 a word", "symbols > 1 a word",
    "capitals > 0.3 of the letters", "capitals > 0.8", "exclamation or question marks > 0.3 a word", "digits > 0.1 of the characters",
    "digits > 0.4", "words like the one before > 0.1", "words like the one before > 0.5", "equals another line", "ends a sentence",
    "starts with a capital", "words longer than 12 on average", "words shorter than 2.5 on average", "brackets and signs > 0.05",
    "first line", "last line")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


UPPER, LOWER, DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(97, 123))), _table(bytes(range(48, 58)))
SYMBOL, MARK, SIGN = _table(SYMBOLS), _table(b"!?"), _table(b"{}[]()=;/\\@_")
SPACE = _table(bytes([32, *range(9, 14)]))
CLOSE = _table(b".!?:\"'")
CHARACTER = ~_table(bytes(range(0x80, 0xC0)))         # bytes that start a code point


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of set flags between neighbouring cuts."""
    upto = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=upto[1:])
    return upto[cuts[1:]] - upto[cuts[:-1]]


def repeated_words(hashes: np.ndarray, woffs: np.ndarray) -> np.ndarray:
    """By document, words inside a window of ``WINDOW`` words that its text holds twice or more."""
    n = len(hashes) - WINDOW + 1
    docs = len(woffs) - 1
    if n < 1:
        return np.zeros(docs, np.int64)
    doc = np.repeat(np.arange(docs), np.diff(woffs))
    key = mix(every_hash(prefix(hashes), WINDOW) + doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    inside = doc[:n] == doc[WINDOW - 1:]
    at = np.flatnonzero(inside)
    o = at[np.argsort(key[at], kind="stable")]
    same = key[o][1:] == key[o][:-1]
    twice = np.zeros(n, bool)
    twice[o[1:][same]] = True
    twice[o[:-1][same]] = True
    step = np.zeros(len(hashes) + 1, np.int64)
    hit = np.flatnonzero(twice)
    step[hit] += 1
    np.add.at(step, hit + WINDOW, -1)
    return _sums(np.cumsum(step)[:-1] > 0, woffs)


def measure(texts: pa.Array):
    """Counts by document, features of the lines with a word (bits of an int), their words and
    the offsets of the documents among those lines, and all lines' byte bounds of these."""
    data, offs = text_buffer(texts)
    start, end, woffs = word_bounds(data, offs)
    hashes = word_hashes(data, start, end)
    in_word = ~SPACE[data]
    counts = {"n_words": np.diff(woffs), "word_chars": _sums(in_word & CHARACTER[data], offs), "n_symbols": _sums(SYMBOL[data], offs),
              "n_repeat_words": repeated_words(hashes, woffs)}
    # lines: cut at line feeds and between documents
    cuts = np.unique(np.concatenate([offs, np.flatnonzero(data == 10) + 1])) if len(data) else offs[:1]
    lo, hi = cuts[:-1], cuts[1:]
    wcut = np.searchsorted(start, cuts)
    words = np.diff(wcut)
    some = words > 0
    line_doc = np.searchsorted(offs, lo, side="right") - 1
    sums = {k: _sums(t[data], cuts) for k, t in (("up", UPPER), ("low", LOWER), ("digit", DIGIT), ("sym", SYMBOL), ("mark", MARK), ("sign", SIGN))}
    chars = np.maximum(_sums(in_word, cuts), 1)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[wcut[:-1][some]] = False
    again = _sums(again, wcut)
    # equal lines of one document, compared as bytes without the line feed
    raw = data.tobytes()
    seen, dup, twin = {}, np.zeros(len(offs) - 1, np.int64), np.zeros(len(lo), bool)
    for i in np.flatnonzero(some).tolist():
        e = hi[i] - 1 if raw[hi[i] - 1] == 10 else hi[i]
        key = (int(line_doc[i]), raw[lo[i]:e])
        j = seen.setdefault(key, i)
        if j != i:
            dup[key[0]] += 1
            twin[i] = twin[j] = True
    counts["n_dup_lines"] = dup
    at = np.flatnonzero(some)
    w = words[at]
    s = {k: v[at] for k, v in sums.items()}
    letters, chars = np.maximum(s["up"] + s["low"], 1), chars[at]
    first_byte, last_byte = data[start[wcut[at]]], data[end[wcut[at + 1] - 1] - 1]
    doc = line_doc[at]
    edge = np.append(True, doc[1:] != doc[:-1])[:len(doc)]
    flags = [np.ones(len(at), bool), w <= 2, w <= 5, w <= 15, w > 60, s["sym"] > 0, s["sym"] > 0.2 * w, s["sym"] > w,
             s["up"] > 0.3 * letters, s["up"] > 0.8 * letters, s["mark"] > 0.3 * w, s["digit"] > 0.1 * chars, s["digit"] > 0.4 * chars,
             again[at] > 0.1 * w, again[at] > 0.5 * w, twin[at], CLOSE[last_byte], UPPER[first_byte], chars > 12 * w, chars < 2.5 * w,
             s["sign"] > 0.05 * chars, edge, np.append(edge[1:], True)[:len(doc)]]
    bits = np.zeros(len(at), np.int64)
    for k, f in enumerate(flags):
        bits |= f.astype(np.int64) << k
    return counts, bits, w, np.searchsorted(doc, np.arange(len(offs))), (data, lo[at], hi[at])


# --------------------------------------------------------------------- field

@dataclass(frozen=True)
class Field:
    """Weights of the features for content (against boilerplate), and of neighbouring labels."""
    weights: np.ndarray
    step: np.ndarray          # [label, next label]

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return features(bits) @ self.weights


def features(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)


def _by_place(offs: np.ndarray):
    """Documents by falling length, and for each place the lines there of those long enough."""
    size = np.diff(offs)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    first, size = offs[:-1][order], size[order]
    return [first[:int(np.searchsorted(-size, -t))] + t for t in range(int(size[0]) if len(size) else 0)], first, size


def viterbi(score: np.ndarray, offs: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Most likely labels (1 content) of chains given by ``offs``: ``score`` favours content at a
    line, ``step`` two labels in a row. Ties go to content."""
    places, _, _ = _by_place(offs)
    label = np.zeros(len(score), np.int64)
    back = np.zeros((len(score), 2), np.int8)
    best = None
    for at in places:
        here = np.stack([np.zeros(len(at)), score[at]], axis=1)
        if best is None:
            best = here
        else:
            m = len(at)
            reach = best[:m, :, None] + step[None]               # [chain, label, next label]
            back[at] = reach[:, 1] >= reach[:, 0]
            best[:m] = reach.max(axis=1) + here
    if best is None:
        return label
    now = (best[:, 1] >= best[:, 0]).astype(np.int64)              # a chain's last scores stay in its row
    for at in reversed(places):
        m = len(at)
        label[at] = now[:m]
        now[:m] = back[at, now[:m]]
    return label


def fit(bits: np.ndarray, offs: np.ndarray, label: np.ndarray) -> Field:
    """Likelihood climbed in ``STEPS`` steps with a quadratic penalty, by forward and backward sums."""
    x, y = features(bits), label.astype(np.int64)
    places, _, size = _by_place(offs)
    n = max(len(y), 1)
    pairs = np.concatenate([np.stack([a[:len(b)], b]) for a, b in zip(places, places[1:], strict=False)] or [np.zeros((2, 0), np.int64)], axis=1)
    told = np.zeros((2, 2))
    np.add.at(told, (y[pairs[0]], y[pairs[1]]), 1)
    theta = np.zeros(len(FEATURES) + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, STEPS + 1):
        step = theta[-4:].reshape(2, 2)
        e = np.stack([np.zeros(len(y)), x @ theta[:-4]], axis=1)
        fore, aft = np.zeros((len(y), 2)), np.zeros((len(y), 2))
        for t, at in enumerate(places):
            fore[at] = e[at]
            if t:
                fore[at] += np.logaddexp.reduce(fore[places[t - 1][:len(at)]][:, :, None] + step[None], axis=1)
        for t in range(len(places) - 2, -1, -1):
            nxt = places[t + 1]
            aft[places[t][:len(nxt)]] = np.logaddexp.reduce(step[None] + (e[nxt] + aft[nxt])[:, None, :], axis=2)
        both = fore + aft
        total = np.logaddexp.reduce(both, axis=1)
        p1 = np.exp(both[:, 1] - total)
        a, b = pairs
        joint = np.exp(fore[a][:, :, None] + step[None] + (e[b] + aft[b])[:, None, :] - total[a][:, None, None]).sum(axis=0)
        grad = np.concatenate([x.T @ (y - p1), (told - joint).ravel()]) / n - RIDGE * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad ** 2
        theta = theta + RATE * (mean / (1 - 0.9 ** turn)) / (np.sqrt(square / (1 - 0.999 ** turn)) + 1e-8)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


ALL_CONTENT = Field(np.eye(len(FEATURES))[0], np.zeros((2, 2)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field:
    """The field learned from at most ``SAMPLE`` labelled documents; ``label_col``: 1 good, 0 bad."""
    known = (labels.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .filter("i is not null and y in (0, 1)").groupBy("i").agg(F.min("y").alias("y")))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # choose by id first: only the chosen texts are measured
    some = (rows.select("id").distinct().join(known, F.col("id") == F.col("i")).select("i", "y", F.xxhash64("i").alias("h"))
            .orderBy("h", "i").limit(SAMPLE))
    rows = rows.join(some, F.col("id") == F.col("i")).select("h", "y", "text")

    def scan(batches):
        for b in (b for whole in batches for b in slices(whole, 2, SLICE)):
            _, bits, _, offs, _ = measure(b.column(2))
            keep = np.flatnonzero((np.diff(offs) > 0) & (np.diff(offs) <= LINES))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep)),
                 pa.array([bits[offs[k]:offs[k + 1]] for k in keep.tolist()], pa.list_(pa.int64()))], ["h", "y", "bits"])

    got = rows.mapInArrow(scan, "h long, y int, bits array<long>").toPandas()
    got = sorted(zip(got["h"].tolist(), got["y"].tolist(), map(list, got["bits"]), strict=True))
    if len({y for _, y, _ in got}) < 2:
        return ALL_CONTENT
    size = np.array([len(b) for _, _, b in got])
    return fit(np.array([x for _, _, b in got for x in b], np.int64), np.append(0, np.cumsum(size)), np.repeat([y for _, y, _ in got], size))


# --------------------------------------------------------------------- whole

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: id, the counts (``COUNTS``), base_failed, n_lines (with a word), content_lines,
    content_share (of the words), kept and, with ``with_text``, the content lines joined by line feeds."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def scan(batches):
        for b in (b for whole in batches for b in slices(whole, 1, SLICE)):
            counts, bits, words, offs, (data, lo, hi) = measure(b.column(1))
            label = viterbi(field.scores(bits), offs, field.step)
            n = counts["n_words"]
            share = _sums_of(words * label, offs) / np.maximum(n, 1)
            failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEATED * n)
            cols = [b.column(0), *[pa.array(counts[c].astype(np.int64)) for c in COUNTS], pa.array(failed), pa.array(np.diff(offs).astype(np.int64)),
                    pa.array(_sums_of(label, offs)), pa.array(share), pa.array(~failed & (share >= SHARE))]
            if with_text:
                raw = data.tobytes()
                cols.append(pa.array([b"\n".join(raw[lo[i]:hi[i]].removesuffix(b"\n") for i in range(s, e) if label[i]).decode()
                                      for s, e in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, [*NAMES, "content"][:len(cols)])

    extra = ", content string" if with_text else ""
    return rows.mapInArrow(scan, f"id {id_type(rows)}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, n_lines long, "
                                 f"content_lines long, content_share double, kept boolean{extra}")


NAMES = ("id", *COUNTS, "base_failed", "n_lines", "content_lines", "content_share", "kept")


def _sums_of(x: np.ndarray, offs: np.ndarray) -> np.ndarray:
    upto = np.append(0, np.cumsum(x))
    return (upto[offs[1:]] - upto[offs[:-1]]).astype(np.int64)


def op13_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    field = train(docs, read(spark, sf_dir, "labels"))
    return quality(docs, field, with_text=False).withColumnRenamed("id", "doc_id")
