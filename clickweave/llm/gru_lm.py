"""Scores of a gated recurrent language model.

The model is a GRU in numpy with a class-factored softmax: a token's
probability is that of its class times that of the token within the class. Its
vocabulary is the most frequent training words, the end of a text, and a fixed
number of types of all other words (by their last letters); within its type a
word has its smoothed unigram probability, so every text has a probability.

Corpus counts cover all training documents. Training starts with a bounded
sample in one task; then every task trains a copy on all its training
documents by truncated backpropagation, and the copies are averaged by the
tokens they saw. Scoring carries the state across windows from the first word
of a document to its end.

Words above a count reach the workers as a dictionary of bounded size. The
occurrences of the others meet their counts in a join.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.session import materialize

END = ""
CLASSES, PER_CLASS, HIDDEN, EMBEDDED, WORD_TYPES = 32, 64, 12, 12, 64
VOCABULARY = CLASSES * PER_CLASS
SMOOTH = 0.1

Params = dict[str, np.ndarray]


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only


def word_type(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % WORD_TYPES


# --- the network -------------------------------------------------------------


def first_params(unigram: np.ndarray, seed: int = 11, units: int | None = None, classes: int | None = None) -> Params:
    """Random weights; the output's biases are the unigram distribution."""
    rng = np.random.default_rng(seed)
    hidden, embedded, classes = units or HIDDEN, units or EMBEDDED, classes or CLASSES
    by_class = unigram.reshape(classes, -1)
    mass = by_class.sum(1)

    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

    return {
        "embed": (0.3 * rng.standard_normal((len(unigram), embedded))).astype(np.float32),
        "into": normal(embedded, 3 * hidden),
        "bias": np.zeros(3 * hidden, np.float32),
        "back": normal(hidden, 3 * hidden),
        "to_class": (0.1 * normal(hidden, classes)),
        "class_bias": np.log(mass + 1e-9).astype(np.float32),
        "to_word": (0.1 * rng.standard_normal((classes, hidden, by_class.shape[1])) / math.sqrt(hidden)).astype(np.float32),
        "word_bias": np.log(by_class / (mass[:, None] + 1e-30) + 1e-9).astype(np.float32),
    }


def _softmax(x: np.ndarray, target: np.ndarray, weight: np.ndarray | None):
    """Log probabilities of the targets under the columns of ``x`` ([choices, tokens], overwritten);
    with ``weight``, the gradient of minus their weighted sum by ``x`` as well."""
    at = np.arange(len(target))
    x -= x.max(0)
    picked = x[target, at]
    np.exp(x, out=x)
    total = x.sum(0)
    logs = picked - np.log(total)
    if weight is None:
        return logs, None
    x *= weight / total
    x[target, at] -= weight
    return logs, x


def _sorted(ids: np.ndarray) -> np.ndarray:
    """The stable order of ids; 16 bits are sorted by their digits."""
    return np.argsort(ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids, kind="stable")


def _by_lane(x: np.ndarray) -> np.ndarray:
    return x.transpose(0, 2, 1)


def forward(p: Params, read: np.ndarray, start: np.ndarray, state: np.ndarray):
    """States of a window: ``read`` and ``start`` are [steps, lanes]; a start empties the state first.

    Inside, lanes come last, so that every gate is one contiguous block."""
    steps, lanes = read.shape
    h = len(p["back"])
    x = p["embed"][read.ravel()].reshape(steps, lanes, -1)
    # a gate is tanh(half its input) / 2 + 1/2: the halves are taken before the steps
    half = np.r_[np.full(2 * h, 0.5, np.float32), np.ones(h, np.float32)]
    gates_in = np.matmul((p["into"] * half).T, _by_lane(x))
    gates_in += (p["bias"] * half)[:, None]
    into_back = np.ascontiguousarray((p["back"] * half).T)
    before, zr, new, back_n, after = (np.empty((steps, n, lanes), np.float32) for n in (h, 2 * h, h, h, h))
    back = np.empty((3 * h, lanes), np.float32)
    starts = start.any(1)
    state = state.T
    for t in range(steps):
        before[t] = np.where(start[t], np.float32(0), state) if starts[t] else state
        np.matmul(into_back, before[t], out=back)
        gate, n, state = zr[t], new[t], after[t]
        np.add(gates_in[t, : 2 * h], back[: 2 * h], out=gate)
        np.tanh(gate, out=gate)
        gate *= np.float32(0.5)
        gate += np.float32(0.5)
        back_n[t] = back[2 * h :]
        np.multiply(gate[h:], back[2 * h :], out=n)
        n += gates_in[t, 2 * h :]
        np.tanh(n, out=n)
        np.subtract(before[t], n, out=state)
        state *= gate[:h]
        state += n
    return _by_lane(after), (x, before, zr, new, back_n)


def log_probs(p: Params, states: np.ndarray, target: np.ndarray, grads: Params | None = None, weight: np.ndarray | None = None):
    """Natural log probabilities of the targets ([tokens]); with ``grads``,
    adds the gradients of minus their weighted sum and returns that of the
    states as well."""
    classes, per_class = p["word_bias"].shape
    order = _sorted(target // per_class)  # tokens of one class lie together
    of_class, of_word = np.divmod(target[order], per_class)
    ends = np.searchsorted(of_class, np.arange(classes + 1))
    states = states[order]
    weight = None if grads is None else weight[order]
    x = np.matmul(p["to_class"].T, states.T)
    x += p["class_bias"][:, None]
    logs, d = _softmax(x, of_class, weight)
    d_states = None
    if grads is not None:
        grads["to_class"] += (d @ states).T
        grads["class_bias"] += d.sum(1)
        d_states = d.T @ p["to_class"].T
    for c in np.flatnonzero(np.diff(ends)):
        part = slice(ends[c], ends[c + 1])
        s = states[part]
        x = np.matmul(p["to_word"][c].T, s.T)
        x += p["word_bias"][c][:, None]
        more, d = _softmax(x, of_word[part], None if weight is None else weight[part])
        logs[part] += more
        if grads is not None:
            grads["to_word"][c] += (d @ s).T
            grads["word_bias"][c] += d.sum(1)
            d_states[part] += d.T @ p["to_word"][c].T
    out = np.empty(len(target), np.float32)
    out[order] = logs
    if grads is None:
        return out, None
    d_out = np.empty_like(d_states)
    d_out[order] = d_states
    return out, d_out


def backward(p: Params, grads: Params, read: np.ndarray, start: np.ndarray, kept, d_after: np.ndarray) -> None:
    """Backpropagation through the window's steps, no further."""
    x, before, zr, new, back_n = kept
    steps, h, lanes = before.shape
    d_after = np.ascontiguousarray(_by_lane(d_after))
    z, r = zr[:, :h], zr[:, h:]
    by_n, by_z, by_r = (1 - z) * (1 - new * new), (before - new) * z * (1 - z), back_n * r * (1 - r)
    d_in, d_back = (np.empty((steps, 3 * h, lanes), np.float32) for _ in range(2))
    carried = np.zeros((h, lanes), np.float32)
    starts = start.any(1)
    for t in range(steps - 1, -1, -1):
        carried += d_after[t]
        own, own_back = d_in[t], d_back[t]
        np.multiply(carried, by_z[t], out=own[:h])
        d_n = np.multiply(carried, by_n[t], out=own[2 * h :])
        np.multiply(d_n, by_r[t], out=own[h : 2 * h])
        own_back[: 2 * h] = own[: 2 * h]
        np.multiply(d_n, r[t], out=own_back[2 * h :])
        carried *= z[t]
        carried += p["back"] @ own_back
        if starts[t]:
            carried *= ~start[t]
    grads["back"] += np.matmul(before, _by_lane(d_back)).sum(0)
    grads["into"] += np.matmul(_by_lane(x), _by_lane(d_in)).sum(0)
    grads["bias"] += d_in.sum((0, 2))
    d_x, words = np.matmul(_by_lane(d_in), p["into"].T).reshape(steps * lanes, -1), read.ravel()
    order = _sorted(words)
    firsts = np.flatnonzero(np.r_[True, np.diff(words[order]) > 0])
    grads["embed"][words[order][firsts]] += np.add.reduceat(d_x[order], firsts, axis=0)


class Lanes(NamedTuple):
    """Texts laid behind each other in lanes of like length, longest lane
    first. The lanes stand behind each other in flat arrays of one entry a
    token, so memory follows the tokens, not the longest text times the lanes;
    one more entry stands for the places behind a lane's end."""

    first: np.ndarray  #: where each lane begins
    length: np.ndarray  #: tokens of each lane
    reads: np.ndarray
    follows: np.ndarray
    starts: np.ndarray  #: whether a text starts
    text: np.ndarray  #: which text it is, -1 behind a lane's end


def lanes_of(texts: list[np.ndarray], width: int, end_id: int) -> Lanes:
    """``texts`` in at most ``width`` lanes; before its first word a text reads ``end_id``."""
    width = max(1, min(width, len(texts)))
    lanes: list[list[int]] = [[] for _ in range(width)]
    free = [(0, i) for i in range(width)]
    for k in sorted(range(len(texts)), key=lambda k: (-len(texts[k]), k)):
        used, i = heapq.heappop(free)
        lanes[i].append(k)
        heapq.heappush(free, (used + len(texts[k]), i))
    length = np.zeros(width, np.int64)
    for used, i in free:
        length[i] = used
    order = sorted(range(width), key=lambda i: (-length[i], i))
    length = length[order]
    of = np.array([k for i in order for k in lanes[i]], np.int32)
    sizes = np.array([len(texts[k]) for k in of], np.int64)
    follows = np.concatenate([*(texts[k] for k in of), np.zeros(1, np.int32)]).astype(np.int32, copy=False)
    text = np.append(np.repeat(of, sizes), np.int32(-1))
    starts = np.zeros(len(text), bool)
    starts[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    reads = np.roll(follows, 1)
    reads[starts] = end_id
    reads[-1] = 0
    return Lanes(np.cumsum(length) - length, length, reads, follows, starts, text)


def windows(texts: list[np.ndarray], width: int, steps: int, end_id: int):
    """Windows of the lanes: reads, follows, starts, text, lanes still alive.
    Each is gathered when its turn comes."""
    lanes = lanes_of(texts, width, end_id)
    behind = len(lanes.text) - 1
    for at in range(0, int(lanes.length[0]), steps):
        n = int((lanes.length > at).sum())
        step = np.arange(at, min(at + steps, int(lanes.length[0])))[:, None]
        where = np.where(step < lanes.length[:n], lanes.first[:n] + step, behind)
        yield lanes.reads[where], lanes.follows[where], lanes.starts[where], lanes.text[where], n


class Adam:
    def __init__(self, params: Params, rate: float):
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}
        self.t, self.rate = 0, rate

    def step(self, params: Params, grads: Params) -> None:
        self.t += 1
        fix = self.rate * math.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g * g - v)
            params[k] -= np.float32(fix) * m / (np.sqrt(v) + np.float32(1e-6))


def train_texts(params: Params, adam: Adam, texts: list[np.ndarray], end_id: int, width: int, steps: int) -> int:
    """One pass over the texts; returns the tokens seen."""
    seen = 0
    if not texts:
        return seen
    state = np.zeros((min(width, len(texts)), len(params["back"])), np.float32)
    for reads, follows, starts, text, n in windows(texts, width, steps, end_id):
        after, kept = forward(params, reads, starts, state[:n])
        real = text.ravel() >= 0
        total = int(real.sum())
        grads = {k: np.zeros_like(v) for k, v in params.items()}
        weight = real.astype(np.float32) / max(total, 1)
        _, d = log_probs(params, after.reshape(-1, after.shape[2]), follows.ravel(), grads, weight)
        backward(params, grads, reads, starts, kept, d.reshape(after.shape))
        size = math.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        if size > 1:
            grads = {k: g / np.float32(size) for k, g in grads.items()}
        adam.step(params, grads)
        state = after[-1]
        seen += total
    return seen


def score_texts(params: Params, texts: list[np.ndarray], end_id: int, width: int, steps: int) -> np.ndarray:
    """Natural log probability of each text's tokens."""
    out = np.zeros(len(texts))
    if not texts:
        return out
    state = np.zeros((min(width, len(texts)), len(params["back"])), np.float32)
    for reads, follows, starts, text, n in windows(texts, width, steps, end_id):
        after, _ = forward(params, reads, starts, state[:n])
        real = text.ravel() >= 0
        logs, _ = log_probs(params, after.reshape(-1, after.shape[2])[real], follows.ravel()[real])
        out += np.bincount(text.ravel()[real], logs, len(texts))
        state = after[-1]
    return out


# --- on Spark ----------------------------------------------------------------


def count_words(docs: DataFrame, flush: int = 500_000) -> DataFrame:
    """``word``, ``n`` over the texts of ``docs`` (doc_id, text); the end of a text is the word ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = [w.decode() for w in counts]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(1):
                counts.update(tokens_of(text.as_py()))
                if len(counts) >= flush:
                    yield rows()
                    counts.clear()
            counts[b""] += batch.num_rows
        if counts:
            yield rows()

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The words above the lowest count (a power of 2^(1/8)) that at most ``most`` words reach."""
    octave = F.floor(F.log2("n") * 8)
    sizes = {r["o"]: r["n"] for r in counts.groupBy(octave.alias("o")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = max(sizes, default=0) + 1, 0
    for o in sorted(sizes, reverse=True):
        if held + sizes[o] > most:
            break
        least, held = o, held + sizes[o]
    rows = counts.filter(octave >= least).collect()
    return sorted(((r["word"], r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


def _pack(params: Params) -> bytes:
    return b"".join(params[k].astype(np.float32).tobytes() for k in sorted(params))


def _unpack(data: bytes, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size * 4
        out[k] = np.frombuffer(data[at : at + n], np.float32).reshape(like[k].shape).copy()
        at += n
    return out


def score_documents(
    docs: DataFrame,
    held_out: Column,
    frequent_words: int = 1 << 18,
    warm_docs: int = 400,
    warm_passes: int = 3,
    rate: float = 0.005,
    lanes: int = 512,
    steps: int = 32,
    units: int = HIDDEN,
    vocabulary: int = VOCABULARY,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    each row of ``docs`` (``doc_id``, ``text``).

    Learns from the rows for which ``held_out`` (an expression of doc_id) is
    false, and scores all of them, whole. Null and empty texts are an end
    alone. base_score: log10 probability under smoothed unigram counts; score:
    under the model. Without training rows both are 0. Repeated rows count and
    are returned each; null doc_ids stay null. Other columns are not read. An
    empty table gives an empty table. A worker holds a batch's tokens, whatever
    the length of a text. Every task trains on its own rows and the copies are
    averaged, so scores depend on how the input is split into tasks; counts and
    base scores do not.

    Bounded, whatever the corpus: ``vocabulary`` outputs, ``units`` hidden and
    embedded units, ``frequent_words`` words in the workers' dictionary,
    ``warm_docs`` documents (first by hash of their ids) for the common start
    of training. Of the outputs one is the end of a text and 64 are types;
    the most frequent words have the others. The network predicts any other
    word as its type alone, times its unigram probability within the type, so
    the larger a corpus's vocabulary, the more ``vocabulary`` leaves to that.
    """
    if units < 1 or vocabulary < WORD_TYPES + 1:
        raise ValueError(f"units must be at least 1 and vocabulary at least {WORD_TYPES + 1}")
    classes = max(1, round(math.sqrt(vocabulary / 2)))
    outputs = classes * -(-vocabulary // classes)  # classes of one size; places behind the vocabulary stay unused
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("string"))
    training = texts.filter(~held_out)
    counts = materialize(count_words(training), "word_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).collect()[0]
    n_all, v_all = int(total["n"]), int(total["v"])

    words = counts.filter(F.col("word") != END)
    frequent = _frequent(words, frequent_words)
    type_of = F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)) % WORD_TYPES
    by_type = {r["t"]: (r["n"], r["v"]) for r in words.groupBy(type_of.alias("t")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    type_n, type_v = (np.array([by_type.get(t, (0, 0))[i] for t in range(WORD_TYPES)], float) for i in (0, 1))
    chosen = frequent[: vocabulary - WORD_TYPES - 1]
    for w, n in chosen:
        t = word_type(w.encode())
        type_n[t] -= n
        type_v[t] -= 1
    n_ends = n_all - int(sum(by_type[t][0] for t in by_type))
    # Ids by falling count, so that classes hold words of like frequency.
    entries = [("end", 0, n_ends), *(("type", t, type_n[t]) for t in range(WORD_TYPES)), *(("word", i, n) for i, (_, n) in enumerate(chosen))]
    entries.sort(key=lambda e: (-e[2], e[0], e[1]))
    ids = {(kind, i): at for at, (kind, i, _) in enumerate(entries)}
    unigram = np.zeros(outputs)
    unigram[: len(entries)] = [n + SMOOTH for _, _, n in entries]
    end_id = ids["end", 0]
    type_ids = np.array([ids["type", t] for t in range(WORD_TYPES)], np.int32)
    word_ids = np.array([ids["word", i] if i < len(chosen) else type_ids[word_type(w.encode())] for i, (w, _) in enumerate(frequent)], np.int32)
    log_count = np.log10(np.array([n for _, n in frequent], float) + SMOOTH)
    log_type = np.log10(type_n + SMOOTH * (type_v + 1))
    types = np.array([word_type(w.encode()) for w, _ in frequent], np.int32)
    in_vocabulary = len(chosen)
    sent = spark.sparkContext.broadcast([w.encode() for w, _ in frequent])  # at most frequent_words

    def dictionary() -> dict[bytes, int]:
        return {w: i for i, w in enumerate(sent.value)}

    id_type = np.uint16 if outputs <= 1 << 16 else np.int32

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dictionary()
        names = ["row", "doc_id", "n_tokens", "n_known", "logs", "oov_logs", "ids", "rare"]
        for batch in batches:
            columns, rare_words, rare_uses, ends = [[] for _ in range(5)], [], [], [0]
            for text in batch.column(2):
                tokens = tokens_of(text.as_py())
                found = np.fromiter(map(known.get, tokens, repeat(-1)), np.int32, len(tokens))
                missing = np.flatnonzero(found < 0)
                others = [tokens[k] for k in missing.tolist()]
                other_types = np.fromiter(map(word_type, others), np.int32, len(others))
                ids = np.full(len(tokens) + 1, end_id, id_type)
                if len(word_ids):
                    ids[:-1] = word_ids[found]
                ids[missing] = type_ids[other_types]
                held = found[found >= 0]
                outside = held[held >= in_vocabulary]
                logs = float(log_count[held].sum()) if len(held) else 0.0
                oov = float(log_count[outside].sum() - log_type[types[outside]].sum()) if len(outside) else 0.0
                oov -= float(log_type[other_types].sum())
                for column, value in zip(columns, (len(tokens) + 1, len(held), logs, oov, ids.tobytes())):
                    column.append(value)
                uses = Counter(others)
                rare_words += [w.decode() for w in uses]
                rare_uses += uses.values()
                ends.append(len(rare_words))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            listed = pa.StructArray.from_arrays([pa.array(rare_words, pa.string()), pa.array(rare_uses, pa.int64())], names=["word", "uses"])
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns, kinds), rare], names=names)

    doc_type = texts.schema["doc_id"].dataType.simpleString()
    numbers = f"row long, doc_id {doc_type}, n_tokens long, n_known long, logs double, oov_logs double"

    def encoded_of(rows: DataFrame) -> DataFrame:
        numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        return numbered.mapInArrow(encode, f"{numbers}, ids binary, rare array<struct<word:string,uses:bigint>>")

    def read(ids: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x.as_py(), id_type) for x in ids]

    # words are looked up once; training and scoring read their ids
    encoded = materialize(encoded_of(texts), "encoded_texts")

    start = first_params(unigram / unigram.sum(), units=units, classes=classes)
    train_schema = "tokens long, params binary"

    def trainer(params_now: bytes, passes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            params, seen = _unpack(params_now, start), 0
            adam = Adam(params, rate)
            for batch in batches:
                texts_read = read(batch.column(0))
                for _ in range(passes):
                    seen += train_texts(params, adam, texts_read, end_id, lanes, steps)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([_pack(params)], pa.binary())], names=["tokens", "params"])

        return run

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, added = 0, 0.0
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                added, seen = added + n * np.frombuffer(data.as_py(), np.float32).astype(float), seen + n
        if seen:
            mean = (added / seen).astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([mean], pa.binary())], names=["tokens", "params"])

    params = _pack(start)
    if n_all:
        # hashes below this leave about twice as many documents as wanted, so few rows meet in the last step
        share = min(1.0, (2 * warm_docs + 100) / n_ends)
        low = training.filter(F.xxhash64("doc_id") <= int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else F.lit(True))
        few = low.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(warm_docs).coalesce(1)
        params = encoded_of(few).select("ids").mapInArrow(trainer(params, warm_passes), train_schema).collect()[0]["params"]
        copies = materialize(encoded.filter(~held_out).select("ids").mapInArrow(trainer(params, 1), train_schema), "model_copies")
        means = copies.repartition(16).mapInArrow(average, train_schema).collect()  # 16 models at most
        seen = sum(r["tokens"] for r in means)
        params = sum(r["tokens"] / seen * np.frombuffer(r["params"], np.float32).astype(float) for r in means).astype(np.float32).tobytes()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unpack(params, start)
        for batch in batches:
            logs10 = score_texts(model, read(batch.column(6)), end_id, lanes, steps) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(logs10)], names=[*batch.schema.names[:6], "model"])

    scored = materialize(encoded.drop("rare").mapInArrow(score, f"{numbers}, model double"), "scored_texts")
    uses = encoded.select("row", F.inline("rare"))
    counted = uses.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("uses") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("rare_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("uses")).otherwise(0)).alias("rare_known"),
    )
    whole = math.log10(n_all + SMOOTH * (v_all + 1))
    end_log = math.log10(n_ends + SMOOTH)
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    base = F.col("logs") + rare_logs + end_log - F.col("n_tokens") * whole
    model_score = F.col("model") + F.col("oov_logs") + rare_logs
    return scored.join(counted, "row", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + (1 if n_ends else 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (model_score if n_all else F.lit(0.0)).alias("score"),
    )
