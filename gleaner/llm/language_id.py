"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text forwards and backwards and gives every byte position a distribution over the
languages and "none of them"; a document's probabilities are the mean over all of its positions. A text is read in windows
of ``CORE`` bytes, cut at character starts, with ``CONTEXT`` bytes before and after them that warm the states up and are
not counted. Texts of up to ``CORE`` bytes are read in one piece, and no position is left out or counted twice.

It is trained in numpy by backpropagation through time on the driver, from a bounded sample: ``SPANS_PER_DOC`` spans of
``SPAN`` bytes of the ``DOCS_PER_LABEL`` distinct texts of lowest hash of each language. "None of them" is learned from
spans whose letters are shuffled, random letters, and letters of scripts drawn at random, so that what the network never
saw does not have to be one of the languages. The weights are a few kilobytes and travel with the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS_PER_LABEL = 400
SPANS_PER_DOC, SPAN = 4, 96
# Spans of no language, as a share of the others.
NOISE_SHARE = 0.5
HIDDEN = 8
CORE, CONTEXT = 384, 32
EPOCHS = 4
BATCH = 128
# Small samples are gone through more often.
LEAST_STEPS = 400
WINDOWS_AT_ONCE = 2048
GROUP_BYTES = 2 << 20
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def fresh_weights(labels: int, hidden: int = HIDDEN, seed: int = 7) -> dict[str, np.ndarray]:
    """``xd`` (byte to gates: reset, update, candidate), ``hd`` (state to gates), ``bd`` per direction, and the output."""
    rng = np.random.default_rng(seed)
    out = {}
    for d in "fb":
        out[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        out[f"h{d}"] = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32)
        out[f"b{d}"] = np.zeros(3 * hidden, np.float32)
    out["o"] = rng.normal(0, 0.3, (2 * hidden, labels)).astype(np.float32)
    out["c"] = np.zeros(labels, np.float32)
    return out


def _scan(weights: dict, d: str, codes: np.ndarray, mask: np.ndarray, keep: bool):
    """States of one direction for (word, position); padded positions leave the state as it is."""
    n, length = codes.shape
    hidden = weights["hf"].shape[0]
    state = np.zeros((n, hidden), np.float32)
    states = np.zeros((n, length, hidden), np.float32)
    trace = []
    steps = range(length) if d == "f" else range(length - 1, -1, -1)
    for t in steps:
        x = weights[f"x{d}"][codes[:, t]] + weights[f"b{d}"]
        h = state @ weights[f"h{d}"][:, :2 * hidden]
        gates = _sigmoid(x[:, :2 * hidden] + h)
        reset, update = gates[:, :hidden], gates[:, hidden:]
        inner = state @ weights[f"h{d}"][:, 2 * hidden:]
        fresh = np.tanh(x[:, 2 * hidden:] + reset * inner)
        on = mask[:, t, None]
        new = np.where(on, update * state + (1 - update) * fresh, state)
        if keep:
            trace.append((t, state, reset, update, inner, fresh))
        state = new
        states[:, t] = state
    return states, trace


def _outputs(weights: dict, codes: np.ndarray, mask: np.ndarray, keep: bool = False):
    forward, f_trace = _scan(weights, "f", codes, mask, keep)
    backward, b_trace = _scan(weights, "b", codes, mask, keep)
    both = np.concatenate([forward, backward], 2)
    scores = both @ weights["o"] + weights["c"]
    scores -= scores.max(2, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(2, keepdims=True)
    return scores, both, f_trace, b_trace


def gradients(weights: dict, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray):
    """Mean cross entropy over the positions, and its gradient by backpropagation through time."""
    hidden = weights["hf"].shape[0]
    probs, both, f_trace, b_trace = _outputs(weights, codes, mask, True)
    count = mask.sum()
    picked = np.take_along_axis(probs, labels[:, None, None], 2)[:, :, 0]
    loss = float(-(np.log(picked + 1e-12) * mask).sum() / count)
    delta = probs.copy()
    np.put_along_axis(delta, np.broadcast_to(labels[:, None, None], (*codes.shape, 1)), picked[:, :, None] - 1, 2)
    delta *= mask[:, :, None] / count
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    grads["o"] = np.einsum("nth,ntl->hl", both, delta)
    grads["c"] = delta.sum((0, 1))
    back = delta @ weights["o"].T
    for d, trace, out in (("f", f_trace, back[:, :, :hidden]), ("b", b_trace, back[:, :, hidden:])):
        later = np.zeros((len(codes), hidden), delta.dtype)
        wh = weights[f"h{d}"]
        # What reaches the gates at each position; weights that all positions share get their sums in one go afterwards.
        at_input = np.empty((codes.shape[1], len(codes), 3 * hidden), delta.dtype)
        at_state = np.empty_like(at_input)
        before = np.empty((codes.shape[1], len(codes), hidden), delta.dtype)
        for t, state, reset, update, inner, fresh in reversed(trace):
            whole = out[:, t] + later
            on = mask[:, t, None]
            here = whole * on
            d_fresh = here * (1 - update) * (1 - fresh * fresh)
            gate = at_input[t]
            gate[:, :hidden] = d_fresh * inner * reset * (1 - reset)
            gate[:, hidden:2 * hidden] = here * (state - fresh) * update * (1 - update)
            gate[:, 2 * hidden:] = d_fresh
            at_state[t] = gate
            at_state[t, :, 2 * hidden:] *= reset
            before[t] = state
            later = whole * ~on + here * update + at_state[t] @ wh.T
        grads[f"h{d}"] += before.reshape(-1, hidden).T @ at_state.reshape(-1, 3 * hidden)
        flat = at_input.reshape(-1, 3 * hidden)
        grads[f"b{d}"] += flat.sum(0)
        read = codes.T.ravel()
        order = np.argsort(read, kind="stable")
        values, first = np.unique(read[order], return_index=True)
        grads[f"x{d}"][values] += np.add.reduceat(flat[order], first)
    return loss, grads


def _matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    length = max(map(len, parts))
    codes = np.zeros((len(parts), length), np.uint8)
    mask = np.zeros((len(parts), length), bool)
    for i, p in enumerate(parts):
        codes[i, :len(p)] = np.frombuffer(p, np.uint8)
        mask[i, :len(p)] = True
    return codes, mask


def noise(spans: list[bytes], count: int, seed: int = 11) -> list[bytes]:
    """Spans of no language: shuffled letters of real ones, random letters, and random letters of other scripts."""
    rng = np.random.default_rng(seed)
    small = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    # First code point and number of letters of some scripts.
    scripts = ((0x391, 56), (0x410, 64), (0x5D0, 27), (0x620, 42), (0x904, 53), (0xE01, 46), (0x3041, 83), (0x4E00, 20000), (0xAC00, 11000))
    out = []
    for i in range(count):
        kind = i % 3
        if kind == 0 and spans:
            text = list(spans[int(rng.integers(len(spans)))].decode("utf-8", "ignore"))
            rng.shuffle(text)
            out.append("".join(text).encode())
            continue
        if kind == 1:
            codes = small[rng.integers(0, len(small), SPAN)]
            codes[rng.random(SPAN) < rng.choice([0.0, 0.1, 0.2])] = 32
            out.append(codes.tobytes())
            continue
        first, size = scripts[int(rng.integers(len(scripts)))]
        letters = "".join(chr(first + int(c)) for c in rng.integers(0, size, SPAN // 2))
        out.append(" ".join(letters[j:j + 5] for j in range(0, len(letters), 5)).encode()[:SPAN])
    return out


def train(spans: list[bytes], labels: list[int], n_labels: int, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Fit the network with Adam on (span, label) pairs; the last of ``n_labels`` + 1 outputs is no language."""
    others = noise(spans, int(len(spans) * NOISE_SHARE))
    parts = [(p, y) for p, y in [*zip(spans, labels), *[(p, n_labels) for p in others]] if p]
    rng = np.random.default_rng(seed)
    weights = fresh_weights(n_labels + 1, seed=seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    per_epoch = max(1, -(-len(parts) // BATCH))
    epochs = max(epochs, -(-LEAST_STEPS // per_epoch))
    step, rounds = 0, epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(parts))
        order = order[np.argsort([len(parts[i][0]) for i in order], kind="stable")]
        batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
        for b in rng.permutation(len(batches)):
            codes, mask = _matrix([parts[i][0] for i in batches[b]])
            _, grads = gradients(weights, codes, mask, np.array([parts[i][1] for i in batches[b]]))
            step += 1
            rate = 0.02 * (1 - (step - 1) / rounds)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-12))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                weights[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return weights


def windows(data: np.ndarray, start: int, end: int) -> list[tuple[int, int, int, int]]:
    """(window start, core start, core end, window end) of the text at data[start:end]; cores begin with a character."""
    cuts = [start]
    while end - cuts[-1] > CORE:
        cut = cuts[-1] + CORE
        while cut > cuts[-1] + 1 and data[cut] & 0xC0 == 0x80:
            cut -= 1
        cuts.append(cut)
    cuts.append(end)
    return [(max(start, a - CONTEXT), a, b, min(end, b + CONTEXT)) for a, b in zip(cuts, cuts[1:]) if b > a]


class Reader:
    """Pooled probabilities of texts; the network's forward passes over many windows at once."""

    def __init__(self, weights: dict):
        h = self.hidden = len(weights["hf"])
        self.tables = {}
        for d in "fb":
            # Reset and update are sigmoids, of which half of the sum goes into tanh; each gate has its own arrays.
            x, recur = weights[f"x{d}"] + weights[f"b{d}"], weights[f"h{d}"]
            self.tables[d] = [(np.ascontiguousarray(x[:, i * h:(i + 1) * h] * f), np.ascontiguousarray(recur[:, i * h:(i + 1) * h] * f))
                              for i, f in enumerate(np.float32([0.5, 0.5, 1.0]))]
        self.out = [np.ascontiguousarray(weights["o"][:h]), np.ascontiguousarray(weights["o"][h:])]
        self.shift = weights["c"]

    def _step(self, d: str, codes: np.ndarray, state: np.ndarray, room: list[np.ndarray]) -> None:
        """The next state in place."""
        held = []
        for (table, recur), own, other in zip(self.tables[d], room[:3], room[3:]):
            np.take(table, codes, axis=0, out=own, mode="clip")
            np.matmul(state, recur, out=other)
            held.append(own)
        for own, other in zip(room[:2], room[3:5]):
            own += other
            np.tanh(own, out=own)
            own += 1
            own *= 0.5
        reset, update, fresh = held
        reset *= room[5]
        fresh += reset
        np.tanh(fresh, out=fresh)
        state -= fresh
        state *= update
        state += fresh

    def _sums(self, data: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """Sum over the core positions of each window's probabilities."""
        starts, lengths = chunk[:, 0], chunk[:, 3] - chunk[:, 0]
        core_from, core_to = chunk[:, 1] - starts, chunk[:, 2] - starts
        length = int(lengths.max())
        codes = data[np.minimum(starts[None, :] + np.arange(length)[:, None], len(data) - 1)]
        n, shortest = len(chunk), int(lengths.min())
        room = [np.empty((n, self.hidden), np.float32) for _ in range(6)]
        forward = np.empty((length, n, self.hidden), np.float32)
        state = np.zeros((n, self.hidden), np.float32)
        for t in range(length):
            self._step("f", codes[t], state, room)
            forward[t] = state
        total = np.zeros((n, len(self.shift)), np.float64)
        state = np.zeros((n, self.hidden), np.float32)
        for t in range(length - 1, -1, -1):
            self._step("b", codes[t], state, room)
            if t >= shortest:
                state[lengths <= t] = 0
            scores = forward[t] @ self.out[0]
            scores += state @ self.out[1]
            scores += self.shift
            np.exp(scores, out=scores)
            scores *= (((core_from <= t) & (t < core_to)) / scores.sum(1))[:, None]
            total += scores
        return total

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text (zeros for an empty one); the last column is no language."""
        out = np.zeros((len(texts), len(self.shift)))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_BYTES):
                size += len(texts[end])
                end += 1
            data = np.frombuffer(b"".join(texts[at:end]), np.uint8)
            places, owners, start = [], [], 0
            for i in range(at, end):
                found = windows(data, start, start + len(texts[i]))
                places += found
                owners += [i] * len(found)
                start += len(texts[i])
            if places:
                places, owners = np.array(places), np.array(owners)
                order = np.argsort(places[:, 3] - places[:, 0], kind="stable")
                for a in range(0, len(order), WINDOWS_AT_ONCE):
                    part = order[a:a + WINDOWS_AT_ONCE]
                    np.add.at(out, owners[part], self._sums(data, places[part]))
            at = end
        sizes = np.array([max(1, len(t)) for t in texts])
        return out / sizes[:, None]


def _sample_spans(per_doc: int):
    """Label, text digest and span of the chosen spans; a task gives each text of a label once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            labels, digests, spans = [], [], []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                whole = text.encode()
                digest = xxhash.xxh128_digest(whole)
                if (label, digest) in seen:
                    continue
                seen.add((label, digest))
                # Spans at hashed places of the whole text, which begin and end with a character.
                room = max(1, len(whole) - SPAN + 1)
                found = {}
                for i in range(per_doc):
                    at = xxhash.xxh64_intdigest(digest, i) % room
                    found[whole[at:at + SPAN].decode("utf-8", "ignore").encode()] = None
                spans += found
                labels += [label] * len(found)
                digests += [digest] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.string()), pa.array(digests, pa.binary()), pa.array(spans, pa.binary())],
                names=["label", "digest", "span"])

    return run


def lowest_digests(rows: DataFrame, group: str, digest: str, n: int) -> DataFrame:
    """The ``n`` lowest distinct digests (hexadecimal) of each group.

    A first pass estimates how many there are, so that only about 4 * n of a group are ranked, whatever its size.
    """
    sizes = rows.groupBy(group).agg(F.approx_count_distinct(digest).alias("size"))
    top = float(1 << 60)
    bound = F.least(F.lit(top), F.lit(4.0 * n * top) / F.greatest(F.col("size"), F.lit(1)))
    low = F.conv(F.substring(digest, 1, 15), 16, 10).cast("double") <= bound
    few = rows.join(F.broadcast(sizes), group).where(low).select(group, digest).distinct()
    order = Window.partitionBy(group).orderBy(digest)
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rank")


def learn(docs: DataFrame, label_col: str = "lang", text_col: str = "text",
          docs_per_label: int = DOCS_PER_LABEL, spans_per_doc: int = SPANS_PER_DOC) -> tuple[list[str], dict] | None:
    """Train on a bounded sample of the labelled rows; None if there is nothing to learn from."""
    usable = docs.where(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    labels = sorted(r["label"] for r in usable.select("label").distinct().collect())
    if not labels:
        return None
    # Only labels and digests are ranked; the texts of the chosen digests are joined back, and copies give the same spans.
    tagged = usable.withColumn("digest", F.sha2("text", 256))
    chosen = lowest_digests(tagged.select("label", "digest"), "label", "digest", docs_per_label)
    rows = tagged.join(F.broadcast(chosen), ["label", "digest"])
    found = rows.select("label", "text").mapInArrow(
        _sample_spans(spans_per_doc), "label string, digest binary, span binary").distinct().collect()
    found = sorted((bytes(r["span"]), r["label"]) for r in found)
    place = {y: i for i, y in enumerate(labels)}
    return labels, train([w for w, _ in found], [place[y] for _, y in found], len(labels))


# A language's least score: this quantile of the scores of right answers on rows it was not learned from, and no more than
# ENOUGH, which is half as probable again as all else together.
SCORE_QUANTILE, ENOUGH = 0.005, 0.6


def least_scores(judged: DataFrame, label_col: str, names: tuple[str, str] = ("lang_pred", "score")) -> dict[str, float]:
    """By language the score below which an answer is none, from judged rows that were held out of the sample.

    Scores are counted in thousandths, so the quantile is exact on these, the same in every run, and only a thousand
    counts of a language reach the driver. A language without a right answer is not among the keys.
    """
    right = judged.where(F.col(names[0]) == F.col(label_col).cast("string"))
    counts = right.groupBy(F.col(names[0]).alias("label"), F.floor(F.col(names[1]) * 1000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    found: dict[str, list[tuple[int, int]]] = {}
    for r in counts.collect():
        found.setdefault(r["label"], []).append((r["k"], r["n"]))
    least = {}
    for label, pairs in found.items():
        left = int(SCORE_QUANTILE * sum(n for _, n in pairs))
        for k, n in sorted(pairs):
            if left < n:
                least[label] = min(k / 1000, ENOUGH)
                break
            left -= n
    return least


def _predict(labels: list[str], weights: dict, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(weights)
        for batch in batches:
            letters = batch.column("letters").to_pylist()
            texts = [t if on else b"" for t, on in zip(batch.column("body").cast(pa.binary()).to_pylist(), letters)]
            probs = reader(texts)[:, :len(labels)]
            best = probs.argmax(1)
            names = [labels[b] if on else UNKNOWN for b, on in zip(best, letters)]
            score = np.where(letters, probs[np.arange(len(best)), best], 0.0)
            own = [f"k{i}" for i in range(kept)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in own], pa.array(names, pa.string()),
                 pa.array(np.clip(score, 0, 1), pa.float64())], names=[*own, "label", "score"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], dict] | None, keep: list[Column], text_col: str = "text",
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``keep`` columns of every row, its predicted language and the pooled probability of that language.

    What the languages' probabilities lack to one is the probability that it is none of them.

    A text that is null or has no letter gets ``und`` with score 0, and so does every text if there is no model.
    Ties go to the first language in order; repeated rows get equal answers; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = docs.select(*keep)
    own = [f"k{i}" for i in range(len(keep))]
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias(names[0]), F.lit(0.0).alias(names[1]))
    rows = docs.select(*[c.alias(k) for c, k in zip(keep, own)], text.alias("body"), text.rlike(r"\p{L}").alias("letters"))
    labels, weights = model
    schema = T.StructType([*[T.StructField(k, f.dataType) for k, f in zip(own, kept.schema.fields)],
                           T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
    found = rows.mapInArrow(_predict(labels, weights, len(keep)), schema)
    return found.select(*[F.col(k).alias(f.name) for k, f in zip(own, kept.schema.fields)],
                        F.col("label").alias(names[0]), F.col("score").alias(names[1]))
