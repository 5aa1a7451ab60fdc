"""Language of a text by a byte convolutional network.

Bytes are folded into classes and embedded; filters of several widths slide
over fixed-length windows; each filter's largest answer in a window goes into a
softmax over the languages. The network is trained in numpy on windows of a
bounded sample of labelled texts, and applied to batches of windows that cover
every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name, mix, slices, utf8

#: Bytes of a window; windows overlap by the widest filter less one, so every run of bytes a filter can see is seen.
WINDOW = 192
WIDTHS, FILTERS, EMBED = (2, 3, 4), 24, 8
#: Bounds of the training sample: texts over all languages, windows of a text, and languages (the most frequent).
SAMPLE_TEXTS, WINDOWS_A_TEXT, MOST_LANGUAGES = 6_000, 2, 1024
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.004, 20240306
#: Windows shorter than this are only used where a text has no longer one.
SHORTEST = 12
UNKNOWN = "und"
#: Windows that one numpy pass works on.
PASS = 256

# Classes of bytes: 0 pads, 1 is everything that is no letter, 2 to 27 are the letters a to z in either case;
# bytes of letters beyond ASCII keep classes of their own.
_CLASS = np.ones(256, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = _CLASS[ord("A"):ord("Z") + 1] = np.arange(2, 28)
_CLASS[128:] = np.arange(28, 156)
CLASSES = 156


@dataclass
class Network:
    """Weights: byte embeddings, filters of each width with their biases, and the softmax layer."""

    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = SEED) -> Network:
        random = np.random.default_rng(seed)

        def some(*shape, scale):
            return (random.standard_normal(shape) * scale).astype(np.float32)

        return cls(languages, some(CLASSES, EMBED, scale=0.5),
                   [some(w * EMBED, FILTERS, scale=(2 / (w * EMBED)) ** 0.5) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   some(FILTERS * len(WIDTHS), len(languages), scale=0.1), np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.biases, self.out, self.out_bias]

    def _answers(self, windows: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, what its filters answer at each place of each window (biases left out)."""
        n, length = windows.shape
        embedded = self.embed[windows].reshape(n, length * EMBED)
        for width, filters in zip(WIDTHS, self.filters):
            seen = np.lib.stride_tricks.sliding_window_view(embedded, width * EMBED, axis=1)[:, ::EMBED]
            yield (seen.reshape(-1, width * EMBED) @ filters).reshape(n, length - width + 1, FILTERS)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Chance of each language for each window of byte classes."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), PASS):
            pooled = np.concatenate([a.max(axis=1) + b for a, b in zip(self._answers(windows[at:at + PASS]), self.biases)], axis=1)
            out[at:at + PASS] = _softmax(np.maximum(pooled, 0) @ self.out + self.out_bias)
        return out

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Cross-entropy of a batch and its gradient for each of :meth:`weights`."""
        tops, places = [], []
        for answers, bias in zip(self._answers(windows), self.biases):
            places.append(answers.argmax(axis=1))
            tops.append(np.take_along_axis(answers, places[-1][:, None], 1)[:, 0] + bias)
        pooled = np.concatenate(tops, axis=1)
        hidden = np.maximum(pooled, 0)
        chance = _softmax(hidden @ self.out + self.out_bias)
        n = len(windows)
        loss = -float(np.log(np.maximum(chance[np.arange(n), wanted], 1e-12)).mean())
        chance[np.arange(n), wanted] -= 1
        chance /= n
        back = (chance @ self.out.T) * (pooled > 0)
        embed = np.zeros_like(self.embed)
        filters, biases = [], []
        for i, (width, place) in enumerate(zip(WIDTHS, places)):
            mine = back[:, i * FILTERS:(i + 1) * FILTERS]
            # Only the bytes at each filter's largest answer have a gradient.
            at = place[:, :, None] + np.arange(width)
            bytes_ = windows[np.arange(n)[:, None, None], at]
            inputs = self.embed[bytes_].reshape(n, FILTERS, width * EMBED)
            filters.append(np.einsum("nf,nfk->kf", mine, inputs))
            biases.append(mine.sum(axis=0))
            spread = mine[:, :, None] * self.filters[i].T[None]
            np.add.at(embed, bytes_.reshape(-1), spread.reshape(-1, EMBED))
        embed[0] = 0
        return loss, [embed, *filters, *biases, hidden.T @ chance, chance.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def trained(network: Network, windows: np.ndarray, wanted: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Network:
    """``network`` after ``epochs`` passes of Adam over the windows; a rerun gives the same weights."""
    random = np.random.default_rng(seed)
    weights = network.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    network.embed[0] = 0
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(windows))
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            mine = order[at:at + BATCH]
            batch = windows[mine].copy()
            # Short texts must be told apart as well: half of the windows are cut to a random length.
            keep = np.where(random.random(len(batch)) < 0.5, random.integers(SHORTEST, WINDOW + 1, len(batch)), WINDOW)
            batch[np.arange(WINDOW) >= keep[:, None]] = 0
            _, slopes = network.gradients(batch, wanted[mine])
            step += 1
            for w, slope, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def windows_of(raw: np.ndarray, starts: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Byte classes of windows that cover every text, padded with zeros, and the text each window is of. Empty texts have none."""
    sizes = np.diff(starts)
    step = length - max(WIDTHS) + 1
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - length) // step)), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[:-1][text] + number * step
    at = begin[:, None] + np.arange(length)
    inside = at < starts[1:][text][:, None]
    classes = _CLASS[raw]
    return np.where(inside, classes[np.minimum(at, max(0, len(raw) - 1))], 0).astype(np.uint8), text


def has_letter(text: Column) -> Column:
    """Whether a text holds a letter of any script."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _sampled_windows(a_text: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch, "text"):
                raw, starts = utf8(part.column("text"))
                made, text = windows_of(raw, starts)
                if not len(made):
                    continue
                first = np.searchsorted(text, np.arange(part.num_rows))
                counts = np.diff(np.append(first, len(text)))
                picked = np.zeros(len(made), bool)
                chance = mix(np.asarray(part.column("pick")).astype(np.uint64)[:, None] + np.arange(a_text, dtype=np.uint64))
                some = counts > 0
                picked[(first[some, None] + (chance[some] % counts[some, None].astype(np.uint64)).astype(np.int64)).reshape(-1)] = True
                picked &= (made > 1).sum(axis=1) >= SHORTEST // 2
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(pa.array(text[picked])), pa.array([w.tobytes() for w in made[picked]], pa.binary())],
                    names=["lang", "window"])
    return run


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE_TEXTS, a_text: int = WINDOWS_A_TEXT,
          epochs: int = EPOCHS) -> Network | None:
    """A network for the languages of labelled texts; ``None`` where there are none with a letter.

    Rows with a null text or language teach nothing. At most ``sample``
    different texts are used, as many of each language as it has or its even
    share (at least one), and ``a_text`` windows of each, from anywhere in the
    text; which ones is decided by the text alone, so equal texts count once
    and a rerun gives the same network. Only the :data:`MOST_LANGUAGES` most
    frequent languages are learned (ties by name). Other columns are not read.
    """
    usable = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & has_letter(F.col("text")))
    keyed = usable.withColumn("pick", F.xxhash64("text"))
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("pick", 0.02).alias("n")).orderBy(
        F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return None
    share = max(1, sample // len(counts))
    # Texts whose hash is low enough: about twice a language's share, then exactly the lowest of them.
    limits = {r["lang"]: min(1.0, (2 * share + 20) / max(1, r["n"])) for r in counts}
    within = F.col("pick") <= F.element_at(F.create_map(*[F.lit(x) for k, v in limits.items() for x in (
        k, int(min(2**63 - 1, v * 2**64 - 2**63)))]), F.col("lang"))
    few = keyed.select("lang", "pick").where(within).distinct()
    lowest = few.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list("pick")), 1, share).alias("picks"))
    chosen = lowest.select("lang", F.explode("picks").alias("pick"))
    one = keyed.join(F.broadcast(chosen), ["lang", "pick"]).groupBy("lang", "pick").agg(F.min("text").alias("text"))
    rows = one.mapInArrow(_sampled_windows(a_text), "lang string, window binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], bytes(r["window"])))
    languages = sorted({r["lang"] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    windows = np.frombuffer(b"".join(bytes(r["window"]) for r in rows), np.uint8).reshape(len(rows), WINDOW)
    network = Network.fresh(languages)
    if len(languages) == 1:
        return network
    return trained(network, windows, np.array([number[r["lang"]] for r in rows]), epochs)


def text_chances(network: Network, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Chance of each language for each text: the mean over its windows, weighted by their letters; zeros for a text without windows."""
    out = np.zeros((len(starts) - 1, len(network.languages)))
    weight = np.zeros(len(starts) - 1)
    # Texts go on in runs of bounded numbers of windows; a text of many windows is added up over several runs.
    step = PASS * WINDOW
    at = 0
    while at < len(starts) - 1:
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + step, "right")) - 1)
        for low in range(int(starts[at]), max(int(starts[stop]), int(starts[at]) + 1), step):
            high = min(int(starts[stop]), low + step + max(WIDTHS) - 1)
            cut = np.clip(starts[at:stop + 1], low, high) - low
            windows, text = windows_of(raw[low:high], cut)
            if len(windows):
                letters = (windows > 1).sum(axis=1)
                chances = network.probabilities(windows) * letters[:, None]
                np.add.at(out, at + text, chances)
                np.add.at(weight, at + text, letters)
        at = stop
    return np.divide(out, weight[:, None], out=out, where=weight[:, None] > 0)


def predict(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, the language of each whole text and its chance.

    A text that is null, empty or holds no letter is ``und`` with score 0, and
    so is every text if nothing was learned. Ties go to the language first by
    name. Repeated rows get equal answers; a very long text is added up window
    by window; an empty table gives no rows. Columns called ``lang_pred`` or
    ``score`` are replaced; only the text is looked at.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    if network is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    letters = free_name(docs, "_letters")
    ready = docs.select(*kept, has_letter(F.col(text)).alias(letters))
    out = docs.select(*kept).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches):
        names = np.array(network.languages, object)
        for batch in batches:
            for part in slices(batch, text):
                columns = dict(zip(part.schema.names, part.columns))
                known = columns.pop(letters).to_numpy(zero_copy_only=False).astype(bool)
                chances = text_chances(network, *utf8(columns[text]))
                best = chances.argmax(axis=1)
                columns["lang_pred"] = pa.array(np.where(known, names[best], UNKNOWN).tolist(), pa.string())
                columns["score"] = pa.array(np.where(known, np.clip(chances[np.arange(len(best)), best], 0.0, 1.0), 0.0))
                yield pa.RecordBatch.from_pydict(columns)

    return ready.mapInArrow(run, out)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))
