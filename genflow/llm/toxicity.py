"""Toxicity by a subsequence string kernel and a linear machine on Nyström landmarks.

A unit of text (a word, or single letters that stand apart) is compared with
others by its gapped subsequences of three characters, weighted by decay for
each character they span. Inserted or missing characters change few of them.
A sentence is a window of a few units; its features are their sum over the
root of their number. Landmarks span the feature space in which the support
vector machine is trained on labelled sentences: those of clean texts are
clean, and of a toxic text the sentences the machine finds most toxic are
toxic, which is settled anew in every round. The kernel is a product of
explicit features, so a trained machine is one weight per subsequence, looked
up by hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import mix, scratch, slices, whole, words

DECAY = 0.6
#: Characters that a subsequence may span; longer units are cut into overlapping windows.
SPAN, WINDOW, STEP = 7, 24, 12
FEATURE_BITS = 20
#: Bytes of text that one numpy pass works on: each takes some hundred bytes of arrays.
SLICE_BYTES = 1 << 19
#: The mark in front of a unit.
OPEN = 2
#: Units of a sentence.
SENTENCE = 2
#: Bounds of the training sample and of what the driver fits on: a sample's text gives two sentences at most.
SAMPLE_DOCS = 12_000
POSITIVE_UNITS, NEGATIVE_UNITS = 3_000, 6_000
POSITIVE_LANDMARKS, NEGATIVE_LANDMARKS, MOST_LANDMARKS = 200, 80, 450
#: Rounds of choosing the toxic texts' sentences and training on them; margin from which a sentence may be the reason of its text's label.
ROUNDS, PLAUSIBLE = 4, -0.5
#: Log odds from which a unit may be a sign of toxicity; the first of them that any unit reaches.
MIN_ODDS = (3.0, 2.0, 1.0)
#: Margin of a text without units of three characters.
NOTHING = -2.0
# Digits and signs that stand for letters.
LOOKS_LIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, and where each text starts."""
    lower = pc.fill_null(pc.utf8_lower(texts), "")
    sizes = pc.utf8_length(lower).to_numpy(zero_copy_only=False)
    joined = "".join(lower.to_pylist())
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


_FOLD = np.arange(128, dtype=np.uint32)
_LETTER = np.zeros(128, bool)
_LETTER[97:123] = True
for _sign, _letter in LOOKS_LIKE.items():
    _FOLD[ord(_sign)] = ord(_letter)


def units(code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of all units end to end, start of each unit with one more for the end, text of each unit).

    A unit is a run without white space, less everything but letters; a sign
    or digit that looks like a letter counts as one if letters stand on both
    sides of it. Neighbouring units of one letter are joined.
    """
    if not len(code):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64)
    low = np.minimum(code, 127)
    letter = np.where(code < 128, _LETTER[low], True) & (code != 0xA0) & ((code < 0x2000) | (code > 0x206F))
    space = (code <= 32) | (code == 0xA0) | ((code >= 0x2000) & (code <= 0x200A)) | (code == 0x3000)
    folded = np.where(code < 128, _FOLD[low], code)
    between = np.zeros(len(code), bool)
    between[1:-1] = letter[:-2] & letter[2:]
    edge = starts[(starts > 0) & (starts < len(code))]
    between[edge] = between[edge - 1] = False  # the neighbour is another text's
    keep = letter | (between & (folded != code))
    begins = np.zeros(len(code), np.int64)
    begins[1:] = space[:-1]
    begins[starts[1:-1][starts[1:-1] < len(code)]] = 1
    token = np.cumsum(begins)[keep]
    chars = folded[keep]
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[keep]
    if not len(chars):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    size = np.diff(np.append(first, len(chars)))
    owner = text[first]
    apart = np.ones(len(first), bool)
    apart[1:] = (size[1:] > 1) | (size[:-1] > 1) | (owner[1:] != owner[:-1])
    first, owner = first[apart], owner[apart]
    # Long units go as windows that overlap by half.
    size = np.diff(np.append(first, len(chars)))
    times = np.maximum(1, -(-(size - STEP) // STEP))
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    begin = np.repeat(first, times) + at * STEP
    end = np.minimum(begin + WINDOW, np.repeat(first + size, times))
    if (times > 1).any():
        take = np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin) + np.arange((end - begin).sum())
        chars = chars[take]
    edges = np.concatenate([[0], np.cumsum(end - begin)])
    return chars, edges, np.repeat(owner, times)


def opened(chars: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units with a mark in front of each, so that how a word begins is told from the same letters inside it."""
    return np.insert(chars, edges[:-1], OPEN), edges + np.arange(len(edges))


def subsequences(chars: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of gaps: (where a subsequence starts, its hash, its weight)."""
    stop = np.repeat(edges[1:], np.diff(edges))
    wide = chars.astype(np.uint64)
    for one in range(1, SPAN - 1):
        for two in range(1, SPAN - one):
            reach = one + two
            at = np.flatnonzero(np.arange(len(chars)) + reach < stop)
            key = (wide[at] << np.uint64(42)) | (wide[at + one] << np.uint64(21)) | wide[at + reach]
            yield at, mix(key), DECAY ** (reach - 2)


def features(chars: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit, hash and weight of every subsequence; a unit's weights have length one."""
    chars, edges = opened(chars, edges)
    unit_of = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    found = [(unit_of[at], key, np.full(len(at), weight)) for at, key, weight in subsequences(chars, edges)]
    unit, key, weight = (np.concatenate(c) for c in zip(*found))
    norm = np.sqrt(np.bincount(unit, weights=weight**2, minlength=len(edges) - 1))
    return unit, key, weight / norm[unit]


@dataclass
class Machine:
    """A weight per hashed subsequence, an offset, and the calibration of a text's margin."""

    weights: np.ndarray
    offset: float
    slope: float = 4.0
    shift: float = 0.0

    def values(self, chars: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """What each unit adds to a sentence, before the offset."""
        chars, edges = opened(chars, edges)
        top = np.zeros(len(chars))
        norm = np.zeros(len(chars))
        mask = np.uint64((1 << FEATURE_BITS) - 1)
        for at, key, weight in subsequences(chars, edges):
            top[at] += weight * self.weights[(key & mask).astype(np.int64)]
            norm[at] += weight * weight
        total = np.add.reduceat(top, edges[:-1])
        size = np.sqrt(np.add.reduceat(norm, edges[:-1]))
        return np.where(size > 0, total / np.where(size > 0, size, 1), 0.0)

    def sentences(self, texts: pa.Array):
        """Sentences of all texts: (units' letters, edges), then for each sentence its first unit, number of units, text and margin.

        Units of fewer than three letters have no features and are passed over.
        """
        code, starts = codes(texts)
        chars, edges, owner = units(code, starts)
        long = np.flatnonzero(np.diff(edges) >= 3)
        if not len(long):
            none = np.zeros(0, np.int64)
            return chars, edges, long, none, none, none, np.zeros(0)
        begin, _, name = words(chars, edges, np.ones(len(chars), bool))
        assert len(begin) == len(edges) - 1
        _, first, back = np.unique(name[long], return_index=True, return_inverse=True)
        one = long[first]
        size = edges[one + 1] - edges[one]
        take = np.repeat(edges[one] - np.cumsum(size) + size, size) + np.arange(size.sum())
        each = self.values(chars[take], np.concatenate([[0], np.cumsum(size)]))[back]
        owner = owner[long]
        held = np.bincount(owner, minlength=len(starts) - 1)
        sums = np.concatenate([[0.0], np.cumsum(each)])
        # One sentence from each unit on that has enough after it; a shorter text is one sentence.
        at = np.arange(len(long))
        left = np.cumsum(held)[owner] - at
        full = (left >= SENTENCE) | ((held[owner] < SENTENCE) & (left == held[owner]))
        at, text = at[full], owner[full]
        count = np.minimum(SENTENCE, held[text])
        return chars, edges, long, at, count, text, (sums[at + count] - sums[at]) / np.sqrt(count) + self.offset

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        """Largest margin of a sentence in each text."""
        *_, text, margin = self.sentences(texts)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, text, margin)
        return np.where(np.isneginf(out), NOTHING, out)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _mapped(names: list[str], columns: np.ndarray, base: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Nyström features of each unit: its kernel with each landmark, from their rows over their subsequences (sorted hashes), times ``root``."""
    out = np.zeros((len(names), root.shape[1]), np.float32)
    across, root = np.ascontiguousarray(base.T, np.float32), root.astype(np.float32)
    for low in range(0, len(names), 100):
        code, edges = codes(pa.array(names[low:low + 100]))
        unit, key, weight = features(code, edges)
        at = np.minimum(np.searchsorted(columns, key), len(columns) - 1)
        ok = np.flatnonzero(columns[at] == key)
        ok = ok[np.argsort(unit[ok], kind="stable")]
        if len(ok):
            begin = np.flatnonzero(np.diff(unit[ok], prepend=-1))
            out[low + unit[ok][begin]] = np.add.reduceat(across[at[ok]] * weight[ok][:, None].astype(np.float32), begin, axis=0) @ root
    return out


def _rows(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    code, edges = codes(pa.array(landmarks))
    unit, key, weight = features(code, edges)
    columns = np.unique(key)
    base = np.zeros((len(landmarks), len(columns)))
    np.add.at(base, (unit, np.searchsorted(columns, key)), weight)
    return columns, base


def fit(positive: list[str], negative: list[str], landmarks: list[str], cost: float = 10.0) -> Machine:
    """Squared-hinge support vector machine on Nyström features of sentences (units with blanks between)."""
    columns, base = _rows(landmarks)
    values, vectors = np.linalg.eigh(base @ base.T)
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])  # K^(-1/2) of the landmarks' kernel
    held, sign = [t.split(" ") for t in positive + negative], np.array([1.0] * len(positive) + [-1.0] * len(negative))
    names = sorted({u for t in held for u in t})
    number = {u: i for i, u in enumerate(names)}
    each = _mapped(names, columns, base, root)
    z = np.ones((len(held), each.shape[1] + 1), np.float32)
    for low in range(0, len(held), 2048):
        part = held[low:low + 2048]
        sizes = np.array([len(t) for t in part])
        rows = each[np.array([number[u] for t in part for u in t])]
        z[low:low + 2048, :-1] = np.add.reduceat(rows, np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]
    del each, held, names, number
    share = np.where(sign > 0, len(sign) / (2 * max(1, len(positive))), len(sign) / (2 * max(1, len(negative))))
    w = np.zeros(z.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):  # Newton steps over the rows inside the margin
        total, wanted = ridge.copy(), np.zeros(len(w))
        for low in range(0, len(z), 2048):
            rows, mine = z[low:low + 2048].astype(np.float64), sign[low:low + 2048]
            c = cost * share[low:low + 2048] * (mine * (rows @ w) < 1)
            total += (rows * c[:, None]).T @ rows
            wanted += rows.T @ (c * mine)
        new = np.linalg.solve(total, wanted)
        done = np.abs(new - w).max() < 1e-8
        w = new
        if done:
            break
    dense = base.T @ (root @ w[:-1])
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    np.add.at(weights, (columns & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64), dense.astype(np.float32))
    return Machine(weights, float(w[-1]))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct units of each labelled text."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            code, starts = codes(part.column(0))
            chars, edges, owner = units(code, starts)
            label = part.column(1).to_pylist()
            text = chars.astype("<u4").tobytes().decode("utf-32-le", "replace")
            seen = {(text[a:b], int(o)) for a, b, o in zip(edges[:-1], edges[1:], owner) if b - a >= 3}
            doc = part.column(2).to_pylist()
            rows = [(u, label[o], doc[o]) for u, o in seen]
            columns = list(zip(*rows)) if rows else [[]] * 3
            kinds = [pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["unit", "toxic", "doc"])


def _chosen(shared):
    """Of each text its most toxic sentence, the most toxic one beside it, and one chosen by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                chars, edges, long, at, count, text, margin = machine.sentences(part.column(part.schema.get_field_index("text")))
                label = np.asarray(part.column(part.schema.get_field_index("toxic")))
                doc = np.asarray(part.column(part.schema.get_field_index("doc")))
                letters = chars.astype("<u4").tobytes().decode("utf-32-le", "replace")
                rows = []
                cut = np.searchsorted(text, np.arange(part.num_rows + 1))
                for t, (a, b) in enumerate(zip(cut, cut[1:])):
                    if a == b:
                        continue
                    best = a + int(margin[a:b].argmax())
                    apart = np.abs(np.arange(a, b) - best) >= SENTENCE
                    picks = [("top", best), ("any", a + int(doc[t]) % (b - a))]
                    if apart.any():
                        picks.append(("next", a + int(np.where(apart, margin[a:b], -np.inf).argmax())))
                    for kind, i in picks:
                        sentence = " ".join(letters[edges[u]:edges[u + 1]] for u in long[at[i]:at[i] + count[i]])
                        rows.append((kind, int(label[t]), sentence, float(margin[i])))
                columns = list(zip(*rows)) if rows else [[]] * 4
                kinds = [pa.string(), pa.int32(), pa.string(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "toxic", "sentence", "margin"])
    return run


def _margin(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                names = part.schema.names
                rest = [part.column(i) for i, n in enumerate(names) if n != "text"]
                margin = pa.array(machine.of_texts(part.column(names.index("text"))), pa.float64())
                yield pa.RecordBatch.from_arrays([*rest, margin], names=[n for n in names if n != "text"] + ["margin"])
    return run


def margins(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``margin`` in place of its ``text``: the largest of the text's sentences."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(_margin(shared), f"{kept}, margin double" if kept else "margin double")


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled texts ``(text, toxic, doc)``: at most ``sample`` of them, half toxic where there are so many, chosen by hash.

    An id's different texts are different samples, equal ones count once,
    however often its row is repeated, so the bound holds for any table.
    """
    once = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = once.where(F.col("doc_id").isNotNull()).withColumn("pick", F.xxhash64(F.lit(17), "doc_id"))
    parts = [rows.where(F.col("toxic") == t).orderBy("pick", "doc_id").limit(sample // 2) for t in (1, 0)]
    chosen = scratch(parts[0].unionByName(parts[1]).select("doc_id", "toxic"), "toxic-labels")
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("name"))
    # The chosen labels are `sample` rows at most, and so are the names chosen of their texts: they go to all executors, and no other text moves.
    names = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "name", "toxic").distinct().withColumn("doc", F.xxhash64(F.lit(17), "doc_id", "name"))
    parts = [names.where(F.col("toxic") == t).orderBy("doc", "doc_id").limit(sample // 2) for t in (1, 0)]
    names = scratch(parts[0].unionByName(parts[1]), "toxic-names")
    found = texts.join(F.broadcast(names), ["doc_id", "name"]).groupBy("doc_id", "name", "toxic", "doc").agg(F.min("text").alias("text"))
    return scratch(found.select("text", "toxic", "doc").repartition(24), "toxic-sample")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Machine:
    """A machine from texts ``(doc_id, text)`` and labels ``(doc_id, toxic)``.

    Fits on :func:`sampled` texts. Units that toxic texts have and clean ones
    lack show which sentences to start from. Then, round by round, a toxic
    text's most toxic sentences are labelled toxic if they may plausibly be the
    reason, a clean text's most toxic one and another are labelled clean, and
    the machine is trained on these labelled sentences. Null labels, ids and
    texts do not count; of an id's labels the highest does. Without a toxic or
    a clean text everything scores as the one label there is.
    """
    texts = sampled(docs, labels, sample)
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        share = 1.0 if 1 in n else 0.0
        return Machine(np.zeros(1 << FEATURE_BITS, np.float32), 0.0, 0.0, 30.0 if share else -30.0)
    found = scratch(texts.mapInArrow(_split, "unit string, toxic int, doc bigint"), "unit-docs")
    stats = scratch(found.groupBy("unit").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "units")
    b, g = F.col("bad") + F.lit(0.5), F.col("good") + F.lit(0.5)
    odds = F.log(b / F.lit(n[1] + 1)) - F.log(g / F.lit(n[0] + 1))
    scored = stats.select("unit", "bad", "good", (odds * F.sqrt("bad")).alias("weight"), F.xxhash64("unit").alias("h"))
    scored = scored.withColumn("odds", odds)
    strongest = scored.where("bad >= 2").agg(F.max("odds")).first()[0] or 0.0
    least = next((m for m in MIN_ODDS if strongest > m), MIN_ODDS[-1])
    top = scored.where((F.col("bad") >= 2) & (F.col("odds") > least)).orderBy(F.desc("weight"), "unit").limit(POSITIVE_UNITS)
    names = scratch(top.select("unit"), "top-units")
    # At most POSITIVE_UNITS lists of at most sample / 2 documents.
    lists = found.where("toxic = 1").join(names, "unit").groupBy("unit").agg(F.collect_set("doc").alias("docs")).toArrow()
    positive = cover({unit: set(docs.values.to_numpy().tolist()) for unit, docs in zip(lists.column("unit").to_pylist(), lists.column("docs"))})
    del lists
    if not positive:
        return Machine(np.zeros(1 << FEATURE_BITS, np.float32), 0.0, 0.0, float(np.log(n[1] / n[0])))
    clean = scored.where(F.col("good") >= 1).where(~F.col("unit").isin(positive))
    common = [r["unit"] for r in clean.orderBy(F.desc("good"), "unit").limit(NEGATIVE_UNITS // 3).collect()]
    other = [r["unit"] for r in clean.orderBy("h", "unit").limit(NEGATIVE_UNITS).collect()]
    negative = list(dict.fromkeys(common + other))
    landmarks = list(dict.fromkeys(positive[:POSITIVE_LANDMARKS // 2] + negative[:NEGATIVE_LANDMARKS]))
    machine = fit(positive, negative, landmarks)
    good: set[str] = set()
    for _ in range(ROUNDS):
        shared = texts.sparkSession.sparkContext.broadcast(machine)
        picked = texts.mapInArrow(_chosen(shared), "kind string, toxic int, sentence string, margin double")
        bad_, any_, next_ = F.col("toxic") == 1, F.col("kind") == "any", F.col("kind") == "next"
        plausible = F.col("margin") > PLAUSIBLE
        wanted = picked.where((bad_ & ~any_ & plausible) | (~bad_ & (~next_ | plausible))).select("toxic", "sentence").distinct()
        chosen = wanted.toArrow()  # three rows a sampled text at most
        toxic = chosen.column("toxic").to_numpy() == 1
        bad = sorted(chosen.column("sentence").filter(pa.array(toxic)).to_pylist())
        good.update(chosen.column("sentence").filter(pa.array(~toxic)).to_pylist())
        if not bad or not good:
            break
        fresh = _telling(machine, bad, POSITIVE_LANDMARKS) + _telling(machine, sorted(good), NEGATIVE_LANDMARKS)
        landmarks = list(dict.fromkeys([*landmarks, *fresh]))[:MOST_LANDMARKS]
        machine = fit(bad, sorted(good), landmarks)
    seen = margins(texts, machine).collect()  # a pair of numbers per sampled text
    x, y = np.array([r["margin"] for r in seen]), np.array([r["toxic"] for r in seen], float)
    machine.slope, machine.shift = calibrate(x, y)
    return machine


def _telling(machine: Machine, sentences: list[str], most: int) -> list[str]:
    """Units of the sentences that the machine finds most toxic."""
    names = sorted({u for t in sentences for u in t.split(" ")})
    code, edges = codes(pa.array(names))
    value = machine.values(code, edges)
    return [names[i] for i in np.argsort(-value, kind="stable")[:most]]


def cover(lists: dict[str, set]) -> list[str]:
    """Units that explain the toxic documents, most telling first.

    Each choice takes the unit with most documents no earlier one explains, so
    ordinary words of a copied toxic text are left out. Ends where a unit would
    explain a single document.
    """
    heap = [(-len(docs), unit) for unit, docs in lists.items()]
    heapq.heapify(heap)
    chosen, done = [], set()
    while heap:
        _, unit = heapq.heappop(heap)
        left = lists[unit] - done
        if len(left) < 2:
            continue
        if heap and len(left) < -heap[0][0]:
            lists[unit] = left
            heapq.heappush(heap, (-len(left), unit))
            continue
        chosen.append(unit)
        done |= left
    return chosen


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift for margins, by Newton steps with softened targets."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    z = np.stack([x, np.ones_like(x)], 1)
    w = np.array([2.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - target) + 1e-3 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
    return float(max(w[0], 0.0)), float(w[1])


def score(docs: DataFrame, machine: Machine, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row: the chance that a text is toxic, and whether it is 0.5 or more.

    Null and empty texts, and texts without units, get the score of the lowest
    margin. Repeated rows get equal scores; other columns are not carried.
    """
    found = margins(docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")), machine)
    logit = F.greatest(F.least(F.col("margin") * F.lit(machine.slope) + F.lit(machine.shift), F.lit(30.0)), F.lit(-30.0))
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return found.select("doc_id", chance.alias("score"), (chance >= 0.5).cast("int").alias("predicted"))


def _clean(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            for part in slices(batch, batch.schema.names[at], SLICE_BYTES):
                chance = machine.probability(machine.of_texts(part.column(at)))
                yield part.filter(pa.array(chance < 0.5))
    return run


def drop_toxic(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`score` predicts as toxic, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.mapInArrow(_clean(shared, docs.columns.index(text)), docs.schema)


def held_out(doc_id: str = "doc_id", remainder: int = 0):
    """Whether crc32 of the id as text leaves ``remainder`` on division by 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == remainder, F.lit(True))
