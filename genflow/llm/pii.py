"""Personal data by candidates and gradient-boosted trees, in DataFrame operations only.

Generators propose spans, more than are right and some that overlap. Spans
that pass a base rule always count. The others are judged by boosted trees on
their format and context, against a threshold for each kind, calibrated on
candidates the trees have not seen. What the trees learn from is a check that
their features do not show: the check digit of a card, the range of an
address's parts, how a phone number's codes begin, whether a mail domain's
ending is one that other documents use.

Every match is a row once it is found: positions are running sums over a
text's matches, so work is in proportion to the text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import scratch, whole
from .sharding import _numbered

# The base kinds as listed, in the JVM's pattern language. Runs are
# possessive and start where a run starts (or the last match ended), which finds the
# same spans as plain runs in linear time.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Only runs of 16 to 19 digits can pass, so no other run becomes a match.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators with looser formats, each named after the kind it may hold.
LIKE = {
    "email_like": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{{1,63}}\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z]{{2,24}}",
    "ip_like": r"(?<![0-9.,])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9])",
    "card_like": r"(?<![0-9])[0-9]{3,6}(?:[\x20.-][0-9]{3,6}){2,4}(?![0-9])",
    "phone_like": r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
KINDS = (*BASE, *LIKE)
CONTEXT = {"mail": "mail|write|contact|@", "call": "phone|call|tel|mobile|fax", "card": "card|visa|credit|pay|account",
           "net": "ip|host|server|address|login"}
BEFORE, AFTER = 32, 12
# Code points that are no characters mark where matches start and end; a text's own become a third one.
_START, _END, _OTHER = "\ufdd0", "\ufdd1", "\ufdd2"
#: One candidate in so many, by hash, is kept from the trees and sets the thresholds; all others teach them.
HELD_OUT = 5
TREES, DEPTH = 12, 4
#: Candidates of one training task, and least tasks.
TASK_ROWS, LEAST_TASKS = 50_000, 4
#: Share of right redactions that a kind's threshold must reach on held-out candidates, and how many of these it takes.
PRECISION, LEAST_HELD = 0.98, 20
#: No span of a looser generator is longer.
LONGEST_LIKE = 192


def _marked(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, f"({pattern})", f"{_START}$1{_END}")


def _matches(marked: Column, kind: str) -> Column:
    """Each marked place in order: characters since the match before, its size, text and surroundings up to its neighbours."""
    parts = F.split(marked, _START)
    rest = lambda part: F.substring_index(part, _END, -1)

    def one(before, part):
        match, gap = F.substring_index(part, _END, 1), rest(before)
        return F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(match).alias("size"), match.alias("match"),
                        F.lower(F.right(gap, F.lit(BEFORE))).alias("left"), F.left(rest(part), F.lit(AFTER)).alias("right"))

    found = F.zip_with(F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts) - 1), one)
    return F.when(F.contains(marked, F.lit(_START)), found).otherwise(
        F.array().cast("array<struct<kind:string,gap:int,size:int,match:string,left:string,right:string>>"))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def value(i):
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The base rule of a kind, for a match of its pattern."""
    count = F.length(_digits(match))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.when(count.between(16, 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(8, 15)
    return F.lit(True)


def holds(kind: str, match: Column, endings: Column) -> Column:
    """The hidden check of a looser kind; ``endings`` says whether a mail domain's ending occurs among base mails."""
    digits = _digits(match)
    if kind == "ip_like":
        return F.forall(F.split(match, "[.,]"), lambda part: part.cast("int") <= 255)
    if kind == "card_like":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone_like":
        return digits.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$")
    return endings


def _ending(match: Column) -> Column:
    return F.lower(F.regexp_extract(match, "([A-Za-z]+)$", 1))


def _by_kind(checks: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(F.col("kind") == kind, check) for kind, check in checks.items()], F.lit(False))


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Documents ``(nid, doc_id)`` and the candidates of all generators, a row each.

    A candidate has its document's ``nid``, kind, start, end, whether it is a
    ``base`` span, whether its check ``holds``, and its features, none of which
    shows that check. Null and empty texts have none. Stored without the texts.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.translate(whole(text), _START + _END, _OTHER * 2).alias("_t"))
    listed = plain.select("doc_id", F.concat(*[_matches(_marked(F.col("_t"), p), k) for k, p in (BASE | LIKE).items()]).alias("found"))
    stored = _numbered(scratch(listed, "pii-matches"))
    rows = stored.select("nid", F.posexplode("found").alias("at", "m")).select("nid", "at", "m.*")
    so_far = Window.partitionBy("nid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    placed = rows.select("nid", "kind", (end - F.col("size")).cast("int").alias("start"), end.cast("int").alias("end"), "match", "left", "right", "size")
    match, size = F.col("match"), F.col("size")

    def times(sign: str) -> Column:
        return size - F.length(F.replace(match, F.lit(sign), F.lit("")))

    numbers = [
        size, F.size(F.split(match, "[^0-9A-Za-z]+")), F.length(F.regexp_replace(match, "[^A-Za-z]", "")), match.startswith("+").cast("int"),
        times("@"), times("."), times("-"), times(" "), size - F.length(F.regexp_replace(match, r"[()\[\]]", "")),
        F.col("left").rlike("[a-z0-9._-]$").cast("int"), F.col("right").rlike("^[A-Za-z0-9_-]").cast("int"),
        F.length(F.regexp_replace("left", "[^0-9]", "")), F.length(F.regexp_replace("right", "[^0-9]", "")),
        *[F.col("left").rlike(words).cast("int") for words in CONTEXT.values()],
        # A span may be proposed as several kinds, with its own chance as each.
        *[F.col("kind").isin(k, f"{k}_like").cast("int") for k in BASE],
    ]
    rule = _by_kind({k: passes(k, match) for k in BASE})
    described = scratch(placed.select("nid", "kind", "start", "end", "match", rule.alias("base"),
                                      F.array(*[n.cast("float") for n in numbers]).alias("features")), "pii-candidates")
    endings = described.where("kind = 'email'").select(_ending(match).alias("ending")).where("ending <> ''").distinct()
    known = described.join(endings, _ending(match) == F.col("ending"), "left")
    holding = _by_kind({k: passes(k, match) for k in BASE} | {k: holds(k, match, F.col("ending").isNotNull()) for k in LIKE})
    return stored.select("nid", "doc_id"), known.select("nid", "kind", "start", "end", "base", holding.alias("holds"), "features")


FEATURES = 13 + len(CONTEXT) + len(BASE)


def _vectors(rows: DataFrame) -> DataFrame:
    names = [f"f{i}" for i in range(FEATURES)]
    wide = rows.select("*", *[F.col("features")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return VectorAssembler(inputCols=names, outputCol="vector").transform(wide).drop(*names)


def train(found: DataFrame) -> tuple[GBTClassificationModel | None, dict[str, float], list[dict]]:
    """Trees, a threshold for each kind, and a report, from the candidates of all kinds; what holds its check is right.

    Every candidate counts, however many there are: four fifths, by hash, teach
    the trees, and the other fifth sets the thresholds. A kind has none if too
    few are held out or none is precise enough. The report has each kind's
    threshold, precision, recall and number of held-out candidates.
    """
    named = found.select("kind", F.col("holds").cast("int").alias("label"), "features",
                         (F.pmod(F.xxhash64("nid", "kind", "start"), F.lit(HELD_OUT)) == 0).alias("held"))
    learning = [r["n"] for r in named.where(~F.col("held")).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()]
    if len(learning) < 2:
        return None, {}, []
    taught = sum(learning)
    data = _vectors(named.coalesce(max(LEAST_TASKS, taught // TASK_ROWS)))
    # Spark looks for splits in max(bins * bins, 10,000) rows, a square below 2^31: with these bins in all of them.
    model = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7,
                          maxBins=min(max(32, math.isqrt(taught) + 1), 46_340)).fit(data.where(~F.col("held")))
    bins = model.transform(data.where("held")).select("kind", F.floor(vector_to_array("probability")[1] * 100).alias("bin"), "label")
    rows = bins.groupBy("kind", "bin").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")).collect()  # 101 rows a kind at most
    thresholds, report = {}, []
    for kind in KINDS:
        mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: -r["bin"])
        right = n = 0
        best = None
        for row in mine:
            right, n = right + row["right"], n + row["n"]
            if right >= PRECISION * n and row["bin"] >= 50:
                best = (row["bin"] / 100, right / n, right)
        if best and n >= LEAST_HELD:
            thresholds[kind] = best[0]
        if mine:
            report.append({"kind": kind, "threshold": thresholds.get(kind), "precision": best[1] if best else None,
                           "recall": best[2] / right if best and right else None, "held_out": n})
    return model, thresholds, report


def _beaten(judged: DataFrame) -> DataFrame:
    """Spans that a likelier one overlaps (of equally likely ones the first by start, end, kind). Spans meet in cells of their greatest length."""
    cell = F.floor(F.col("start") / LONGEST_LIKE)
    rank = F.struct(-F.col("p"), F.col("start"), F.col("end"), F.col("kind"))
    celled = judged.select("nid", "kind", "start", "end", rank.alias("rank"),
                           F.explode(F.array_distinct(F.array(cell, F.floor((F.col("end") - 1) / LONGEST_LIKE)))).alias("cell"))
    a, b = celled.alias("a"), celled.alias("b")
    meet = (F.col("a.nid") == F.col("b.nid")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("b.start") < F.col("a.end")) & (
        F.col("a.start") < F.col("b.end")) & (F.col("b.rank") < F.col("a.rank"))
    return a.join(b, meet, "left_semi").select("a.nid", "a.kind", "a.start").distinct()


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, spans)`` for every row; spans are structs of kind, start, end and ``base``.

    Base spans all stay. Added ones come from the looser generators, never
    overlap a base span, and passed their kind's threshold; an added span that
    a likelier one overlaps goes. Null and empty texts have no spans; repeated
    rows get equal spans; other columns are not carried.
    """
    names, found = candidates(docs, text, doc_id)
    found = scratch(found, "pii-found")
    model, thresholds, _ = train(found)
    sure = found.where("base").select("nid", "kind", "start", "end", "base")
    likely = {k: t for k, t in thresholds.items() if k in LIKE}
    if likely:
        # A base span that starts before and ends after a candidate's start, or starts inside it, overlaps it.
        low = Window.partitionBy("nid").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        high = Window.partitionBy("nid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        near = found.where(F.col("base") | F.col("kind").isin(*likely)).select(
            "*", F.max(F.when(F.col("base"), F.col("end"))).over(low).alias("until"), F.min(F.when(F.col("base"), F.col("start"))).over(high).alias("next"))
        free = near.where(~F.col("base") & (F.coalesce("until", F.lit(0)) <= F.col("start")) & (F.coalesce("next", "end") >= F.col("end")))
        p = vector_to_array("probability")[1]
        judged = model.transform(_vectors(free)).select("nid", "kind", "start", "end", p.alias("p")).where(
            _by_kind({k: F.col("p") >= t for k, t in likely.items()}))
        judged = scratch(judged, "pii-judged")
        added = judged.join(_beaten(judged), ["nid", "kind", "start"], "left_anti").select("nid", "kind", "start", "end", F.lit(False).alias("base"))
        sure = sure.unionByName(added)
    spans = sure.groupBy("nid").agg(F.collect_list(F.struct("kind", "start", "end", "base")).alias("spans"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,base:boolean>>")
    return names.join(spans, "nid", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text, by kind as listed, then start; a row per row of :func:`find`, without spans zeros and empty texts."""
    def listed(spans: Column, kinds: Sequence[str]) -> Column:
        by_kind = [F.array_sort(F.transform(_of_kind(spans, k), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))) for k in kinds]
        return F.array_join(F.transform(F.concat(*by_kind), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(_of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("spans"), tuple(BASE)).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans"), KINDS).alias("spans"))
