"""Personal data: patterns, and terms that reveal what the patterns found.

Base kinds are emails, IPv4 addresses, payment cards and phone numbers. Their values are the
protected entities. The corpus then tells how strongly a term of an entity's texts reveals it:
the lower confidence bound (Wilson) of the probability that a text with the term holds the
entity. It must reach ``disclosure``, and be twice the share of all texts that hold the entity,
so that the term tells at least one bit about it. The bound rises with the texts that agree and
does not depend on the size of the corpus. A single text never reaches the default, as each text
has words of its own, with or without a value; two that agree do.

Copies and near copies are no second evidence. Each text has three sketches, the smallest of a
hash over all pairs of consecutive words. The texts of an entity that share a sketch, directly
or over others, are one class, and classes are counted; texts with the term but without the
entity count by their first sketch.

Terms that reach ``disclosure`` become spans of the kind ``term`` wherever they occur. In the
sanitised text base values are generalised to their kind; disclosing terms are generalised to
``[term]``, or removed if they reach ``removal``.

Only DataFrame functions are used. Expressions are written so that the regular-expression
engine neither recurses nor tries a run of characters from each of its places, so texts of
any length pass. Terms are all whole words of a text outside its values. Rows of (entity, term,
class) are made only of entities that enough classes hold, and aggregated; the whole corpus is
then searched only for the terms that can still reach the bound.

Edge cases: a null text is an empty one without spans; equal texts have equal spans, however
often they occur; rows without an id have a row each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.functions.tables import sized
from treewatt.llm.common import Scratch
from treewatt.llm.components import components

KINDS = ("email", "ip", "card", "phone")
LOCAL, DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# A match may only begin where the one before ended or where a run begins; runs are never
# given back, as what follows them can't be in them.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{DOMAIN}]++(?:\.[{DOMAIN}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}]++"
DISCLOSURE = 0.4
REMOVAL = 0.9
DEVIATIONS = 1.645  # one-sided confidence of 95 %
GAIN = 2.0  # times the share of all texts that hold the entity: one bit
BROADCAST_ROWS = 500_000  # of a few numbers or a word each
LONGEST_TERM = 64  # code points; longer words are data, not names
SPANS = "array<struct<start:int,stop:int,value:string>>"


def matches(text: Column, pattern: Column) -> Column:
    """(start, stop, value) of all matches, in code points, stop exclusive.

    The pieces between the matches and the matches themselves give the places.
    """
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(values)).alias("gap"), values.alias("value")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def further(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["value"])
        span = F.struct(begin.alias("start"), end.alias("stop"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    found = F.aggregate(pieces, start, further, lambda state: state["spans"])
    return F.when(F.size(values) > 0, found).otherwise(F.array().cast(SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """From the right every second digit is doubled, with its digits added."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    )
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10 == 0


def accepted(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(
            parts, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(False)
        )
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def with_base_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """(keep, body, email, ip, card, phone): the accepted spans of each kind."""
    rows = docs.select("keep", F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    for kind, pattern in PATTERNS.items():
        found = matches(F.col("body"), F.lit(pattern))
        rows = rows.withColumn(f"all_{kind}", found)
    return rows.select(
        "keep",
        "body",
        *[_kept(kind) for kind in KINDS],
    )


def _kept(kind: str) -> Column:
    return F.filter(f"all_{kind}", lambda s: accepted(kind, s["value"])).alias(kind)


def labelled(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")),
    )


def lower_bound(together: Column, texts: Column, deviations: float) -> Column:
    """Of the probability behind so many hits among so many texts."""
    square = deviations * deviations
    share = together / texts
    spread = F.sqrt(share * (1 - share) / texts + square / (4 * texts * texts))
    return (share + square / (2 * texts) - deviations * spread) / (1 + square / texts)


def _words(column: Column) -> Column:
    return F.regexp_extract_all(column, F.lit(TERM), F.lit(0))


def _sketch(words: str, number: int) -> Column:
    """The smallest of the number-th hash of two consecutive words."""

    def hashed(word: Column, i: Column) -> Column:
        after = F.get(words, i + 1)
        return F.xxhash64(*((word, after), (after, word), (word, after, word))[number])

    least = F.array_min(F.transform(words, hashed))
    return F.coalesce(least, F.lit(0)).alias(f"sketch_{number}")


def _judged(pairs: DataFrame, texts: str, disclosure: float, deviations: float) -> DataFrame:
    """Of (entity, term, share, together, own) those that reach the bounds, with their strength.

    texts has the sketches of the texts with the term, own those of them with the entity.
    """
    without = F.greatest(F.col(texts) - F.col("own"), F.lit(0))
    strength = lower_bound(F.col("together"), F.col("together") + without, deviations)
    return pairs.withColumn("strength", strength).where(
        (F.col("strength") >= disclosure) & (F.col("strength") >= GAIN * F.col("share"))
    )


def term_candidates(
    found: DataFrame, total: int, scratch: Scratch, disclosure: float, deviations: float
) -> DataFrame:
    """(entity, term, share, together, own): terms that reveal an entity, judged by the texts
    with values alone.

    A term has at least as many sketches in all texts as in those, so none that reaches the
    bounds in the end is lost.
    """
    spans = F.flatten(F.array(*KINDS))
    values = scratch.write(
        found.where(F.size(spans) > 0)
        .select(
            "text_hash",
            F.array_distinct(F.transform(spans, lambda s: F.xxhash64(s["value"]))).alias("entities"),
            _words(_replaced(_cut())).alias("outside"),
            _words(F.col("body")).alias("words"),
        )
        .select(
            "text_hash",
            "entities",
            *[_sketch("words", i) for i in range(3)],
            F.array_distinct(
                F.filter("outside", lambda w: F.length(w).between(2, LONGEST_TERM))
            ).alias("terms"),
        ),
        "values",
    )
    # Classes that a term needs at least, all of them with the entity: two at the default.
    least = disclosure * deviations * deviations / (1 - disclosure)
    sketches = [f"sketch_{i}" for i in range(3)]
    held = values.select("text_hash", *sketches, F.explode("entities").alias("entity"))
    share = F.count(F.lit(1)) / total
    entities = scratch.write(
        held.groupBy("entity")
        .agg(share.alias("share"), F.min("text_hash").alias("one"), F.max("text_hash").alias("other"))
        .where((F.col("one") != F.col("other")) & (GAIN * F.col("share") <= 1))
        .select("entity", "share"),
        "entities",
    )
    several = held.join(sized(entities, entities.count(), BROADCAST_ROWS), "entity").distinct()
    carriers = scratch.write(_with_classes(several, least, scratch), "carriers")
    asked = carriers.select("text_hash").distinct()
    words = (
        values.join(sized(asked, asked.count(), BROADCAST_ROWS), "text_hash", "left_semi")
        .select("text_hash", F.explode("terms").alias("term"))
        .distinct()
    )
    pairs = words.join(carriers, "text_hash")
    own = (
        pairs.select("entity", "term", "sketch_0")
        .distinct()
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    together = scratch.write(
        pairs.select("entity", "share", "term", "text_class")
        .distinct()
        .groupBy("entity", "share", "term")
        .agg(F.count(F.lit(1)).alias("together"))
        .where(F.col("together") >= least)
        .join(own, ["entity", "term"]),
        "together",
    )
    asked = together.select("term").distinct()
    beside = (
        values.select("sketch_0", F.explode("terms").alias("term"))
        .join(sized(asked, asked.count(), BROADCAST_ROWS), "term", "left_semi")
        .distinct()
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("beside"))
    )
    judged = _judged(together.join(beside, "term"), "beside", disclosure, deviations)
    return scratch.write(judged.select("entity", "term", "share", "together", "own"), "candidates")


def _with_classes(carriers: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Adds text_class, which texts of an entity have in common that share a sketch; only of
    entities with so many classes."""
    nodes = [
        F.xxhash64("entity", F.lit(f"{i}"), f"sketch_{i}").alias(f"node_{i}") for i in range(3)
    ]
    named = carriers.select("*", *nodes)
    links = named.select("node_0", "node_1").union(named.select("node_0", "node_2"))
    roots = components(links, scratch, "classes")
    classed = scratch.write(
        named.join(roots, F.col("node_0") == F.col("node")).select(
            *carriers.columns, F.col("root").alias("text_class")
        ),
        "classed",
    )
    enough = (
        classed.select("entity", "text_class")
        .distinct()
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("classes"))
        .where(F.col("classes") >= least)
        .select("entity")
    )
    return classed.join(enough, "entity", "left_semi")


def term_places(
    texts: DataFrame, candidates: DataFrame, scratch: Scratch, disclosure: float, deviations: float
) -> DataFrame:
    """(text_hash, places, removed) of the texts that hold disclosing terms.

    places are the numbers of words; removed has the terms among them that reach REMOVAL.
    """
    terms = candidates.select("term").distinct()
    hits = scratch.write(
        texts.select("text_hash", _words(F.col("body")).alias("words"))
        .select("text_hash", "words", _sketch("words", 0))
        .select("text_hash", "sketch_0", F.posexplode("words").alias("place", "term"))
        .join(sized(terms, terms.count(), BROADCAST_ROWS), "term"),
        "hits",
    )
    counted = (
        hits.select("term", "sketch_0").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    )
    strengths = scratch.write(
        _judged(candidates.join(counted, "term"), "texts", disclosure, deviations)
        .groupBy("term")
        .agg(F.max("strength").alias("strength")),
        "terms",
    )
    named = hits.join(sized(strengths, strengths.count(), BROADCAST_ROWS), "term")
    return scratch.write(
        named.groupBy("text_hash").agg(
            F.array_sort(F.collect_set("place")).alias("places"),
            F.collect_set(F.when(F.col("strength") >= REMOVAL, F.col("term"))).alias("removed"),
        ),
        "places",
    )


def _spans_at(words: str, gaps: str, places: str) -> Column:
    """(start, stop, value) of the words with these numbers; gaps stand before, between and
    after the words."""
    start = F.struct(
        F.lit(0).alias("next"), F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")
    )

    def length(column: str, state: Column, count: Column) -> Column:
        part = F.slice(column, state["next"] + 1, count)
        return F.aggregate(part, F.lit(0), lambda n, x: n + F.length(x))

    def further(state: Column, place: Column) -> Column:
        skipped = place - state["next"]
        begin = state["at"] + length(gaps, state, skipped + 1) + length(words, state, skipped)
        word = F.get(words, place)
        end = begin + F.length(word)
        span = F.struct(begin.alias("start"), end.alias("stop"), word.alias("value"))
        return F.struct(
            (place + 1).alias("next"),
            end.alias("at"),
            F.concat(state["spans"], F.array(span)).alias("spans"),
        )

    return F.aggregate(places, start, further, lambda state: state["spans"])


def with_all_spans(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    disclosure: float = DISCLOSURE,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """(keep, body, email, ip, card, phone, term, removed) per row.

    term has the spans of disclosing terms, and removed the terms among them that reach
    REMOVAL.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    chosen = docs.select(F.struct(*keep).alias("keep"), F.col(text_col).alias("text"))
    found = with_base_spans(chosen, "text").withColumn("text_hash", F.xxhash64("body"))
    candidates = term_candidates(found, docs.count(), scratch, disclosure, deviations)
    none = {"term": F.array().cast(SPANS), "removed": F.array().cast("array<string>")}
    if candidates.isEmpty():
        return found.withColumns(none).drop("text_hash")
    bodies = chosen.select(F.coalesce("text", F.lit("")).alias("body"))
    texts = bodies.withColumn("text_hash", F.xxhash64("body"))
    held = term_places(texts, candidates, scratch, disclosure, deviations)
    joined = found.join(sized(held, held.count(), BROADCAST_ROWS), "text_hash", "left")
    has = F.col("places").isNotNull()
    cut = joined.select(
        "keep",
        "body",
        *KINDS,
        "places",
        "removed",
        F.when(has, _words(F.col("body"))).alias("words"),
        F.when(has, F.split("body", TERM, -1)).alias("gaps"),
    )
    return cut.select(
        "keep",
        "body",
        *KINDS,
        F.when(has, _spans_at("words", "gaps", "places")).otherwise(none["term"]).alias("term"),
        F.coalesce("removed", none["removed"]).alias("removed"),
    )


def sanitised(found: DataFrame) -> DataFrame:
    """The rows of with_all_spans with ``clean``: the text without what its spans show.

    Where spans overlap the one that begins first stands for both.
    """
    parts = [_shown(kind) for kind in KINDS]
    parts.append(
        F.transform(
            "term",
            lambda s: F.struct(
                s["start"].alias("start"),
                s["stop"].alias("stop"),
                F.when(F.array_contains("removed", s["value"]), F.lit("")).otherwise("[term]").alias("shown"),
            ),
        )
    )
    return found.withColumn("clean", _replaced(F.concat(*parts)))


def _replaced(spans: Column) -> Column:
    """The body with what each span (start, stop, shown) shows in its place."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def further(state: Column, span: Column) -> Column:
        gap = F.substr(F.col("body"), state["at"] + 1, span["start"] - state["at"])
        return F.when(
            span["start"] >= state["at"],
            F.struct(span["stop"].alias("at"), F.concat(state["out"], gap, span["shown"]).alias("out")),
        ).otherwise(
            F.struct(F.greatest(state["at"], span["stop"]).alias("at"), state["out"].alias("out"))
        )

    return F.aggregate(
        F.array_sort(spans), start, further, lambda s: F.concat(s["out"], F.substr(F.col("body"), s["at"] + 1))
    )


def _cut() -> Column:
    """All base spans, with a line break to show."""
    return F.concat(
        *[
            F.transform(
                kind,
                lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit("\n").alias("shown")),
            )
            for kind in KINDS
        ]
    )


def _shown(kind: str) -> Column:
    return F.transform(
        kind,
        lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), F.lit(f"[{kind}]").alias("shown")
        ),
    )


def op4_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = with_all_spans(docs, ["doc_id"])
    base = F.array_join(F.concat(*[labelled(k, F.col(k)) for k in KINDS]), ",")
    spans = F.array_join(F.concat(*[labelled(k, F.col(k)) for k in (*KINDS, "term")]), ",")
    return found.select(
        F.col("keep.doc_id").alias("doc_id"),
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        spans.alias("spans"),
    )
