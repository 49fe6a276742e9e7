"""Benchmark items in documents, also with other numbers, names and units.

Both sides are brought to templates: numbers, names and units become typed placeholders.
Windows of template words, and of the words as they stand, are joined by hash; matches are gathered by item and diagonal;
neighbouring diagonals form an occurrence; and a diagonal whose placeholders do not stand for
the same values as the rest of the occurrence does not count there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity.sources.layers import stage

from .common import lookup, rolling, split_words, whole

#: Words in a window; how many of them must be more than placeholders.
WINDOW, LITERAL = 5, 3
#: An item is in a document if this share of its words is, or so many words in a row.
SIMILAR, RUN = 0.8, 13
#: Diagonals this close to one (words put in or left out) belong to the same occurrence.
NEIGHBOUR = 8

#: Units that count as such after a number (fixed values).
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter "
    "liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years cent cents dollar dollars euro euros mph kmh percent"
).split()
#: Placeholders are control characters, which no word holds otherwise; POINT joins a number's parts.
NUMBER, NAME, UNIT, POINT = "\x01", "\x02", "\x03", "\x04"

A_NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
A_NAME = r"[A-ZÀ-ÖØ-Þ](?<=[a-z0-9,;:\x80-\uFFFF] [A-ZÀ-ÖØ-Þ])[a-zß-öø-ÿ]+(?![A-Za-z0-9\x80-\uFFFF])"
A_UNIT = rf"(?<={NUMBER} ?)(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![A-Za-z0-9\x80-\uFFFF])"
NO_WORD = r"[\x00\x05-\x2F\x3A-\x60\x7B-\x7F]+"


def cleaned(text: Column) -> Column:
    """The text without the characters that stand for placeholders."""
    text = whole(text)
    for mark in (NUMBER, NAME, UNIT, POINT):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return text


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), NO_WORD, " "))


def template(text: Column) -> Column:
    """The words of a text, parted by blanks, with numbers, names and units as placeholders."""
    named = F.regexp_replace(cleaned(text), A_NAME, NAME)
    return spaced(F.regexp_replace(F.regexp_replace(named, A_NUMBER, NUMBER), A_UNIT, UNIT))


def plain(text: Column) -> Column:
    """The same words as they stand, lower-cased: as many as :func:`template` gives."""
    return spaced(F.regexp_replace(cleaned(text), r"(?<=[0-9])[.,](?=[0-9])", POINT))


def windows(rows: DataFrame, text_col: str) -> DataFrame:
    """A row per word: the other columns, ``n_words``, ``pos``, and the words from it on.

    ``w.t`` has them as template words and ``w.p`` as they stand, null behind the last one.
    """
    kept = [c for c in rows.columns if c != text_col]
    both = F.arrays_zip(rolling("_words", WINDOW).alias("t"), rolling("_plain", WINDOW).alias("p"))
    return (
        rows.withColumn("_words", split_words(template(F.col(text_col))))
        .withColumn("_plain", split_words(plain(F.col(text_col))))
        .select(*kept, F.size("_words").alias("n_words"), F.posexplode(both).alias("pos", "w"))
    )


def window_hash(words: str) -> Column:
    return F.xxhash64(*(f"w.{words}.w{j}" for j in range(WINDOW)))


def short_hash(width: int) -> Column:
    """The hash of fewer words than a window has, as they stand."""
    return F.xxhash64(F.lit(width), *(f"w.p.w{j}" for j in range(width)))


def is_slot(word: Column) -> Column:
    """Whether a word or window holds a placeholder."""
    return F.translate(word, NUMBER + NAME + UNIT, "") != word


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Windows of the benchmark as they stand, and as templates if enough words are no placeholders.

    An item shorter than a window is one window of its own ``width``. ``slot`` is whether a
    match may stand for other values than the item's.
    """
    slots = sum(is_slot(F.col(f"w.t.w{j}")).cast("int") for j in range(WINDOW))
    named = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    rows = windows(named, "text").withColumn("width", F.least("n_words", F.lit(WINDOW)))
    short = F.coalesce(*(F.when(F.col("width") == k, short_hash(k)) for k in range(1, WINDOW)))
    fixed = F.struct(F.coalesce(short, window_hash("p")).alias("hash"), F.lit(False).alias("slot"))
    free = F.struct(window_hash("t").alias("hash"), (slots > 0).alias("slot"))
    return (
        rows.where(F.col("pos") + F.col("width") <= F.col("n_words"))
        .withColumn("ways", F.when(slots <= WINDOW - LITERAL, F.array(fixed, free)).otherwise(F.array(fixed)))
        .select(
            "item_id", F.col("n_words").alias("item_words"), F.col("pos").alias("item_pos"), "width", F.inline("ways")
        )
        .distinct()
    )


def text_hashes(widths: list[int]) -> Column:
    """What a word of a document is looked up by: its windows, and those of fewer words if wanted."""
    full, as_template, as_is = F.col(f"w.t.w{WINDOW - 1}").isNotNull(), window_hash("t"), window_hash("p")
    found = F.when(full & (as_template != as_is), F.array(as_template, as_is)).when(full, F.array(as_is))
    if not widths:
        return found
    short = F.array(*(F.when(F.col(f"w.p.w{k - 1}").isNotNull(), short_hash(k)) for k in widths))
    return F.concat(F.coalesce(found, F.array().cast("array<long>")), F.filter(short, lambda h: h.isNotNull()))


def longest_run(places: Column) -> Column:
    """Words that the longest row of consecutive windows covers; ``places`` is sorted."""
    start = F.struct(F.lit(-9).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state: Column, p: Column) -> Column:
        run = F.when(p == state["last"] + 1, state["run"] + 1).otherwise(1)
        return F.struct(p.alias("last"), run.alias("run"), F.greatest(run, state["best"]).alias("best"))

    best = F.aggregate(places, start, step)["best"]
    return F.when(best > 0, F.least(best + (WINDOW - 1), F.col("item_words"))).otherwise(0)


def words_at(places: Column) -> Column:
    """The places of the words that a list of windows covers."""
    last = F.col("item_words") - 1
    return F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, F.least(p + (WINDOW - 1), last)))))


def covered(places: Column) -> Column:
    """How many different words a list of windows covers."""
    return F.size(words_at(places))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The items found in each document: id, ``text_key``, item, ``coverage``, ``run``, ``kind``.

    An item is found if one of its occurrences is sound: a diagonal with those near it, or all
    diagonals of the document together; the best one is reported. ``kind`` is ``exact`` if all
    placeholders stand for the item's own values, ``changed`` if each value of the item was
    replaced by one other value throughout, and ``literal`` if the replacements contradict
    each other and only windows that stand word for word were counted. Case does not count.
    Null and empty texts hold nothing; items of fewer than five words are found word for word
    only; rows that repeat an id are judged one by one, equal items are all named. Empty
    tables give an empty result; other columns are ignored.
    """
    items = stage(item_windows(benchmark, item_col, item_text_col), "benchmark-windows")
    keyed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    )
    widths = [r.width for r in items.where(F.col("width") < WINDOW).select("width").distinct().collect()]
    rows = windows(keyed, "text").select("id", "text_key", "pos", F.explode(text_hashes(sorted(widths))).alias("hash"))
    matches = (
        rows.join(lookup(items, items.count(), 64), "hash")
        .groupBy("id", "text_key", "item_id", "item_words", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
        .agg(
            F.array_sort(F.collect_set("item_pos")).alias("all_at"),
            F.array_sort(F.collect_set(F.when(~F.col("slot"), F.col("item_pos")))).alias("literal_at"),
        )
    )
    whose = ["id", "text_key", "item_id", "item_words"]
    possible = stage(matches.groupBy(*whose).agg(F.collect_list(span()).alias("spans")).where(found("spans")), "candidates")
    near = Window.partitionBy(*whose).orderBy("diagonal").rangeBetween(-NEIGHBOUR, NEIGHBOUR)
    candidates = (
        possible.select(*whose, F.inline("spans"))
        .withColumn("near", F.collect_list(span()).over(near))
        .groupBy(*whose)
        .agg(
            F.collect_list(span()).alias("spans"),
            F.collect_list(F.when(found("near"), F.col("diagonal"))).alias("occurrences"),
        )
    )
    return slots_checked(keyed, benchmark, stage(candidates, "occurrences"), item_col, item_text_col).select(
        F.col("id").alias(id_col), "text_key", "item_id", "coverage", "run", "kind"
    )


def span() -> Column:
    return F.struct("diagonal", "all_at", "literal_at")


def share(places: Column) -> Column:
    """Share of an item's words that lists of windows cover."""
    return covered(F.flatten(places)) / F.col("item_words")


def longest(places: Column) -> Column:
    """The longest run in any of several lists of windows, 0 without a list."""
    return F.coalesce(F.array_max(F.transform(places, longest_run)), F.lit(0))


def found(spans: str) -> Column:
    """Whether spans hold enough of an item, whatever the placeholders stand for."""
    at = F.transform(spans, lambda s: s["all_at"])
    return (share(at) >= SIMILAR) | (longest(at) >= RUN)


def slots_checked(keyed: DataFrame, benchmark: DataFrame, candidates: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Compares what the placeholders stand for, in the few documents that hold an item's template."""
    theirs = candidates.withColumnsRenamed({"id": "_id", "text_key": "_key"})
    count = candidates.count()
    items = benchmark.select(
        F.col(item_col).alias("_item"),
        split_words(template(F.col(text_col))).alias("item_template"),
        split_words(plain(F.col(text_col))).alias("item_plain"),
    )
    slots = F.filter(F.sequence(F.lit(0), F.size("item_template") - 1), lambda i: is_slot(F.get("item_template", i)))

    def pairs(span: Column) -> Column:
        at = words_at(span["all_at"])
        return F.transform(
            F.filter("slots", lambda i: F.array_contains(at, i)),
            lambda i: F.struct(
                F.get("item_template", i).alias("kind"),
                F.get("item_plain", i).alias("was"),
                F.get("plain", i + span["diagonal"]).alias("now"),
            ),
        )

    rows = (
        keyed.join(
            lookup(theirs, count, 1200), F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
        )
        .join(items, F.col("item_id").eqNullSafe(F.col("_item")))
        .withColumn("plain", split_words(plain(F.col("text"))))
        .withColumn("slots", slots)
    )

    def agree(pairs: Column) -> Column:
        return F.size(F.array_distinct(F.transform(pairs, lambda p: F.struct(p["kind"], p["was"])))) == F.size(pairs)

    def judged(spans: Column) -> Column:
        """What the spans amount to, taken in order: those that contradict earlier ones are left out."""
        places = F.transform(spans, lambda s: s["all_at"])
        start = F.struct(F.slice(places, 1, 0).alias("at"), F.slice(pairs(F.get(spans, F.lit(0))), 1, 0).alias("pairs"))

        def step(state: Column, s: Column) -> Column:
            more = F.array_distinct(F.concat(state["pairs"], pairs(s)))
            taken = F.struct(F.concat(state["at"], F.array(s["all_at"])).alias("at"), more.alias("pairs"))
            return F.when(agree(more), taken).otherwise(state)

        def result(state: Column) -> Column:
            own = F.forall(state["pairs"], lambda p: p["was"] == p["now"])
            return F.array(
                verdict(F.when(own, 2).otherwise(1), state["at"]),
                verdict(F.lit(0), F.transform(spans, lambda s: s["literal_at"])),
            )

        return F.aggregate(spans, start, step, result)

    def verdict(rank: Column, at: Column) -> Column:
        return F.struct(rank.alias("rank"), share(at).alias("coverage"), longest(at).alias("run"))

    def ordered(spans: Column, first: Column) -> Column:
        """The diagonal that an occurrence is seen from, then those of most windows first."""
        keyed = lambda s: F.struct((s["diagonal"] != first).alias("other"), (-F.size(s["all_at"])).alias("size"), s.alias("s"))
        return F.transform(F.array_sort(F.transform(spans, keyed)), lambda k: k["s"])

    pooled = F.array(ordered(F.col("spans"), F.lit(-1 << 31)))
    close = lambda d: F.filter("spans", lambda s: F.abs(s["diagonal"] - d) <= NEIGHBOUR)
    each = F.transform("occurrences", lambda d: ordered(close(d), d))
    verdicts = F.flatten(F.transform(F.concat(each, pooled), judged))
    sound = F.filter(verdicts, lambda v: (v["coverage"] >= SIMILAR) | (v["run"] >= RUN))
    return (
        rows.withColumn("best", F.array_max(sound))
        .where("best IS NOT NULL")
        .withColumn("kind", F.element_at(F.array(*map(F.lit, ("literal", "changed", "exact"))), F.col("best.rank") + 1))
        .select("*", "best.coverage", "best.run")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which no item was found; columns unchanged."""
    hit = (
        contaminated(docs, benchmark, id_col, text_col)
        .select(F.col(id_col).alias("_id"), F.col("text_key").alias("_key"))
        .distinct()
    )
    hit = stage(hit, "contaminated")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key")
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return rows.join(lookup(hit, hit.count(), 32), same, "left_anti").select("row.*")
